"""Time the headline queries; prints one JSON line.

Each query is run to completion into the no-op sink: one warm-up, then the median of three runs.
`comparison` times the same checks made rule by rule, with two counts per rule, as a check of what the
single pass is worth on this machine.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barsieve.functions.predicates import all_present
from barsieve.operators.quality import Labels, column_rules, duplicate_key_failures, null_key_failures, rule_failures
from barsieve.plans import queries as q
from barsieve.plans import views
from barsieve.scratch import scratch_path
from barsieve.sources.snapshots import read_snapshots

HEADLINE = [
    "gold_monthly",
    "gold_month_close_full",
    "gold_ticks",
    "gold_ticks_full",
    "failed_report",
    "passed_null_key",
    "passed_strict",
    "rule_duplicate_key",
    "rule_duplicate_hot_key",
    "except_all_surplus",
    "dedup_keep_first",
    "profile_constant_columns",
    "silver_typed",
    "metadata_spec",
    "missing_dates",
    "ingest_audit",
    "reconcile_equal",
    "quality_job",
    "incremental_check",
]
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no recording of the Python line behind every expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run: Callable[[], object], runs: int = RUNS) -> float:
    run()
    taken = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def rule_by_rule(spark: SparkSession, sf_dir: str) -> None:
    """The report one rule at a time: each rule is counted, and counted again with the union so far."""
    df, labels = views.dirty(spark, sf_dir), Labels(q.SOURCE, q.TARGET, tuple(q.DIRTY_KEYS))
    present = df.where(all_present(q.DIRTY_KEYS))
    reports = [null_key_failures(df, labels), duplicate_key_failures(present, labels)]
    reports += [rule_failures(present, [r], labels) for r in column_rules(q._specs(spark, q.DIRTY_METADATA), q.DIRTY_KEYS)]
    union = None
    for report in reports:
        report.count()
        if report.count() > 0:
            union = report if union is None else union.unionByName(report)
    drain(union)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    registered = q.all_queries()
    times = {name: seconds(lambda n=name: drain(registered[n](spark, sf_dir))) for name in HEADLINE}

    files = scratch_path(spark, "bench-snapshots")
    views.write_snapshot_files(views.snapshot_rows(spark, sf_dir), files)
    times["mkt_decode_read"] = seconds(lambda: drain(read_snapshots(spark, files, "*.gz")))

    by_rule = seconds(lambda: rule_by_rule(spark, sf_dir), 1)
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries, median of three warm runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
                "spark": spark.version,
                "comparison": {"failed_report_rule_by_rule": by_rule},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
