"""The registered queries: each takes the session and a folder of tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsieve.functions.days import day_folder
from barsieve.functions.declared import ColumnSpec, column_specs, key_columns, mandatory_columns, parse_specs
from barsieve.functions.predicates import all_present
from barsieve.operators import calendar, profile
from barsieve.operators.duplicates import except_all, keep_first
from barsieve.operators.gold import monthly_bars, ordered_by_day
from barsieve.operators.quality import (
    CheckResult,
    Labels,
    check,
    duplicate_key_failures,
    length_rule,
    null_key_failures,
    rule_failures,
    type_rule,
)
from barsieve.operators.reconcile import row_counts, written_counts
from barsieve.operators.silver import project_bars, typed, typed_bars
from barsieve.plans import views
from barsieve.plans.datasets import Dataset, run_listed
from barsieve.schemas import SNAPSHOT_SCHEMA, STAGED_BAR_COLUMNS
from barsieve.scratch import scratch_path
from barsieve.sources.archives import list_archives, scan_staged_entries, stage_entries, unzip_rows
from barsieve.sources.csv import read_by_name, scan_csv
from barsieve.sources.published import read_published
from barsieve.sources.snapshots import read_snapshots
from barsieve.sources.streamed import stream_archive_rows, stream_snapshots
from barsieve.sources.tables import create_table, overwrite, read_table, stage_csv
from barsieve.streaming.ingest import ingest, ingest_checked, new_files

Query = Callable[[SparkSession, str], DataFrame]

SOURCE, TARGET = "events", "events_checked"
DIRTY_KEYS = ["symbol", "d"]
DIRTY_METADATA = [
    ("event_id", "BIGINT", None, False, False),
    ("symbol", "VARCHAR(3)", None, True, True),
    ("px", "DECIMAL(5,2)", None, False, False),
    ("d", "DATE", "'DD-MON-YYYY'", True, True),
]
ODD_METADATA = [
    ("event_id", "SMALLINT", None, False, False),
    ("symbol", "VARCHAR(3)", None, True, True),
    ("px", "DATETIME", None, False, False),
    ("d", "DATE", "'DD.MM.YYYY'", False, False),
]


def _specs(spark: SparkSession, metadata: list[tuple[str, str, str | None, bool, bool]]) -> list[ColumnSpec]:
    return column_specs(views.metadata_frame(spark, metadata), [m[0] for m in metadata])


def _check_dirty(spark: SparkSession, sf_dir: str) -> CheckResult:
    return check(views.dirty(spark, sf_dir), _specs(spark, DIRTY_METADATA), SOURCE, TARGET)


def _dirty_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.dirty(spark, sf_dir).where(all_present(DIRTY_KEYS))


def _one_rule(view: Callable, keys: list[str], column: str, declared: str, which: str, mandatory=False, fmt=None) -> Query:
    """The report of one type or length check of one column."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = _specs(spark, [(column, declared, fmt, column in keys, mandatory)])[0]
        rule = (type_rule if which == "type" else length_rule)(spec, keys)
        return rule_failures(view(spark, sf_dir), [rule], Labels(SOURCE, TARGET, tuple(keys)))

    return run


def _dirty_labels() -> Labels:
    return Labels(SOURCE, TARGET, tuple(DIRTY_KEYS))


# -- gold --------------------------------------------------------------------------------------------


def gold_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_by_day(monthly_bars(views.bars(spark, sf_dir)))


def gold_month_close_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_bars(views.bars(spark, sf_dir), full_month=True)


def gold_returns_null_on_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant over all series, with a date column of another name and null over a zero close."""
    renamed = views.bars(spark, sf_dir).withColumnRenamed("generated_date", "timestamp")
    per_series = renamed.withColumn("symbol", F.concat_ws("-", "symbol", "series"))
    return monthly_bars(per_series, date_col="timestamp", series=None, on_zero="null")


def gold_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows per symbol and day."""
    return monthly_bars(views.ticks(spark, sf_dir), tie_break=["event_id"])


def gold_ticks_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the close of the whole month."""
    return monthly_bars(views.ticks(spark, sf_dir), tie_break=["event_id"], full_month=True)


def gold_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed bars as a catalog table, the gold table made from it in day order, and both read by name.

    The tables have names of their own in every run and are left in the warehouse.
    """
    run = uuid.uuid4().hex
    create_table(typed_bars(project_bars(views.staged_bars(spark, sf_dir))), f"silver_{run}")
    create_table(monthly_bars(read_table(spark, f"silver_{run}")), f"gold_{run}", order_by_day="generated_date")
    return read_table(spark, f"gold_{run}")


# -- checks ------------------------------------------------------------------------------------------


def rule_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_key_failures(views.dirty(spark, sf_dir), _dirty_labels())


def rule_duplicate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_key_failures(views.dirty(spark, sf_dir), _dirty_labels())


def rule_duplicate_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are copies of each other, keys included."""
    copies = views.dirty(spark, sf_dir).select("symbol", "d")
    return duplicate_key_failures(copies, Labels(SOURCE, TARGET, ("symbol",)))


def rule_duplicate_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key with most of the rows, and zeros of both signs among them, which stay apart in the report."""
    return duplicate_key_failures(views.one_hot_key(spark, sf_dir), Labels(SOURCE, TARGET, ("k",)))


def rule_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table declared with types and formats that no check knows, next to ones that are checked."""
    return check(views.dirty(spark, sf_dir), _specs(spark, ODD_METADATA), SOURCE, TARGET).failed


def failed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_dirty(spark, sf_dir).failed


def failed_report_other_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the metadata delivered in another order."""
    metadata = views.metadata_frame(spark, DIRTY_METADATA).orderBy(F.col("sl no").desc())
    specs = column_specs(metadata, [m[0] for m in DIRTY_METADATA])
    return check(views.dirty(spark, sf_dir), specs, SOURCE, TARGET).failed


def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a table without failures: no rows, all columns."""
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    metadata = [("o_orderkey", "BIGINT", None, True, True), ("o_orderstatus", "CHAR(1)", None, False, True)]
    return check(orders, _specs(spark, metadata), SOURCE, TARGET).failed


def passed_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_dirty(spark, sf_dir).passed_null_key


def passed_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _check_dirty(spark, sf_dir).passed_strict


def except_all_surplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.dirty(spark, sf_dir).select(*DIRTY_KEYS)
    return except_all(keys, keys.dropDuplicates(DIRTY_KEYS))


def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(views.dirty(spark, sf_dir), DIRTY_KEYS)


# -- profile, projection, silver ---------------------------------------------------------------------


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.dirty(spark, sf_dir).select(
        "*", F.lit("x").alias("same"), F.when(F.col("event_id") % 2 == 0, "y").alias("same_or_null"),
        F.lit(None).cast("string").alias("nothing"),
    )


def profile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.counts(_profiled(spark, sf_dir))


def profile_constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.constant_columns(_profiled(spark, sf_dir))


def filter_min_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.at_least(views.bars(spark, sf_dir), "tottrdqty", 5000)


def bars_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = project_bars(views.staged_bars(spark, sf_dir))
    # numbers as text differ between engines in form, so the values are compared as numbers
    numbers = ["OPEN", "HIGH", "LOW", "CLOSE", "LAST", "PREVCLOSE", "TOTTRDVAL"]
    return projected.withColumns({c: F.col(c).cast("double") for c in numbers})


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = _specs(spark, DIRTY_METADATA)
    return typed(_check_dirty(spark, sf_dir).passed_null_key, specs)


def silver_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_bars(project_bars(views.staged_bars(spark, sf_dir)))


# -- metadata ----------------------------------------------------------------------------------------


def metadata_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_specs(views.part_metadata(spark, sf_dir))


def metadata_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_columns(views.part_metadata(spark, sf_dir))


def metadata_mandatory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mandatory_columns(views.part_metadata(spark, sf_dir))


# -- calendar and reconciliation ---------------------------------------------------------------------


def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    return calendar.day_range(calendar.day_bounds(orders, "o_orderdate"))


def expected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.expected_files(date_spine(spark, sf_dir), "archive/")


def _days_per_symbol(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bars = views.bars(spark, sf_dir)
    days = calendar.day_range(calendar.day_bounds(bars, "generated_date", ("symbol",)), ("symbol",))
    return days, bars.where(F.col("series") == "EQ").withColumnRenamed("generated_date", "trade_date")


def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = views.bars(spark, sf_dir)
    return calendar.missing_within(bars, "generated_date", F.col("series") == "EQ", ("symbol",))


def missing_from_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a range of days and a listing that come from different tables."""
    return calendar.missing_days(*_days_per_symbol(spark, sf_dir), ("symbol",))


def available_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.available_days(*_days_per_symbol(spark, sf_dir), ("symbol",))


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    files = events.select(F.col("ts").cast("date").alias("trade_date"), F.col("event_type").alias("source_file"))
    return calendar.records_per_file(files)


def ingest_audit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per staged file, per day and in all; the day is known by a folder only."""
    path = scratch_path(spark, "audit")
    events = views.table(spark, sf_dir, "events")
    file = F.concat(F.coalesce("event_type", F.lit("none")), F.lit(".csv"))
    staged = events.select("event_id", "user_id", day_folder(F.col("ts")).alias("day"), file.alias("source_file"))
    stage_csv(staged, path, "day", "source_file")
    return calendar.records_per_file(scan_csv(spark, f"{path}/*", ["event_id"], nested=True, source_file=True))


def files_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with one file per day and user; files of even users are market files."""
    user = F.col("user_id")
    suffix = F.when(user % 2 == 0, ".mkt.gz").otherwise(".txt.gz")
    listing = views.table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("trade_date"),
        F.concat(F.lit("staged/"), user.cast("string"), suffix).alias("path"),
    )
    return calendar.files_per_day(listing.distinct())


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars against the table of bars of one series, both counted while that is written."""
    path = scratch_path(spark, "reconcile")
    write = lambda rows: overwrite(rows, fmt="parquet", path=path)
    return written_counts(views.bars(spark, sf_dir), F.col("series") == "EQ", write)


def reconcile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from both tables, the second written and read back."""
    bars = views.bars(spark, sf_dir)
    path = scratch_path(spark, "reconcile")
    overwrite(bars.where(F.col("series") == "EQ"), fmt="parquet", path=path)
    return row_counts(bars, read_table(spark, fmt="parquet", path=path))


def reconcile_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    return row_counts(orders, orders)


# -- files -------------------------------------------------------------------------------------------

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(*[F.col(c).cast("string") for c in EVENT_COLUMNS])


def _event_types(df: DataFrame) -> DataFrame:
    types = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double"}
    return df.select(*[F.col(c).cast(t) for c, t in types.items()])


def scan_csv_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flat")
    overwrite(_event_text(spark, sf_dir), fmt="csv", path=path, header="true")
    return _event_types(scan_csv(spark, path, EVENT_COLUMNS))


def scan_csv_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "nested")
    events = _event_text(spark, sf_dir)
    stage_csv(events.withColumn("part", F.col("event_type")), path, "part")
    return _event_types(scan_csv(spark, path, nested=True))


def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "infer")
    overwrite(_event_text(spark, sf_dir), fmt="csv", path=path, header="true")
    scanned = scan_csv(spark, path, infer=True)
    names = [F.lit(scanned.schema[c].dataType.simpleString()).alias(f"{c}_family") for c in ("value", "event_type")]
    return scanned.select(
        F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", "value", *names
    )


def scan_csv_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder whose headers differ: other order, further columns, one of them without a name."""
    path = scratch_path(spark, "mixed")
    events, even = _event_text(spark, sf_dir), F.col("event_id").cast("bigint") % 2 == 0
    overwrite(events.where(even), fmt="csv", path=path, header="true")
    other = events.where(~even).select(*reversed(EVENT_COLUMNS), F.lit("x").alias("more"))
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in other.columns], F.lit(""))
    head = ",".join([*other.columns, ""])
    lines = other.select(line.alias("value")).groupBy(F.expr("pmod(xxhash64(value), 16)").alias("file"))
    files = lines.agg(F.concat_ws("\n", F.lit(head), F.collect_list("value")).alias("value"))
    files.repartition("file").select("value").write.mode("append").text(path)
    scanned = read_by_name(spark, path, EVENT_COLUMNS)
    return _event_types(scanned)


def mkt_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshots")
    views.write_snapshot_files(views.snapshot_rows(spark, sf_dir), path)
    return read_snapshots(spark, path, "*.gz").drop("source_file")


def mkt_stage_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded records staged as headed CSV per day and file, and read back."""
    files, staged = scratch_path(spark, "snapshots"), scratch_path(spark, "staged")
    views.write_snapshot_files(views.snapshot_rows(spark, sf_dir), files)
    stage_csv(read_snapshots(spark, files, "*.gz"), staged, "trade_date", "source_file")
    rows = scan_csv(spark, f"{staged}/*", SNAPSHOT_SCHEMA.names, nested=True)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in SNAPSHOT_SCHEMA.fields])


def mkt_decode_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only files named as market files are decoded; the other half of the records is in files of another name."""
    path = scratch_path(spark, "named")
    views.write_named_snapshot_files(views.snapshot_rows(spark, sf_dir), path)
    return read_snapshots(spark, path).drop("source_file")


def mkt_decode_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through the data source that streams them."""
    path = scratch_path(spark, "streamed")
    views.write_snapshot_files(views.snapshot_rows(spark, sf_dir), path)
    return stream_snapshots(spark, path, "*.gz").drop("source_file")


def bhav_unzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    views.write_archives(views.staged_bars(spark, sf_dir), path)
    return typed_bars(project_bars(unzip_rows(list_archives(spark, path, "*"))))


def bhav_unzip_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same archives through the data source that deals their entries to tasks."""
    path = scratch_path(spark, "archives")
    views.write_archives(views.staged_bars(spark, sf_dir), path)
    return typed_bars(project_bars(stream_archive_rows(spark, path, name_filter="*")))


def bhav_stage_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive entries staged as they are, one file per entry, and read by a CSV scan.

    Half of the entries have their columns in reverse and a comma at the end of each line.
    """
    archives, staged = scratch_path(spark, "archives"), scratch_path(spark, "entries")
    views.write_archives(views.staged_bars(spark, sf_dir), archives)
    stage_entries(list_archives(spark, archives, "*"), staged)
    return typed_bars(project_bars(scan_staged_entries(spark, staged)))


def bhav_stage_same_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from archives whose entries all have one name."""
    archives, staged = scratch_path(spark, "archives"), scratch_path(spark, "entries")
    views.write_archives(views.staged_bars(spark, sf_dir), archives, entry="bhav.csv")
    stage_entries(list_archives(spark, archives, "*"), staged)
    return typed_bars(project_bars(scan_staged_entries(spark, staged)))


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written twice to the same place; the second write replaces the first."""
    path = scratch_path(spark, "report")
    report = failed_report(spark, sf_dir)
    overwrite(report, fmt="parquet", path=path)
    overwrite(report, fmt="parquet", path=path)
    return read_table(spark, fmt="parquet", path=path)


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of CSV files, each ingested by its own run; consumed files go to an archive.

    The second delivery has its columns in another order.
    """
    root = scratch_path(spark, "ingest")
    events, first = _event_text(spark, sf_dir), F.col("event_type").eqNullSafe("click")
    for rows in (events.where(first), events.where(~first).select(*reversed(EVENT_COLUMNS))):
        rows.write.mode("append").option("header", True).csv(f"{root}/incoming")
        stream = new_files(spark, f"{root}/incoming", EVENT_COLUMNS, f"{root}/archive")
        folder = ingest(stream, EVENT_COLUMNS, f"{root}/table", f"{root}/progress")
    return _event_types(spark.read.parquet(folder))


def incremental_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty rows delivered as CSV files and read one file at a time, checked together; the report that this leaves."""
    root = scratch_path(spark, "checked")
    rows = views.dirty(spark, sf_dir)
    # keys recur in both halves, so duplicates stand in different files
    for half in (0, 1):
        part = rows.where(F.col("event_id") % 2 == half).coalesce(2)
        part.write.mode("append").option("header", True).csv(f"{root}/incoming")
    specs = _specs(spark, DIRTY_METADATA)
    stream = new_files(spark, f"{root}/incoming", rows.columns, f"{root}/archive", files_per_batch=1)
    typed_id = lambda df: df.withColumn("event_id", F.col("event_id").cast(rows.schema["event_id"].dataType))
    ingest_checked(stream, rows.columns, specs, SOURCE, TARGET, f"{root}/out", f"{root}/progress", typed_id)
    return spark.read.parquet(f"{root}/out/failed").drop("checkpoint", "from")


def incremental_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty rows in two deliveries, checked by a run each; keys of the first are duplicates in the second."""
    root = scratch_path(spark, "across")
    rows = views.dirty(spark, sf_dir)
    specs = _specs(spark, DIRTY_METADATA)
    typed_id = lambda df: df.withColumn("event_id", F.col("event_id").cast(rows.schema["event_id"].dataType))
    for half in (0, 1):
        part = rows.where(F.col("event_id") % 2 == half)
        part.write.mode("append").option("header", True).csv(f"{root}/incoming")
        stream = new_files(spark, f"{root}/incoming", rows.columns, f"{root}/archive")
        ingest_checked(
            stream, rows.columns, specs, SOURCE, TARGET, f"{root}/out", f"{root}/progress", typed_id, across_runs=True
        )
    return spark.read.parquet(f"{root}/out/failed").drop("checkpoint", "from")


BAR_METADATA = [
    ("SYMBOL", "VARCHAR(20)", None, True, True),
    ("SERIES", "VARCHAR(2)", None, True, True),
    ("OPEN", "DECIMAL(12,2)", None, False, True),
    ("HIGH", "DECIMAL(12,2)", None, False, True),
    ("LOW", "DECIMAL(12,2)", None, False, True),
    ("CLOSE", "DECIMAL(12,2)", None, False, True),
    ("LAST", "DECIMAL(12,2)", None, False, True),
    ("PREVCLOSE", "DECIMAL(12,2)", None, False, False),
    ("TOTTRDQTY", "BIGINT", None, False, True),
    ("TOTTRDVAL", "DECIMAL(14,2)", None, False, True),
    ("generated_date", "DATE", "'DD-MON-YYYY'", True, True),
    ("TOTALTRADES", "BIGINT", None, False, True),
    ("ISIN", "VARCHAR(12)", None, False, True),
]


SNAPSHOT_METADATA = [
    (name, "TINYINT" if name.startswith("Best_") else "BIGINT", None, name in ("Timestamp", "Security_Token"), True)
    for name in SNAPSHOT_SCHEMA.names
]


def _run_job(spark: SparkSession, sf_dir: str) -> str:
    """The job over both datasets, daily bars and snapshots; the folder with its results."""
    root = scratch_path(spark, "job")
    staged = views.staged_bars(spark, sf_dir).drop("trade_date")
    overwrite(staged, fmt="csv", path=f"{root}/data", header="true")
    views.write_named_snapshot_files(views.snapshot_rows(spark, sf_dir), f"{root}/market")
    stage_csv(read_snapshots(spark, f"{root}/market"), f"{root}/snapshots", "trade_date", "source_file")
    for name, metadata in (("bars", BAR_METADATA), ("snapshots", SNAPSHOT_METADATA)):
        frame = views.metadata_frame(spark, metadata)
        overwrite(frame, fmt="csv", path=f"{root}/metadata/{name}.csv", header="true")

    def dataset(name: str, read: Callable[[SparkSession], DataFrame]) -> Dataset:
        return Dataset(
            name=name,
            metadata_file=f"{name}.csv",
            read=read,
            source_name=f"staged {name}",
            target_name=name,
            folder=f"{root}/checked/{name}",
        )

    datasets = [
        dataset("bars", lambda session: project_bars(scan_csv(session, f"{root}/data", STAGED_BAR_COLUMNS, staged=False))),
        dataset(
            "snapshots",
            lambda session: scan_csv(session, f"{root}/snapshots/*", SNAPSHOT_SCHEMA.names, nested=True, staged=False),
        ),
    ]
    outcome = run_listed(spark, [f"{root}/metadata/{n}.csv" for n in ("other", "bars", "snapshots")], datasets)
    if outcome != {"bars": None, "snapshots": None}:
        raise RuntimeError(f"quality job failed: {outcome}")
    return root


def quality_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged bars and their metadata file, run as the job runs them; the passed table, typed."""
    return typed_bars(read_published(spark, f"{_run_job(spark, sf_dir)}/checked/bars", "passed"))


def quality_job_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure report of the second dataset of the same run: market files, decoded, staged and checked."""
    return read_published(spark, f"{_run_job(spark, sf_dir)}/checked/snapshots", "failed")


def _check_rules() -> dict[str, Query]:
    date = "'DD-MON-YYYY'"
    return {
        "rule_type_date": _one_rule(_dirty_keyed, DIRTY_KEYS, "d", "DATE", "type", True, date),
        "rule_type_date_optional": _one_rule(views.dirty, ["event_id"], "d", "DATE", "type", False, date),
        "rule_type_date_mandatory": _one_rule(views.dirty, ["event_id"], "d", "DATE", "type", True, date),
        "rule_type_string": _one_rule(views.event_props, ["event_id"], "props", "VARCHAR(8)", "type"),
        "rule_type_string_mandatory": _one_rule(views.event_props, ["event_id"], "props", "STRING", "type", True),
        "rule_type_string_symbol": _one_rule(_dirty_keyed, DIRTY_KEYS, "symbol", "CHAR(3)", "type", True),
        "rule_type_integer": _one_rule(_dirty_keyed, DIRTY_KEYS, "px", "INTEGER", "type"),
        "rule_type_integer_mandatory": _one_rule(_dirty_keyed, DIRTY_KEYS, "px", "SMALLINT", "type", True),
        "rule_type_decimal": _one_rule(_dirty_keyed, DIRTY_KEYS, "px", "DECIMAL(5,2)", "type"),
        "rule_type_decimal_mandatory": _one_rule(_dirty_keyed, DIRTY_KEYS, "px", "NUMBER(5,2)", "type", True),
        "rule_len_string": _one_rule(views.event_props, ["event_id"], "props", "VARCHAR(8)", "length"),
        "rule_len_string_key": _one_rule(_dirty_keyed, DIRTY_KEYS, "symbol", "VARCHAR(3)", "length"),
        "rule_len_bigint": _one_rule(views.event_numbers, ["event_id"], "num", "BIGINT", "length"),
        "rule_len_int": _one_rule(views.event_numbers, ["event_id"], "num", "INT", "length"),
        "rule_len_tinyint": _one_rule(views.event_numbers, ["event_id"], "num", "TINYINT", "length"),
        "rule_len_decimal": _one_rule(_dirty_keyed, DIRTY_KEYS, "px", "DECIMAL(4,1)", "length"),
        "rule_len_decimal_whole": _one_rule(_dirty_keyed, DIRTY_KEYS, "px", "NUMBER(3)", "length"),
    }


def all_queries() -> dict[str, Query]:
    named = [
        gold_monthly,
        gold_month_close_full,
        gold_returns_null_on_zero,
        gold_ticks,
        gold_ticks_full,
        gold_catalog,
        rule_null_key,
        rule_duplicate_key,
        rule_duplicate_copies,
        rule_duplicate_hot_key,
        rule_unsupported,
        failed_report,
        failed_report_other_order,
        clean_report,
        passed_null_key,
        passed_strict,
        except_all_surplus,
        dedup_keep_first,
        profile_counts,
        profile_constant_columns,
        filter_min_quantity,
        bars_projection,
        silver_typed,
        silver_bars,
        metadata_spec,
        metadata_keys,
        metadata_mandatory,
        date_spine,
        expected_files,
        missing_dates,
        missing_from_listing,
        available_dates,
        ingest_audit,
        ingest_audit_files,
        files_per_day,
        reconcile_counts,
        reconcile_tables,
        reconcile_equal,
        scan_csv_flat,
        scan_csv_nested,
        scan_csv_infer,
        scan_csv_mixed,
        mkt_decode,
        mkt_decode_named,
        mkt_decode_stream,
        mkt_stage_csv,
        bhav_unzip,
        bhav_unzip_entries,
        bhav_stage_csv,
        bhav_stage_same_entry,
        sink_roundtrip,
        incremental_ingest,
        incremental_check,
        incremental_duplicates,
        quality_job,
        quality_job_snapshots,
    ]
    return {q.__name__: q for q in named} | _check_rules()
