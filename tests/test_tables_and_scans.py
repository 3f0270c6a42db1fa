import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsieve.functions.declared import column_specs
from barsieve.operators import calendar, profile
from barsieve.operators.reconcile import row_counts
from barsieve.operators.silver import typed
from barsieve.plans import datasets, views
from barsieve.plans.datasets import Dataset, run_listed
from barsieve.schemas import METADATA_COLUMNS
from barsieve.scratch import scratch_path
from barsieve.sources.csv import read_metadata, scan_csv
from barsieve.sources.tables import create_table, overwrite, read_table
from tests.conftest import rows


def _csv(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_flat_and_nested_scans(spark, tmp_path):
    _csv(tmp_path / "a.csv", "k,v\n1,x\n2,\n")
    _csv(tmp_path / "day1" / "b.csv", "k,v\n3,y\n")
    _csv(tmp_path / "day1" / "deep" / "c.csv", "k,v\n4,z\n")
    _csv(tmp_path / "day1" / "d.txt", "k,v\n5,w\n")
    flat, nested = scan_csv(spark, str(tmp_path)), scan_csv(spark, f"{tmp_path}/", nested=True)
    assert rows(flat) == [("1", "x"), ("2", None)]
    assert rows(nested) == [("3", "y")]
    assert {f.dataType.simpleString() for f in flat.schema} == {"string"}
    assert scan_csv(spark, str(tmp_path), infer=True).schema["k"].dataType.simpleString() == "int"
    assert rows(scan_csv(spark, str(tmp_path), ["k", "v"])) == rows(flat)


def test_columns_are_found_by_name(spark, tmp_path):
    _csv(tmp_path / "a.csv", "k,v\n1,x\n")
    _csv(tmp_path / "b.csv", "v,more,k,\ny,7,2,\n,,3,\n")
    _csv(tmp_path / "c.csv", 'more,"v",k\n1,"a,b",4\n')
    want = [("1", "x"), ("2", "y"), ("3", None), ("4", "a,b")]
    assert rows(scan_csv(spark, str(tmp_path), ["k", "v"])) == want
    assert rows(scan_csv(spark, str(tmp_path), ["v", "k"]).select("k", "v")) == want


def test_a_file_that_lacks_a_column_fails(spark, tmp_path):
    _csv(tmp_path / "a.csv", "k,v\n1,x\n")
    _csv(tmp_path / "b.csv", "k,w\n2,y\n")
    with pytest.raises(Exception, match="no header with k, v in .*b.csv"):
        scan_csv(spark, str(tmp_path), ["k", "v"]).collect()


def test_csv_is_parsed_once(spark, tmp_path, capsys):
    _csv(tmp_path / "a.csv", "k,v\n1,x\n")
    scan_csv(spark, str(tmp_path), ["k", "v"]).explain()
    plan = capsys.readouterr().out
    assert "FileScan parquet" in plan and "FileScan csv" not in plan


def test_source_files_and_days(spark, tmp_path):
    _csv(tmp_path / "August282023" / "a.csv", "k\n1\n")
    _csv(tmp_path / "August292023" / "b.csv", "k\n2\n")
    got = rows(scan_csv(spark, str(tmp_path), ["k"], nested=True, source_file=True))
    assert got == [("1", "a.csv", dt.date(2023, 8, 28)), ("2", "b.csv", dt.date(2023, 8, 29))]


def test_headers_only(spark, tmp_path):
    _csv(tmp_path / "a.csv", "k,v\n")
    assert rows(scan_csv(spark, str(tmp_path), ["k", "v"])) == []


def test_metadata_is_named_by_position(spark, tmp_path):
    header = ",".join(f"h{i}" for i in range(14))
    _csv(tmp_path / "m.csv", f"{header}\n1,c,,DATE,,,,,,'DD-MON-YYYY',Y,,Y,\n")
    metadata = read_metadata(spark, str(tmp_path / "m.csv"))
    assert metadata.columns == METADATA_COLUMNS
    (spec,) = column_specs(metadata, ["c"])
    assert (spec.declared, spec.date_pattern, spec.is_key, spec.mandatory) == ("DATE", "dd-MMM-yyyy", True, True)


def test_catalog_tables_are_replaced(spark):
    day = F.make_date(F.lit(2020), F.lit(1), (F.col("id") % 28 + 1).cast("int")).alias("d")
    overwrite(spark.range(5), "replaced")
    overwrite(spark.range(3), "replaced")
    assert read_table(spark, "replaced").count() == 3
    create_table(spark.range(100).select("id", day), "by_day", order_by_day="d")
    assert read_table(spark, "by_day").count() == 100
    for name in ("replaced", "by_day"):
        spark.sql(f"drop table {name}")


def test_format_tables(spark):
    path = scratch_path(spark, "t")
    overwrite(spark.range(4), fmt="orc", path=path)
    assert read_table(spark, fmt="orc", path=path).count() == 4
    assert path != scratch_path(spark, "t")


def test_profile(spark):
    df = spark.createDataFrame([(1, "x", None, "a"), (2, "x", None, None)], "n int, s string, e string, m string")
    assert tuple(profile.counts(df).collect()[0]) == (2, 4)
    assert profile.constant_column_names(df) == ["s", "e", "m"]
    assert profile.constant_column_names(df.where("false")) == ["n", "s", "e", "m"]
    assert profile.at_least(df.withColumnRenamed("n", "Total_Traded_Quantity"), minimum=2).count() == 1


def test_reconcile(spark):
    assert tuple(row_counts(spark.range(5), spark.range(5)).collect()[0])[:3] == (5, 5, 0)
    more = row_counts(spark.range(2), spark.range(5)).collect()[0]
    assert (more["missing_rows"], more["status"]) == (-3, "rows that the target lacks: -3")
    assert row_counts(spark.range(0), spark.range(0)).collect()[0]["source_rows"] == 0


def test_typed_values_never_fail(spark):
    metadata = [
        ("d", "DATE", "'DD-MON-YYYY'", False, False), ("i", "INT", None, False, False),
        ("x", "DECIMAL(5,2)", None, False, False), ("s", "CHAR(2)", None, False, False),
        ("o", "TIMESTAMP", None, False, False),
    ]
    specs = column_specs(views.metadata_frame(spark, metadata), [m[0] for m in metadata])
    df = spark.createDataFrame(
        [("01-JAN-2016", "7", "1.25", "ab", "t"), ("31-FEB-2016", "7.x", "1,2", None, None)],
        "d string, i string, x string, s string, o string",
    )
    out = typed(df, specs)
    assert [f.dataType.simpleString() for f in out.schema] == ["date", "bigint", "double", "string", "string"]
    assert rows(out) == [(None, None, None, None, None), (dt.date(2016, 1, 1), 7, 1.25, "ab", "t")]
    assert typed(df, specs, exact_decimals=True).schema["x"].dataType.simpleString() == "decimal(5,2)"


def test_days(spark):
    bounds = spark.createDataFrame([("2023-12-30", "2024-01-02"), ("2024-02-02", "2024-02-01")], "start_date string, end_date string")
    days = calendar.day_range(bounds)
    assert [str(r[0]) for r in days.orderBy("trade_date").collect()] == [
        "2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02",
    ]
    files = calendar.expected_files(days, "https://example.org/eq/").orderBy("trade_date").collect()
    assert files[2]["file_name"] == "cm01JAN2024bhav.csv.zip"
    assert files[2]["day_folder"] == "January012024"
    assert files[2]["location"] == "https://example.org/eq/2024/JAN/cm01JAN2024bhav.csv.zip"
    listing = spark.createDataFrame([("2023-12-31",), ("2023-12-31",), ("2024-01-02",)], "t string").selectExpr("date(t) trade_date")
    assert sorted(str(r[0]) for r in calendar.missing_days(days, listing).collect()) == ["2023-12-30", "2024-01-01"]
    assert sorted(str(r[0]) for r in calendar.available_days(days, listing).collect()) == ["2023-12-31", "2024-01-02"]


def test_audit(spark):
    df = spark.createDataFrame([("d1", "a"), ("d1", "a"), ("d1", "b"), ("d2", None)], "trade_date string, source_file string")
    got = {(r["trade_date"], r["source_file"], r["total_level"]): r["n_records"] for r in calendar.records_per_file(df).collect()}
    assert got == {
        ("d1", "a", 0): 2, ("d1", "b", 0): 1, ("d2", None, 0): 1,
        ("d1", None, 1): 3, ("d2", None, 1): 1, (None, None, 3): 4,
    }
    listing = spark.createDataFrame([("d1", "x/1.mkt.gz"), ("d1", "x/1.mkt.gz.bak"), ("d1", "x.mkt.gz/2.txt")], "trade_date string, path string")
    assert [tuple(r) for r in calendar.files_per_day(listing).collect()] == [("d1", 3, 2)]


def test_job_isolates_datasets(spark, tmp_path):
    metadata = views.metadata_frame(spark, [("k", "INT", None, True, True)])
    for name in ("good.csv", "bad.csv"):
        overwrite(metadata, fmt="csv", path=f"{tmp_path}/{name}", header="true")

    def dataset(name, columns):
        return Dataset(
            name, f"{name}.csv", lambda s: s.createDataFrame([("1",) * len(columns)], columns), "s", "t",
            {"fmt": "parquet", "path": f"{tmp_path}/{name}-failed"}, {"fmt": "parquet", "path": f"{tmp_path}/{name}-passed"},
        )

    datasets.log.disabled = True
    listing = [f"{tmp_path}/{n}" for n in ("bad.csv", "good.csv", "ignored.csv")]
    outcome = run_listed(spark, listing, [dataset("good", ["k"]), dataset("bad", ["k", "undeclared"])])
    assert outcome["good"] is None and "undeclared" in outcome["bad"] and len(outcome) == 2
    assert spark.read.parquet(f"{tmp_path}/good-passed").count() == 1


def test_scans_are_staged_by_name(spark, tmp_path):
    _csv(tmp_path / "a.csv", '"k","v, w",z\n1,"x, y",2\nk,"v, w",q\n')
    _csv(tmp_path / "b.csv", '"v, w",more,"k","a""b"\n"u",m,3,p\n')
    staged = scan_csv(spark, str(tmp_path), ["k", "v, w"])
    assert rows(staged) == [("1", "x, y"), ("3", "u")]
    assert rows(scan_csv(spark, str(tmp_path), ["k", "v, w"], staged=False)) == rows(staged)
    plan = staged.where("k = '1'").select("k")._jdf.queryExecution().optimizedPlan().toString()
    assert "_cells" not in plan and "_c0" not in plan and "Join" not in plan
    only = tmp_path / "quoted"
    _csv(only / "b.csv", '"v, w",more,"k","a""b"\n"u",m,3,p\n')
    names = spark.read.option("header", True).option("escape", '"').csv(str(only)).columns
    assert rows(scan_csv(spark, str(only), [names[0], names[2]])) == [("u", "3")]
