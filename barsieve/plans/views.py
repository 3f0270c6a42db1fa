"""Views that give the test tables the shape of staged market data, and the files made from them."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barsieve.functions.days import archive_name, day_folder
from barsieve.schemas import BARS_SCHEMA, METADATA_COLUMNS, SNAPSHOT_FIELDS, STAGED_BAR_COLUMNS

# the functions that tasks run travel with the job, so executors need no copy of this package
register_pickle_by_value(sys.modules[__name__])


# the tables used here; a given schema saves the job that would read it from a file
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per nation, series and order day; a zero previous close on the 13th of a month.

    Orders are aggregated per day before the window, which then sees one row per day.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    owners = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    days = (
        orders.join(owners, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.col("n_name").alias("symbol"),
            F.when(F.col("o_orderstatus") == "F", "EQ").otherwise("BE").alias("series"),
            F.col("o_orderdate").cast("date").alias("generated_date"),
        )
        .agg(
            F.min_by(price, key).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, key).alias("close"),
            F.count("*").alias("totaltrades"),
            F.sum(key % 9000).alias("tottrdqty"),
            F.sum(price.cast("decimal(18,2)")).cast("double").alias("tottrdval"),
        )
    )
    previous = F.lag("close").over(W.partitionBy("symbol", "series").orderBy("generated_date"))
    filled = days.withColumn("last", F.col("close")).withColumn("isin", F.concat(F.lit("IN"), "symbol"))
    filled = filled.withColumn(
        "prevclose", F.when(F.dayofmonth("generated_date") == 13, F.lit(0.0)).otherwise(previous)
    )
    return filled.select(*BARS_SCHEMA.names)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many bars per symbol and day: one per event, the event type as symbol, ordered by event id in a day."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.lit("EQ").alias("series"),
        value.alias("open"),
        (value + 1).alias("high"),
        (value - 1).alias("low"),
        (value * 2).alias("close"),
        F.when(F.col("event_id") % 10 == 0, F.lit(0.0)).otherwise(value).alias("prevclose"),
        F.col("ts").cast("date").alias("generated_date"),
        "event_id",
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text with null keys, odd symbols, decimal commas, whole numbers and bad dates."""
    n, value = F.col("event_id"), F.col("value")
    text = value.cast("string")
    return table(spark, sf_dir, "events").select(
        n,
        F.when(n % 23 == 0, None)
        .when(n % 31 == 0, "M&M")
        .otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string")))
        .alias("symbol"),
        F.when(n % 13 == 0, F.replace(text, F.lit("."), F.lit(",")))
        .when(n % 17 == 0, None)
        .when(n % 29 == 0, F.floor(value).cast("bigint").cast("string"))
        .otherwise(text)
        .alias("px"),
        F.when(n % 19 == 0, None)
        .when(n % 11 == 0, "bad-date")
        .otherwise(F.date_format("ts", "dd-MMM-yyyy"))
        .alias("d"),
    )


def one_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which seven in ten share a key; among their values are zeros of both signs, many times, and nulls."""
    n = F.col("event_id")
    value = F.when(n % 5 == 0, F.lit(-0.0)).when(n % 5 == 1, F.lit(0.0)).when(n % 5 == 2, None)
    return table(spark, sf_dir, "events").select(
        F.when(n % 10 < 7, "hot").when(n % 10 == 7, None).otherwise(F.col("user_id").cast("string")).alias("k"),
        value.otherwise(F.col("value")).alias("v"),
    )


def event_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids as text, padded with zeros on every seventh row, so that some exceed each digit limit."""
    n = F.col("event_id")
    text = n.cast("string")
    return table(spark, sf_dir, "events").select(
        n,
        F.when(n % 7 == 0, F.lpad(text, 21, "0")).when(n % 5 == 0, F.lpad(text, 12, "0")).otherwise(text).alias("num"),
    )


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as they are, braces and quotes included, and null on every tenth row."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        n, F.when(n % 10 == 0, None).otherwise(F.col("props")).alias("props"), "event_type"
    )


def part_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metadata table as large as `part`: one declared column per part, over all kinds of types."""
    n, size = F.col("p_partkey"), F.col("p_size").cast("string")
    declared = [
        F.concat(F.lit("varchar("), size, F.lit(")")),
        F.concat(F.lit("DECIMAL("), size, F.lit(", 2)")),
        F.concat(F.lit("Number("), size, F.lit(")")),
        F.lit(" DATE "),
        F.lit("DATETIME"),
        F.lit("BIGINT"),
        F.lit("INT"),
        F.lit("INTEGER"),
        F.lit("TINYINT"),
        F.lit("SMALLINT"),
        F.lit("FLOAT"),
        F.lit("VARCHAR"),
        F.concat(F.lit("CHAR("), size, F.lit(")")),
    ]
    formats = ["'DD-MON-YYYY'", '"YYYY-MM-DD"', "'DD.MM.YYYY'", None]
    values = {
        "sl no": n.cast("string"),
        "column_name": F.concat(F.lit("c"), n.cast("string")),
        "description": F.col("p_name"),
        "data_type": F.element_at(F.array(*declared), (n % len(declared) + 1).cast("int")),
        "date_format": F.element_at(F.array(*[F.lit(f) for f in formats]), (n % len(formats) + 1).cast("int")),
        "primary_key": F.when(F.col("p_size") < 10, "Y").otherwise("N"),
        "mandatory_flag": F.when(F.col("p_type") == "ECONOMY", "Y"),
    }
    return table(spark, sf_dir, "part").select(
        *[values.get(c, F.lit(None).cast("string")).alias(c) for c in METADATA_COLUMNS]
    )


def metadata_frame(spark: SparkSession, rows: list[tuple[str, str, str | None, bool, bool]]) -> DataFrame:
    """Metadata for a handful of columns: (name, declared type, quoted date format, key, mandatory)."""
    values = {
        "sl no": [str(i) for i in range(len(rows))],
        "column_name": [r[0] for r in rows],
        "data_type": [r[1] for r in rows],
        "date_format": [r[2] for r in rows],
        "primary_key": ["Y" if r[3] else "N" for r in rows],
        "mandatory_flag": ["Y" if r[4] else "N" for r in rows],
    }
    empty = [None] * len(rows)
    return spark.createDataFrame(pa.table({c: pa.array(values.get(c, empty), pa.string()) for c in METADATA_COLUMNS}))


# -- snapshot files ----------------------------------------------------------------------------------


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot record per event, with values up to the largest that four unsigned bytes hold."""
    n, cents = F.col("event_id"), F.floor(F.col("value") * 100).cast("bigint") % 4294967296
    values = {
        "Transcode": n % 65536,
        "Timestamp": 4294967295 - n % 4294967296,
        "Message_Length": F.lit(78).cast("bigint"),
        "Security_Token": F.col("user_id") % 65536,
        "Last_Traded_Price": cents,
        "Best_Buy_Quantity": n % 1000,
        "Best_Buy_Price": (cents + 1) % 4294967296,
        "Best_Sell_Quantity": n % 777,
        "Best_Sell_Price": (cents + 2) % 4294967296,
        "Total_Traded_Quantity": (n * 7919) % 4294967296,
        "Average_Traded_Price": (cents + 3) % 4294967296,
        "Interval_Open_Price": (cents + 4) % 4294967296,
        "Interval_High_Price": (cents + 5) % 4294967296,
        "Interval_Low_Price": (cents + 6) % 4294967296,
        "Interval_Close_Price": (cents + 7) % 4294967296,
        "Interval_Total_Traded_Quantity": n % 100,
    }
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("trade_date"), *[values[c].alias(c) for c, _ in SNAPSHOT_FIELDS]
    )


def write_snapshot_files(rows: DataFrame, path: str) -> None:
    """Pack rows into 78-byte records and write them as gzip files, one folder per trading day.

    The text writer puts the line separator, one zero byte, after each value; it is the last pad byte.
    """
    packed = F.concat(
        *[_little_endian(F.col(n), size) for n, size in SNAPSHOT_FIELDS], F.lit("FFFFFFFF" + "00" * 15)
    )
    ready = rows.select(
        day_folder(F.col("trade_date")).alias("day"), F.unhex(packed).cast("string").alias("value")
    )
    writer = ready.write.mode("overwrite").partitionBy("day")
    writer.option("compression", "gzip").option("lineSep", "\u0000").text(path)


def write_named_snapshot_files(rows: DataFrame, path: str) -> None:
    """The same with the records of even transcodes in files named as market files, the others in files that are not.

    Spark names the files it writes, so those of the market are renamed afterwards.
    """
    spark = rows.sparkSession
    market = F.col("Transcode") % 2 == 0
    write_snapshot_files(rows.where(market), f"{path}/market")
    write_snapshot_files(rows.where(~market), f"{path}/other")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for file in spark.read.text(f"{path}/market", recursiveFileLookup=True).inputFiles():
        old = hadoop(file)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, hadoop(file.replace(".txt.gz", ".mkt.gz")))


def _little_endian(value: Column, size: int) -> Column:
    digits = F.lpad(F.hex(value), size * 2, "0")
    return F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(size))])


# -- bar archives ------------------------------------------------------------------------------------


def staged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as text under the staged column names, dates as in the daily files."""
    day = F.upper(F.date_format("generated_date", "dd-MMM-yyyy"))
    names = {c: ("generated_date" if c == "TIMESTAMP" else c.lower()) for c in STAGED_BAR_COLUMNS}
    return bars(spark, sf_dir).select(
        *[(day if c == "TIMESTAMP" else F.col(names[c]).cast("string")).alias(c) for c in STAGED_BAR_COLUMNS],
        F.col("generated_date").alias("trade_date"),
    )


def write_archives(rows: DataFrame, path: str, entry: str | None = None) -> None:
    """One zip archive per day with one CSV entry, named after the archive or as given.

    On even days of the month the columns stand in reverse, and each line ends in a comma. An archive ends in a one-byte
    comment, the line feed that the text writer puts after each value.
    """
    field = lambda c: F.coalesce(F.col(c), F.lit(""))
    turned = F.dayofmonth("trade_date") % 2 == 0
    plain = F.concat_ws(",", *[field(c) for c in STAGED_BAR_COLUMNS])
    reverse = F.concat_ws(",", *[field(c) for c in reversed(STAGED_BAR_COLUMNS)], F.lit(""))
    heads = ",".join(STAGED_BAR_COLUMNS), ",".join([*reversed(STAGED_BAR_COLUMNS), ""])
    days = rows.groupBy("trade_date").agg(F.sort_array(F.collect_list(F.when(turned, reverse).otherwise(plain))).alias("lines"))
    head = F.when(turned, F.lit(heads[1])).otherwise(F.lit(heads[0]))
    name = archive_name(F.col("trade_date"))
    named = F.regexp_replace(name, r"\.zip$", "") if entry is None else F.lit(entry)
    archives = days.select(
        name.alias("archive"), named.alias("entry"), F.concat_ws("\n", head, F.col("lines"), F.lit("")).alias("text")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.select(["entry", "text"]).to_pylist()
            packed = pa.array([_zip([e]) for e in entries], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("archive"), packed], names=["archive", "content"])

    content = archives.mapInArrow(pack, "archive string, content binary")
    ready = content.select("archive", F.col("content").cast("string").alias("value"))
    ready.write.mode("overwrite").partitionBy("archive").text(path)


def _zip(entries: list[dict[str, str]]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for entry in entries:
            archive.writestr(entry["entry"], entry["text"])
        archive.comment = b"\n"
    return buffer.getvalue()[:-1]
