"""Column lists and schemas of the staged data, the metadata and the failure report."""

from __future__ import annotations

from pyspark.sql import types as T

# The metadata table has these 14 columns, by position.
METADATA_COLUMNS = [
    "sl no",
    "column_name",
    "description",
    "data_type",
    "data_length",
    "decimal_length",
    "decimal_exists",
    "start_position",
    "end_position",
    "date_format",
    "primary_key",
    "foreign_key",
    "mandatory_flag",
    "comments",
]

# The failure report has these six text columns.
REPORT_COLUMNS = [
    "Validation Type",
    "Source Table Name",
    "Target Table Name",
    "Primary Key Field(s)",
    "Validation Column",
    "Unmatched Records",
]

# Columns of a staged daily bar file, in file order, and their typed form.
STAGED_BAR_COLUMNS = [
    "SYMBOL",
    "SERIES",
    "OPEN",
    "HIGH",
    "LOW",
    "CLOSE",
    "LAST",
    "PREVCLOSE",
    "TOTTRDQTY",
    "TOTTRDVAL",
    "TIMESTAMP",
    "TOTALTRADES",
    "ISIN",
]
BARS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("last", T.DoubleType()),
        T.StructField("prevclose", T.DoubleType()),
        T.StructField("tottrdqty", T.LongType()),
        T.StructField("tottrdval", T.DoubleType()),
        T.StructField("generated_date", T.DateType()),
        T.StructField("totaltrades", T.LongType()),
        T.StructField("isin", T.StringType()),
    ]
)

# One intraday snapshot is a 78-byte record of these little-endian fields
# (name, bytes), followed by an unnamed 4-byte field and 16 bytes of padding.
SNAPSHOT_FIELDS = [
    ("Transcode", 2),
    ("Timestamp", 4),
    ("Message_Length", 2),
    ("Security_Token", 2),
    ("Last_Traded_Price", 4),
    ("Best_Buy_Quantity", 4),
    ("Best_Buy_Price", 4),
    ("Best_Sell_Quantity", 4),
    ("Best_Sell_Price", 4),
    ("Total_Traded_Quantity", 4),
    ("Average_Traded_Price", 4),
    ("Interval_Open_Price", 4),
    ("Interval_High_Price", 4),
    ("Interval_Low_Price", 4),
    ("Interval_Close_Price", 4),
    ("Interval_Total_Traded_Quantity", 4),
]
SNAPSHOT_BYTES = 78

SNAPSHOT_SCHEMA = T.StructType(
    [T.StructField(n, T.IntegerType() if size == 2 else T.LongType()) for n, size in SNAPSHOT_FIELDS]
)


def strings(names: list[str]) -> T.StructType:
    """Schema with every column as text, the form in which staged files are checked."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


REPORT_SCHEMA = strings(REPORT_COLUMNS)
