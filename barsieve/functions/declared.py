"""Declared column types: from metadata rows to the checks and casts they call for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words looked for in a declared type, in order of precedence.
STRING_WORDS = ["VARCHAR", "CHAR", "STRING"]
INTEGER_WORDS = ["INTEGER", "INT"]
DECIMAL_WORDS = ["NUMBER", "FLOAT", "DOUBLE", "DECIMAL"]

# Digits of the largest value of each integer type.
INTEGER_DIGITS = {"bigint": 19, "int": 10, "tinyint": 3}

# Declared date formats and the patterns they stand for.
DATE_PATTERNS = {
    "MM-YYYY-DD": "MM-yyyy-dd",
    "YYYY-MM-DD": "yyyy-MM-dd",
    "YY/MM/DD": "yy/MM/dd",
    "DD/MM/YYYY": "dd/MM/yyyy",
    "DD-MON-YY HH:MI:SS": "dd-MMM-yy HH:mm:ss",
    "DD-MON-YYYY": "dd-MMM-yyyy",
}

UNSUPPORTED = "unsupported"


@dataclass(frozen=True)
class ColumnSpec:
    """One column as the metadata declares it."""

    name: str
    declared: str
    type_check: str
    length_check: str
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    date_pattern: str | None = None
    is_key: bool = False
    mandatory: bool = False
    position: int = 0


def key_names(specs: list[ColumnSpec]) -> list[str]:
    """The key columns in the order that the metadata numbers them."""
    return [s.name for s in sorted(specs, key=lambda s: s.position) if s.is_key]


def _has_any(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))


def parse_specs(metadata: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn metadata rows into one row of check settings per declared column.

    A declared type is matched by the words it contains; length, precision and scale are the numbers
    in its parentheses. A type without them gets nulls there, and the rule that needs them is skipped.
    Metadata columns in `keep` are carried along.
    """
    word = F.upper(F.trim("data_type"))
    inside = F.regexp_extract(word, r"\(([^()]*)\)?$", 1)
    parts = F.split(inside, ",")
    first, second = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    is_string, is_decimal = _has_any(word, STRING_WORDS), _has_any(word, DECIMAL_WORDS)
    type_check = (
        F.when(word == "DATE", "date")
        .when(is_string, "string")
        .when(_has_any(word, INTEGER_WORDS), "integer")
        .when(is_decimal, "decimal")
        .otherwise(UNSUPPORTED)
    )
    length_check = (
        F.when(is_string, "string")
        .when(word == "BIGINT", "bigint")
        .when(word.isin(INTEGER_WORDS), "int")
        .when(word == "TINYINT", "tinyint")
        .when(is_decimal, "decimal")
        .otherwise(UNSUPPORTED)
    )
    digits = F.coalesce(*[F.when(length_check == k, n) for k, n in INTEGER_DIGITS.items()])
    patterns = F.create_map(*[F.lit(x) for pair in DATE_PATTERNS.items() for x in pair])
    unquoted = F.regexp_replace(F.trim("date_format"), "^['\"]|['\"]$", "")
    return metadata.select(
        *keep,
        "column_name",
        F.col("data_type").alias("declared"),
        type_check.alias("type_check"),
        length_check.alias("length_check"),
        F.when(length_check == "string", first.try_cast("int")).otherwise(digits).alias("max_length"),
        F.when(length_check == "decimal", first.try_cast("int")).alias("precision"),
        F.when(
            (length_check == "decimal") & first.try_cast("int").isNotNull(),
            F.when(F.size(parts) == 2, second.try_cast("int")).otherwise(0),
        ).alias("scale"),
        F.when(type_check == "date", patterns[unquoted]).alias("date_pattern"),
        F.coalesce(F.col("primary_key") == "Y", F.lit(False)).alias("is_key"),
        F.coalesce(F.col("mandatory_flag") == "Y", F.lit(False)).alias("mandatory"),
    )


def key_columns(metadata: DataFrame) -> DataFrame:
    """Names of the columns flagged as key."""
    return metadata.where(F.col("primary_key") == "Y").select("column_name")


def mandatory_columns(metadata: DataFrame) -> DataFrame:
    """Names of the columns flagged as mandatory."""
    return metadata.where(F.col("mandatory_flag") == "Y").select("column_name")


def column_specs(metadata: DataFrame, columns: list[str]) -> list[ColumnSpec]:
    """The specs of the given data columns, in their order; keys are in the order of the metadata's `sl no`.

    Raises ValueError when a data column has no metadata row or several, or a key column is not in the data.
    """
    wanted = F.col("column_name").isin(columns) | F.col("is_key")
    parsed = parse_specs(metadata, ("sl no",)).where(wanted)
    listed = {r["column_name"]: r["count"] for r in parsed.groupBy("column_name").count().collect()}
    absent = [c for c in listed if c not in columns]
    if absent:
        raise ValueError(f"key columns declared but not in the data: {', '.join(sorted(map(str, absent)))}")
    wrong = [c for c in columns if listed.get(c) != 1]
    if wrong:
        raise ValueError(f"columns without exactly one metadata row: {', '.join(wrong)}")
    number = F.col("sl no").try_cast("double")
    rows = [r.asDict() for r in parsed.withColumn("sl no", number).collect()]
    rows.sort(key=lambda r: (r["sl no"] is None, r["sl no"] or 0, columns.index(r["column_name"])))
    settings = {r["column_name"]: r | {"position": i} for i, r in enumerate(rows)}
    skipped = ("sl no", "column_name")
    return [ColumnSpec(name=c, **{k: v for k, v in settings[c].items() if k not in skipped}) for c in columns]
