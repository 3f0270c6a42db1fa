"""Failure predicates: each returns a boolean column, true where the value breaks the rule, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the text of each declared family must look like.
STRING_PATTERN = r"^[a-zA-Z0-9 ]*$"
INTEGER_PATTERN = r"^[+-]?\d+$"
DECIMAL_PATTERN = r"^[-+]?\d*\.\d+$"

TYPE_PATTERNS = {"string": STRING_PATTERN, "integer": INTEGER_PATTERN, "decimal": DECIMAL_PATTERN}


def breaks_pattern(value: Column, pattern: str, mandatory: bool) -> Column:
    """Text that does not match; a null breaks the rule only when the column is mandatory."""
    return F.coalesce(~value.rlike(pattern), F.lit(mandatory))


def breaks_date(value: Column, pattern: str, mandatory: bool) -> Column:
    """Text that is no date in the pattern; a null breaks the rule only when the column is mandatory."""
    unparsed = F.try_to_date(value, pattern).isNull()
    return unparsed if mandatory else unparsed & value.isNotNull()


def breaks_length(value: Column, limit: int) -> Column:
    """Text longer than the limit; a null passes."""
    return F.coalesce(F.length(value) > limit, F.lit(False))


def breaks_precision(value: Column, precision: int, scale: int) -> Column:
    """Number text with too many digits in all or after the point; a sign counts as a digit, a null passes.

    More than one point always breaks the rule.
    """
    size = F.length(value)
    too_many = (size > precision + 1) | ((size == precision + 1) & ~value.contains("."))
    one_part_or_two = rf"^[^.]*(\.[^.]{{0,{scale}}})?\z"
    return F.coalesce(too_many | ~value.rlike(one_part_or_two), F.lit(False))


def first_null(keys: list[str]) -> Column:
    """Name of the first key column that is null in the row, or null."""
    return F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])


def all_present(keys: list[str]) -> Column:
    """True where no key column is null."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def named_values(columns: list[str]) -> dict[str, Column]:
    """`a -> 1` per column; made once where many texts are put together from the same columns."""
    return {c: F.concat(F.lit(f"{c} -> "), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in columns}


def row_text(columns: list[str], named: dict[str, Column] | None = None) -> Column:
    """The named values of a row as text, `{a -> 1, b -> null}`."""
    named = named_values(columns) if named is None else named
    return F.concat(F.lit("{"), F.concat_ws(", ", *[named[c] for c in columns]), F.lit("}"))
