"""Metadata-driven checks: the failure report and the passed rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsieve.functions.declared import UNSUPPORTED, ColumnSpec, key_names
from barsieve.functions.predicates import (
    TYPE_PATTERNS,
    all_present,
    breaks_date,
    breaks_length,
    breaks_pattern,
    breaks_precision,
    first_null,
    named_values,
    row_text,
)
from barsieve.operators.duplicates import first_rows, surplus_rows
from barsieve.schemas import REPORT_COLUMNS, REPORT_SCHEMA
from barsieve.scratch import scratch_path

# Names of the checks in the report, and the text that stands for a whole column.
NULL_KEY = "Primary Key - Null Data Validation"
DUPLICATE_KEY = "Primary Key - Duplicate Data Validation"
DATE_FORMAT = "Date Format Validation"
NEW_DATE_FORMAT = "Date Format Validation - New Format"
DATA_TYPE = "DataType - {declared} Validation"
DATA_LENGTH = "DataLength - {declared} Validation"
ALL_RECORDS = "**ALL RECORDS**"

_SOUND, _BROKEN = "_sound", "_broken"


@dataclass(frozen=True)
class Labels:
    """Table names and key columns printed on every report row."""

    source: str
    target: str
    keys: tuple[str, ...]

    @property
    def key_text(self) -> str:
        return ", ".join(self.keys)


@dataclass(frozen=True)
class Rule:
    """One check of one column: the rows where `breaks` holds are reported with `text`.

    `breaks` is None for a check that the declared type does not allow; it gives one row for the column.
    """

    kind: str
    column: str | Column
    breaks: Column | None = None
    text: Column | None = None


def type_rule(spec: ColumnSpec, keys: list[str], text: Column | None = None) -> Rule:
    """The check of the text form that the declared type asks for."""
    value = F.col(spec.name).cast("string")
    text = _short_text(spec, keys) if text is None else text
    if spec.type_check == "date":
        if spec.date_pattern is None:
            return Rule(NEW_DATE_FORMAT, spec.name)
        return Rule(DATE_FORMAT, spec.name, breaks_date(value, spec.date_pattern, spec.mandatory), text)
    if spec.type_check == UNSUPPORTED:
        # a type that no check knows is reported under the length name here as well
        return Rule(DATA_LENGTH.format(declared=spec.declared), spec.name)
    breaks = breaks_pattern(value, TYPE_PATTERNS[spec.type_check], spec.mandatory)
    return Rule(DATA_TYPE.format(declared=spec.declared), spec.name, breaks, text)


def length_rule(spec: ColumnSpec, keys: list[str], text: Column | None = None) -> Rule | None:
    """The check of the declared length or precision; None where the type declares neither."""
    kind = DATA_LENGTH.format(declared=spec.declared)
    value = F.col(spec.name).cast("string")
    text = _short_text(spec, keys) if text is None else text
    if spec.length_check == UNSUPPORTED:
        return Rule(kind, spec.name)
    if spec.length_check == "decimal":
        if spec.precision is None or spec.scale is None:
            return None
        return Rule(kind, spec.name, breaks_precision(value, spec.precision, spec.scale), text)
    if spec.max_length is None:
        return None
    return Rule(kind, spec.name, breaks_length(value, spec.max_length), text)


def column_rules(specs: list[ColumnSpec], keys: list[str]) -> list[Rule]:
    """Length and type check of every column, in column order."""
    rules = []
    named = named_values([*keys, *[s.name for s in specs if s.name not in keys]])
    for spec in specs:
        text = _short_text(spec, keys, named)
        rules += [length_rule(spec, keys, text), type_rule(spec, keys, text)]
    return [r for r in rules if r is not None]


def rule_failures(df: DataFrame, rules: list[Rule], labels: Labels, null_keys: Rule | None = None) -> DataFrame:
    """Report rows of all rules from one scan of the rows, plus one row per check that cannot be made.

    With a rule for null keys, a row that breaks it is reported under it alone.
    """
    by_row = [r for r in rules if r.breaks is not None]
    whole_column = [r for r in rules if r.breaks is None]
    if not by_row and null_keys is None:
        return _column_failures(df.sparkSession, whole_column, labels)

    def found(r: Rule) -> Column:
        column = F.lit(r.column) if isinstance(r.column, str) else r.column
        return F.struct(F.lit(r.kind).alias("_kind"), column.alias("_column"), r.text.alias("_text"))

    failures = broken(by_row, found) if by_row else None
    if null_keys is not None:
        alone = F.when(null_keys.breaks, F.array(found(null_keys)))
        failures = alone if failures is None else F.when(~null_keys.breaks, failures).otherwise(alone)
    report = _report(df.select(F.inline(failures)), F.col("_kind"), F.col("_column"), F.col("_text"), labels)
    if not whole_column:
        return report
    return report.unionByName(_column_failures(df.sparkSession, whole_column, labels))


def broken(rules: list[Rule], value: Callable[[Rule], Column]) -> Column:
    """An array with the value of each rule that the row breaks; a value is built only for a broken rule.

    The array is one expression evaluated per row, so the generated code does not grow with the rules. As a
    long condition the rules would make one method too large for the JVM to compile.
    """
    return F.array_compact(F.array(*[F.when(r.breaks, value(r)) for r in rules if r.breaks is not None]))


def breaks_none(rules: list[Rule]) -> Column:
    """True where a row breaks none of the rules; one expression as well, for the same reason."""
    breaks = [r.breaks for r in rules if r.breaks is not None]
    return ~F.exists(F.array(*breaks), lambda b: b) if breaks else F.lit(True)


def null_key_failures(df: DataFrame, labels: Labels) -> DataFrame:
    """Rows with a null key, each under its first null key column, with all columns as text."""
    return rule_failures(df, [], labels, _null_key_rule(df.columns, labels))


def duplicate_key_failures(df: DataFrame, labels: Labels, seen: DataFrame | None = None) -> DataFrame:
    """All rows per key but one, or all rows of a key in `seen`, with all columns as text; null keys are left out."""
    return rule_failures(surplus_rows(df, list(labels.keys), seen), [_duplicate_rule(df.columns, labels)], labels)


class CheckResult:
    """The outcome of checking a table; each part is built when it is asked for.

    `failed` is the report of all failures, `passed_null_key` the rows without a null key and
    `passed_strict` the rows that break no rule, one per key.
    """

    def __init__(
        self,
        rows: DataFrame,
        columns: list[str],
        labels: Labels,
        rules: list[Rule],
        seen: DataFrame | None = None,
        sound: Column | None = None,
    ) -> None:
        self._rows = rows
        self._columns = columns
        self._labels = labels
        self._rules = rules
        self._seen = seen
        self._sound = breaks_none(rules) if sound is None else sound

    @property
    def _keys(self) -> list[str]:
        return list(self._labels.keys)

    @cached_property
    def failed(self) -> DataFrame:
        """All rules, null keys included, are one expression over the rows; duplicate keys are found apart from them."""
        if not self._keys:
            return rule_failures(self._rows, self._rules, self._labels)
        by_rule = rule_failures(self._rows, self._rules, self._labels, _null_key_rule(self._columns, self._labels))
        return by_rule.unionByName(duplicate_key_failures(self._rows.select(self._columns), self._labels, self._seen))

    @cached_property
    def passed_null_key(self) -> DataFrame:
        """A filter on the scan, without a shuffle."""
        rows = self._rows.select(self._columns)
        return rows.where(all_present(self._keys)) if self._keys else rows

    @cached_property
    def passed_strict(self) -> DataFrame:
        """The smallest row of each key, where it breaks no rule: an aggregate that carries that flag."""
        if not self._keys:
            return self._rows.where(self._sound).select(self._columns)
        # the rules stand below the aggregate alone: no filter can be pushed through it
        judged = self._rows.select(*self._columns, self._sound.alias(_SOUND))
        if self._seen is not None:
            judged = judged.join(self._seen, self._keys, "left_anti").select(judged.columns)
        return first_rows(judged, self._keys, [_SOUND]).where(_SOUND).drop(_SOUND)

    def staged(self, path: str | None = None) -> CheckResult:
        """The same outcome over rows that are written once, each with the numbers of the rules that it breaks.

        For several parts of one check: the input is read and its rules evaluated by that write alone, and every part
        reads what it needs of the table, which is in `path` or the shared folder.
        """
        spark = self._rows.sparkSession
        path = path or scratch_path(spark, "checked")
        numbers = {id(r): F.lit(i) for i, r in enumerate(self._rules)}
        table = self._rows.withColumn(_BROKEN, broken(self._rules, lambda r: numbers[id(r)]))
        table.write.parquet(path)
        rules = [
            r if r.breaks is None else replace(r, breaks=F.array_contains(_BROKEN, i)) for i, r in enumerate(self._rules)
        ]
        rows = spark.read.schema(table.schema).parquet(path)
        return CheckResult(rows, self._columns, self._labels, rules, self._seen, F.size(_BROKEN) == 0)


def check(
    df: DataFrame, specs: list[ColumnSpec], source: str, target: str, seen: DataFrame | None = None
) -> CheckResult:
    """Check every column against its spec: null keys, duplicate keys, then length and type per column.

    Rules after the null-key check see only rows whose keys are all present. All failures are reported. `seen` has the
    distinct keys, among those of the rows, that were checked before; their rows are all duplicates. Raises
    ValueError when a declared column is not in the data or a column of the data is not declared.
    """
    declared = [s.name for s in specs]
    missing = [c for c in declared if c not in df.columns]
    if missing:
        raise ValueError(f"columns declared but not in the data: {', '.join(missing)}")
    undeclared = [c for c in df.columns if c not in declared]
    if undeclared:
        raise ValueError(f"columns in the data but not declared: {', '.join(undeclared)}")
    keys = key_names(specs)
    labels = Labels(source, target, tuple(keys))
    return CheckResult(df.select(declared), declared, labels, column_rules(specs, keys), seen if keys else None)


def _null_key_rule(columns: list[str], labels: Labels) -> Rule:
    keys = list(labels.keys)
    return Rule(NULL_KEY, first_null(keys), ~all_present(keys), row_text(columns))


def _duplicate_rule(columns: list[str], labels: Labels) -> Rule:
    return Rule(DUPLICATE_KEY, labels.key_text, F.lit(True), row_text(columns))


def _short_text(spec: ColumnSpec, keys: list[str], named: dict[str, Column] | None = None) -> Column:
    return row_text(keys if spec.name in keys else [*keys, spec.name], named)


def _report(rows: DataFrame, kind: Column, column: Column, text: Column, labels: Labels) -> DataFrame:
    values = [kind, F.lit(labels.source), F.lit(labels.target), F.lit(labels.key_text), column, text]
    return rows.select(*[v.alias(n) for v, n in zip(values, REPORT_COLUMNS)])


def _column_failures(spark: SparkSession, rules: list[Rule], labels: Labels) -> DataFrame:
    """One report row for each check that cannot be made."""
    if not rules:
        return spark.createDataFrame([], REPORT_SCHEMA)
    rows = F.array(*[F.struct(F.lit(r.kind).alias("_kind"), F.lit(r.column).alias("_column")) for r in rules])
    listed = spark.range(0, 1, 1, 1).select(F.inline(rows))
    return _report(listed, F.col("_kind"), F.col("_column"), F.lit(ALL_RECORDS), labels)

