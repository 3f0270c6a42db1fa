"""One table of edge values per rule: value -> (broken when optional, broken when mandatory)."""

import pytest
from pyspark.sql import functions as F

from barsieve.functions import predicates as p

STRINGS = {
    "abc": (False, False), "A 1": (False, False), "": (False, False), "M&M": (True, True),
    "a-b": (True, True), "a.b": (True, True), "é": (True, True), None: (False, True),
}
INTEGERS = {
    "5": (False, False), "+5": (False, False), "-5": (False, False), "": (True, True), "5.0": (True, True),
    " 5": (True, True), "--5": (True, True), "1e3": (True, True), None: (False, True),
}
DECIMALS = {
    "1.5": (False, False), ".5": (False, False), "-.5": (False, False), "+1.50": (False, False),
    "1.": (True, True), "5": (True, True), "1,5": (True, True), "1.2.3": (True, True), "": (True, True),
    None: (False, True),
}


@pytest.mark.parametrize(
    "pattern, table",
    [(p.STRING_PATTERN, STRINGS), (p.INTEGER_PATTERN, INTEGERS), (p.DECIMAL_PATTERN, DECIMALS)],
)
def test_patterns(spark, pattern, table):
    df = spark.createDataFrame([(v,) for v in table], "v string")
    got = df.select(
        "v",
        p.breaks_pattern(F.col("v"), pattern, False).alias("o"),
        p.breaks_pattern(F.col("v"), pattern, True).alias("m"),
    ).collect()
    assert {r["v"]: (r["o"], r["m"]) for r in got} == table


@pytest.mark.parametrize(
    "pattern, good, bad",
    [
        ("dd-MMM-yyyy", ["01-JAN-2016", "29-Feb-2016", "31-dec-2023"], ["31-FEB-2016", "bad", "", "2016-01-01"]),
        ("yyyy-MM-dd", ["2016-01-31"], ["2016-13-01", "01-JAN-2016"]),
        ("MM-yyyy-dd", ["01-2016-31"], ["2016-01-31"]),
        ("yy/MM/dd", ["16/01/31"], ["16/31/01"]),
        ("dd/MM/yyyy", ["31/01/2016"], ["01/31/2016"]),
        ("dd-MMM-yy HH:mm:ss", ["01-Jan-16 10:11:12"], ["01-Jan-16"]),
    ],
)
def test_dates(spark, pattern, good, bad):
    df = spark.createDataFrame([(v,) for v in [*good, *bad, None]], "v string")
    got = df.select(
        "v",
        p.breaks_date(F.col("v"), pattern, False).alias("o"),
        p.breaks_date(F.col("v"), pattern, True).alias("m"),
    ).collect()
    want = {v: (False, False) for v in good} | {v: (True, True) for v in bad} | {None: (False, True)}
    assert {r["v"]: (r["o"], r["m"]) for r in got} == want


def test_lengths(spark):
    df = spark.createDataFrame([(v,) for v in ["", "abc", "abcd", "éééé", None]], "v string")
    got = df.select("v", p.breaks_length(F.col("v"), 3).alias("b")).collect()
    assert {r["v"]: r["b"] for r in got} == {"": False, "abc": False, "abcd": True, "éééé": True, None: False}


def test_precision(spark):
    # digits before and after the point together at most 4, after it at most 1; a sign counts
    want = {
        "1.5": False, "123.4": False, "1234.5": True, "1.25": True, "-12.3": False, "-123.4": True, "1234": False,
        "12345": True, ".5": False, "1.": False, "1.2.3": True, "..": True, "": False, "1,5": False, None: False,
    }
    df = spark.createDataFrame([(v,) for v in want], "v string")
    got = df.select("v", p.breaks_precision(F.col("v"), 4, 1).alias("b")).collect()
    assert {r["v"]: r["b"] for r in got} == want


def test_row_text_and_keys(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, "b", None)], "a int, b string, c string")
    got = df.select(
        p.row_text(["a", "b", "c"]), p.first_null(["a", "b"]), p.all_present(["a", "b"])
    ).collect()
    assert [tuple(r) for r in got] == [
        ("{a -> 1, b -> null, c -> x}", "b", False),
        ("{a -> null, b -> null, c -> y}", "a", False),
        ("{a -> 2, b -> b, c -> null}", None, True),
    ]
