"""Random values: the column expressions against a few lines of Python each."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsieve.functions import predicates as p
from barsieve.operators.duplicates import except_all, keep_first, mark_surplus

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
NUMBER_TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="0123456789.+-, x", max_size=9)), min_size=1, max_size=60)


def _fits(text, precision, scale):
    if text is None:
        return True
    parts = text.split(".")
    if len(parts) > 2:
        return False
    return sum(map(len, parts)) <= precision and (len(parts) == 1 or len(parts[1]) <= scale)


@FEW
@given(values=NUMBER_TEXT, precision=st.integers(1, 9), scale=st.integers(0, 4))
def test_precision(spark, values, precision, scale):
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    got = df.select("v", p.breaks_precision(F.col("v"), precision, scale).alias("b")).collect()
    assert [r["b"] for r in got] == [not _fits(r["v"], precision, scale) for r in got]


@FEW
@given(values=NUMBER_TEXT)
def test_patterns(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    for name, pattern in {"integer": r"[+-]?[0-9]+", "decimal": r"[+-]?[0-9]*\.[0-9]+"}.items():
        got = df.select("v", p.breaks_pattern(F.col("v"), p.TYPE_PATTERNS[name], False).alias("b")).collect()
        assert [r["b"] for r in got] == [r["v"] is not None and not re.fullmatch(pattern, r["v"]) for r in got]


KEYED = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["x", "", None])),
    min_size=1,
    max_size=50,
)


@FEW
@given(data=KEYED)
def test_one_row_per_key_is_kept(spark, data):
    df = spark.createDataFrame(data, "k string, n int, s string")
    marked = mark_surplus(df, ["k"])
    kept = sorted(map(repr, (tuple(r) for r in marked.where("not _surplus").drop("_surplus").collect())))
    assert kept == sorted(map(repr, (tuple(r) for r in keep_first(df, ["k"]).collect())))
    assert len(kept) == len({k for k, _, _ in data})
    surplus = sorted(map(repr, (tuple(r) for r in marked.where("_surplus").drop("_surplus").collect())))
    assert surplus == sorted(map(repr, (tuple(r) for r in except_all(df, keep_first(df, ["k"])).collect())))
