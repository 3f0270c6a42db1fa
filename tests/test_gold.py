import datetime as dt
import random

import pytest

from barsieve.operators.gold import monthly_bars, ordered_by_day
from tests.conftest import rows

SCHEMA = "symbol string, series string, d date, open double, high double, low double, close double, prevclose double, n int"


def _day(text):
    return dt.date.fromisoformat(text) if text else None


def _bars(spark, data):
    return spark.createDataFrame([(s, e, _day(d), *rest) for s, e, d, *rest in data], SCHEMA)


SMALL = [
    ("a", "EQ", "2020-01-01", 1.0, 9.0, 1.0, 10.0, 0.0, 1),
    ("a", "EQ", "2020-01-02", 2.0, 8.0, 0.5, 20.0, 10.0, 2),
    ("a", "EQ", "2020-01-03", 3.0, 12.0, 2.0, 5.0, None, 3),
    ("a", "BE", "2020-01-04", 9.0, 99.0, 0.1, 9.0, 5.0, 4),
    ("a", "EQ", "2020-02-01", 7.0, 7.0, 7.0, 7.0, 5.0, 5),
    ("b", "EQ", "2020-01-02", None, None, 4.0, None, 2.0, 6),
    ("b", "EQ", "2020-01-05", 4.0, 4.0, None, 4.0, 2.0, 7),
]


def test_running_month(spark):
    df = monthly_bars(_bars(spark, SMALL), date_col="d")
    got = {r["n"]: (r["open_monthly"], r["close_monthly"], r["high_monthly"], r["low_monthly"]) for r in df.collect()}
    assert got == {
        1: (1.0, 10.0, 9.0, 1.0),
        2: (1.0, 20.0, 9.0, 0.5),
        3: (1.0, 5.0, 12.0, 0.5),
        5: (7.0, 7.0, 7.0, 7.0),
        6: (None, None, None, 4.0),
        7: (None, 4.0, 4.0, 4.0),
    }


def test_full_month_close(spark):
    df = monthly_bars(_bars(spark, SMALL), date_col="d", full_month=True)
    assert {r["n"]: r["close_monthly"] for r in df.collect()} == {1: 5.0, 2: 5.0, 3: 5.0, 5: 7.0, 6: 4.0, 7: 4.0}


def test_spreads_and_returns(spark):
    bars = _bars(spark, SMALL)
    zero = {r["n"]: r for r in monthly_bars(bars, date_col="d", series=None).collect()}
    null = {r["n"]: r for r in monthly_bars(bars, date_col="d", series=None, on_zero="null").collect()}
    assert len(zero) == len(null) == 7
    assert (zero[2]["spread_high_low"], zero[2]["spread_open_close"]) == (-7.5, 18.0)
    assert (zero[1]["returns_perc"], null[1]["returns_perc"]) == (0.0, None)
    assert zero[2]["returns_perc"] == null[2]["returns_perc"] == 100.0
    assert zero[3]["returns_perc"] is null[3]["returns_perc"] is None
    with pytest.raises(ValueError):
        monthly_bars(bars, date_col="d", on_zero="other")


def _many(seed):
    """A third of the rows in one symbol and month, several rows a day, nulls among days and symbols."""
    rng = random.Random(seed)
    data = []
    for n in range(3000):
        symbol = "hot" if rng.random() < 0.34 else rng.choice(["x", "y", "z", None])
        day = f"2021-{rng.choice([1, 2]):02d}-{rng.randint(1, 28):02d}" if symbol != "hot" else f"2021-01-{rng.randint(1, 3):02d}"
        price = [rng.choice([None, *range(50)]) for _ in range(4)]
        data.append((symbol, "EQ", day if rng.random() > 0.02 else None, *[None if p is None else float(p) for p in price], 1.0, n))
    return data


def _expected(data, full):
    """Direct evaluation: per row, over the rows of its symbol and month up to its day."""
    out = []
    for symbol, _, day, *_, n in data:
        month = [r for r in data if r[0] == symbol and (r[2] or "")[:7] == (day or "")[:7]]
        seen = sorted((r for r in month if (r[2] or "") <= (day or "")), key=lambda r: (r[2] or "", r[-1]))
        last = max(month, key=lambda r: (r[2] or "", r[-1])) if full else seen[-1]
        highs = [r[4] for r in seen if r[4] is not None]
        lows = [r[5] for r in seen if r[5] is not None]
        out.append((n, seen[0][3], last[6], max(highs, default=None), min(lows, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("full", [False, True])
def test_many_rows_per_day_match_brute_force(spark, full):
    data = _many(3)
    df = monthly_bars(_bars(spark, data).repartition(5), date_col="d", tie_break=["n"], full_month=full)
    assert rows(df.select("n", "open_monthly", "close_monthly", "high_monthly", "low_monthly")) == _expected(data, full)


def test_default_tie_break_does_not_depend_on_row_order(spark):
    bars = _bars(spark, _many(5))
    first = rows(monthly_bars(bars.repartition(3, "n"), date_col="d"))
    second = rows(monthly_bars(bars.repartition(7, "open"), date_col="d"))
    assert first == second


def test_windows_see_one_row_per_day(spark, capsys):
    monthly_bars(_bars(spark, SMALL), date_col="d").explain()
    plan = capsys.readouterr().out
    windows = plan[plan.index("Window") :]
    # every window stands above the aggregate by symbol and day
    assert "min_by(open" in windows and plan.rindex("Window") < plan.index("min_by(open")
    assert "Broadcast" not in plan or "BroadcastExchange" in plan


def test_order_by_day_splits_a_large_day(spark):
    same = [(f"s{k}", "EQ", "2020-01-01", 1.0, 1.0, 1.0, 1.0, 1.0, k) for k in range(4000)]
    bars = _bars(spark, same + SMALL).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        ordered = ordered_by_day(bars, "d")
        sizes = [len(p) for p in ordered.rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    days = [r["d"] for r in ordered.collect()]
    assert days == sorted(days) and sum(sizes) == 4007
    assert max(sizes) < 2500
