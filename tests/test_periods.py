import datetime as dt
import random

from barloom.operators import select

SCHEMA = "period string, start date, end date"


def day(n):
    return dt.date(2000, 1, 1) + dt.timedelta(days=n)


def brute(bars, periods):
    out = []
    for r in bars.collect():
        for name, lo, hi in periods:
            if r.trading_date is not None and (lo is None or r.trading_date > lo) and (hi is None or r.trading_date < hi):
                out.append((r.ticker or "", r.trading_date, r.close, name))
    return sorted(out)


def found(bars, spark, periods):
    rows = select.label_periods(bars, spark.createDataFrame(periods, SCHEMA)).collect()
    return sorted((r.ticker or "", r.trading_date, r.close, r.period) for r in rows)


def test_random_periods_equal_brute_force(spark, make_bars):
    rng = random.Random(4)
    bars = make_bars([float(i) for i in range(150)]).union(make_bars([9.0] * 90, ticker=None, start=day(7300)))
    periods = []
    for i in range(60):
        start = rng.randrange(-50, 7600)
        ends = (day(start), day(start + rng.choice([-5, 0, 1, 2, 30, 31, 32, 33, 64, 900])))
        periods.append((f"p{i}", *[rng.choice([e, e, e, None]) for e in ends]))
    assert found(bars, spark, periods) == brute(bars, periods)


def test_borders_are_left_out_and_overlaps_come_twice(spark, make_bars):
    bars = make_bars([1.0, 2.0, 3.0, 4.0], days=[dt.date(2007, 8, 1), dt.date(2007, 8, 2), dt.date(2008, 12, 30), dt.date(2008, 12, 31)])
    periods = [("crisis", dt.date(2007, 8, 1), dt.date(2008, 12, 31)), ("late", dt.date(2008, 1, 1), None), ("all", None, None), ("all", None, None)]
    got = found(bars, spark, periods)
    assert got == brute(bars, periods)
    assert [p for *_, c, p in got if c == 2.0] == ["all", "all", "crisis"] and [p for *_, c, p in got if c == 4.0] == ["all", "all", "late"]


def test_same_as_the_literal_periods(spark, make_bars):
    bars = make_bars([float(i) for i in range(700)], start=dt.date(2006, 11, 1))
    periods = [(n, dt.date.fromisoformat(lo), dt.date.fromisoformat(hi)) for n, lo, hi in select.MARKET_PERIODS]
    assert len(found(bars, spark, periods)) == select.period_slice(bars).count() > 0


def test_nothing_to_label(spark, make_bars):
    bars = make_bars([1.0])
    empty = spark.createDataFrame([], SCHEMA)
    assert select.label_periods(bars, empty).count() == 0
    assert found(bars.limit(0), spark, [("all", None, None)]) == []
    undated = bars.selectExpr("ticker", "cast(null as date) as trading_date", "close")
    assert found(undated, spark, [("all", None, None)]) == []


def test_equal_buckets_and_no_nested_loop(spark, make_bars):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = select.label_periods(make_bars([1.0, 2.0]), spark.createDataFrame([("a", None, day(9))], SCHEMA))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan
