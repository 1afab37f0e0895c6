import datetime as dt

import numpy as np
import pytest

from barloom.operators import clean
from barloom.schema import BAR

D0 = dt.date(2020, 1, 1)


def series(spark, values, days=None, key="A"):
    rows = [(key, "close", D0 + dt.timedelta(days=(days[i] if days else i)), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ticker string, attr string, ds date, y double")


def result(df):
    return [r.y for r in df.orderBy("ds").collect()]


def test_interpolate_hand_made(spark):
    out = clean.interpolate(series(spark, [None, 2.0, None, None, 5.0, None, 4.0, None]))
    assert result(out) == [2, 2, 3, 4, 5, 4.5, 4, 4]


def test_interpolate_missing_days(spark):
    out = clean.interpolate(series(spark, [1.0, 4.0, 2.0], [0, 3, 5]))
    assert result(out) == [1, 2, 3, 4, 3, 2]


def test_interpolate_single_value_and_no_value(spark):
    one = series(spark, [None, 7.0, None])
    none = series(spark, [None, None], key="B")
    out = clean.interpolate(one.union(none))
    assert result(out) == [7, 7, 7]


@pytest.mark.parametrize("gap", [0.2, 0.9])
def test_interpolate_equals_numpy_across_segments(spark, small_pieces, gap):
    rng = np.random.default_rng(3)
    n = 400
    y = rng.normal(100, 10, n)
    known = rng.random(n) > gap
    values = [float(v) if k else None for v, k in zip(y, known)]
    out = clean.interpolate(series(spark, values))
    expected = np.interp(np.arange(n), np.flatnonzero(known), y[known])
    np.testing.assert_allclose(result(out), expected, rtol=1e-12)


def test_calendar_fill(spark, make_bars):
    bars = make_bars([1.0, 2.0], days=[D0, D0 + dt.timedelta(days=3)])
    rows = clean.calendar_fill(bars).orderBy("trading_date").collect()
    assert [r.close for r in rows] == [1.0, None, None, 2.0]
    assert {r.ticker for r in rows} == {"AAA"}


def test_deduplicate_is_deterministic(spark):
    rows = [("A", D0, 1.0, 1.0, 1.0, 1.0, 5), ("A", D0, 3.0, 1.0, 1.0, 2.0, 5), ("A", D0, 2.0, 9.0, 1.0, 1.0, 5)]
    for order in (rows, rows[::-1]):
        kept = clean.deduplicate(spark.createDataFrame(order, BAR)).collect()
        assert [r.open for r in kept] == [3.0]
        assert kept[0].close == 2.0
    assert clean.deduplicate(spark.createDataFrame(rows, BAR), prefer=["high"]).first().high == 9.0


def test_mode_ignores_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), (None,)], "id string")
    assert clean.mode_of(df, "id").first().id == "a"
    tie = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "id string")
    assert clean.mode_of(tie, "id").first().asDict() == {"id": "a", "n": 2}


def test_prepare_series_and_fill_missing(spark, make_bars):
    bars = make_bars([1.0, 3.0], days=[D0, D0 + dt.timedelta(days=2)])
    out = clean.prepare_series(bars).orderBy("ds").collect()
    assert [(r.unique_id, r.y) for r in out] == [("AAA", 1.0), ("AAA", 2.0), ("AAA", 3.0)]
    filled = clean.fill_missing(spark.createDataFrame([(None, 1)], "id string, n int"), "A", ["id"])
    assert filled.first().id == "A"


def test_long_enough(spark, make_bars):
    bars = make_bars([1.0] * 31).union(make_bars([1.0] * 32, ticker="BBB"))
    assert {r.ticker for r in clean.long_enough(bars, 31).collect()} == {"BBB"}


def test_bounds(spark, make_bars):
    row = clean.bounds(make_bars([1.0, 5.0, 3.0], volume=[1, 7, 2])).first()
    assert (row.n_bars, row.min_price, row.max_price, row.volume_axis) == (3, 1.0, 5.0, 21)
