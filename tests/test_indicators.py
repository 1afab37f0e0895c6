import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from barloom.operators import indicators, select
from barloom.operators.series import LENGTH, POSITION, with_position
from barloom.sources.tables import order_bars, supplier_bars


def frame(df, *columns):
    return df.orderBy("ticker", "trading_date").select("ticker", "trading_date", *columns).toPandas()


@pytest.fixture(params=["order", "supplier"])
def bars(request, spark):
    return (order_bars if request.param == "order" else supplier_bars)(spark, DATA)


def check(actual, expected, rtol=1e-9):
    np.testing.assert_allclose(np.asarray(actual, float), np.asarray(expected, float), rtol=rtol, atol=1e-9)


def test_position_across_segments(bars, small_pieces):
    out = frame(with_position(bars, ["ticker"], "trading_date"), POSITION, LENGTH)
    group = out.groupby("ticker")
    check(out[POSITION], group.cumcount() + 1)
    check(out[LENGTH], group[POSITION].transform("size"))


def test_returns_equal_pandas(bars, small_pieces):
    out = frame(indicators.returns(bars), "close", "returns", "cumulative_return")
    change = out.groupby("ticker").close.pct_change(1)
    check(out.returns, change)
    check(out.cumulative_return, (1 + change).groupby(out.ticker).cumprod())


def test_cumulative_return_hand_made(make_bars):
    out = frame(indicators.returns(make_bars([1.0, 1.1, 1.21, 0.605])), "cumulative_return")
    check(out.cumulative_return, [np.nan, 1.1, 1.21, 0.605])
    shifted = frame(indicators.returns(make_bars([2.0, 2.2, 2.42, 1.21])), "cumulative_return")
    check(shifted.cumulative_return, [np.nan, 1.1, 1.21, 0.605])


def test_returns_with_missing_and_zero_prices(make_bars, small_pieces):
    closes = [None, 10.0, None, 12.0] + [None] * 40 + [6.0, 0.0, 3.0, 6.0]
    out = frame(indicators.returns(make_bars(closes)), "returns", "cumulative_return")
    r = out.returns.tolist()
    assert np.isnan(r[0]) and np.isnan(r[1])
    check(r[2:5] + [r[44], r[45], r[47]], [0.0, 0.2, 0.0, -0.5, -1.0, 1.0])
    assert np.isnan(r[46])
    c = out.cumulative_return.tolist()
    check(c[3:5] + [c[44], c[45]], [1.2, 1.2, 0.6, 0.0])
    assert np.isnan(c[46]) and np.isnan(c[47])


def test_moving_stats_equal_pandas(bars, small_pieces):
    out = frame(indicators.moving_stats(bars), "close", "ma20", "std20", "ma150")
    close = out.groupby("ticker").close
    check(out.ma20, close.transform(lambda s: s.rolling(20).mean()))
    check(out.std20, close.transform(lambda s: s.rolling(20).std()), rtol=1e-7)
    check(out.ma150, close.transform(lambda s: s.rolling(150).mean() if len(s) > 150 else s * np.nan))


def test_moving_average_needs_full_frame(make_bars):
    assert frame(indicators.moving_stats(make_bars([1.0] * 19)), "ma20").ma20.isna().all()
    assert frame(indicators.moving_stats(make_bars([1.0] * 20)), "ma20").ma20.tolist()[-1] == 1.0
    assert frame(indicators.moving_stats(make_bars([1.0] * 150)), "ma150").ma150.isna().all()
    assert frame(indicators.moving_stats(make_bars([1.0] * 151)), "ma150").ma150.count() == 2


def test_no_frame_is_summed_over_more_than_the_short_window(make_bars):
    """A frame is summed anew at every row: the long average comes from the short frames' sums, and rows are not numbered for it."""
    plan = indicators.moving_stats(make_bars([1.0] * 3))._jdf.queryExecution().optimizedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\(RowFrame, (-\d+), (-?\d+|currentrow\$\(\))\)", plan)
    rows = [(0 if last.startswith("c") else int(last)) - int(first) + 1 for first, last in frames]
    assert max(rows) == 20 and "row_number" not in plan


@pytest.mark.parametrize("short, long", [(20, 150), (5, 20), (3, 4), (7, 5)])
def test_frames_from_pieces_with_gaps_and_nan(spark, make_bars, small_pieces, short, long):
    rng = np.random.default_rng(3)
    closes = [None if i in (47, 201) else float("nan") if i == 300 else float(x) for i, x in enumerate(rng.integers(1, 9999, 480))]
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i + 40 * (i > 90) + 300 * (i > 100)) for i in range(480)]
    both = make_bars(closes, days=days).unionByName(make_bars(closes[:long], "AT", days=days[:long]))
    out = indicators.moving_stats(both, short=short, long=long).orderBy("ticker", "trading_date").collect()
    assert [r.close is None for r in out[:480]] == [x is None for x in closes] and len(out) == 480 + long
    for i, r in enumerate(out):
        series, at = (closes, i) if i < 480 else (closes[:long], i - 480)
        for width, name in ((short, f"ma{short}"), (long, f"ma{long}")):
            window = series[max(at - width + 1, 0) : at + 1]
            if len(window) < width or None in window or (width == long and len(series) <= long):
                assert r[name] is None
            else:
                check([r[name]], [sum(window) / width])


def test_bands(bars):
    out = frame(indicators.bollinger(bars), "ma20", "std20", "lower_band", "upper_band")
    check(out.upper_band - out.lower_band, 4 * out.std20, rtol=1e-6)


def test_accumulation_distribution(bars, small_pieces, make_bars):
    out = frame(indicators.accumulation_distribution(bars), "money_flow_volume", "accumulation_distribution")
    running = out.groupby("ticker").money_flow_volume.cumsum()
    np.testing.assert_allclose(out.accumulation_distribution, running, atol=1e-6)
    flat = indicators.accumulation_distribution(make_bars([5.0, 5.0]))
    assert [r.accumulation_distribution for r in flat.collect()] == [0.0, 0.0]


def test_row_order_and_other_series_do_not_matter(spark):
    bars = order_bars(spark, DATA)
    expected = frame(indicators.indicator_panel(bars), "ma20", "upper_band")
    shuffled = bars.repartition(3, F.rand(1)).orderBy(F.rand(2))
    pd.testing.assert_frame_equal(frame(indicators.indicator_panel(shuffled), "ma20", "upper_band"), expected)
    alone = frame(indicators.indicator_panel(bars.where("ticker = '1-URGENT'")), "ma20", "upper_band")
    part = expected[expected.ticker == "1-URGENT"].reset_index(drop=True)
    pd.testing.assert_frame_equal(alone, part)


def test_period_slice_is_open_at_both_ends(make_bars):
    days = [dt.date(2007, 8, 1), dt.date(2007, 8, 2), dt.date(2008, 12, 30), dt.date(2008, 12, 31), dt.date(2020, 1, 2)]
    out = select.period_slice(make_bars([1.0] * 5, days=days)).orderBy("trading_date").collect()
    assert [r.trading_date for r in out] == [days[1], days[2], days[4]]
    assert [r.period for r in out] == ["financial_crisis_2008"] * 2 + ["covid_pandemic"]


def test_overlapping_periods_give_a_row_each(make_bars):
    periods = [("a", "2019-12-01", "2020-02-01"), ("b", "2019-12-31", "2020-01-03")]
    out = select.period_slice(make_bars([1.0, 2.0, 3.0]), periods)
    assert sorted((r.period, r.close) for r in out.collect()) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 1.0), ("b", 2.0)]


def test_period_slice_reaches_the_scan(spark, tmp_path, make_bars):
    make_bars([1.0, 2.0]).write.parquet(str(tmp_path / "b"))
    plan = select.period_slice(spark.read.parquet(str(tmp_path / "b")))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan


def test_split_and_difference(make_bars):
    bars = make_bars([float(i) for i in range(11)])
    parts = select.train_valid_split(bars)
    assert [r.part for r in parts.orderBy("trading_date").collect()] == ["train"] * 8 + ["valid"] * 3
    train = parts.where("part = 'train'").drop("part")
    assert select.rows_not_in(bars, train).count() == 3
    doubled = bars.union(bars)
    assert select.rows_not_in(doubled, bars).count() == 0
    assert select.rows_not_in(doubled, bars, keep_copies=True).count() == 11


def test_first_rows_and_range(make_bars):
    bars = make_bars([float(i) for i in range(10)])
    assert sorted(r.close for r in select.first_rows(bars, 3).collect()) == [0, 1, 2]
    inside = select.bars_between(bars, "2020-01-02", "2020-01-04")
    assert sorted(r.close for r in inside.collect()) == [1, 2]
