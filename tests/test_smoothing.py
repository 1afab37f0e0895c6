import numpy as np
import pytest
from conftest import DATA

from barloom.functions.polynomial import smoothing_weights
from barloom.operators import select, smoothing
from barloom.sources.tables import supplier_bars


def column(df, name):
    return np.array([np.nan if r[name] is None else r[name] for r in df.orderBy("trading_date").collect()])


def brute_smooth(y, window=31, degree=3):
    half, out, x = window // 2, [], np.arange(window)
    for i in range(len(y)):
        start = min(max(i - half, 0), len(y) - window)
        fit = np.polyfit(x - half, y[start : start + window], degree)
        out.append(np.polyval(fit, i - start - half))
    return np.array(out)


def test_weights_interior_row():
    m = 15
    k = np.arange(-m, m + 1)
    closed = 3 * (3 * m * m + 3 * m - 1 - 5 * k * k) / ((2 * m - 1) * (2 * m + 1) * (2 * m + 3))
    np.testing.assert_allclose(smoothing_weights(31, 3)[m], closed, atol=1e-14)


@pytest.mark.parametrize("n", [32, 40, 200])
def test_savgol_equals_polyfit(make_bars, small_pieces, n):
    y = np.random.default_rng(n).normal(50, 5, n)
    out = smoothing.savgol(make_bars(y.tolist()), "close")
    np.testing.assert_allclose(column(out, "smoothed"), brute_smooth(y), rtol=1e-9)


def test_savgol_keeps_cubics(make_bars):
    x = np.arange(40) / 10
    y = 1 + 2 * x - 3 * x**2 + 0.5 * x**3
    np.testing.assert_allclose(column(smoothing.savgol(make_bars(y.tolist()), "close"), "smoothed"), y, atol=1e-9)


def test_savgol_short_series_and_missing_values(make_bars):
    assert np.isnan(column(smoothing.savgol(make_bars([1.0] * 31), "close"), "smoothed")).all()
    y = [1.0] * 60
    y[20] = None
    out = column(smoothing.savgol(make_bars(y), "close"), "smoothed")
    assert np.isnan(out[:36]).all() and not np.isnan(out[36:]).any()


def test_savgol_many_series(spark):
    bars = select.price_range(supplier_bars(spark, DATA))
    out = smoothing.savgol(bars).orderBy("ticker", "trading_date").toPandas()
    for _, g in out.groupby("ticker"):
        np.testing.assert_allclose(g.smoothed, brute_smooth(g.price_diff.to_numpy()), atol=1e-6)


def brute_decompose(y, period):
    half, n = period // 2, len(y)
    weights = np.ones(period + 1 - period % 2) / period
    if period % 2 == 0:
        weights[[0, -1]] /= 2
    trend = np.full(n, np.nan)
    for i in range(half, n - half):
        trend[i] = np.dot(weights, y[i - half : i + half + 1])
    means = np.array([np.nanmean((y - trend)[p::period]) for p in range(period)])
    seasonal = np.resize(means - means.mean(), n)
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("period", [30, 7])
def test_decomposition_equals_brute_force(make_bars, small_pieces, period):
    y = np.random.default_rng(1).normal(100, 8, 137)
    out = smoothing.seasonal_decompose(make_bars(y.tolist()), period=period)
    for name, expected in zip(("trend", "seasonal", "resid"), brute_decompose(y, period)):
        np.testing.assert_allclose(column(out, name), expected, atol=1e-9)


def test_decomposition_recovers_planted_parts(make_bars):
    t = np.arange(120)
    pattern = np.sin(2 * np.pi * t / 30)
    out = smoothing.seasonal_decompose(make_bars((5 + 0.5 * t + pattern).tolist()))
    trend = column(out, "trend")
    assert np.isnan(trend[:15]).all() and np.isnan(trend[-15:]).all() and np.isnan(trend).sum() == 30
    np.testing.assert_allclose(trend[15:-15], (5 + 0.5 * t)[15:-15], atol=1e-9)
    np.testing.assert_allclose(column(out, "seasonal"), pattern, atol=1e-9)


def test_decomposition_keeps_every_row(make_bars, small_pieces):
    short = smoothing.seasonal_decompose(make_bars([1.0] * 59))
    assert short.count() == 59
    assert short.where("trend is null and seasonal is null and resid is null").count() == 59
    assert smoothing.seasonal_decompose(make_bars([1.0] * 60)).where("seasonal is not null").count() == 60


def test_decomposition_of_a_long_series(make_bars):
    y = np.random.default_rng(2).normal(10, 1, 6000)
    out = smoothing.seasonal_decompose(make_bars(y.tolist()))
    assert out.count() == 6000
    np.testing.assert_allclose(column(out, "trend"), brute_decompose(y, 30)[0], atol=1e-9)


@pytest.mark.parametrize("period", [30, 7])
def test_decomposition_with_missing_values(make_bars, small_pieces, period):
    y = np.random.default_rng(3).normal(10, 1, 150)
    y[[60, 90]] = np.nan
    given = [None if np.isnan(v) else float(v) for v in y]
    out = smoothing.seasonal_decompose(make_bars(given), period=period)
    for name, expected in zip(("trend", "seasonal", "resid"), brute_decompose(y, period)):
        np.testing.assert_allclose(column(out, name), expected, atol=1e-9)
