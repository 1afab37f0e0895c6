import datetime as dt

import numpy as np
import pytest
from conftest import DATA

from barloom.operators import clean, forecast
from barloom.operators.forecast import beside_actual, fit_and_predict, forecast_additive, forecast_baseline, seed_of
from barloom.plans import flows
from barloom.sources.tables import order_bars

D0 = dt.date(2018, 1, 1)


def series(spark, y, key="A"):
    rows = [(key, "close", D0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "ticker string, attr string, ds date, y double")


def planted(n):
    t = np.arange(n)
    return (100 + 0.2 * t) * (1 + 0.1 * np.sin(2 * np.pi * t / 7))


def test_baseline_recovers_trend_and_weekdays(spark):
    out = forecast_baseline(series(spark, planted(700))).orderBy("ds").toPandas()
    assert len(out) == 756
    np.testing.assert_allclose(out.yhat, planted(756), rtol=0.01)
    assert (out.yhat_lower <= out.yhat).all() and (out.yhat <= out.yhat_upper).all()


def test_additive_recovers_trend_and_weekdays(spark):
    out = forecast_additive(series(spark, planted(700))).orderBy("ds").toPandas()
    assert len(out) == 756 and list(out.columns) == ["ticker", "attr", "ds", "yhat", "yhat_lower", "yhat_upper"]
    np.testing.assert_allclose(out.yhat, planted(756), rtol=0.02)


def test_additive_follows_a_bend_and_a_year():
    day = np.arange(1200.0)
    bend = np.where(day < 500, 100 + 0.3 * day, 250 - 0.1 * (day - 500))
    y = bend * (1 + 0.05 * np.sin(2 * np.pi * day / 365.25))
    out = fit_and_predict(day, y, 56)
    np.testing.assert_allclose(out.yhat[:1200], y, rtol=0.03)


@pytest.mark.parametrize("noise", [0.0, 0.3, 1.0])
def test_one_bend_leaves_few_change_points(noise):
    day = np.arange(1200.0)
    y = np.where(day < 500, 100 + 0.3 * day, 250 - 0.1 * (day - 500)) + np.random.default_rng(1).normal(0, 1, 1200) * noise
    bends = fit_and_predict(day, y, 56).attrs["bends"]
    assert 1 <= np.count_nonzero(bends) <= 3
    assert abs(bends.sum() + 0.4) < 0.02


def test_sparse_weights_meet_the_conditions_of_the_optimum():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n, p = int(rng.integers(3, 200)), int(rng.integers(0, 31))
        t = np.arange(n) / (n - 1)
        x = forecast._hinges(t, np.linspace(0.0, 0.8, p + 1)[1:])
        z = np.cumsum(rng.normal(0, 0.1, n))
        ridge, weight = 1e-3, float(rng.choice([1e-3, 0.05, 1.0]))
        w = forecast._sparse(x.T @ x, x.T @ z, ridge, weight)
        pull = x.T @ (z - x @ w)
        np.testing.assert_allclose(pull[:2], ridge * w[:2], atol=1e-6)
        assert (np.abs(pull[2:]) <= weight + 1e-6).all()
        used = np.flatnonzero(w[2:])
        np.testing.assert_allclose(pull[2:][used], weight * np.sign(w[2:][used]), atol=1e-6)


def test_drawn_futures_cover_nine_tenths():
    """Series that bend five times in the first 80 % of the history, on average, and as often ahead."""
    n, ahead, inside = 1500, 120, []
    for i in range(150):
        rng = np.random.default_rng(10_000 + i)
        place = np.arange(n + ahead)
        chance = np.where((place < 0.8 * n) | (place >= n), 5 / (0.8 * n), 0.0)
        bends = np.where(rng.random(n + ahead) < chance, rng.laplace(0, 0.1, n + ahead), 0.0)
        y = 1000 + np.cumsum(0.1 + np.cumsum(bends)) + rng.normal(0, 1 + 4 * (i % 2), n + ahead)
        out = fit_and_predict(np.arange(float(n)), y[:n], ahead, seasons=(), seed=seed_of("series", i))
        inside.append(((y >= out.yhat_lower) & (y <= out.yhat_upper))[n:].mean())
    assert 0.88 <= np.mean(inside) <= 0.92


def test_draws_follow_from_the_key():
    bend = [100 + 0.3 * i if i < 300 else 190 - 0.1 * (i - 300) for i in range(600)]
    one, again, other = (fit_and_predict(np.arange(600.0), np.array(bend), 300, seasons=(), seed=seed_of(k)) for k in ("A", "A", "B"))
    assert one.equals(again)
    assert one.yhat.equals(other.yhat) and not one.yhat_upper.equals(other.yhat_upper)
    width = (one.yhat_upper - one.yhat_lower).to_numpy()
    assert width[-1] > 3 * width[0]
    short = fit_and_predict(np.arange(600.0), np.array(bend), 200, seasons=(), seed=seed_of("A"))
    assert np.allclose(short.yhat_upper, one.yhat_upper[:800])


@pytest.mark.parametrize("model", [forecast_baseline, forecast_additive])
def test_interval_covers_nine_tenths(spark, model):
    rng = np.random.default_rng(5)
    y = planted(900) + rng.normal(0, 4, 900)
    out = model(series(spark, y[:844])).orderBy("ds").toPandas()
    inside = (y >= out.yhat_lower) & (y <= out.yhat_upper)
    assert 0.85 <= inside[:844].mean() <= 0.95
    assert inside[844:].mean() >= 0.75


@pytest.mark.parametrize("values", [[5.0], [5.0, 6.0], [0.0] * 40, [3.0] * 20])
def test_additive_on_degenerate_series(values):
    out = fit_and_predict(np.arange(float(len(values))), np.array(values), 3)
    assert len(out) == len(values) + 3
    assert np.isfinite(out[["yhat", "yhat_lower", "yhat_upper"]].to_numpy()).all()


def test_additive_repeats_itself_and_ignores_row_order(spark):
    frame = series(spark, planted(200)).union(series(spark, planted(100), "B"))
    one = forecast_additive(frame).orderBy("ticker", "ds").toPandas()
    two = forecast_additive(frame.repartition(5)).orderBy("ticker", "ds").toPandas()
    assert one.equals(two)


def test_additive_horizon_per_series(spark):
    frame = series(spark, planted(60)).union(series(spark, planted(50), "B")).union(series(spark, planted(40), "C"))
    horizon = spark.createDataFrame([("A", "close", 5), ("B", "close", 9), ("X", "close", 9)], "ticker string, attr string, horizon int")
    out = forecast_additive(frame, horizon=horizon, ahead=True)
    counts = {(r.ticker, r.ahead): r["count"] for r in out.groupBy("ticker", "ahead").count().collect()}
    assert counts == {("A", False): 60, ("A", True): 5, ("B", False): 50, ("B", True): 9, ("C", False): 40}


def test_beside_actual_keeps_both_sides(spark):
    actual = series(spark, planted(60))
    out = beside_actual(forecast_baseline(actual.limit(30)), actual)
    assert out.where("yhat is null").count() == 0
    assert out.where("y is null").count() == 26


@pytest.mark.parametrize("model", ["baseline", "additive"])
def test_validation_marks_every_calendar_day(spark, model):
    bars = order_bars(spark, DATA)
    out = flows.validate(bars, ["close"], model)
    assert out.count() == clean.calendar_spine(bars).count()
    assert out.where("part is null or yhat is null").count() == 0
    assert out.where("part = 'valid' and y is not null and in_interval is null").count() == 0


def test_charts_are_all_there(spark, tmp_path):
    bars = order_bars(spark, DATA)
    flows.write_charts(bars, str(tmp_path))
    for name in flows.charts(bars):
        assert spark.read.parquet(f"{tmp_path}/{name}").columns
    assert flows.forecast(bars, "baseline").select("attr").distinct().count() == 5


def test_baseline_spread_at_a_high_level(spark):
    rng = np.random.default_rng(6)
    noise = rng.normal(0, 0.5, 700)
    start = dt.date(2020, 1, 6)
    rows = [("A", "close", start + dt.timedelta(days=i), 1e9 + float(noise[i])) for i in range(700)]
    series = spark.createDataFrame(rows, "ticker string, attr string, ds date, y double")
    row = forecast_baseline(series).where("ds = date '2020-03-02'").first()
    spread = (row.yhat_upper - row.yhat_lower) / 2 / 1.645
    assert abs(spread / noise.std() - 1) < 0.03


def test_baseline_keeps_series_without_a_horizon(spark):
    rows = [(t, "close", dt.date(2020, 1, 1) + dt.timedelta(days=i), 5.0 + i) for t in "AB" for i in range(30)]
    series = spark.createDataFrame(rows, "ticker string, attr string, ds date, y double")
    horizon = spark.createDataFrame([("A", "close", 3)], "ticker string, attr string, horizon int")
    counts = {r.ticker: r["count"] for r in forecast_baseline(series, horizon=horizon).groupBy("ticker").count().collect()}
    assert counts == {"A": 33, "B": 30}
