"""Forecasts with intervals for regular daily series."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.series import attach, days_between, per_series, with_segment

# Horizon, interval and priors of the forecast.
HORIZON_DAYS = 7 * 8
INTERVAL_WIDTH = 0.90
INTERVAL_Z = 1.645
CHANGE_POINTS = 30
CHANGE_POINT_SCALE = 0.1
SEASONALITY_SCALE = 15.0

# Where change points may lie, and the Fourier orders of the seasons.
CHANGE_POINT_RANGE = 0.8
YEARLY = (365.25, 10)
WEEKLY = (7.0, 3)
ROUNDS = 4
CHUNK_ROWS = 4096

# Draws of the future, days drawn at a time, sweeps over the change points, steps to the optimum at most.
DRAWS = 1000
DRAWN_DAYS = 128
SWEEPS = 20
STEPS = 1000
_EMPTY = {T.LongType: "int64", T.DoubleType: "float64", T.BooleanType: "bool"}

# Tasks get this module's functions with the job, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def forecast_baseline(
    series: DataFrame, keys: Sequence[str] = ("ticker", "attr"), horizon: int | DataFrame = HORIZON_DAYS, ahead: bool = False
) -> DataFrame:
    """Straight trend times weekday factor, with a normal interval of the residuals.

    ``horizon`` is a number of days or a table with a ``horizon`` per series (0 for one that is not in it). The
    series is read twice: once for the line, once for sums by weekday, from which
    both the factors and the spread of the residuals follow. History and horizon
    are then generated from one row per series. ``ahead`` adds whether a day is past the history.
    """
    rows = with_segment(series.select(*keys, "ds", "y"), keys, "ds")
    day_number = F.unix_date("ds").cast("double")
    lines = per_series(
        rows,
        keys,
        F.min("ds").alias("_start"),
        F.max("ds").alias("_stop"),
        F.regr_slope(F.col("y"), day_number).alias("_slope"),
        F.regr_intercept(F.col("y"), day_number).alias("_level"),
    )
    line = ["_start", "_stop", "_slope", "_level"]
    g = F.col("_level") + F.col("_slope") * day_number
    e = F.col("y") - F.col("_g")
    known = attach(rows, lines, keys).withColumn("_g", F.when(F.col("y").isNotNull(), g))
    by_weekday = known.groupBy(*keys, F.dayofweek("ds").alias("_weekday")).agg(
        F.avg(F.try_divide(F.col("y"), F.col("_g"))).alias("_factor"),
        F.count("y").alias("_n"),
        F.sum(e).alias("_e"),
        F.sum("_g").alias("_gs"),
        F.sum(e * e).alias("_ee"),
        F.sum(e * F.col("_g")).alias("_eg"),
        F.sum(F.col("_g") * F.col("_g")).alias("_gg"),
        *[F.max(c).alias(c) for c in line],
    )
    # The residual y - f * g is e - h * g with h = f - 1: sums of e do not cancel when the level is large.
    h = F.col("_factor") - 1
    squares = F.col("_ee") - 2 * h * F.col("_eg") + h * h * F.col("_gg")
    # Seven rows per series.
    fitted = by_weekday.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_weekday", "_factor"))).alias("_factors"),
        F.sum("_n").alias("_n"),
        F.sum(F.col("_e") - h * F.col("_gs")).alias("_r"),
        F.sum(squares).alias("_rr"),
        *[F.max(c).alias(c) for c in line],
    )
    variance = F.try_divide(F.col("_rr") - F.col("_r") * F.col("_r") / F.col("_n"), F.col("_n") - 1)
    sigma = F.sqrt(F.greatest(variance, F.lit(0.0)))
    models = fitted.withColumn("_sigma", sigma)
    if isinstance(horizon, DataFrame):
        models = models.join(horizon.select(*keys, "horizon"), list(keys), "left").fillna(0, ["horizon"])
    else:
        models = models.withColumn("horizon", F.lit(horizon))
    last = F.date_add("_stop", F.col("horizon").cast("int"))
    days = days_between(models.withColumn("_last", last), keys, "_start", "_last", "ds")
    yhat = g * F.element_at("_factors", F.dayofweek("ds"))
    return days.withColumn("yhat", yhat).select(
        *keys,
        "ds",
        "yhat",
        (F.col("yhat") - INTERVAL_Z * F.col("_sigma")).alias("yhat_lower"),
        (F.col("yhat") + INTERVAL_Z * F.col("_sigma")).alias("yhat_upper"),
        *([(F.col("ds") > F.col("_stop")).alias("ahead")] if ahead else []),
    )


def _waves(days: np.ndarray, seasons: Sequence[tuple[float, int]]) -> np.ndarray:
    angles = [2 * np.pi * k * days / length for length, order in seasons for k in range(1, order + 1)]
    return np.stack([wave(a) for a in angles for wave in (np.sin, np.cos)], axis=1)


def _hinges(t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - knots[None, :], 0.0)])


def _sums(features, target: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Products of feature rows with each other and with the target; ``features`` gives the rows of a slice."""
    gram, moment = np.zeros((width, width)), np.zeros(width)
    for lo in range(0, len(target), CHUNK_ROWS):
        part = slice(lo, min(lo + CHUNK_ROWS, len(target)))
        x = features(part)
        gram = gram + x.T @ x
        moment = moment + x.T @ target[part]
    return gram, moment


def _ridge(gram: np.ndarray, moment: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Least squares with squared penalties."""
    return np.linalg.lstsq(gram + np.diag(penalty), moment, rcond=None)[0]


def _sparse(gram: np.ndarray, moment: np.ndarray, ridge: float, weight: float) -> np.ndarray:
    """Least squares whose first two weights have a squared penalty and the others ``weight`` times their size.

    Level and slope are solved for in closed form; coordinate descent sweeps over the others, which are exactly 0 where the data ask for
    less than the penalty, and ``_settled`` goes on from there. A column that is a line itself stays at 0.
    """
    across = gram[:2, 2:]
    line = np.linalg.lstsq(gram[:2, :2] + ridge * np.eye(2), np.column_stack([across, moment[:2]]), rcond=None)[0]
    inner, pull = gram[2:, 2:] - across.T @ line[:, :-1], moment[2:] - across.T @ line[:, -1]
    usable = np.flatnonzero(np.diag(inner) > 1e-9 * np.diag(gram)[2:])
    inner, pull = inner[np.ix_(usable, usable)], pull[usable]
    found, size = np.zeros(len(usable)), np.diag(inner)
    for _ in range(SWEEPS):
        for j in range(len(usable)):
            part = pull[j] - inner[j] @ found + size[j] * found[j]
            found[j] = np.sign(part) * max(abs(part) - weight, 0.0) / size[j]
    bends = np.zeros(len(moment) - 2)
    bends[usable] = _settled(inner, pull, weight, found)
    return np.concatenate([line[:, -1] - line[:, :-1] @ bends, bends])


def _settled(inner: np.ndarray, pull: np.ndarray, weight: float, found: np.ndarray) -> np.ndarray:
    """The optimum, from a start near it: sweeps alone take very many rounds where neighbouring columns are much alike.

    Solves for the weights in use as if their signs were right, and goes there, or to the best place on the way where one of them
    reaches 0. With all signs right, the weight that is 0 and wants most to leave it comes into use, until none does.
    """

    def loss(w: np.ndarray) -> float:
        return float(w @ (inner @ w) / 2 - pull @ w + weight * np.abs(w).sum())

    signs = np.sign(found)
    for _ in range(STEPS):
        used = np.flatnonzero(signs)
        goal = np.zeros(len(found))
        if len(used):
            goal[used] = np.linalg.lstsq(inner[np.ix_(used, used)], (pull - weight * signs)[used], rcond=None)[0]
        best, least = goal, loss(goal)
        for j in used[(goal[used] * found[used]) < 0]:
            stop = found + (goal - found) * (found[j] / (found[j] - goal[j]))
            stop[j] = 0.0
            if loss(stop) < least:
                best, least = stop, loss(stop)
        right = (np.sign(best) == signs).all()
        found, signs = best, np.sign(best)
        if right:
            wish = pull - inner @ found
            wish[signs != 0] = 0.0
            j = int(np.argmax(np.abs(wish))) if len(wish) else 0
            if not len(wish) or abs(wish[j]) <= weight * (1 + 1e-9):
                break
            signs[j] = np.sign(wish[j])
    return found


def _apply(features, n: int, weights: np.ndarray) -> np.ndarray:
    return np.concatenate([features(slice(lo, lo + CHUNK_ROWS)) @ weights for lo in range(0, n, CHUNK_ROWS)])


def _uniform(seed: int, draws: np.ndarray, days: np.ndarray, kind: int) -> np.ndarray:
    """A number between 0 and 1 for each draw and day, by a hash of both, the series and the kind of number."""
    # Odd multipliers of a 64-bit mixing function.
    place, first, second = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
    x = np.full((len(draws), len(days)), seed % 2**64, np.uint64)
    for part in (draws[:, None], days[None, :], np.array([[kind]])):
        x = (x + part.astype(np.uint64) + np.uint64(1)) * place
        x = (x ^ (x >> np.uint64(30))) * first
        x = (x ^ (x >> np.uint64(27))) * second
        x = x ^ (x >> np.uint64(31))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _past_bends(bends: np.ndarray) -> np.ndarray:
    """Slope changes of the history: neighbouring change points that bend the same way are one, seen between the points allowed."""
    signs = np.sign(bends)
    starts = np.flatnonzero((signs != 0) & (signs != np.concatenate([[0.0], signs[:-1]])))
    runs = np.cumsum(np.isin(np.arange(len(bends)), starts))
    return np.array([bends[(runs == k) & (signs != 0)].sum() for k in range(1, len(starts) + 1)])


def _drawn_interval(
    seed: int, days: np.ndarray, step: float, bends: np.ndarray, span: float, sigma: float, factor: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """How far below and above the forecast the middle 90 % of the drawn futures lie, for each day ahead.

    On each day a draw may bend, by a Laplace-distributed change of slope, and strays from its trend by normal noise. Bends are as frequent as
    change points in use were in ``span`` days, and together vary as much as those of the history. A few bends tell neither rate nor size well, so each
    draw has its own, gamma-distributed about them. A bounded number of days is drawn at a time; each draw carries its slope and its level on.
    """
    draws, tail = np.arange(DRAWS), (1 - INTERVAL_WIDTH) / 2
    past, used = _past_bends(bends), np.count_nonzero(bends)
    k = max(len(past), 2)
    waits = -np.log(_uniform(seed, draws, np.arange(2 * k), 4))
    chance = np.minimum(used / len(past) * waits[:, : len(past)].sum(axis=1) / span, 1.0)[:, None]
    size = np.sqrt(np.sum(past**2) / (2 * used)) * k / waits[:, k:].sum(axis=1)[:, None]
    slope, level = np.zeros(DRAWS), np.zeros(DRAWS)
    found = []
    for lo in range(0, len(days), DRAWN_DAYS):
        part = days[lo : lo + DRAWN_DAYS]
        even = 2 * _uniform(seed, draws, part, 1) - 1
        bend = np.where(_uniform(seed, draws, part, 0) < chance, -np.sign(even) * size * np.log1p(-np.abs(even)), 0.0)
        slopes = slope[:, None] + np.cumsum(bend, axis=1)
        levels = level[:, None] + np.cumsum(slopes, axis=1) * step
        slope, level = slopes[:, -1], levels[:, -1]
        spread = np.sqrt(-2 * np.log(_uniform(seed, draws, part, 2))) * np.cos(2 * np.pi * _uniform(seed, draws, part, 3))
        found.append(np.quantile(levels * factor[lo : lo + DRAWN_DAYS] + sigma * spread, [tail, 1 - tail], axis=0))
    return tuple(np.concatenate(found, axis=1))


def seed_of(*key: object) -> int:
    """The start of a series' draws, from its key alone."""
    return int.from_bytes(hashlib.blake2b(repr([str(k) for k in key]).encode(), digest_size=8).digest(), "little")


def fit_and_predict(
    day: np.ndarray,
    y: np.ndarray,
    horizon: int,
    change_points: int = CHANGE_POINTS,
    seasons: Sequence[tuple[float, int]] = (WEEKLY, YEARLY),
    seed: int = 0,
) -> pd.DataFrame:
    """Fit one series given as day numbers and values; returns history and horizon, and in ``attrs`` the slope change of each change point."""
    span = max(float(day[-1] - day[0]), 1.0)
    scale = float(np.max(np.abs(y))) or 1.0
    all_days = np.concatenate([day, day[-1] + np.arange(1, horizon + 1)])
    n, t, z = len(day), (all_days - day[0]) / span, y / scale
    inner = change_points
    knots = np.linspace(0.0, CHANGE_POINT_RANGE, inner + 1)[1:]

    def trend_rows(part: slice) -> np.ndarray:
        return _hinges(t[part], knots)

    def season_rows(part: slice) -> np.ndarray:
        return _waves(all_days[part], seasons)

    noise = max(float(np.std(z)), 1e-6) ** 2 * 0.05
    season_factor = np.ones(len(t))
    for _ in range(ROUNDS if seasons else 1):
        sums = _sums(lambda p: trend_rows(p) * season_factor[:n][p, None], z, inner + 2)
        growth = _sparse(*sums, noise / 25.0, noise / CHANGE_POINT_SCALE)
        trend = _apply(trend_rows, len(t), growth)
        if seasons:
            width = 2 * sum(order for _, order in seasons)
            penalty = np.full(width, noise / SEASONALITY_SCALE**2)
            beta = _ridge(*_sums(lambda p: season_rows(p) * trend[:n][p, None], z - trend[:n], width), penalty)
            season_factor = 1.0 + _apply(season_rows, len(t), beta)
    fitted = trend * season_factor
    sigma = float(np.sqrt(np.mean((z - fitted[:n]) ** 2)))
    below, above = np.full(len(t), -INTERVAL_Z * sigma), np.full(len(t), INTERVAL_Z * sigma)
    # Future changes of slope: as frequent and as large as those found in the history.
    if horizon and growth[2:].any():
        below[n:], above[n:] = _drawn_interval(seed, all_days[n:], 1 / span, growth[2:], CHANGE_POINT_RANGE * span, sigma, season_factor[n:])
    out = pd.DataFrame(
        {
            "_day": all_days.astype("int64"),
            "yhat": fitted * scale,
            "yhat_lower": (fitted + below) * scale,
            "yhat_upper": (fitted + above) * scale,
        }
    )
    out.attrs["bends"] = growth[2:] * scale / span
    return out


def forecast_additive(
    series: DataFrame,
    keys: Sequence[str] = ("ticker", "attr"),
    horizon: int | DataFrame = HORIZON_DAYS,
    ahead: bool = False,
    change_points: int = CHANGE_POINTS,
    weekly: bool = True,
    yearly: bool = True,
) -> DataFrame:
    """Piecewise-linear trend with weekly and yearly seasons in proportion to it, and a 90 % interval.

    After the decomposable model of Taylor and Letham (2018), fitted by
    alternating penalised least squares instead of sampling, so its numbers are
    not those of that paper's own software. Every series may bend at the same change points and has the same seasons.
    Changes of slope have a Laplace prior, so most of them are exactly 0; a squared penalty shrinks the seasons. Days ahead get their
    interval from drawn futures, which bend as often and as much as the history did; the draws follow from the key of the
    series, so reruns agree. One task fits one series, which
    holds one number per calendar day; feature rows are made in chunks. ``horizon`` and ``ahead`` as
    in the baseline.
    """
    keys = list(keys)
    seasons = ([WEEKLY] if weekly else []) + ([YEARLY] if yearly else [])
    schema = T.StructType(
        [f for f in series.schema.fields if f.name in keys]
        + [T.StructField("_day", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("yhat", "yhat_lower", "yhat_upper")]
        + [T.StructField("ahead", T.BooleanType())]
    )

    def fit(pdf: pd.DataFrame, days: int) -> pd.DataFrame:
        pdf = pdf.sort_values("_day")
        out = fit_and_predict(pdf["_day"].to_numpy(float), pdf["y"].to_numpy(float), days, change_points, seasons, seed_of(*pdf[keys].iloc[0]))
        out.attrs = {}
        for key in keys:
            out[key] = pdf[key].iloc[0]
        out["ahead"] = out["_day"] > pdf["_day"].iloc[-1]
        return out

    def fit_beside(pdf: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({f.name: pd.Series(dtype=_EMPTY.get(type(f.dataType), "object")) for f in schema.fields})
        return fit(pdf, int(wanted["horizon"].max()) if len(wanted) else 0)

    numbered = series.where(F.col("y").isNotNull()).select(*keys, F.unix_date("ds").alias("_day"), "y")
    grouped = numbered.groupBy(*keys)
    if isinstance(horizon, DataFrame):
        # Other names: both sides may come from the same table.
        wanted = horizon.select(*[F.col(k).alias(f"_{k}") for k in keys], "horizon").groupBy(*[f"_{k}" for k in keys])
        predicted = grouped.cogroup(wanted).applyInPandas(fit_beside, schema)
    else:
        predicted = grouped.applyInPandas(lambda pdf: fit(pdf, horizon), schema)
    return predicted.withColumn("ds", F.date_from_unix_date(F.col("_day").cast("int"))).select(
        *keys, "ds", "yhat", "yhat_lower", "yhat_upper", *(["ahead"] if ahead else [])
    )


def beside_actual(
    forecast: DataFrame,
    actual: DataFrame,
    keys: Sequence[str] = ("ticker", "attr"),
    how: str = "full_outer",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Forecast and known values side by side; days known to one side only are kept.

    With ``how="left"`` only the forecast's days are, for a forecast that has all of them. ``extra`` columns of the forecast stay.
    """
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
    joined = forecast.join(actual.select(*keys, "ds", "y"), [*keys, "ds"], how)
    return joined.select(*keys, "ds", "y", "yhat", "yhat_lower", "yhat_upper", inside.alias("in_interval"), *extra)
