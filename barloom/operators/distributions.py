"""Histograms and box-plot statistics per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.numbers import finite
from barloom.operators.series import attach, per_series, with_segment

KEYS = ["ticker"]
DAY = "trading_date"
SLOTS = 64
#: The summary's ranks are off by a part of 1/ACCURACY at most; with the place between two ranks, MARGIN covers that
#: in series of more than WHOLE rows. Shorter ones are ordered whole.
ACCURACY, MARGIN, WHOLE = 10_000, 0.001, 4096


def _bin(value: str, lo: str, hi: str, bins: int) -> Column:
    """Index of the equal-width bin; the last one is closed."""
    scaled = F.floor((F.col(value) - F.col(lo)) / (F.col(hi) - F.col(lo)) * bins)
    return F.least(scaled.cast("int"), F.lit(bins - 1))


def histogram(df: DataFrame, value: str, bins: int = 10, view: tuple[float, float] | None = None) -> DataFrame:
    """Counts and densities of equal-width bins between each series' minimum and maximum.

    Every bin has a row, empty ones too. A series with a single value gets a range
    of one around it. ``view`` marks the bins that overlap the displayed interval.
    """
    rows = df.select(*KEYS, DAY, finite(value).alias(value)).where(F.col(value).isNotNull())
    rows = with_segment(rows, KEYS, DAY)
    half = F.when(F.col("_min") == F.col("_max"), F.lit(0.5)).otherwise(F.lit(0.0))
    limits = (
        per_series(rows, KEYS, F.min(value).alias("_min"), F.max(value).alias("_max"))
        .withColumn("_lo", F.col("_min") - half)
        .withColumn("_hi", F.col("_max") + half)
        .drop("_min", "_max")
    )
    counts = (
        attach(rows, limits, KEYS)
        .groupBy(*KEYS, _bin(value, "_lo", "_hi", bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("_count"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    )
    # At most `bins` rows per series from here on.
    filled = counts.groupBy(*KEYS).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "_count"))).alias("_counts"),
        F.sum("_count").alias("_n"),
        F.max("_lo").alias("_lo"),
        ((F.max("_hi") - F.max("_lo")) / bins).alias("_width"),
    )
    out = (
        filled.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .withColumn("count", F.coalesce(F.element_at("_counts", F.col("bin")), F.lit(0)))
        .withColumn("left_edge", F.col("_lo") + F.col("bin") * F.col("_width"))
        .withColumn("right_edge", F.col("_lo") + (F.col("bin") + 1) * F.col("_width"))
        .withColumn("density", F.col("count") / (F.col("_n") * F.col("_width")))
    )
    columns = [*KEYS, "bin", "left_edge", "right_edge", "count", "density"]
    if view is not None:
        lo, hi = view
        out = out.withColumn("in_view", (F.col("right_edge") >= lo) & (F.col("left_edge") <= hi))
        columns.append("in_view")
    return out.select(*columns)


def _value_counts(df: DataFrame, value: str) -> DataFrame:
    """Each distinct value of a series with its number of rows, dealt out to slots."""
    given = df.select(*KEYS, finite(value).alias("_x")).where(F.col("_x").isNotNull() & F.col("ticker").isNotNull())
    counted = given.groupBy(*KEYS, "_x")
    return counted.agg(F.count(F.lit(1)).alias("_c")).withColumn(
        "_slot", F.pmod(F.xxhash64("_x"), F.lit(SLOTS)).cast("int")
    )


def _for_slots(values: DataFrame, stats: DataFrame) -> DataFrame:
    """Add per-series columns to value counts; one copy per slot, so a long series is spread over slots."""
    copies = stats.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    return values.join(copies, [*KEYS, "_slot"], "left")


def _brackets(df: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Of each series its rows ``_n`` and, for every quantile, two of its values that hold it between them."""
    asked = [min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-MARGIN, MARGIN)]
    given = df.select(*KEYS, finite(value).alias("_x")).where(F.col("_x").isNotNull() & F.col("ticker").isNotNull())
    near = F.percentile_approx("_x", asked, ACCURACY)
    limits = given.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"), near.alias("_near")
    )
    few = F.col("_n") <= WHOLE
    pairs = [
        F.struct(
            F.lit(i).alias("i"),
            F.when(few, F.col("_min")).otherwise(F.get("_near", F.lit(2 * i))).alias("lo"),
            F.when(few, F.col("_max")).otherwise(F.get("_near", F.lit(2 * i + 1))).alias("hi"),
        )
        for i in range(len(probabilities))
    ]
    return limits.select(*KEYS, "_n", F.array(*pairs).alias("_brackets"))


def _inside(placed: DataFrame) -> DataFrame:
    """The values that lie in a bracket, once for each: all that is ever ordered."""
    held = F.filter("_brackets", lambda b: (F.col("_x") >= b["lo"]) & (F.col("_x") <= b["hi"]))
    return placed.select(*KEYS, "_x", "_c", "_n", F.explode(F.transform(held, lambda b: b["i"])).alias("_i"))


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles of each series by linear interpolation between order statistics.

    A summary of each series, combined map-side, brackets every quantile between two of its values; the
    ranks below a bracket are counted, and only the distinct values inside it are ordered: about
    one in 500 of a long series, however its values lie. Gives ``n, q0, q1, ...`` per series.
    """
    placed = _for_slots(_value_counts(df, value), _brackets(df, value, probabilities))
    x, which = F.col("_x"), range(len(probabilities))
    under = [F.when(x < F.get("_brackets", F.lit(i))["lo"], F.col("_c")).otherwise(F.lit(0)) for i in which]
    lower = placed.groupBy(*KEYS).agg(F.array(*[F.sum(u) for u in under]).alias("_below"))
    upto = Window.partitionBy(*KEYS, "_i").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _inside(placed).withColumn("_end", F.sum("_c").over(upto)).join(lower, KEYS)
    ranked = ranked.withColumn("_end", F.col("_end") + F.get("_below", F.col("_i")))
    ranked = ranked.withColumn("_start", F.col("_end") - F.col("_c"))
    places = [(F.col("_n") - 1) * F.lit(float(p)) for p in probabilities]
    outside = F.raise_error(F.lit("a bracket does not hold its quantile")).cast("double")

    def at(i: int, rank: Column) -> Column:
        return F.max(F.when((F.col("_i") == i) & (rank >= F.col("_start")) & (rank < F.col("_end")), x))

    picked = ranked.groupBy(*KEYS).agg(
        F.max("_n").alias("_n"),
        *[at(i, F.floor(place)).alias(f"low{i}") for i, place in enumerate(places)],
        *[at(i, F.ceil(place)).alias(f"high{i}") for i, place in enumerate(places)],
    )
    low, high = ([F.coalesce(F.col(f"{end}{i}"), outside) for i in range(len(places))] for end in ("low", "high"))
    return picked.select(
        *KEYS,
        F.col("_n").alias("n"),
        *[(low[i] + (place - F.floor(place)) * (high[i] - low[i])).alias(f"q{i}") for i, place in enumerate(places)],
    )


def _fences(df: DataFrame, value: str, whisker: float) -> DataFrame:
    q = quantiles(df, value, [0.25, 0.5, 0.75])
    reach = whisker * (F.col("q2") - F.col("q0"))
    return q.withColumn("_low_fence", F.col("q0") - reach).withColumn("_high_fence", F.col("q2") + reach)


def box_stats(df: DataFrame, value: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (the outermost values within 1.5 quartile ranges) and the number of outliers."""
    x = F.col("_x")
    low = F.least(F.min(F.when(x >= F.col("_low_fence"), x)), F.max("q0"))
    high = F.greatest(F.max(F.when(x <= F.col("_high_fence"), x)), F.max("q2"))
    outside = (x < F.col("_low_fence")) | (x > F.col("_high_fence"))
    return (
        _for_slots(_value_counts(df, value), _fences(df, value, whisker))
        .groupBy(*KEYS)
        .agg(
            F.max("n").alias("n"),
            F.max("q0").alias("q1"),
            F.max("q1").alias("median"),
            F.max("q2").alias("q3"),
            low.alias("whisker_low"),
            high.alias("whisker_high"),
            F.sum(F.when(outside, F.col("_c")).otherwise(F.lit(0))).alias("n_outliers"),
        )
    )


def box_outliers(df: DataFrame, value: str, whisker: float = 1.5) -> DataFrame:
    """The rows beyond the whiskers, with the side they are on."""
    rows = df.select(*KEYS, DAY, finite(value).alias(value)).where(F.col(value).isNotNull())
    rows = with_segment(rows, KEYS, DAY)
    fences = per_series(rows, KEYS).join(_fences(df, value, whisker), KEYS)
    side = F.when(F.col(value) < F.col("_low_fence"), F.lit("low")).when(
        F.col(value) > F.col("_high_fence"), F.lit("high")
    )
    outliers = attach(rows, fences, KEYS).withColumn("side", side)
    return outliers.where(F.col("side").isNotNull()).select(*KEYS, DAY, value, "side")
