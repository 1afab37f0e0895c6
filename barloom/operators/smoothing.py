"""Polynomial smoothing and seasonal decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.polynomial import smoothing_weights
from barloom.operators.series import (
    BLOCK,
    LENGTH,
    POSITION,
    attach_by_block,
    home_rows,
    in_blocks,
    inside_block,
    with_position,
)

KEYS = ["ticker"]
DAY = "trading_date"


def savgol(bars: DataFrame, value: str = "price_diff", window: int = 31, degree: int = 3) -> DataFrame:
    """Add ``smoothed``: at each row, the local polynomial through the window centred on it.

    Rows nearer to an end than half a window take the polynomial of the first or
    last full window. Series not longer than the window give null, and so does a
    window with a missing value.
    """
    half, reach = window // 2, window - 1
    blocks = in_blocks(with_position(bars, KEYS, DAY), before=reach, after=reach)
    around = inside_block(KEYS, DAY).rowsBetween(-reach, reach)
    nearby = F.collect_list(F.coalesce(F.col(value), F.lit(float("nan")))).over(around)
    table = ",".join("array(" + ",".join(f"{w!r}D" for w in row) + ")" for row in smoothing_weights(window, degree).tolist())
    # The window starts at row `_start`; the list of nearby rows starts at row max(position - reach, 1).
    start = F.greatest(F.lit(1), F.least(F.col(POSITION) - half, F.col(LENGTH) - reach))
    offset = F.col("_start") - F.greatest(F.lit(1), F.col(POSITION) - reach)
    products = F.zip_with(
        F.slice("_nearby", (offset + 1).cast("int"), window),
        F.element_at(F.expr(f"array({table})"), (F.col(POSITION) - F.col("_start") + 1).cast("int")),
        lambda y, w: y * w,
    )
    fitted = F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
    rows = home_rows(blocks.withColumn("_nearby", nearby)).withColumn("_start", start)
    smoothed = F.when(F.col(LENGTH) > window, F.nanvl(fitted, F.lit(None).cast("double")))
    return rows.withColumn("smoothed", smoothed).select(*bars.columns, "smoothed")


def seasonal_decompose(bars: DataFrame, value: str = "close", period: int = 30) -> DataFrame:
    """Classical additive decomposition into trend, seasonal pattern and residual.

    The trend is the centred moving average (half weights at both ends for an
    even period), null where any of its values is missing. The pattern is the
    mean of the detrended values by position in the period, centred. Every row
    stays; in series shorter than two periods all three are null.
    """
    half = period // 2
    placed = with_position(bars.select(*KEYS, DAY, value), KEYS, DAY)
    blocks = in_blocks(placed, before=half, after=half)
    order = inside_block(KEYS, DAY)
    if period % 2 == 0:
        frame, weights = order.rowsBetween(1 - half, half - 1), period - 1
        ends = F.lag(value, half).over(order) + F.lead(value, half).over(order)
    else:
        frame, weights, ends = order.rowsBetween(-half, half), period, F.lit(0.0)
    whole = F.when(F.count(value).over(frame) == weights, F.sum(value).over(frame))
    average = (whole + 0.5 * ends) / period
    full = (F.col(POSITION) > half) & (F.col(POSITION) <= F.col(LENGTH) - half) & (F.col(LENGTH) >= 2 * period)
    trended = home_rows(blocks.withColumn("trend", F.when(full, average))).withColumn(
        "_phase", ((F.col(POSITION) - 1) % period).cast("int")
    )
    phases = trended.groupBy(*KEYS, "_phase").agg(
        F.avg(F.col(value) - F.col("trend")).alias("_mean"), F.max(LENGTH).alias(LENGTH)
    )
    # At most `period` rows per series from here on.
    pattern = phases.groupBy(*KEYS).agg(
        F.map_from_entries(F.collect_list(F.struct("_phase", "_mean"))).alias("_means"),
        F.avg("_mean").alias("_level"),
        F.max(LENGTH).alias(LENGTH),
    )
    return (
        attach_by_block(trended.drop(LENGTH), pattern, KEYS)
        .withColumn("seasonal", F.element_at("_means", F.col("_phase")) - F.col("_level"))
        .withColumn("resid", F.col(value) - F.col("trend") - F.col("seasonal"))
        .select(*KEYS, DAY, value, "trend", "seasonal", "resid")
    )
