"""Returns, moving statistics, bands and money flow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import (
    LENGTH,
    SEGMENT,
    earlier_segments,
    home_segments,
    inside_block,
    inside_segment,
    segments_in_blocks,
    whole_series,
    with_segment,
)

KEYS = ["ticker"]
DAY = "trading_date"


def returns(bars: DataFrame, price: str = "close") -> DataFrame:
    """Add the daily return and the cumulative return since the first price.

    A missing price counts as unchanged. The product of (1 + return) up to a day
    telescopes to price / first price, which needs no running product. After a
    price of zero the product is undefined, so it is null from then on.
    """
    rows = with_segment(bars, KEYS, DAY)
    known = F.when(F.col(price).isNotNull(), F.col(DAY))
    summary = rows.groupBy(*KEYS, SEGMENT).agg(
        F.max_by(price, known).alias("_last"),
        F.min_by(price, known).alias("_first"),
        F.min(F.when(F.col(price) == 0, F.col(DAY))).alias("_zero"),
    )
    in_order = Window.partitionBy(*KEYS).orderBy(SEGMENT)
    carried = summary.select(
        *KEYS,
        SEGMENT,
        F.last("_last", ignorenulls=True).over(earlier_segments(KEYS)).alias("_carried"),
        F.first("_first", ignorenulls=True)
        .over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        .alias("_base"),
        F.min("_zero").over(whole_series(KEYS)).alias("_zero"),
    )
    before = inside_segment(KEYS, DAY).rowsBetween(Window.unboundedPreceding, -1)
    previous = F.coalesce(F.last(price, ignorenulls=True).over(before), F.col("_carried"))
    current = F.coalesce(F.col(price), F.col("_previous"))
    defined = F.col("_previous").isNotNull() & (F.col("_zero").isNull() | (F.col(DAY) <= F.col("_zero")))
    return (
        rows.join(carried, [*KEYS, SEGMENT], "left")
        .withColumn("_previous", previous)
        .withColumn("returns", F.try_divide(current, F.col("_previous")) - 1)
        .withColumn("cumulative_return", F.when(defined, F.try_divide(current, F.col("_base"))))
        .select(*bars.columns, "returns", "cumulative_return")
    )


def moving_stats(bars: DataFrame, price: str = "close", short: int = 20, long: int = 150) -> DataFrame:
    """Add ``ma<short>``, ``std<short>`` and ``ma<long>`` over trailing rows.

    Null until the frame is full, and the long average only in series longer than it. A frame is
    summed anew at every row, so the long one is put together from the sums of the short frames
    that it consists of and of the rows that remain. Nothing is ever subtracted, so sums are as
    exact as if taken at once, and a NaN stays in the frames it lies in.
    """
    blocks = segments_in_blocks(bars, KEYS, DAY, before=max(short, long) - 1)
    order = inside_block(KEYS, DAY)
    pieces, rest = divmod(long, short)

    def full_sum(first: int, last: int) -> Column:
        frame = order.rowsBetween(first, last)
        return F.when(F.count(price).over(frame) == last - first + 1, F.sum(price).over(frame))

    near = order.rowsBetween(1 - short, 0)
    summed = blocks.withColumn("_near", full_sum(1 - short, 0)).withColumn(f"std{short}", F.stddev_samp(price).over(near))
    parts = [F.lag("_near", k * short).over(order) for k in range(pieces)]
    if rest:
        summed = summed.withColumn("_rest", full_sum(1 - long, rest - long))
        parts.append(F.col("_rest"))
    stats = (
        summed.withColumn(f"ma{short}", F.col("_near") / short)
        .withColumn(f"std{short}", F.when(F.col("_near").isNotNull(), F.col(f"std{short}")))
        .withColumn(f"ma{long}", F.when(F.col(LENGTH) > long, reduce(Column.__add__, parts) / long))
    )
    return home_segments(stats).select(*bars.columns, f"ma{short}", f"std{short}", f"ma{long}")


def bollinger(bars: DataFrame, price: str = "close", width: float = 2.0) -> DataFrame:
    """Moving statistics and the bands two deviations around the short average."""
    return (
        moving_stats(bars, price)
        .withColumn("lower_band", F.col("ma20") - width * F.col("std20"))
        .withColumn("upper_band", F.col("ma20") + width * F.col("std20"))
    )


def indicator_panel(bars: DataFrame) -> DataFrame:
    """What the price charts draw: open trend, close with averages and bands, volume."""
    return bollinger(bars).select(
        "ticker", "trading_date", "open", "close", "volume", "ma20", "ma150", "lower_band", "upper_band"
    )


def accumulation_distribution(bars: DataFrame) -> DataFrame:
    """Add the money flow volume of each day and its running sum; a flat day contributes nothing."""
    high, low, close = F.col("high"), F.col("low"), F.col("close")
    flow = F.try_divide((close - low) - (high - close), high - low) * F.col("volume")
    rows = with_segment(bars, KEYS, DAY).withColumn("money_flow_volume", F.coalesce(flow, F.lit(0.0)))
    totals = rows.groupBy(*KEYS, SEGMENT).agg(F.sum("money_flow_volume").alias("_total"))
    carried = totals.select(
        *KEYS, SEGMENT, F.coalesce(F.sum("_total").over(earlier_segments(KEYS)), F.lit(0.0)).alias("_carried")
    )
    so_far = inside_segment(KEYS, DAY).rowsBetween(Window.unboundedPreceding, 0)
    running = F.col("_carried") + F.sum("money_flow_volume").over(so_far)
    return (
        rows.join(carried, [*KEYS, SEGMENT], "left")
        .withColumn("accumulation_distribution", running)
        .select(*bars.columns, "money_flow_volume", "accumulation_distribution")
    )
