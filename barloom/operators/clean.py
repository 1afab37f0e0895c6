"""Deduplication, calendar filling, interpolation and the long form of bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import (
    SEGMENT,
    attach,
    days_between,
    inside_segment,
    later_segments,
    per_series,
    whole_series,
    with_segment,
)
from barloom.schema import ATTRIBUTES


def deduplicate(df: DataFrame, keys: Sequence[str] = ("ticker", "trading_date"), prefer: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the greatest by ``prefer``, then by the other columns.

    A maximum is combined map-side, so a key with very many copies does not
    gather them in one task.
    """
    rest = [*prefer, *[c for c in df.columns if c not in keys and c not in prefer]]
    kept = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def calendar_spine(bars: DataFrame, keys: Sequence[str] = ("ticker",), day: str = "trading_date") -> DataFrame:
    """Every calendar day from the first to the last bar of each series."""
    span = bars.groupBy(*keys).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return days_between(span, keys, "_first", "_last", day).select(*keys, day)


def calendar_fill(bars: DataFrame, keys: Sequence[str] = ("ticker",), day: str = "trading_date") -> DataFrame:
    """Bars on every calendar day; days without a bar have nulls.

    The same rows as the calendar spine left-joined to the bars, but each bar is
    expanded to the days up to the next bar, so no spine has to be shuffled.
    """
    rows = with_segment(bars, keys, day)
    firsts = rows.groupBy(*keys, SEGMENT).agg(F.min(day).alias("_first_day"))
    later = firsts.select(*keys, SEGMENT, F.min("_first_day").over(later_segments(keys)).alias("_later_day"))
    following = F.coalesce(F.lead(day).over(inside_segment(keys, day)), F.col("_later_day"))
    last = F.greatest(F.date_sub(following, 1), F.col(day))
    spans = rows.join(later, [*keys, SEGMENT], "left").withColumn("_to", last)
    each = F.explode(F.sequence(day, "_to", F.expr("interval 1 day")))
    values = {c: F.when(F.col("_each") == F.col(day), F.col(c)) for c in bars.columns if c not in (*keys, day)}
    filled = spans.withColumn("_each", each).withColumns(values)
    return filled.withColumn(day, F.col("_each")).select(*bars.columns)


def to_long(bars: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """One row per series, attribute and day: ``ticker, attr, ds, y``."""
    pairs = [part for a in attributes for part in (F.lit(a), F.col(a).cast("double"))]
    stacked = F.stack(F.lit(len(attributes)), *pairs).alias("attr", "y")
    return bars.select("ticker", F.col("trading_date").alias("ds"), stacked).select("ticker", "attr", "ds", "y")


def prepare_series(
    df: DataFrame, day: str = "trading_date", series: str = "ticker", value: str = "close"
) -> DataFrame:
    """One attribute as a regular series ``ds, unique_id, y`` with its gaps interpolated."""
    renamed = df.select(F.col(day).alias("ds"), F.col(series).alias("unique_id"), F.col(value).cast("double").alias("y"))
    return interpolate(renamed, keys=["unique_id"]).select("ds", "unique_id", "y")


def interpolate(series: DataFrame, keys: Sequence[str] = ("ticker", "attr"), day: str = "ds", value: str = "y") -> DataFrame:
    """A value for every calendar day of each series, linear between known values.

    Days before the first and after the last known value take the nearest one.
    Missing days and null values are both gaps. Each known value is paired with
    the next one and then expanded to the days it covers, so only known values
    are shuffled. A series without any known value has no rows.
    """
    rows = with_segment(series.select(*keys, day, value), keys, day)
    known_day = F.when(F.col(value).isNotNull(), F.col(day))
    summary = rows.groupBy(*keys, SEGMENT).agg(
        F.min(day).alias("_first_day"),
        F.max(day).alias("_last_day"),
        F.min(known_day).alias("_known_day"),
        F.min_by(value, known_day).alias("_known_value"),
    )
    around = summary.select(
        *keys,
        SEGMENT,
        F.min("_first_day").over(whole_series(keys)).alias("_start"),
        F.max("_last_day").over(whole_series(keys)).alias("_stop"),
        F.min("_known_day").over(whole_series(keys)).alias("_origin"),
        F.min("_known_day").over(later_segments(keys)).alias("_later_day"),
        F.first("_known_value", ignorenulls=True).over(later_segments(keys)).alias("_later_value"),
    )
    inside = inside_segment(keys, day)
    spans = (
        rows.where(F.col(value).isNotNull())
        .join(around, [*keys, SEGMENT], "left")
        .withColumn("_next_day", F.coalesce(F.lead(day).over(inside), F.col("_later_day")))
        .withColumn("_next_value", F.coalesce(F.lead(value).over(inside), F.col("_later_value")))
        .withColumn("_from", F.when(F.col(day) == F.col("_origin"), F.col("_start")).otherwise(F.col(day)))
        .withColumn("_to", F.greatest(F.coalesce(F.date_sub("_next_day", 1), F.col("_stop")), F.col(day)))
    )
    slope = F.try_divide(F.col("_next_value") - F.col(value), F.datediff("_next_day", day))
    days = spans.withColumn("_slope", slope).withColumn(
        "_each", F.explode(F.sequence("_from", "_to", F.expr("interval 1 day")))
    )
    inner = (F.col("_each") > F.col(day)) & F.col("_next_day").isNotNull()
    y = F.when(inner, F.col("_slope") * F.datediff("_each", day) + F.col(value)).otherwise(F.col(value))
    return days.select(*keys, F.col("_each").alias(day), y.alias(value))


def mode_of(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """The most frequent non-null value and its count; the smallest one on a tie.

    Counts are taken per value first, so the final step sees distinct values only.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("_minus"), F.col(column).alias("value"))).alias("_top")
    return counts.groupBy(*by).agg(top).select(
        *by, F.col("_top.value").alias(column), (-F.col("_top._minus")).alias("n")
    )


def fill_missing(df: DataFrame, value, columns: Sequence[str]) -> DataFrame:
    """Replace nulls of the named columns by a constant."""
    return df.fillna(value, subset=list(columns))


def bounds(bars: DataFrame) -> DataFrame:
    """First and last day, rows, price extremes and the volume axis (three times the largest volume) per series."""
    return bars.groupBy("ticker").agg(
        F.min("trading_date").alias("first_date"),
        F.max("trading_date").alias("last_date"),
        F.count(F.lit(1)).alias("n_bars"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        (F.max("volume") * 3).alias("volume_axis"),
    )


def long_enough(bars: DataFrame, more_than: int, keys: Sequence[str] = ("ticker",), day: str = "trading_date") -> DataFrame:
    """Only the series with more than so many rows."""
    rows = with_segment(bars, keys, day)
    counted = per_series(rows, keys, F.count(F.lit(1)).alias("_n"))
    return attach(rows, counted, keys).where(F.col("_n") > more_than).select(*bars.columns)
