"""Slices of bars by date, by period, by position, and their differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import LENGTH, POSITION, with_position

# The two market periods, both ends excluded.
MARKET_PERIODS = [
    ("financial_crisis_2008", "2007-08-01", "2008-12-31"),
    ("covid_pandemic", "2020-01-01", "2021-06-30"),
]


def bars_between(bars: DataFrame, start, end, day: str = "trading_date") -> DataFrame:
    """Bars from ``start`` up to but excluding ``end``."""
    return bars.where((F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date")))


def period_slice(bars: DataFrame, periods: Sequence[tuple[str, str, str]] = MARKET_PERIODS, day: str = "trading_date") -> DataFrame:
    """Label bars with the named periods they lie strictly inside; a bar in two periods comes twice.

    The periods are literals: the range test reaches the scan, and no join is planned.
    """

    def inside(lo: str, hi: str) -> Column:
        return (F.col(day) > F.lit(lo).cast("date")) & (F.col(day) < F.lit(hi).cast("date"))

    labels = F.array_compact(F.array(*[F.when(inside(lo, hi), F.lit(name)) for name, lo, hi in periods]))
    any_period = reduce(Column.__or__, [inside(lo, hi) for _, lo, hi in periods])
    return bars.where(any_period).withColumn("period", F.explode(labels))


#: Calendar days of a bucket, in which bars and pieces of periods meet, and parts that a bucket's bars are dealt to.
BUCKET_DAYS, PARTS = 32, 64


def label_periods(bars: DataFrame, periods: DataFrame, day: str = "trading_date") -> DataFrame:
    """Label bars with the periods of a table ``period, start, end`` they lie strictly inside; a bar in several comes several times.

    A null start or end is open. Periods are cut at the borders of calendar buckets, so bars find them by an equal bucket; the exact
    test follows. Each bucket's bars are dealt to ``PARTS`` parts, with a copy of the bucket's pieces for each, so that no
    day or ticker makes a part hot. Spark sends the pieces to the bars if it measures them to be small, and else
    shuffles both. Open ends reach as far as the bars do. Periods that hold no day, repeated ones included, label nothing more than their rows say:
    a repeated row labels twice. Bars without a date are in no period.
    """
    dated = bars.where(F.col(day).isNotNull())
    first, last = (dated.agg(f(F.unix_date(day))).scalar() for f in (F.min, F.max))
    bucket = lambda n: F.floor(n / BUCKET_DAYS).cast("int")
    named = periods.select("period", F.unix_date(F.col("start").cast("date")).alias("_start"), F.unix_date(F.col("end").cast("date")).alias("_end"))
    reach = named.select(
        "*", F.greatest(F.coalesce(F.col("_start") + 1, first), first).alias("_from"), F.least(F.coalesce(F.col("_end") - 1, last), last).alias("_to")
    )
    pieces = (
        reach.where(F.col("_from") <= F.col("_to"))
        .select("period", "_from", "_to", F.explode(F.sequence(bucket(F.col("_from")), bucket(F.col("_to")))).alias("_bucket"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    )
    keyed = [c for c in ("ticker", day) if c in bars.columns]
    placed = dated.withColumn("_day", F.unix_date(day)).withColumn("_bucket", bucket(F.col("_day")))
    dealt = placed.withColumn("_part", F.pmod(F.xxhash64(*keyed), F.lit(PARTS)).cast("int"))
    met = dealt.join(pieces, ["_bucket", "_part"]).where((F.col("_day") >= F.col("_from")) & (F.col("_day") <= F.col("_to")))
    return met.select(*bars.columns, "period")


def price_range(bars: DataFrame) -> DataFrame:
    """Add ``price_diff``, the day's high minus its low."""
    return bars.withColumn("price_diff", F.col("high") - F.col("low"))


def first_rows(bars: DataFrame, n: int, keys: Sequence[str] = ("ticker",), day: str = "trading_date") -> DataFrame:
    """The first n rows of each series by date."""
    return with_position(bars, keys, day).where(F.col(POSITION) <= n).select(*bars.columns)


def train_valid_split(
    df: DataFrame, keys: Sequence[str] = ("ticker",), day: str = "trading_date", numerator: int = 4, denominator: int = 5
) -> DataFrame:
    """Mark the leading part of each series ``train`` and the rest ``valid``, by an exact integer cut."""
    placed = with_position(df, keys, day)
    cut = F.floor(F.col(LENGTH) * numerator / denominator)
    part = F.when(F.col(POSITION) <= cut, F.lit("train")).otherwise(F.lit("valid"))
    return placed.withColumn("part", part).select(*df.columns, "part")


def rows_not_in(df: DataFrame, other: DataFrame, keep_copies: bool = False) -> DataFrame:
    """Set difference; ``keep_copies`` subtracts copy by copy."""
    return df.exceptAll(other) if keep_copies else df.subtract(other)
