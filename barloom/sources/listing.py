"""Tickers and files in a global order: request plans, stripes, the k-th ticker, size budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.dates import epoch_seconds
from barloom.functions.sampling import least_hashes
from barloom.session import stored

# Fixed value: the query part of a request.
REQUEST = "%s?ticker=%s&type=stock&resolution=D&from=%d&to=%d"


def universe(bars: DataFrame) -> DataFrame:
    """Every ticker once."""
    return bars.select("ticker").distinct()


#: Sampled keys for each range, and ranges at most: what the driver sees is bounded, the ranges are balanced.
SAMPLED = 64
MOST_RANGES = 2048


#: Rows among which a place is found by ordering them.
FEW = 10_000


def _borders(df: DataFrame, key: str, ranges: int) -> list:
    """First keys of all ranges but the first, so that they are about equally full.

    They come from the rows with the smallest key hashes, ``SAMPLED`` for each
    range: the same ones in every run, and the only rows the driver sees.
    """
    sample = least_hashes(df.select(key), [key], SAMPLED * ranges, df.count())
    seen = sorted({row[key] for row in sample.collect() if row[key] is not None})
    return seen[:: max(1, -(-len(seen) // ranges))][1:]


def _range_of(key: str, borders: list) -> Column:
    """How many borders are not above a key, by halving steps over one constant array; 0 for null."""
    if not borders:
        return F.lit(0)
    given = F.array(*map(F.lit, borders))
    steps = F.array(*[F.lit(1 << i) for i in range(len(borders).bit_length() - 1, -1, -1)])
    there = lambda at, step: F.coalesce(F.get(given, at + step - 1) <= F.col(key), F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(there(at, step), at + step).otherwise(at))


def _ranges(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """Add ``_range``, the key's range number; ranges follow the key order and are about equally full.

    The borders balance the ranges and have no effect on results.
    """
    return df.withColumn("_range", _range_of(key, _borders(df, key, ranges)))


def _tasks(df: DataFrame) -> int:
    return min(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), MOST_RANGES)


def with_running(df: DataFrame, key: str, measure: Column, name: str, upto: int | None = None) -> DataFrame:
    """Add the running total of a measure over all rows in the order of a unique key.

    Totals of key ranges first, then running totals inside each range: at no
    point does one task order the whole table. There are as many ranges as shuffle
    partitions. ``upto`` leaves out ranges whose earlier ranges exceed it, before they are ordered.
    """
    rows = _ranges(df.withColumn("_measure", measure), key, _tasks(df))
    totals = rows.groupBy("_range").agg(F.sum("_measure").alias("_total"))
    # One row per range: this window has one partition by design.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    if upto is not None:
        offsets = offsets.where(F.col("_before") <= upto)
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.sum("_measure").over(inside))
        .drop("_range", "_measure", "_before")
    )


def stripes(tickers: DataFrame, n: int, key: str = "ticker") -> DataFrame:
    """Deal the tickers out to n workers in turn, in key order."""
    numbered = with_running(tickers, key, F.lit(1).cast("bigint"), "_number")
    return numbered.withColumn("stripe", F.pmod(F.col("_number") - 1, F.lit(n)).cast("int")).drop("_number")


def kth_ticker(tickers: DataFrame, k: int, key: str = "ticker") -> DataFrame:
    """The ticker at 0-based place k of the sorted listing, null first; no row beyond its end.

    The listing is counted by ranges, and the range that holds the place again, until it has ``FEW`` rows; those alone
    are ordered. So k may be anything, and the driver sees counts and borders only.
    """
    rows = stored(tickers.select(key).distinct(), "listing")
    if k < 0:
        return rows.limit(0)
    while True:
        borders = _borders(rows, key, _tasks(rows))
        counts = {r["_range"]: r["count"] for r in rows.groupBy(_range_of(key, borders).alias("_range")).count().collect()}
        inside = next((i for i in range(len(borders) + 1) if k < sum(counts.get(j, 0) for j in range(i + 1))), None)
        if inside is None:
            return rows.limit(0)
        k -= sum(counts.get(j, 0) for j in range(inside))
        after = F.col(key) >= F.lit(borders[inside - 1]) if inside else F.lit(True)
        before = (F.col(key) < F.lit(borders[inside])) | F.col(key).isNull() if inside < len(borders) else F.lit(True)
        rows = rows.where(after & before)
        if counts[inside] <= FEW:
            return rows.orderBy(key).offset(k).limit(1)


def within_budget(files: DataFrame, key: str, size: str, megabytes: float) -> DataFrame:
    """Rows taken in key order until their total size exceeds the budget; the one that crosses it is kept."""
    cap = int(megabytes * 1024 * 1024)
    running = with_running(files, key, F.col(size).cast("bigint"), "_upto", upto=cap)
    return (
        running.where(F.col("_upto") - F.col(size) <= cap)
        .withColumn("running_mb", F.col("_upto") / 1024 / 1024)
        .drop("_upto")
    )


def request_plan(tickers: DataFrame, endpoint: str, from_date: Column, to_date: Column) -> DataFrame:
    """One request per ticker for the bars between two days."""
    epochs = tickers.withColumn("from_epoch", epoch_seconds(from_date)).withColumn("to_epoch", epoch_seconds(to_date))
    return epochs.withColumn(
        "url", F.format_string(REQUEST, F.lit(endpoint), F.col("ticker"), F.col("from_epoch"), F.col("to_epoch"))
    )


def recent_window(as_of: Column, days: int = 25) -> tuple[Column, Column]:
    """The request window of a regular run: the last days up to ``as_of``."""
    return F.date_sub(as_of, days), as_of


def next_slice(start: Column, days: int = 7) -> tuple[Column, Column]:
    """The request window of a replay run: a week from ``start``."""
    return start, F.date_add(start, days)
