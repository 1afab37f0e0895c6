"""Ordered work on series of any length, without one task per series.

A series is the set of rows sharing ``keys``, ordered by a date that is unique
within it. A plain ``Window.partitionBy(keys)`` would sort a whole series in one
task. Here rows are grouped by (series, segment) or (series, block) instead:

* a *segment* is a fixed span of calendar days, so it holds at most
  ``SEGMENT_DAYS`` rows. It is a function of the date alone, so grouping needs
  no look-up. What a segment needs to know about the rest of its series comes
  from a summary of one row per segment, made with map-side partial aggregates.
* a *block* is a fixed span of row positions. Rolling frames run inside
  blocks; the few rows a frame reaches beyond its block are copied into it.
  Where no row's own position is needed, whole segments are dealt to blocks by
  the position of their first row, which spares numbering the rows.

Joins between rows and summaries are always on (series, segment) or
(series, block), so no join key ever holds more than a bounded number of rows,
however unevenly rows spread over series. They are left joins, so the rows are
always the streamed side: the summary may be broadcast once Spark has measured
it to be small, and otherwise both sides are shuffled on the same keys the
window after the join needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

SEGMENT_DAYS = 1024
BLOCK_ROWS = 2048

SEGMENT = "_segment"
BLOCK = "_block"
POSITION = "_position"
LENGTH = "_length"
HOME = "_home"


def segment_of(day: str) -> Column:
    return F.floor(F.unix_date(day) / SEGMENT_DAYS).cast("int")


def with_segment(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Add the segment; a row without key or date belongs to no series and is left out.

    Joins imply that filter for one of their sides. Stated here it holds for
    all uses of the rows, so they share one scan and one shuffle.
    """
    placed = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, day)])
    return df.where(placed).withColumn(SEGMENT, segment_of(day))


def inside_segment(keys: Sequence[str], day: str) -> WindowSpec:
    """The rows of one segment by date."""
    return Window.partitionBy(*keys, SEGMENT).orderBy(day)


def whole_series(keys: Sequence[str]) -> WindowSpec:
    """All segments of a series; for summaries, which have one row per segment."""
    return Window.partitionBy(*keys)


def earlier_segments(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)


def later_segments(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(1, Window.unboundedFollowing)


def per_series(rows: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates over whole series: one row per series, with the span of its segments."""
    return rows.groupBy(*keys).agg(
        F.min(SEGMENT).alias("_first_segment"), F.max(SEGMENT).alias("_last_segment"), *aggregates
    )


def attach(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``per_series`` output to rows, joined on (series, segment)."""
    repeated = stats.withColumn(SEGMENT, F.explode(F.sequence("_first_segment", "_last_segment")))
    return rows.join(repeated.drop("_first_segment", "_last_segment"), [*keys, SEGMENT], "left")


def _offsets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per segment: its rows, the rows of earlier segments and the length of the series."""
    counts = rows.groupBy(*keys, SEGMENT).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.select(
        *keys,
        SEGMENT,
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier_segments(keys)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole_series(keys)).alias(LENGTH),
    )


def with_position(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Add each row's 1-based position in its series and the length of the series."""
    rows = with_segment(df, keys, day)
    offsets = _offsets(rows, keys).drop("_rows")
    inside = F.row_number().over(inside_segment(keys, day))
    return (
        rows.join(offsets, [*keys, SEGMENT], "left")
        .withColumn(POSITION, F.col("_before") + inside)
        .drop("_before", SEGMENT)
    )


def days_between(df: DataFrame, keys: Sequence[str], first: str, last: str, name: str) -> DataFrame:
    """One row per calendar day from ``first`` to ``last``.

    A few short rows become very many, so spans are cut at segment borders and
    spread over all tasks before they are expanded.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = df.withColumn(SEGMENT, F.explode(F.sequence(segment_of(first), segment_of(last))))
    start = F.date_from_unix_date(F.col(SEGMENT) * SEGMENT_DAYS)
    lo, hi = F.greatest(F.col(first), start), F.least(F.col(last), F.date_add(start, SEGMENT_DAYS - 1))
    expanded = pieces.repartition(tasks, *keys, SEGMENT).withColumn(
        name, F.explode(F.sequence(lo, hi, F.expr("interval 1 day")))
    )
    return expanded.drop(SEGMENT)


def _block_at(position: Column) -> Column:
    return F.floor((position - 1) / BLOCK_ROWS).cast("int")


def in_blocks(positioned: DataFrame, before: int = 0, after: int = 0) -> DataFrame:
    """Give rows their block, copying those within ``before`` or ``after`` rows of another block into it.

    Drop the copies with ``home_rows`` once the frames are evaluated.
    """
    first = _block_at(F.greatest(F.col(POSITION) - after, F.lit(1)))
    last = _block_at(F.least(F.col(POSITION) + before, F.col(LENGTH)))
    return positioned.withColumn(BLOCK, F.explode(F.sequence(first, last)))


def segments_in_blocks(df: DataFrame, keys: Sequence[str], day: str, before: int = 0) -> DataFrame:
    """Give rows the block their segment begins in and the length of the series, copying segments that end within ``before`` rows of another block into it.

    A block holds its rows by date without their positions, so rows are neither sorted nor numbered
    before they are dealt to blocks, and copies are made in the summary. Drop them with
    ``home_segments`` once the frames are evaluated.
    """
    rows = with_segment(df, keys, day)
    first = _block_at(F.col("_before") + 1)
    last = _block_at(F.least(F.col("_before") + F.col("_rows") + before, F.col(LENGTH)))
    places = _offsets(rows, keys).select(*keys, SEGMENT, LENGTH, first.alias(HOME), F.explode(F.sequence(first, last)).alias(BLOCK))
    return rows.join(places, [*keys, SEGMENT], "left").drop(SEGMENT)


def home_segments(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col(BLOCK) == F.col(HOME))


def inside_block(keys: Sequence[str], day: str) -> WindowSpec:
    """The rows of one block, copies included, by date."""
    return Window.partitionBy(*keys, BLOCK).orderBy(day)


def home_rows(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col(BLOCK) == _block_at(F.col(POSITION)))


def attach_by_block(blocks: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add per-series columns to rows that carry their block; ``stats`` must hold the series length."""
    repeated = stats.withColumn(BLOCK, F.explode(F.sequence(F.lit(0), _block_at(F.col(LENGTH)))))
    return blocks.join(repeated.drop(LENGTH), [*keys, BLOCK], "left")
