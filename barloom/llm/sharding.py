"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.tables import plain_names

SEED = 20
COPIES_AT_ONCE = 100_000


def _draw(key: Column, shard: str) -> Column:
    """A number in (0, 1) that depends on key and shard alone."""
    top = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(SEED)), 11)
    return (top.cast("double") + 0.5) / float(1 << 53)


def shard_of(key: Column, weights: Mapping[str, float]) -> Column:
    """The shard (by its place in ``weights``) that scores highest for a key.

    A shard's score is ``-weight / ln(draw)``: its chance to win is its part of all
    weights, and no other shard changes it. So a new shard takes rows only into
    itself. A null key is a key like any other; equal scores go to the earlier shard.
    Shards of weight 0 take nothing.
    """
    if any(w < 0 for w in weights.values()) or not any(weights.values()):
        raise ValueError("weights must not be negative, and one must be positive")
    scored = [
        F.struct((F.lit(-float(w)) / F.log(_draw(key, name))).alias("score"), F.lit(-i).alias("place"))
        for i, (name, w) in enumerate(weights.items())
        if w > 0
    ]
    return (-F.array_max(F.array(*scored))["place"]).cast("int")


def assign(df: DataFrame, key: str, weights: Mapping[str, float], shard: str = "shard") -> DataFrame:
    """Add the shard of each row, by key and weights alone: a projection without a shuffle.

    Rows with the same key, repeated or not, share a shard; an empty table stays empty.
    Other columns stay, one named like ``shard`` is replaced.
    """
    return df.withColumn(shard, shard_of(F.col(key), weights))


def with_slots(df: DataFrame, shard: str, slot: str = "slot") -> DataFrame:
    """Number the rows of every shard without gaps from 0.

    A shard may hold any part of the table, so no task orders a whole one. Rows equal
    in all columns are counted first; the distinct ones are numbered within pieces of a
    shard (by a hash of all columns), and the pieces' totals, a table of shards times
    pieces, give the offsets. The numbers depend on the rows and the number of
    shuffle partitions only. An existing column named like ``slot`` is replaced.
    """
    inner, at, back = plain_names(df.drop(slot))
    columns, place = list(at.values()), at[shard]
    parts = max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = inner.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    pieces = counted.withColumn("piece", F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int"))
    earlier = Window.unboundedPreceding, -1
    inside = Window.partitionBy(place, "piece").orderBy(*columns).rowsBetween(*earlier)
    numbered = pieces.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    totals = pieces.groupBy(F.col(place).alias("of"), F.col("piece").alias("at")).agg(F.sum("copies").alias("total"))
    earlier_pieces = Window.partitionBy("of").orderBy("at").rowsBetween(*earlier)
    offsets = totals.select("of", "at", F.coalesce(F.sum("total").over(earlier_pieces), F.lit(0)).alias("offset"))
    joined = numbered.join(offsets, F.col(place).eqNullSafe(F.col("of")) & (F.col("piece") == F.col("at")), "left")
    first = F.col("offset") + F.col("before")
    placed = joined.select(*columns, first.alias("first"), (first + F.col("copies")).alias("end"))
    starts = F.explode(F.sequence("first", F.col("end") - 1, F.lit(COPIES_AT_ONCE).cast("long"))).alias("start")
    chunks = placed.select(*columns, "end", starts)
    last = F.least(F.col("start") + COPIES_AT_ONCE, F.col("end")) - 1
    return back(chunks.select(*columns, F.explode(F.sequence("start", last)).alias("slot")), F.col("slot").alias(slot))
