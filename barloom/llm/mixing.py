"""Mixing sources to target weights: repetition rates per source, copies per document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.ordering import numbered
from barloom.llm.tables import plain_names, stored

#: The source table is broadcast up to this many rows; beyond it, it is joined over salted keys.
BROADCAST_SOURCES = 10_000
SALTS = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame, weight: Callable[[Column], Column], share: float, at_most: float, size: str = "size"
) -> DataFrame:
    """One row per source: ``source, source_size, target, rate``.

    ``sizes`` has a source and a size for each document. Sources in code point order,
    null last as a source of its own, are numbered from 0; ``weight`` gives a weight for a number.
    ``share`` of the total is dealt by weight; a source stops at ``at_most`` times its size and
    what is beyond is dealt again by weight, until none is above. Each round of dealing is
    one sum over the sources; sources of size 0 have target and rate 0.
    """
    grouped = sizes.groupBy("source").agg(F.sum(size).alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = numbered(stored(grouped, "mix-sources"), order, "_place")
    ranked = ranked.withColumn("_weight", weight(F.col("_place")).cast("double"))
    ranked = stored(ranked.withColumn("_most", F.col("source_size") * F.lit(float(at_most))), "mix-weights")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        stops = F.col("_weight") * F.lit(level) >= F.col("_most")
        sums = ranked.agg(
            F.sum(F.when(stops, F.col("_most"))).alias("stopped"), F.sum(F.when(~stops, F.col("_weight"))).alias("open")
        ).first()
        if not sums["open"]:
            break
        next_level = (total - (sums["stopped"] or 0.0)) / sums["open"]
        if next_level <= level:
            break
        level = next_level
    target = F.least(F.col("_weight") * F.lit(level), F.col("_most"))
    if sums["open"] is None:
        target = F.col("_most")
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return ranked.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def with_source(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with the columns of their source; no source, however large, meets in one task.

    A source table of proven small size is broadcast. A larger one is joined on source and
    a salt that depends on the row, with one copy of each source for every salt.
    """
    renamed = targets.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    if targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return df.join(F.broadcast(renamed), same, "left").drop("_source")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salted = df.withColumn("_row", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    joined = salted.join(renamed.select("*", salts), same & (F.col("_row") == F.col("_salt")), "left")
    return joined.drop("_source", "_row", "_salt")


def copies(key: Column, rate: Column, seed: int) -> Column:
    """floor(rate) copies and one more with the rate's fraction as its chance, drawn by a hash of key and seed."""
    draw = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") / float(1 << 53)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def mix(df: DataFrame, targets: DataFrame, key: str = "doc_id", seed: int = 9) -> DataFrame:
    """Every document as often as the mix takes it: a row for each copy, with the columns of ``df``.

    Repeated rows draw alike, and null keys like one key.
    """
    inner, at, back = plain_names(df)
    rates = targets.select("source", "rate")
    taken = with_source(inner.withColumn("source", F.col(at["source"])), rates)
    times = taken.withColumn("copies", copies(F.col(at[key]), F.col("rate"), seed)).where("copies > 0")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return back(times.select(*at.values(), each))
