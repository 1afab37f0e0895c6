"""Places of rows in a global order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.tables import stored

#: Rows within one sorted partition, in the ids that Spark gives out.
PARTITION_BITS = 33


def numbered(df: DataFrame, order: list[Column], place: str) -> DataFrame:
    """Add each row's place from 0 in a total order.

    Rows are sorted over range partitions, which Spark balances, and stored, so that a
    lost executor cannot change a place. A row's place is its place in its partition
    plus the rows of earlier partitions, a table with one row per partition.
    """
    ordered = stored(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_id", PARTITION_BITS)
    counts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))
    joined = ordered.join(F.broadcast(offsets), part == F.col("_part"), "left")
    return joined.withColumn(place, F.col("_before") + inside).drop("_id", "_part", "_before")
