"""Approximate box statistics from mergeable quantile sketches, kept per ticker and year.

A sketch stands for the values of one ticker in one year. Sketches of any parts of the data
can be merged, so an append adds the sketches of its own rows and statistics of the whole store are made from
them, without its bars. A merged sketch of up to ``SIZE`` values holds all of them and is exact; beyond, ranks are off by
a small part of the number of values (about 1 in 1,000 at this size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.numbers import finite

KEYS = ["ticker"]
DAY = "trading_date"
#: Values that a sketch holds before it starts to thin them out.
SIZE = 4096

SKETCH = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
    ]
)


def sketches(df: DataFrame, value: str, size: int = SIZE) -> DataFrame:
    """One sketch for each ticker and year of the finite values; rows without ticker or date belong to none."""
    rows = df.select(*KEYS, F.year(DAY).alias("year"), finite(value).alias("_x"))
    given = rows.where(F.col("_x").isNotNull() & F.col("ticker").isNotNull() & F.col("year").isNotNull())
    made = given.groupBy(*KEYS, "year").agg(
        F.kll_sketch_agg_double("_x", F.lit(size)).alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.min("_x").alias("min"),
        F.max("_x").alias("max"),
    )
    return made.select(*SKETCH.names)


def merge(parts: DataFrame, by: list[str] | None = None, size: int = SIZE) -> DataFrame:
    """Sketches merged by ticker, or by other columns of theirs such as ticker and year."""
    merged = F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    return parts.groupBy(*(by or KEYS)).agg(merged, F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"))


def approx_quantiles(merged: DataFrame, probabilities: list[float]) -> DataFrame:
    """``ticker, n, q0, q1, ...``: for each probability a value of the series whose rank is about that."""
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probabilities]))
    return merged.select(*KEYS, "n", at.alias("_q")).select(*KEYS, "n", *[F.get("_q", F.lit(i)).alias(f"q{i}") for i in range(len(probabilities))])


def approx_box_stats(parts: DataFrame, whisker: float = 1.5) -> DataFrame:
    """Columns of the exact box statistics, with minimum and maximum, from sketches alone.

    Quartiles are values of the series (the lower one where a quartile lies between two); whiskers the outermost of ``SIZE``
    evenly ranked values within ``whisker`` quartile ranges, and outliers are counted by rank: exact up to ``SIZE`` values, as all are among them then.
    """
    # the function asks for constants; a cast of a constant text is one, and short to plan
    ranks = F.split(F.lit(",".join(str(j / SIZE) for j in range(1, SIZE + 1))), ",").cast("array<double>")
    drawn = merge(parts).withColumn("_held", F.kll_sketch_get_quantile_double("sketch", ranks))
    at = lambda share: F.element_at("_held", int(share * SIZE))
    q = drawn.select(*KEYS, "n", "min", "max", "_held", at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    reach = whisker * (F.col("q3") - F.col("q1"))
    fenced = q.withColumn("_low", F.col("q1") - reach).withColumn("_high", F.col("q3") + reach)
    # how many of the ranked values lie below the low fence, and how many up to the high one; the j-th stands for j * n / SIZE values
    under, within = (F.size(F.filter("_held", lambda x: x < F.col("_low"))), F.size(F.filter("_held", lambda x: x <= F.col("_high"))))
    counted = fenced.withColumn("_under", under).withColumn("_within", within)
    upto = lambda j: F.ceil(F.col(j) * F.col("n") / F.lit(float(SIZE)))
    return counted.select(
        *KEYS, "n", "min", "q1", "median", "q3", "max",
        F.least(F.get("_held", F.col("_under")), "q1").alias("whisker_low"),
        F.greatest(F.get("_held", F.col("_within") - 1), "q3").alias("whisker_high"),
        (upto("_under") + F.col("n") - upto("_within")).alias("n_outliers"),
    )
