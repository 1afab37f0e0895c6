"""Stored bars: JSON and parquet datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.dates import trading_day
from barloom.functions.numbers import finite
from barloom.schema import API_NAMES, API_ROW, BAR, BAR_COLUMNS, PRICES, STORED, STORED_NAMES

_EITHER = T.StructType([*STORED.fields, *[f for f in API_ROW.fields if f.name not in STORED.names]])


def read_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Bars from JSON lines, one-line arrays or (``multi_line``) pretty-printed files, under either set of names."""
    reader = spark.read.schema(_EITHER).option("multiLine", multi_line).option("allowNonNumericNumbers", False)
    raw = reader.json(path)
    from_stored = {ours: theirs for theirs, ours in STORED_NAMES.items()}
    from_api = {ours: theirs for theirs, ours in API_NAMES.items()}
    named = raw.select(*[F.coalesce(F.col(from_stored[c]), F.col(from_api[c])).alias(c) for c in BAR_COLUMNS])
    return named.withColumn("trading_date", trading_day("trading_date"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Stored bars; prices that are no finite numbers are missing."""
    return spark.read.schema(BAR).parquet(path).select(*[finite(c).alias(c) if c in PRICES else c for c in BAR_COLUMNS])


def read_or_empty(
    spark: SparkSession,
    path: str,
    reader: Callable[[SparkSession, str], DataFrame] = read_parquet,
    schema: T.StructType = BAR,
) -> DataFrame:
    """Stored bars, or no rows where nothing has been stored yet. Other errors are raised."""
    try:
        return reader(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def to_stored_names(bars: DataFrame) -> DataFrame:
    """Bars under the column names and date format of stored JSON."""
    stored = bars.withColumn("trading_date", F.date_format("trading_date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return stored.withColumnsRenamed({ours: theirs for theirs, ours in STORED_NAMES.items()}).select(*STORED.names)


def append_bars(bars: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Append to a dataset with one folder per year, sorted by ticker and day in its files.

    Spark balances the files by size: a small append writes one per year, a large year is
    split over tasks.
    """
    dated = bars.select(*BAR_COLUMNS, F.year("trading_date").alias("year")).hint("rebalance", "year")
    ordered = dated.sortWithinPartitions("year", "ticker", "trading_date")
    ordered.write.mode(mode).partitionBy("year").format(fmt).save(path)


def compact_bars(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite a dataset of many small appends into few files, at another path."""
    append_bars(read_parquet(spark, source), target, mode="error")


def export_json(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON folder per ticker, under the stored names."""
    spread = bars.repartition("ticker", F.year("trading_date"))
    to_stored_names(spread).write.mode(mode).partitionBy("ticker_name").json(path)


def export_arrays(bars: DataFrame, path: str, pretty: bool = False) -> None:
    """JSON arrays of one ticker and year each, under the stored names: one to a line, or (``pretty``) one to a file of many lines."""
    parts = ["_of", "_year"]
    packed = to_stored_names(bars).withColumns({"_of": F.col("ticker_name"), "_year": F.substring("trading_date", 1, 4)})
    arrays = packed.groupBy(*parts).agg(F.collect_list(F.struct(*STORED.names)).alias("_rows"))
    text = F.to_json("_rows", {"pretty": "true"} if pretty else None)
    if pretty:
        arrays.select(*parts, text.alias("value")).repartition(*parts).write.mode("overwrite").partitionBy(*parts).text(path)
    else:
        arrays.select(text.alias("value")).write.mode("overwrite").text(path)


def dataset_megabytes(spark: SparkSession, path: str) -> DataFrame:
    """Total size of all files under a path; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg((F.coalesce(F.sum("length"), F.lit(0)) / 1024 / 1024).alias("megabytes"))
