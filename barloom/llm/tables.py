"""The given tables, and materialised steps in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read again.

    Cuts the lineage: a step that is used more than once is computed once, gives
    the same rows to every use, and outlives lost executors.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[..., DataFrame]]:
    """The rows under names that clash with nothing, where each column went, and the way back (with more columns, if named)."""
    at = {name: f"c{i}" for i, name in enumerate(df.columns)}

    def back(out: DataFrame, *more: str) -> DataFrame:
        return out.select(*[F.col(inner).alias(name) for name, inner in at.items()], *more)

    return df.select(*[F.col(f"`{name}`").alias(inner) for name, inner in at.items()]), at, back
