"""Manifests: a batch of a store exists once its manifest does, and a landed file is done once a manifest names it.

A batch is written step by step into folders of its own (``run=.../batch=...``), which no reader looks into before
the last step puts one small file into ``<store>_latest/_commits``. A run that dies on the way leaves folders that
nothing lists, and the next run starts from the same landed files. One run writes to a store at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.stored import read_or_empty

#: One row for each landed file of a batch, and one without a path that stands for the batch itself.
_FILE = [T.StructField("path", T.StringType()), T.StructField("modified", T.TimestampType()), T.StructField("length", T.LongType())]
_PLACED = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
_COMMITS = T.StructType([*_FILE, *_PLACED])


def _path(store: str) -> str:
    """Beside the last days, in a folder that readers of those skip."""
    return f"{store}_latest/_commits"


def folder_of(run: str, batch: int) -> str:
    return f"run={run}/batch={batch}"


def commits(spark: SparkSession, store: str) -> DataFrame:
    """Rows of all manifests: ``path, modified, length, run, batch``."""
    return read_or_empty(spark, _path(store), lambda s, path: s.read.schema(_COMMITS).parquet(path), _COMMITS)


def batches(spark: SparkSession, store: str) -> DataFrame:
    """``run, batch`` of every batch that exists."""
    return commits(spark, store).where(F.col("path").isNull()).select("run", "batch").distinct()


def exists(spark: SparkSession, store: str, run: str, batch: int) -> bool:
    return not batches(spark, store).where((F.col("run") == run) & (F.col("batch") == batch)).isEmpty()


def listed(rows: DataFrame, store: str) -> DataFrame:
    """Rows (with ``run`` and ``batch``, their folders) of existing batches; folders that no manifest lists are pruned."""
    return rows.join(batches(rows.sparkSession, store), ["run", "batch"], "left_semi")


def commit(spark: SparkSession, store: str, folder: str, files: DataFrame | None = None) -> None:
    """Make a batch exist, with the landed files it was made from; one file, so that it appears at once."""
    itself = spark.createDataFrame([(None, None, None)], T.StructType(_FILE))
    rows = itself if files is None else itself.unionByName(files)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{_path(store)}/{folder}")


def landed_files(spark: SparkSession, landing: str, store: str) -> DataFrame:
    """``path, modified, length`` of landed files that no batch has read; their contents are not read.

    A file that was replaced (another time or length) counts as a new one.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    files = files.select("path", F.col("modificationTime").alias("modified"), "length")
    return files.join(commits(spark, store).select(*files.columns), files.columns, "left_anti")


def as_literal(path: str) -> str:
    """A path in which nothing is taken for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)
