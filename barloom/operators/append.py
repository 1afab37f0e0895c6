"""Incremental append: only bars newer than what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.clean import deduplicate

KEYS = ["ticker"]
DAY = "trading_date"


def latest_stored(stored: DataFrame) -> DataFrame:
    """The last stored day of each ticker; null dates are ignored."""
    return stored.groupBy(*KEYS).agg(F.max(DAY).alias("latest"))


def newer_than_latest(new: DataFrame, latest: DataFrame) -> DataFrame:
    """New bars, one per ticker and day, later than the ticker's ``latest`` day; a ticker without one keeps all.

    ``latest`` has one row per ticker and is looked up by the rows directly: the rows are read and
    shuffled once, and a ticker with most of them is split by the adaptive skew join.
    """
    known = latest.select(F.col("ticker").alias("_ticker"), "latest")
    looked_up = deduplicate(new).join(known, F.col("ticker") == F.col("_ticker"), "left")
    fresh = F.col("latest").isNull() | (F.col(DAY) > F.col("latest"))
    return looked_up.where(F.col("ticker").isNotNull() & F.col(DAY).isNotNull() & fresh).select(*new.columns)


def newer_than_stored(new: DataFrame, stored: DataFrame) -> DataFrame:
    """The same against stored bars; where a small table of latest days is kept, read that instead."""
    return newer_than_latest(new, latest_stored(stored))


def missing_from_stored(new: DataFrame, stored: DataFrame) -> DataFrame:
    """New bars whose ticker and day are not stored at all: repairs holes as well as appending."""
    return deduplicate(new).join(stored.select(*KEYS, DAY), [*KEYS, DAY], "left_anti")
