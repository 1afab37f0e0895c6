"""Bars derived from the order and line-item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import BAR_COLUMNS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_bars(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per order priority and day: prices in order of the order key, volume the number of orders.

    All aggregates have fixed-size buffers, so they are hashed and combined map-side.
    """
    orders = table(spark, folder, "orders")
    return (
        orders.groupBy(F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("date").alias("trading_date"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select(*BAR_COLUMNS)
    )


def supplier_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars of many series: one per supplier and ship date.

    Line keys repeat in this table, so ties are broken by the price. Suppliers are grouped by
    their number, which sorts and hashes faster than its text.
    """
    lines = table(spark, folder, "lineitem")
    price, order = F.col("l_extendedprice"), F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return (
        lines.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("trading_date"))
        .agg(
            F.min(order).alias("_first"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(order).alias("_last"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .withColumn("ticker", F.col("l_suppkey").cast("string"))
        .withColumn("open", F.col("_first.l_extendedprice"))
        .withColumn("close", F.col("_last.l_extendedprice"))
        .select(*BAR_COLUMNS)
    )
