"""The three flows, ingest, forecast and charts, each as one lazy plan over all tickers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import distributions, indicators, select, smoothing
from barloom.operators.append import newer_than_latest
from barloom.operators.clean import bounds, deduplicate, interpolate, to_long
from barloom.operators.forecast import HORIZON_DAYS, beside_actual, forecast_additive, forecast_baseline
from barloom.operators.series import attach, per_series, with_segment
from barloom.schema import ATTRIBUTES, LANDED
from barloom.session import shared_folder, stored
from barloom.sources import manifest
from barloom.sources.payloads import flatten_payloads, write_rejects
from barloom.sources.stored import append_bars, read_or_empty, read_parquet
from barloom.streaming.append import append_batch, read_latest

MODELS = {"baseline": forecast_baseline, "additive": forecast_additive}


def ingest(spark: SparkSession, landing: str, store: str) -> None:
    """Decode landed responses that no batch has read yet and append the bars newer than those stored, exactly once.

    What is no bar is written beside the store, in ``<store>_rejects``, in a folder for each batch; the last days of the tickers, all that
    the next run needs to know of the store, in ``<store>_latest``. The batch exists, for all readers, once its manifest is
    written: a run that dies before leaves nothing that counts, and the next one reads the same files again. The names of the new
    files pass through the driver, as in any listing.
    """
    files = manifest.landed_files(spark, landing, store).collect()
    if not files:
        return
    landed = spark.read.schema(LANDED).json([manifest.as_literal(f.path) for f in files])
    folder = manifest.folder_of(uuid.uuid4().hex, 0)
    write_rejects(landed, f"{store}_rejects", f"/{folder}")
    fresh = newer_than_latest(flatten_payloads(landed), read_latest(spark, store))
    append_batch(fresh, store, folder, spark.createDataFrame(files, "path string, modified timestamp, length long"))


def stored_rejects(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    """What existing batches of ``ingest`` have rejected: responses, and elements of others."""
    placed = "run string, batch long"
    found = []
    for kind, schema in (("responses", "status int, payload string"), ("elements", "ticker string, element string")):
        def read(session: SparkSession, path: str, schema: str = schema) -> DataFrame:
            return session.read.schema(f"{schema}, {placed}").json(path)

        rows = read_or_empty(spark, f"{store}_rejects/{kind}", read, T._parse_datatype_string(f"{schema}, {placed}"))
        found.append(manifest.listed(rows, store).drop("run", "batch"))
    return found[0], found[1]


def regular_series(bars: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """A daily value for every ticker and attribute; bars must be unique by ticker and day."""
    return interpolate(to_long(bars, attributes))


def forecast(bars: DataFrame, model: str = "additive", horizon: int = HORIZON_DAYS) -> DataFrame:
    """History and horizon of every ticker and attribute."""
    return MODELS[model](regular_series(deduplicate(bars)), horizon=horizon)


def validate(bars: DataFrame, attributes: Sequence[str] = ATTRIBUTES, model: str = "baseline") -> DataFrame:
    """Fit on the first four fifths of each calendar, predict the rest, set both beside the known values.

    Bars must be unique by ticker and day. Every day between the first and the
    last bar has a row; the cut follows from these two days alone, so the
    calendar itself is not built before the forecast, and the forecast has all of it. The bars are used five times, so
    they are made once and kept in the shared folder.
    """
    keys = ["ticker"]
    bars = stored(bars.select("ticker", "trading_date", *attributes), "validated")
    placed = with_segment(bars, keys, "trading_date")
    spans = (
        per_series(placed, keys, F.min("trading_date").alias("_first"), F.max("trading_date").alias("_last"))
        .withColumn("_days", F.datediff("_last", "_first") + 1)
        .withColumn("_train", F.floor(F.col("_days") * 4 / 5).cast("int"))
        .withColumn("_cut", F.date_add("_first", F.col("_train") - 1))
    )
    known = attach(placed, spans, keys).where(F.col("trading_date") <= F.col("_cut")).select(*bars.columns)
    # A null on the cut makes the training calendar reach it.
    ends = spans.select("ticker", F.col("_cut").alias("trading_date"))
    train = interpolate(to_long(known.unionByName(ends, allowMissingColumns=True), attributes))
    horizon = spans.select(
        "ticker",
        F.explode(F.array(*[F.lit(a) for a in attributes])).alias("attr"),
        (F.col("_days") - F.col("_train")).alias("horizon"),
    )
    predicted = MODELS[model](train, horizon=horizon, ahead=True)
    part = F.when(F.col("ahead"), F.lit("valid")).otherwise(F.lit("train")).alias("part")
    both = beside_actual(predicted, to_long(bars, attributes), how="left", extra=["ahead"])
    return both.select(*[c for c in both.columns if c != "ahead"], part)


def charts(bars: DataFrame, deduplicated: bool = False) -> dict[str, DataFrame]:
    """One result table per chart."""
    clean = bars if deduplicated else deduplicate(bars)
    ranged = select.price_range(clean)
    with_returns = indicators.returns(clean)
    # The names of the charts.
    return {
        "price_diff_hist": distributions.histogram(ranged, "price_diff"),
        "price_diff_boxplot": distributions.box_stats(ranged, "price_diff"),
        "price_diff_outliers": distributions.box_outliers(ranged, "price_diff"),
        "open_price_ts": clean.select("ticker", "trading_date", "open"),
        "market_periods": select.period_slice(clean).select("period", "ticker", "trading_date", "open"),
        "price_diff_smoothed": smoothing.savgol(ranged).select("ticker", "trading_date", "smoothed"),
        "seasonality": smoothing.seasonal_decompose(clean),
        "accumulation_distribution": indicators.accumulation_distribution(clean),
        "return_dist": distributions.histogram(with_returns, "returns", bins=200, view=(-0.10, 0.10)),
        "cumulative_return": with_returns,
        "price_with_indicator": indicators.indicator_panel(clean),
        "axis_limits": bounds(clean),
    }


def write_charts(bars: DataFrame, folder: str) -> None:
    """One dataset per chart; the deduplicated bars are written once, to the shared folder, and read by all."""
    spark = bars.sparkSession
    clean = shared_folder(spark, "chart-bars")
    append_bars(deduplicate(bars), clean)
    for name, frame in charts(read_parquet(spark, clean), deduplicated=True).items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
