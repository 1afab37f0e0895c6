"""Incremental append of landed responses, as a stream or batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.append import latest_stored, newer_than_latest
from barloom.operators.select import price_range
from barloom.operators.sketches import SKETCH, sketches
from barloom.schema import BAR, BAR_COLUMNS, LANDED
from barloom.sources import manifest
from barloom.sources.payloads import flatten_payloads, write_rejects
from barloom.sources.stored import append_bars, read_or_empty

_PLACED = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
_BATCHED = T.StructType([*BAR.fields, *_PLACED])
_LATEST = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("latest", T.DateType()), *_PLACED])
_SKETCHES = T.StructType([*SKETCH.fields, *_PLACED])


def _read(schema: T.StructType):
    return lambda spark, path: spark.read.schema(schema).parquet(path)


def stored_bars(spark: SparkSession, store: str) -> DataFrame:
    """The bars of all batches that exist."""
    rows = read_or_empty(spark, store, _read(_BATCHED), _BATCHED)
    return manifest.listed(rows, store).select(*BAR_COLUMNS)


def read_latest(spark: SparkSession, store: str, run: str = "", batch: int = 0) -> DataFrame:
    """The last stored day of each ticker, from the small table beside the store.

    Batches of ``run`` from ``batch`` on do not count: they are what is about to be written, perhaps again.
    """
    kept = manifest.listed(read_or_empty(spark, f"{store}_latest", _read(_LATEST), _LATEST), store)
    others = kept.where((F.col("run") != run) | (F.col("batch") < batch))
    return others.groupBy("ticker").agg(F.max("latest").alias("latest"))


def read_sketches(spark: SparkSession, store: str) -> DataFrame:
    """Sketches of the daily price range, one for each batch, ticker and year; none of the stored bars are read."""
    return manifest.listed(read_or_empty(spark, f"{store}_sketches", _read(_SKETCHES), _SKETCHES), store).select(*SKETCH.names)


def append_batch(fresh: DataFrame, store: str, folder: str, files: DataFrame | None = None) -> None:
    """Write new bars into their own folder, the last days among them and their sketches; then make the batch exist.

    ``files`` are the landed files that the bars come from. Nothing that is written counts before the last step.
    """
    spark = fresh.sparkSession
    append_bars(fresh, f"{store}/{folder}", mode="overwrite")
    written = spark.read.schema(BAR).parquet(f"{store}/{folder}")
    latest_stored(written).write.mode("overwrite").parquet(f"{store}_latest/{folder}")
    sketches(price_range(written), "price_diff").write.mode("overwrite").parquet(f"{store}_sketches/{folder}")
    manifest.commit(spark, store, folder, files)


def compact_store(spark: SparkSession, store: str, target: str) -> None:
    """Rewrite the bars of all existing batches into few files, at another path."""
    append_bars(stored_bars(spark, store), target, mode="error")


def append_stream(spark: SparkSession, landing: str, store: str, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Append the new bars of all landed files, then stop; the checkpoint remembers which files are done.

    A micro-batch has a folder of its own, named by the id that the checkpoint gives the stream and the batch
    number, and compares with all others: run again after a failure it gives the same rows, or is left as it is if its manifest
    was written, and a stream that has lost its checkpoint, and so has another id, finds everything stored already. Rejects
    are written the same way, in ``<store>_rejects``.
    """
    reader = spark.readStream.schema(LANDED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = session.read.json(f"{checkpoint}/metadata").first()["id"]
        if manifest.exists(session, store, run, batch_id):
            return
        folder = manifest.folder_of(run, batch_id)
        write_rejects(batch, f"{store}_rejects/{folder}")
        fresh = newer_than_latest(flatten_payloads(batch), read_latest(session, store, run, batch_id))
        append_batch(fresh, store, folder)

    return (
        reader.json(landing)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
