"""Seven-day slices of timestamped rows, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Slices are weeks that start on Saturdays, two days after the default start.
SLICE = "7 days"
OFFSET = "2 days"


def weekly_slices(events: DataFrame, key: str = "event_type", ts: str = "ts", value: str = "value") -> DataFrame:
    """Count and total per key and week. A streaming input needs a watermark on ``ts``."""
    week = F.window(ts, SLICE, SLICE, OFFSET)
    totals = events.groupBy(week.alias("_week"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return totals.select(
        F.to_date("_week.start").alias("slice_start"), F.to_date("_week.end").alias("slice_end"), key, "n", "total"
    )


def distinct_late_rows(stream: DataFrame, keys: list[str], ts: str = "ts", lateness: str = "7 days") -> DataFrame:
    """Drop repeated rows of a stream that arrive within the allowed lateness."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def append_on_time(stream: DataFrame, keys: list[str], store: str, checkpoint: str, ts: str = "ts", lateness: str = "7 days") -> StreamingQuery:
    """Append each row of a stream once to ``store``, unless it comes too late, then stop.

    Too late is a row that is not after the latest time of earlier batches less ``lateness``. Keys are kept as state for as
    long as a copy could still be on time, so the state holds the rows of that span and not the whole history. The
    files and the state's progress are committed together by the sink, and a batch that is run again adds nothing.
    """
    kept = distinct_late_rows(stream, keys, ts, lateness)
    writer = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(availableNow=True).start(store)
