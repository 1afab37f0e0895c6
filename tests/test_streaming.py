import datetime as dt

from conftest import DATA
from pyspark.sql import functions as F

from barloom.operators.append import newer_than_latest, newer_than_stored
from barloom.schema import LANDED
from barloom.sources.payloads import pack_payloads
from barloom.sources.tables import order_bars, table
from barloom.streaming.append import append_batch, append_stream, read_latest, stored_bars
from barloom.streaming.slices import append_on_time, distinct_late_rows, weekly_slices


def run(spark, base, files=None):
    append_stream(spark, f"{base}/landing", f"{base}/store", f"{base}/progress", files).awaitTermination()
    return stored_bars(spark, f"{base}/store")


def test_stream_equals_batch_and_repeats_add_nothing(spark, tmp_path):
    bars = order_bars(spark, DATA)
    early = bars.where("trading_date < date '2000-01-01' and ticker <> '5-LOW'")
    pack_payloads(early).write.json(f"{tmp_path}/landing")
    first = run(spark, tmp_path)
    assert first.exceptAll(early).count() == 0 and first.count() == early.count()
    pack_payloads(bars).write.mode("append").json(f"{tmp_path}/landing")
    expected = early.union(newer_than_stored(bars, early))
    second = run(spark, tmp_path)
    assert second.exceptAll(expected).count() == 0 and second.count() == expected.count()
    pack_payloads(bars).write.mode("append").json(f"{tmp_path}/landing")
    assert run(spark, tmp_path).count() == expected.count()
    assert run(spark, tmp_path).count() == expected.count()


def test_lost_checkpoint_adds_nothing(spark, tmp_path, make_bars):
    """Two runs with two batches, then a stream that starts anew."""
    for n in (3, 5):
        pack_payloads(make_bars([float(i) for i in range(n)])).write.mode("append").json(f"{tmp_path}/landing")
        run(spark, tmp_path, files=1)
    for progress in ("other", "third"):
        append_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/store", f"{tmp_path}/{progress}", 1).awaitTermination()
        kept = stored_bars(spark, f"{tmp_path}/store").collect()
        assert sorted(r.close for r in kept) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_a_batch_run_again_overwrites_itself(spark, tmp_path, make_bars):
    bars = make_bars([1.0, 2.0, 3.0])
    for _ in range(2):
        fresh = newer_than_latest(bars, read_latest(spark, f"{tmp_path}/store", "r", 4))
        append_batch(fresh, f"{tmp_path}/store", "run=r/batch=4")
    assert stored_bars(spark, f"{tmp_path}/store").count() == 3


def test_append_does_not_scan_the_store(spark, tmp_path, make_bars):
    append_batch(make_bars([1.0]), f"{tmp_path}/store", "run=r/batch=0")
    files = newer_than_latest(make_bars([1.0, 2.0]), read_latest(spark, f"{tmp_path}/store")).inputFiles()
    assert files and all("/store_latest/" in f for f in files)


def test_stream_writes_rejects(spark, tmp_path, make_bars):
    good = pack_payloads(make_bars([1.0]))
    bad = spark.createDataFrame([(200, "none"), (200, '{"ticker":"A","data":[{"open":1}]}')], LANDED)
    good.union(bad).write.json(f"{tmp_path}/landing")
    assert run(spark, tmp_path).count() == 1
    rejects = f"{tmp_path}/store_rejects/*/*"
    assert spark.read.json(f"{rejects}/responses").count() == 1 and spark.read.json(f"{rejects}/elements").count() == 1


def test_weekly_slices_start_on_saturday(spark):
    rows = [(dt.datetime(2023, 2, 4), "a", 1.0), (dt.datetime(2023, 2, 10, 23), "a", 2.0), (dt.datetime(2023, 2, 11), "a", 4.0)]
    events = spark.createDataFrame(rows, "ts timestamp, event_type string, value double")
    out = weekly_slices(events).orderBy("slice_start").collect()
    assert [(r.slice_start, r.n, r.total) for r in out] == [(dt.date(2023, 2, 4), 2, 3.0), (dt.date(2023, 2, 11), 1, 4.0)]


def test_streamed_slices_equal_batch(spark, tmp_path):
    events = table(spark, DATA, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", "value")
    events.write.parquet(f"{tmp_path}/in")
    events.limit(100).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    slices = weekly_slices(distinct_late_rows(stream, ["event_id"], lateness="40 days"))
    query = (
        slices.writeStream.format("memory").queryName("slices").outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = sorted((r.slice_start, r.event_type, r.n, round(r.total, 6)) for r in spark.table("slices").collect())
    want = sorted((r.slice_start, r.event_type, r.n, round(r.total, 6)) for r in weekly_slices(events).collect())
    assert got == want


def test_late_rows_stay_out_and_copies_come_once(spark, tmp_path):
    """Out of order over four landings: on time within a day of the latest earlier time, however old the landing's other rows are."""
    schema = "event_id long, ts timestamp, value double"
    hour = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    landings = [
        [(1, hour(0)), (2, hour(48)), (2, hour(48))],  # before any mark all rows are on time
        [(3, hour(24)), (4, hour(25)), (1, hour(0)), (2, hour(48)), (5, hour(10))],  # mark at 24: later rows only
        [(6, hour(200)), (7, hour(30)), (4, hour(25))],
        [(8, hour(176)), (9, hour(177)), (6, hour(200)), (7, hour(30))],  # mark at 176
    ]
    for rows in landings:
        spark.createDataFrame([(*r, 1.0) for r in rows], schema).write.mode("append").parquet(f"{tmp_path}/in")
        for _ in range(2):  # the second run finds nothing new
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
            append_on_time(stream, ["event_id"], f"{tmp_path}/store", f"{tmp_path}/progress", lateness="1 day").awaitTermination()
    kept = spark.read.parquet(f"{tmp_path}/store")
    assert sorted(r.event_id for r in kept.collect()) == [1, 2, 4, 6, 7, 9]
