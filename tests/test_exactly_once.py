"""Ingest that dies at any step, run again, and two landings in a row."""

import json

import pytest
from pyspark.sql import DataFrameWriter

from barloom.plans import flows
from barloom.schema import LANDED
from barloom.sources import manifest
from barloom.sources.payloads import pack_payloads
from barloom.streaming.append import append_stream, compact_store, read_latest, read_sketches, stored_bars


class Died(Exception):
    pass


def dies_at(monkeypatch, n, after=False):
    """Let the n-th write of the driver fail, before or after it has put its files there."""
    count = [0]

    def patched(real):
        def write(self, *args, **kwargs):
            count[0] += 1
            if count[0] == n and not after:
                raise Died
            real(self, *args, **kwargs)
            if count[0] == n and after:
                raise Died

        return write

    for name in ("parquet", "json", "save"):
        monkeypatch.setattr(DataFrameWriter, name, patched(getattr(DataFrameWriter, name)))


def land(spark, folder, bars, rejects):
    bad = [(200, "none"), (200, json.dumps({"ticker": "Z", "data": [{"open": 1}]}))][:rejects]
    rows = pack_payloads(bars)
    (rows.union(spark.createDataFrame(bad, LANDED)) if bad else rows).write.mode("append").json(folder)


def state(spark, store):
    responses, elements = flows.stored_rejects(spark, store)
    return (
        sorted((r.ticker, r.close) for r in stored_bars(spark, store).collect()),
        responses.count(), elements.count(), read_latest(spark, store).count(), sum(r.n for r in read_sketches(spark, store).collect()),
    )


# Six writes: two kinds of rejects, bars, latest days, sketches, manifest.
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("n", range(1, 7))
def test_a_run_that_dies_and_runs_again_gives_one_copy(spark, tmp_path, make_bars, n, after):
    landing, store = f"{tmp_path}/landing", f"{tmp_path}/store"
    land(spark, landing, make_bars([1.0, 2.0]), 2)
    with pytest.MonkeyPatch.context() as patch, pytest.raises(Died):
        dies_at(patch, n, after)
        flows.ingest(spark, landing, store)
    done = ([("AAA", 1.0), ("AAA", 2.0)], 1, 1, 1, 2)
    assert state(spark, store) == (done if (n, after) == (6, True) else ([], 0, 0, 0, 0))
    for _ in range(2):
        flows.ingest(spark, landing, store)
        assert state(spark, store) == done


def test_seven_writes_do_not_happen(spark, tmp_path, make_bars, monkeypatch):
    land(spark, f"{tmp_path}/landing", make_bars([1.0]), 1)
    dies_at(monkeypatch, 7)
    flows.ingest(spark, f"{tmp_path}/landing", f"{tmp_path}/store")


def test_rejects_of_two_landings_stay(spark, tmp_path, make_bars):
    landing, store = f"{tmp_path}/landing", f"{tmp_path}/store"
    for closes in ([1.0, 2.0], [1.0, 2.0, 3.0]):
        land(spark, landing, make_bars(closes), 2)
        flows.ingest(spark, landing, store)
    assert state(spark, store) == ([("AAA", 1.0), ("AAA", 2.0), ("AAA", 3.0)], 2, 2, 1, 3)


def test_odd_file_names_and_replaced_files(spark, tmp_path, make_bars):
    landing, store = tmp_path / "landing", f"{tmp_path}/store"
    text = pack_payloads(make_bars([1.0])).toJSON().collect()[0]
    (landing / "a b").mkdir(parents=True)
    for name in ("x[1].json", "y{2}.json", "a b/z*.json", "100%.json"):
        (landing / name).write_text(text)
    flows.ingest(spark, str(landing), store)
    assert manifest.landed_files(spark, str(landing), store).count() == 0
    (landing / "x[1].json").write_text("\n".join(pack_payloads(make_bars([1.0, 2.0])).toJSON().collect()) + "\n")
    assert [f.path.rsplit("/", 1)[1] for f in manifest.landed_files(spark, str(landing), store).collect()] == ["x[1].json"]
    flows.ingest(spark, str(landing), store)
    assert sorted(r.close for r in stored_bars(spark, store).collect()) == [1.0, 2.0]


@pytest.mark.parametrize("n", range(1, 7))
def test_a_stream_that_dies_gives_one_copy(spark, tmp_path, make_bars, n):
    landing, store, progress = (f"{tmp_path}/{x}" for x in ("landing", "store", "progress"))
    land(spark, landing, make_bars([1.0, 2.0]), 2)
    with pytest.MonkeyPatch.context() as patch, pytest.raises(Exception, match="Died"):
        dies_at(patch, n, after=True)
        append_stream(spark, landing, store, progress).awaitTermination()
    append_stream(spark, landing, store, progress).awaitTermination()
    assert sorted(r.close for r in stored_bars(spark, store).collect()) == [1.0, 2.0]
    assert manifest.batches(spark, store).count() == 1


def test_compaction_leaves_out_what_no_manifest_lists(spark, tmp_path, make_bars):
    landing, store = f"{tmp_path}/landing", f"{tmp_path}/store"
    land(spark, landing, make_bars([1.0]), 0)
    with pytest.MonkeyPatch.context() as patch, pytest.raises(Died):
        dies_at(patch, 5)
        flows.ingest(spark, landing, store)
    flows.ingest(spark, landing, store)
    compact_store(spark, store, f"{tmp_path}/compact")
    assert spark.read.parquet(f"{tmp_path}/compact").count() == 1 and spark.read.parquet(store).count() == 2
