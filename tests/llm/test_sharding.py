import zlib
from collections import Counter, defaultdict

import pytest
from helpers import ROWS, as_tables, documents
from pyspark.sql import functions as F

from barloom.llm import queries, sharding


def test_contract_on_odd_rows(spark, monkeypatch):
    as_tables(monkeypatch, queries, documents=documents(spark, ROWS * 3))
    rows = queries.op2_sharding(spark, "").collect()
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in ROWS * 3)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len({r.shard for r in rows if r.doc_id == i}) == 1 for i, _, _ in ROWS)


def test_parts_follow_weights_and_growth_moves_little(spark):
    keys = spark.range(40_000).withColumnRenamed("id", "k")
    weights = {"a": 1.0, "b": 2.0, "none": 0.0, "c": 5.0}
    parts = {r.shard: r["count"] for r in sharding.assign(keys, "k", weights).groupBy("shard").count().collect()}
    assert set(parts) == {0, 1, 3}
    for place, part in ((0, 1 / 8), (1, 2 / 8), (3, 5 / 8)):
        assert abs(parts[place] / 40_000 - part) < 0.01
    both = sharding.assign(sharding.assign(keys, "k", weights), "k", {**weights, "d": 2.0}, "after")
    moved = both.where("shard != after").agg(F.count("*"), F.min("after"), F.max("after")).first()
    assert moved[1] == moved[2] == 4 and abs(moved[0] / 40_000 - 0.2) < 0.01


def test_bad_weights():
    for weights in ({}, {"a": 0.0}, {"a": 1.0, "b": -1.0}):
        with pytest.raises(ValueError):
            sharding.shard_of(F.col("k"), weights)


def test_slots_of_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_AT_ONCE", 7)
    frame = spark.range(100).selectExpr("0 as k", "id % 2 as shard", "'x' as slot", "1 as copies", "2 as c0", "3 as piece")
    rows = sharding.with_slots(frame, "shard").collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(2) for i in range(50)]
    assert sharding.with_slots(frame.where("false"), "shard").count() == 0
