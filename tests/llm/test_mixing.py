import re

import pytest
from helpers import as_tables, documents

from barloom.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def dealt(sizes, weights, share, most):
    """Water-filling by the book: deal, stop who is above, deal the excess again."""
    left, open_ = share * sum(sizes.values()), set(sizes)
    target = {}
    while open_:
        whole = sum(weights[s] for s in open_)
        above = {s for s in open_ if left * weights[s] / whole >= most * sizes[s]}
        if not above:
            target.update({s: left * weights[s] / whole for s in open_})
            break
        target.update({s: most * sizes[s] for s in above})
        left -= sum(target[s] for s in above)
        open_ -= above
    return target


@pytest.mark.parametrize(
    "rows",
    [
        [(i, "w " * (1 + i % 7), f"s{i % 5}") for i in range(400)],
        [(i, "w " * (50 if i % 3 == 0 else 1), None if i % 3 == 0 else "Z" if i % 3 == 1 else "é") for i in range(90)],
        [(1, "a b c", "x"), (2, None, "y"), (3, "", None), (1, "a b c", "x"), (None, "a\x0bb\u00a0c", "y")],
        [(1, None, "x")],
        [],
    ],
)
def test_targets_and_copies(spark, monkeypatch, rows):
    as_tables(monkeypatch, queries, documents=documents(spark, rows))
    got = queries.op9_mixing(spark, "").collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), len(WORD.findall(t or ""))) for i, t, _ in rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = dealt(sizes, weights, 1.5, 2.0)
    of = {i: s for i, _, s in rows}
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        assert r.source_size == sizes[of[r.doc_id]]
        assert r.target == pytest.approx(target[of[r.doc_id]])
    again = queries.op9_mixing(spark, "").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_taken_words_come_near_targets(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 4}") for i in range(8000)]
    as_tables(monkeypatch, queries, documents=documents(spark, rows))
    frame = queries.op9_mixing(spark, "").toPandas()
    by = frame.groupby(frame.doc_id % 4).agg({"taken": "sum", "target": "first"})
    assert (abs(by.taken / by.target - 1) < 0.05).all()


def test_many_sources_are_joined_by_salted_keys(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 3), f"s{i % 6}" if i % 7 else None) for i in range(200)]
    docs = documents(spark, rows)
    sizes = docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))
    targets = queries.mix_targets(sizes)
    broadcast = sorted(map(str, mixing.with_source(sizes, targets).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted(map(str, mixing.with_source(sizes, targets).collect())) == broadcast


def test_mix_emits_whole_rows(spark):
    rows = [(i, "w " * 5, f"s{i % 2}") for i in range(100)]
    docs = documents(spark, rows).selectExpr("*", "doc_id as rate", "'t' as target", "1 as _copies_")
    sizes = docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))
    mixed = mixing.mix(docs, queries.mix_targets(sizes))
    assert mixed.columns == docs.columns
    counts = mixed.groupBy("doc_id").count().toPandas()["count"]
    assert counts.max() <= 2 and 130 <= counts.sum() <= 170
