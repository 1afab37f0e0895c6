import math
import random
import time
import zlib

import numpy as np
import pytest
from helpers import ROWS, as_tables, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import queries, toxicity
from barloom.llm.shingles import shingle_set


def brute_segments(scores):
    """By the definition: the best segment first, then the same left and right of it."""
    best, found = 0.0, None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            total = sum(scores[i : j + 1])
            if total > best + 1e-9:
                best, found = total, (i, j)
    if found is None:
        return []
    i, j = found
    right = [(a + j + 1, b + j + 1, s) for a, b, s in brute_segments(scores[j + 1 :])]
    return [*brute_segments(scores[:i]), (i, j, best), *right]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-4, 4).map(lambda x: x + 0.1 * (x > 0)), max_size=14))
def test_segments_by_the_definition(scores):
    got = toxicity.segments(np.array(scores, float))
    expected = brute_segments(scores)
    assert [round(s, 6) for _, _, s in got] == [round(s, 6) for _, _, s in expected]
    for first, last, total in got:
        assert abs(sum(scores[first : last + 1]) - total) < 1e-9


BAD = ["awful", "vile", "nasty", "rotten"]
GOOD = [f"word{i}" for i in range(300)]


def corpus(n, rng):
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = [rng.choice(GOOD) for _ in range(rng.randint(5, 120))]
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "!", ","]))
        docs.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    return docs, labels


def as_labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_held_out_documents(spark, monkeypatch):
    docs, labels = corpus(1500, random.Random(1))
    as_tables(monkeypatch, queries, documents=documents(spark, docs), labels=as_labels(spark, labels))
    rows = {r.doc_id: r for r in queries.op3_toxicity(spark, "").collect()}
    assert len(rows) == len(docs)
    right = []
    for i, toxic in labels:
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert rows[i].predicted == (rows[i].score >= 0.5) and 0 <= rows[i].score <= 1
        if rows[i].held_out:
            right.append(rows[i].predicted == toxic)
    assert len(right) > 200 and np.mean(right) > 0.98


def test_held_out_labels_have_no_effect(spark, monkeypatch):
    docs, labels = corpus(300, random.Random(2))
    changed = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    results = []
    for given_labels in (labels, changed):
        as_tables(monkeypatch, queries, documents=documents(spark, docs), labels=as_labels(spark, given_labels))
        results.append(sorted(map(tuple, queries.op3_toxicity(spark, "").collect())))
    assert results[0] == results[1]


def test_passages_are_found(spark):
    docs, labels = corpus(800, random.Random(3))
    model = toxicity.fit(documents(spark, docs), as_labels(spark, labels))
    text = " ".join(GOOD[:60] + ["vile", "so", "awful", "nasty"] + GOOD[60:260] + ["rotten", "awful,", "vile!"] + GOOD[200:210])
    frame = documents(spark, [(1, text, "s")]).selectExpr("*", "0 as score", "'x' as passages")
    row = toxicity.score(frame, model).first()
    assert row.score > 0.9
    assert [(p.first_word, p.last_word) for p in row.passages][:1] == [(60, 63)]


def test_a_passage_is_found_wherever_it_stands(spark):
    docs, labels = corpus(800, random.Random(3))
    model = toxicity.fit(documents(spark, docs), as_labels(spark, labels))
    passage = ["vile", "so", "awful", "nasty", "rotten"]
    early = [w for bad in BAD for w in (bad, *GOOD[:60])]
    words = [*early, *passage, *GOOD[60:260], *passage, *GOOD[:100], "vile!", "so", "awful,", "nasty", "rotten", *GOOD[200:210]]
    row = toxicity.score(documents(spark, [(1, " ".join(words), "s")]), model).first()
    second = len(early) + 205
    expected = [(len(early), len(early) + 4), (second, second + 4), (second + 105, second + 109)]
    assert [(p.first_word, p.last_word) for p in row.passages] == expected
    scores = [p.score for p in row.passages]
    assert max(scores) - min(scores) < 1e-9
    once = model.features(*model.passages(" ".join([*early, *passage, *GOOD[60:260]])))
    assert model.features(*model.passages(" ".join(words)))[1] > once[1]


def test_law_recovers_its_parameters():
    rng = np.random.default_rng(8)
    words = rng.integers(20, 2000, 20_000).astype(float)
    rate, height = 1.7, 0.02
    # The best of a text is not above x with probability exp(-height * words * exp(-rate * x)); nothing below 0 is seen.
    best = np.maximum(np.log(height * words / rng.exponential(1, len(words))) / rate, 0.0)
    got = toxicity._law(best, words, 9.0)
    assert abs(got[0] / rate - 1) < 0.03 and abs(got[1] / height - 1) < 0.05
    assert toxicity._law(np.zeros(30), np.ones(30), 9.0) == (9.0, 1.0)


def test_clean_documents_rarely_have_a_passage(spark):
    """Of clean documents that nothing was learned from, about one in twenty has a passage reported at 0.05.

    Words are rough by degrees, and clean texts have them too, so that the best scores of clean texts differ from each other.
    """
    rng = random.Random(11)
    rough = [f"rough{i}" for i in range(400)]
    tilted = [math.exp(3.0 * i / len(rough)) for i in range(len(rough))]

    def text(toxic):
        words = [rng.choice(rough) if rng.random() < 0.05 else rng.choice(GOOD) for _ in range(rng.randint(20, 200))]
        at = rng.randrange(len(words))
        return " ".join([*words[:at], *(rng.choices(rough, tilted, k=8) if toxic else []), *words[at:]])

    labels = [(i, int(rng.random() < 0.3)) for i in range(4000)]
    model = toxicity.fit(documents(spark, [(i, text(toxic), "s") for i, toxic in labels]), as_labels(spark, labels))
    fresh = documents(spark, [(i, text(0), "s") for i in range(4000)])
    share = toxicity.score(fresh, model).where("size(passages) > 0").count() / 4000
    assert 0.03 <= share <= 0.07


def test_many_passages_count_without_a_cap():
    model = toxicity.Model({"vile": 3.0}, rate=1.0, height=1e-3, curve=(-5.0, 1.0, 1.0))
    few, many = (model.features([(i, i, 60.0) for i in range(k)], 100) for k in (10, 1000))
    assert many[0] == few[0] > 50 and many[1] > few[1]


def test_near_mentions_of_a_word_count_once():
    model = toxicity.Model({"vile": 2.0})
    assert [(a, b, round(x, 6)) for a, b, x in model.passages("vile Vile! vile, vile")[0]] == [(0, 0, 2.0)]
    for between, found in ((6, 1), (7, 2)):
        assert len(model.passages(" ".join(["vile", *["so"] * between, "(vile)"]))[0]) == found


def test_many_segments_in_linear_time():
    scores = np.tile([2.0] + [-0.3] * 20, 50_000)
    start = time.process_time()
    assert len(toxicity.segments(scores)) == 50_000
    assert time.process_time() - start < 5


def test_only_near_copies_are_learned_once(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rng = random.Random(5)
    own = lambda n: " ".join(rng.choice(GOOD) for _ in range(n))
    line = min((own(5) for _ in range(3000)), key=lambda t: shingle_set(t)[0])
    shared = [(f"{line} {own(20)}", i % 2) for i in range(100)]
    base = own(100)
    copies = [(f"{base} end{i}", i % 2) for i in range(20)]
    wordless = [("" if i % 2 else " ", i // 2) for i in range(4)]
    texts = [*shared, *copies, *wordless]
    docs = [(i, t, "s") for i, (t, _) in zip(ids, texts, strict=False)]
    labels = [(i, y) for i, (_, y) in zip(ids, texts, strict=False)]
    got = [tuple(r) for r in toxicity.sample(documents(spark, [*docs, *docs[:3]]), as_labels(spark, labels)).collect()]
    assert set(got) <= set(texts)
    assert sorted(r for r in got if line in r[0]) == sorted(shared)
    assert sorted(y for t, y in got if base in t) == [0, 1]
    assert sorted(r for r in got if not r[0].strip()) == sorted(wordless)
    again = toxicity.sample(documents(spark, docs[::-1]), as_labels(spark, labels)).collect()
    assert sorted(map(tuple, again)) == sorted(got)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, None), (None, 1), (1, 1), (99, 1)]])
def test_odd_rows_and_few_labels(spark, monkeypatch, labels):
    for rows in (ROWS, []):
        as_tables(monkeypatch, queries, documents=documents(spark, rows), labels=as_labels(spark, labels))
        got = queries.op3_toxicity(spark, "").collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in got)
