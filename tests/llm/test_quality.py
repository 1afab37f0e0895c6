import math
import random
import re
from collections import Counter

import pytest
from helpers import LONG, as_tables, documents, sql_rows

from barloom.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    places = {p for i, x in enumerate(windows) if often[x] > 1 for p in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(places)


def brute_fit(patterns, rules):
    """The same estimation, document by document."""
    docs = [v for v, n in patterns for _ in range(n)]
    good, right_good, right_bad = 0.75, [0.95] * rules, [0.3] * rules

    def posterior(v):
        a, b = good, 1 - good
        for j, x in enumerate(v):
            if x:
                a *= right_good[j] if x > 0 else 1 - right_good[j]
                b *= 1 - right_bad[j] if x > 0 else right_bad[j]
        return a / (a + b)

    for _ in range(100):
        q = [posterior(v) for v in docs]
        new_good = (sum(q) + 15) / (len(docs) + 20)
        g, b = [], []
        for j in range(rules):
            all_good = sum(x for x, v in zip(q, docs, strict=True) if v[j])
            all_bad = sum(1 - x for x, v in zip(q, docs, strict=True) if v[j])
            g.append((sum(x for x, v in zip(q, docs, strict=True) if v[j] > 0) + 19) / (all_good + 20))
            b.append((sum(1 - x for x, v in zip(q, docs, strict=True) if v[j] < 0) + 6) / (all_bad + 20))
        good, right_good, right_bad = new_good, g, b
    return good, right_good, right_bad, posterior


def made_up(rng, n):
    vocabulary = ["the", "of", "and", "apple", "river", "Stone", "walking", "green!", "über", "12", "|", "a#b", "née", "x" * 30]
    return [" ".join(rng.choices(vocabulary[: rng.randint(2, 14)], k=rng.randint(0, 120))).replace(" river ", "\n") for _ in range(n)]


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = made_up(rng, 60) + [None, "", " \t\n", "one", "a b", "a b c", "a b c a b c", "a a a a", "x\n\nx\n x\nx", "\x0b漢 字\x0c漢 😀\r\n", "a b\x1fc"]
    rows = documents(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = quality.measured(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, *counts in map(tuple, got.collect()):
        assert tuple(counts) == brute_counts(texts[i]), texts[i]


def test_very_long_text(spark):
    [row] = quality.measured(documents(spark, [(1, LONG)], "doc_id long, text string")).collect()
    assert (row.n_words, row.n_repeat_words) == (60_000, 60_000)


def test_estimation_equals_brute_force(spark):
    rng = random.Random(2)
    patterns = Counter()
    for _ in range(400):
        truth = 1 if rng.random() < 0.8 else -1
        patterns[tuple(0 if rng.random() < 0.3 else truth if rng.random() < p else -truth for p in (0.95, 0.9, 0.8, 0.6))] += 1
    rows = sorted(patterns.items())
    frame = spark.createDataFrame([(list(v), n) for v, n in rows], "votes array<tinyint>, n long")
    model = quality.fit(frame, 4)
    good, right_good, right_bad, posterior = brute_fit(rows, 4)
    assert model.good == pytest.approx(good, abs=1e-6)
    assert model.right_on_good == pytest.approx(right_good, abs=1e-6)
    assert model.right_on_bad == pytest.approx(right_bad, abs=1e-6)
    found = frame.withColumn("q", model.quality()).collect()
    assert [r.q for r in found] == pytest.approx([posterior(tuple(r.votes)) for r in found], abs=1e-6)


def test_planted_accuracies_are_found(spark):
    rng = random.Random(3)
    right = (0.98, 0.9, 0.75, 0.85, 0.95)
    patterns = Counter()
    for _ in range(20_000):
        truth = 1 if rng.random() < 0.7 else -1
        patterns[tuple(0 if rng.random() < 0.2 else truth if rng.random() < p else -truth for p in right)] += 1
    frame = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<tinyint>, n long")
    model = quality.fit(frame, 5)
    assert abs(model.good - 0.7) < 0.02
    assert max(abs(a - b) for a, b in zip(model.right_on_good + model.right_on_bad, right + right, strict=True)) < 0.03


def test_a_lone_wrong_rule_does_not_reject(spark):
    """All-must-pass filtering would reject on one bad vote; here the other rules outvote one that is often wrong."""
    common = [([1, 1, 1, 1], 800), ([-1, -1, -1, 0], 100), ([1, 1, 1, -1], 80), ([-1, -1, 0, -1], 20)]
    frame = spark.createDataFrame(common, "votes array<tinyint>, n long")
    model = quality.fit(frame, 4)
    kept = {tuple(r.votes): r.q >= 0.5 for r in frame.withColumn("q", model.quality()).collect()}
    assert kept == {(1, 1, 1, 1): True, (-1, -1, -1, 0): False, (1, 1, 1, -1): True, (-1, -1, 0, -1): False}


def test_no_documents(spark):
    assert quality.fit(spark.createDataFrame([], "votes array<tinyint>, n long"), 3) == quality.start(3)
    assert quality.judge(documents(spark, [])).count() == 0


def test_odd_rows_and_clashing_columns(spark):
    rows = documents(spark).selectExpr("*", "1 as n_words", "'x' as kept", "2 as votes", "3 as `a.b`", "4 as c0")
    out = quality.judge(rows)
    assert out.columns[:5] == ["doc_id", "source", "votes", "a.b", "c0"]
    found = out.collect()
    assert len(found) == 10
    assert not any(r.kept for r in found) and all(r.base_failed for r in found)


def test_query_equals_sql(spark, monkeypatch):
    rng = random.Random(4)
    texts = made_up(rng, 150) + [None, "", "a b"]
    frame = documents(spark, [(None if i == 7 else i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    as_tables(monkeypatch, queries, documents=frame)
    got = sorted(map(tuple, queries.op11_quality_rules(spark, "").collect()), key=str)
    table = frame.toPandas().astype({"doc_id": "Int64"})
    assert got == sorted(sql_rows(queries.ORACLE["op11_quality_rules"], documents=table), key=str)


def test_agrees_with_labels_it_never_saw(spark):
    folder = "/root/testdata/sf0.01"
    judged = queries.op11_quality_rules(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    both = judged.where("not base_failed").join(labels, "doc_id").collect()
    right = sum(r.kept == (r.quality == 1) for r in both)
    assert right >= 0.99 * len(both) > 100


def test_no_python_on_the_main_path(spark):
    plan = quality.measured(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_probability_is_finite():
    assert all(0 < p < 1 and math.isfinite(p) for p in quality.start(9).right_on_bad)
