import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import as_tables, documents, sql_rows

from barloom.llm import queries, spelling

SCHEMA = "doc_id long, text string"


def brute_words(rows):
    found = Counter()
    for i, text in rows:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[a-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n > 1}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [x for x in words if x != w and one_apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), words[w], len(near[w]), words[form[w]] if w in form else None) for w in words)


def made_up(rng, n=250, letters="abé"):
    words = set()
    for _ in range(n // 4):
        word = "".join(rng.choices(letters, k=rng.randint(6, 10)))
        words.add(word)
        for _ in range(3):
            at = rng.randrange(len(word))
            words.add(rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + "z" + word[at + 1 :]]))
    return {w: rng.choice([2, 3, 20, 30, 200, 300, 5000]) for w in words}


@pytest.mark.parametrize("seed", range(4))
def test_variants_equal_brute_force(spark, seed):
    words = made_up(random.Random(seed), letters=["ab", "abé", "aÿbc", "a"][seed])
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    assert sorted(map(tuple, spelling.variants(frame).collect())) == brute_variants(words)


def test_trie_nodes_over_many_partitions(spark):
    """Equal prefixes have one number, other prefixes others, wherever the borders between tasks fall."""
    words = sorted({"".join(random.Random(i).choices("ab", k=i % 13)) for i in range(400)} | {"", "a" * 300, "a" * 299 + "b"})
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        rows = spelling.trie_nodes(frame, frame["word"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    prefix_of = {}
    for word, nodes in rows:
        assert len(nodes) == len(word) + 1
        for i, node in enumerate(nodes):
            assert prefix_of.setdefault(node, word[:i]) == word[:i]
    assert len(prefix_of) == len(set(prefix_of.values()))
    assert [r.word for r in sorted(rows, key=lambda r: r.nodes[-1])] == words


def test_no_more_than_a_word_for_each_character(spark):
    """A pair of nodes that many words share: each counts the others once."""
    words = {f"abc{chr(c)}def": 5 for c in [*range(97, 123), *range(0xC0, 0x100)]} | {"abcdef": 60, "abcmdeff": 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(frame).collect())) == brute_variants(words)


def test_chain_of_forms(spark):
    words = {"aaaaaaa": 2, "baaaaaa": 20, "bbaaaaa": 200, "bbbaaaa": 2000, "bbbbaaa": 20000, "unrelated": 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.form, r.root) for r in spelling.variants(frame).collect()}
    assert got["aaaaaaa"] == ("baaaaaa", "bbbbaaa") and got["bbbaaaa"] == ("bbbbaaa", "bbbbaaa")
    assert got["bbbbaaa"] == (None, "bbbbaaa") and got["unrelated"] == (None, "unrelated")


def test_no_words(spark):
    assert spelling.variants(spelling.vocabulary(documents(spark, []))).count() == 0
    assert spelling.variants(spark.createDataFrame([("lonelyword", 4)], "word string, n long").limit(1)).collect()[0].n_near == 0


def test_contract_on_odd_texts(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = ["Straße", "Überholung", "überholung", "Überholungs", "naïveté", "running", "runnings", "runing", "RUNNING", "a1b2c3d4e5", "x×y÷zabcd", "don'tdont"]
    rows = [(rng.choice([None, i, 7]), " ".join(rng.choices(vocabulary, k=40))) for i in range(60)]
    rows += [(None, None), (1, ""), (2, "q" * 3000 + " " + "q" * 3000 + " " + "q" * 2999 + " " + "q" * 2999), (3, "漢字" * 20)]
    frame = documents(spark, rows, SCHEMA).selectExpr("*", "1 as word", "2 as n", "3 as run", "4 as key")
    as_tables(monkeypatch, queries, documents=frame)
    expected = brute_words(rows)
    got = sorted(map(tuple, queries.op12_spelling(spark, "").collect()))
    assert got == brute_variants(expected)
    table = documents(spark, rows, SCHEMA).toPandas().astype({"doc_id": "Int64"})
    assert got == sorted(sql_rows(queries.ORACLE["op12_spelling"], documents=table))


def test_brute_force_of_the_test_itself():
    near = defaultdict(bool, {("abc", "abd"): True, ("abc", "ab"): True, ("abc", "abc"): False, ("abc", "acb"): False, ("aab", "ab"): True})
    assert all(one_apart(a, b) == expected for (a, b), expected in near.items())
