"""Spelling variants: words one inserted, deleted or replaced character apart, by a dictionary of trie-node pairs.

The words are laid into two tries, one of the words and one of the reversed words, whose nodes are
numbered. A word with one position left out is a pair of integers (the node before the position, the node behind it),
and so is a word cut at a position. Two words that leave out a position with the same pair
differ by a replacement there; where one leaves out and the other is only cut, by an insertion. No strings are
compared. A pair has at most one word that is cut and one word for each character of the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.arrow import ship
from barloom.llm.expressions import let
from barloom.llm.tables import stored

# What a word is made of, which runs lose a character, which words count.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "a-zÀ-ÿ"
LOSES = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form occurs at least so many times as often as its variant.
TIMES = 10

CUT, LEFT_OUT, LEFT_OUT_AGAIN = 0, 1, 2


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, one row for each run of letters of at least ``LEAST_LENGTH`` characters after the planted loss.

    Runs are maximal, with A-Z lower-cased; a run whose checksum with the row's key (null: empty) says so loses one character.
    """
    lower = F.translate(F.col(f"`{text}`"), UPPER, LOWER)
    runs = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    check = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    rows = rows.select("run", check.alias("h"), F.length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    rows = rows.select(F.when(F.col("h") % LOSES == 0, short).otherwise(F.col("run")).alias("word"))
    return rows.where(F.length("word") >= LEAST_LENGTH)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: distinct words and their occurrences in all documents, ``LEAST_COUNT`` at least."""
    return occurrences(docs, key, text).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def trie_nodes(words: DataFrame, word: Column) -> DataFrame:
    """The rows with ``nodes``, the numbers of the trie nodes on the path of ``word``, from the root (its length + 1 of them).

    Words must be distinct; numbers of whole words rise in code point order. Sorted words visit the trie depth-first, so a
    task that holds a stretch of them numbers the nodes it opens with the current path alone. The first path of
    a stretch may continue that of the stretch before: a table with one row for each stretch (its first and last word)
    tells which nodes are the same.
    """
    ship(words.sparkSession)
    shown = [f for f in words.schema.fields if f.name not in ("nodes", "part", "key")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, path, opened = TaskContext.get().partitionId(), "", [0], 1
        for batch in batches:
            paths = []
            for text in batch.column("key").to_pylist():
                same, most = 0, min(len(text), len(before))
                while same < most and text[same] == before[same]:
                    same += 1
                path = path[: same + 1] + list(range(opened, opened + len(text) - same))
                opened += len(text) - same
                before = text
                paths.append(path)
            arrays = [*batch.columns, pa.array(paths, pa.list_(pa.int64())), pa.array([part] * batch.num_rows, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "nodes", "part"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown)
    ordered = words.select(*[f"`{f.name}`" for f in shown], word.alias("key")).orderBy("key")
    rows = stored(ordered.mapInArrow(run, f"{names}, key string, nodes array<long>, part int"), "trie-paths")
    ends = rows.groupBy("part").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("nodes", "key").alias("nodes"), F.max(F.element_at("nodes", -1)).alias("top")
    )
    stretches = []
    offset, last, last_path = 0, None, []
    for r in sorted(ends.collect(), key=lambda r: r["first"].encode()):
        shared = 0 if last is None else next((i for i, (a, b) in enumerate(zip(last, r["first"], strict=False)) if a != b), min(len(last), len(r["first"])))
        taken = last_path[: shared + 1] or [0]
        stretches.append((r["part"], offset, taken))
        last, last_path = r["last"], [taken[i] if i < len(taken) else offset + i for i in r["nodes"]]
        offset += r["top"]
    table = words.sparkSession.createDataFrame(stretches, "part int, offset long, taken array<long>")
    node = lambda i: F.coalesce(F.get("taken", i.cast("int")), F.col("offset") + i)
    joined = rows.join(F.broadcast(table), "part")
    return joined.select(*[f"`{f.name}`" for f in shown], F.transform("nodes", node).alias("nodes"))


def _pairs(words: DataFrame) -> DataFrame:
    """``p, s, kind, id, n``: for each word its pairs of nodes, cut at and leaving out each position.

    ``words`` has ``id, word, n`` and the path ``ahead``. The same word remains wherever in a run of equal characters one
    is left out; only the first counts for insertions.
    """
    backward = trie_nodes(words.select("word"), F.reverse("word")).withColumnRenamed("nodes", "behind")
    both = words.join(backward, "word")
    size = F.length("word")

    def pair(i: Column, kind: Column, gap: int) -> Column:
        return F.struct(F.get("ahead", i).alias("p"), F.get("behind", size - i - gap).alias("s"), kind.cast("tinyint").alias("kind"))

    def left_out(letter: Column, i: Column) -> Column:
        return pair(i, F.when((i > 0) & letter, F.lit(LEFT_OUT_AGAIN)).otherwise(F.lit(LEFT_OUT)), 1)

    cut = F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, F.lit(CUT), 0))
    again = let(F.split("word", ""), lambda letters: F.transform(letters, lambda x, i: F.coalesce(F.get(letters, i - 1) == x, F.lit(False))))
    out = F.transform(F.slice(again, F.lit(1), size), left_out)
    return both.select(F.inline(F.concat(cut, out)), "id", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """``id, word, n, n_near, best_id, best_n`` for each of the distinct words ``word, n``: how many are one edit away, and the most frequent of them.

    Ids are numbers in code point order. Ties go to the smaller word; without near words ``n_near`` is 0 and the best is null.
    Each member of a pair of nodes gets the count and the best of the others, so no pairs of words are made.
    """
    ahead = trie_nodes(stored(words, "spelling-words"), F.col("word")).withColumnRenamed("nodes", "ahead")
    numbered = stored(ahead.withColumn("id", F.element_at("ahead", -1)), "spelling-ahead")
    member = F.struct("n", (-F.col("id")).alias("minus"), "kind")
    met = _pairs(numbered).groupBy("p", "s").agg(F.sort_array(F.collect_list(member), asc=False).alias("met"))
    met = met.where(F.size("met") > 1).select(
        "met",
        F.filter("met", lambda m: m["kind"] != CUT).alias("out"),
        F.filter("met", lambda m: m["kind"] == LEFT_OUT).alias("once"),
        F.get(F.filter("met", lambda m: m["kind"] == CUT), F.lit(0)).alias("cut"),
    )
    met = met.select(F.explode("met").alias("m"), "out", "once", "cut")
    mine, first = F.col("m"), F.get("out", F.lit(0))
    other = F.when(first == mine, F.get("out", F.lit(1))).otherwise(first)
    shorter = F.when(mine["kind"] == LEFT_OUT, F.col("cut"))
    is_cut = mine["kind"] == CUT
    near = F.when(is_cut, F.size("once")).otherwise(F.size("out") - 1 + shorter.isNotNull().cast("int"))
    best = F.when(is_cut, F.get("once", F.lit(0))).otherwise(F.greatest(other, shorter))
    found = met.select((-mine["minus"]).alias("id"), near.cast("long").alias("near"), F.struct(best["n"].alias("n"), best["minus"].alias("minus")).alias("best"))
    found = found.where(F.col("near") > 0).groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    joined = numbered.select("id", "word", "n").join(found, "id", "left")
    return joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), (-F.col("best.minus")).alias("best_id"), F.col("best.n").alias("best_n")
    )


def _roots(links: DataFrame) -> DataFrame:
    """``id, root`` of ``id, target`` rows, following targets to the last.

    Each round doubles how far a link reaches. A form is at least ten times as frequent, so chains end after a few.
    """
    links = stored(links, "spelling-links")
    while True:
        onward = links.select(F.col("id").alias("target"), F.col("target").alias("beyond"))
        joined = links.join(onward, "target", "left").select("id", F.coalesce("beyond", "target").alias("target"), F.col("beyond").isNotNull().alias("moved"))
        joined = stored(joined, "spelling-roots")
        links = joined.select("id", "target")
        if joined.where("moved").isEmpty():
            return links.withColumnRenamed("target", "root")


def variants(words: DataFrame) -> DataFrame:
    """The distinct words ``word, n`` with ``form, root, n_near, form_n``.

    The form of a word is its most frequent near word, if that occurs at least ``TIMES`` times as often; else null. The
    root is where forms lead from the word: the word itself without a form. Rows with a null or repeated
    word are not allowed; an empty table gives no rows.
    """
    near = stored(neighbours(words), "spelling-near")
    linked = near.where(F.col("best_n") >= TIMES * F.col("n"))
    names = near.select("id", "word")
    roots = _roots(linked.select("id", F.col("best_id").alias("target")))
    named = (
        linked.select("id", F.col("best_id").alias("form_id"), F.col("best_n").alias("form_n"))
        .join(roots, "id")
        .join(names.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id")
        .join(names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
        .select("id", "form", "form_n", "root_word")
    )
    out = near.join(named, "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
