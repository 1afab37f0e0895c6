"""Toxic passages: maximal scoring segments of word log-odds, calibrated as extreme values.

A word's score is the log of its odds in toxic against other documents, under a Dirichlet
prior in proportion to its frequency; only words whose score is significant have one, all
others weigh a little against a passage. Words without own evidence fall back to their
beginning. One linear scan finds every maximal scoring segment of a text. A word that is said again says
little more as long as its last mention is near: it counts anew once the words in between outweigh that
mention, so that a passage is found wherever its words stood before. How unlikely the
best score is in clean text of that length follows an extreme-value law whose two parameters are
fitted to clean documents, and a logistic curve turns that into a probability. Both are fitted to documents
that the lexicon in use has not seen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.sampling import least_hashes
from barloom.llm import near_dedup
from barloom.llm.arrow import batch_limit, pieces, with_columns
from barloom.llm.tables import stored

#: Labelled documents learned from, at most: those with the least hash of their id.
LEARNED_ROWS = 20_000
#: Entries of the lexicon that a worker may hold; more are an error, none are left out.
LEXICON_ROWS = 2_000_000
#: Total weight of the Dirichlet prior, in word occurrences.
PRIOR = 5_000.0
#: Standard errors that a score must be away from 0: of a word, of a beginning of words.
WORD_Z, START_Z = 2.0, 4.0
START_CHARS = 4
#: Part of the words of a toxic passage that are toxic themselves.
DENSITY = 0.25
#: A passage is reported if clean text of the same length has one as good less often than this.
SIGNIFICANT = 0.05
#: Parts of the sample; the law and the curve are fitted to each by the lexicon of the others.
FOLDS = 4
#: Clean documents with a high best score that the law's rate is fitted to, at least.
LAW_SCORES = 50
CACHED_WORDS = 100_000
EDGES = "".join(map(chr, [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])) + "¡¿«»„“”‚‘’…–—"

PASSAGES = T.ArrayType(
    T.StructType(
        [T.StructField("first_word", T.IntegerType()), T.StructField("last_word", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )
)


def word_of(raw: str) -> str:
    """A run without white space, lower-cased, without signs at its ends."""
    return raw.lower().strip(EDGES)


def start_of(word: str) -> str | None:
    """The beginning that stands for a longer word."""
    return word[:START_CHARS] + "*" if len(word) > START_CHARS else None


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, sum) of a sequence, in order, in linear time.

    Runs over the positive scores only; each becomes a segment, which is joined with an
    earlier one if that starts lower and ends below it, for the sum from there is then larger.
    Each segment knows the last one before it that starts lower, so none is passed over twice.
    """
    total = np.cumsum(scores)
    found: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        first, low, high = i, float(total[i] - scores[i]), float(total[i])
        lower = len(found) - 1
        while True:
            while lower >= 0 and found[lower][2] >= low:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= high:
                break
            at = lower
            first, _, low, _, lower = found[at]
            del found[at:]
        found.append((first, i, low, high, lower))
    return [(first, last, high - low) for first, last, low, high, _ in found]


@dataclass
class Model:
    """What is learned: scores of words and beginnings, the extreme-value law, the logistic curve."""

    lexicon: dict[str, float]
    others: float = float(np.log1p(-DENSITY))
    rate: float = 1.0
    height: float = 1.0
    curve: tuple[float, float, float] = (0.0, 1.0, 0.0)
    cache: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def word_score(self, raw: str) -> float:
        word = word_of(raw)
        score = self.lexicon.get(word)
        if score is None and (start := start_of(word)):
            score = self.lexicon.get(start)
        return self.others if score is None else score

    def passages(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """Maximal scoring segments and the number of words."""
        words = (text or "").split()
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        for word in set(words).difference(self.cache):
            self.cache[word] = self.word_score(word)
        scores = np.fromiter(map(self.cache.__getitem__, words), np.float64, len(words))
        last: dict[str, int] = {}
        for i in np.flatnonzero(scores > 0).tolist():
            word = word_of(words[i])
            if word in last and (last[word] + 1 - i) * self.others < scores[i]:
                scores[i] = self.others
            else:
                last[word] = i
        return (segments(scores) if len(words) and scores.max() > 0 else []), len(words)

    def surprise(self, score: float, words: int) -> float:
        """-ln of the expected number of passages this good in clean text of this length."""
        return self.rate * score - np.log(self.height * max(words, 1))

    def features(self, found: list[tuple[int, int, float]], words: int) -> tuple[float, float]:
        """The best passage's surprise, and what all that are significant have together beyond it."""
        each = sorted((self.surprise(s, words) for _, _, s in found), reverse=True)
        best = max(each[0], 0.0) if each else 0.0
        more = sum(x for x in each[1:] if x > -np.log(-np.log1p(-SIGNIFICANT)))
        return best, float(np.log1p(more))

    def probability(self, features: tuple[float, float]) -> float:
        base, by_best, by_more = self.curve
        return float(1 / (1 + np.exp(-np.clip(base + by_best * features[0] + by_more * features[1], -500, 500))))


def learned(doc_id: Column) -> Column:
    """Whether a document's label may be learned from; the others are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of at most ``LEARNED_ROWS`` labelled documents that may be learned from.

    Of a group of near duplicates one document of each label is taken, that with the least hash: near copies would
    make the rare words of one text look frequent. Texts without words are like no other.
    """
    known = labels.where("toxic is not null").where(learned(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "toxic-labels")
    chosen = least_hashes(known, ["doc_id"], LEARNED_ROWS, known.count())
    chosen = chosen.select(F.col("doc_id").alias("_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    found = stored(found.select(F.xxhash64("doc_id", "text").alias("id"), "text", "toxic"), "toxic-labelled")
    alike = near_dedup.groups(found.select(F.col("id").alias("doc_id"), "text")).select(F.col("doc_id").alias("id"), "component_id")
    alike = alike.distinct().join(found.select("id", "toxic").distinct(), "id")
    kept = stored(alike.groupBy("component_id", "toxic").agg(F.min("id").alias("id")), "toxic-kept")
    return stored(found.join(kept.select("id"), "id", "left_semi").dropDuplicates(["id"]).select("text", "toxic"), "toxic-sample")


def fold_of(text: Column) -> Column:
    """The part of the sample that a text belongs to, by its hash."""
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def word_counts(learn: DataFrame) -> DataFrame:
    """``fold, word, toxic, clean``: the documents of each kind that a word occurs in, for each part of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                counts = (Counter(), Counter())
                for text, toxic, fold in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "fold")), strict=True):
                    counts[toxic].update((fold, word) for word in {word_of(w) for w in set(text.split())} - {""})
                keys = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([fold for fold, _ in keys], pa.int32()),
                        pa.array([word for _, word in keys], pa.string()),
                        *(pa.array([counts[kind][k] for k in keys], pa.int64()) for kind in (1, 0)),
                    ],
                    ["fold", "word", "toxic", "clean"],
                )

    counted = learn.select("text", "toxic", fold_of(F.col("text")).alias("fold")).mapInArrow(run, "fold int, word string, toxic long, clean long")
    return counted.groupBy("fold", "word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def scored(counts: DataFrame, toxic: float, clean: float, least: float) -> DataFrame:
    """Words with a significant score: ``word, score, z``."""
    prior = F.lit(PRIOR) * (F.col("toxic") + F.col("clean")) / F.lit(max(toxic + clean, 1.0))
    bad, good = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(bad / (F.lit(toxic + PRIOR) - bad)) - F.log(good / (F.lit(clean + PRIOR) - good))
    z = odds / F.sqrt(1 / bad + 1 / good)
    return counts.select("word", "toxic", "clean", odds.alias("score"), z.alias("z")).where(F.col("z") >= least)


def lexicon(counted: DataFrame) -> dict[str, float]:
    """Scores of significant words, and of beginnings that are significant among all other words."""
    counts = counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sums = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    toxic, clean = float(sums[0] or 0), float(sums[1] or 0)
    if not toxic or not clean:
        return {}
    words = scored(counts, toxic, clean, WORD_Z)
    longer = counts.where(F.length("word") > START_CHARS).join(words.select("word"), "word", "left_anti")
    start = F.concat(F.substring("word", 1, START_CHARS), F.lit("*")).alias("word")
    starts = longer.groupBy(start).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    both = words.union(scored(starts, toxic, clean, START_Z))
    rows = both.orderBy(F.desc("z"), "word").select("word", "score").limit(LEXICON_ROWS + 1).collect()
    if len(rows) > LEXICON_ROWS:
        raise ValueError(f"more than {LEXICON_ROWS} words have a significant score; learn from fewer documents")
    return {r.word: r.score for r in rows}


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled sample. Without both kinds of labels nothing scores and all probabilities are low."""
    batch_limit(docs.sparkSession)
    learn = sample(docs, labels)
    counts = stored(word_counts(learn), "toxic-words")
    model = Model(lexicon(counts))
    if not model.lexicon:
        return Model({}, curve=(-5.0, 1.0, 0.0))
    # A lexicon fits the documents it comes from better than others, so each part is scored by the lexicon of the other parts.
    parts = [Model(lexicon(counts.where(F.col("fold") != fold))) for fold in range(FOLDS)]
    sorted_out = learn.select("text", "toxic", fold_of(F.col("text")).alias("fold"))
    best = T.StructType([T.StructField(c, T.DoubleType()) for c in ("best", "words", "kind")])

    def measured(kind) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text"):
                    asked = zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "fold")), strict=True)
                    rows = [(*kind(parts[fold], *parts[fold].passages(t)), float(x)) for t, x, fold in asked]
                    columns = list(zip(*rows, strict=True)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], best.names)

        return np.array(sorted_out.mapInArrow(run, best).collect(), float).reshape(-1, 3)

    heights = measured(lambda m, found, n: (max((s for _, _, s in found), default=0.0), float(n)))
    clean = heights[heights[:, 2] == 0]
    model.rate, model.height = _law(clean[:, 0], np.maximum(clean[:, 1], 1), _rate(model))
    for part in parts:
        part.rate, part.height = model.rate, model.height
    points = measured(lambda m, found, n: m.features(found, n))
    model.curve = _logistic(points[:, :2], points[:, 2])
    return model


def _law(best: np.ndarray, words: np.ndarray, expected: float) -> tuple[float, float]:
    """Rate and height of the extreme-value law that make the best scores of clean documents likeliest.

    Scores up to the median of those above 0 only count as not more than it, so that the law follows the upper part. The law needs scores
    that differ there; with fewer than ``LAW_SCORES`` of them the rate is the ``expected`` one and only the height is fitted, to all.
    """
    above = best[best > 0]
    least = float(np.median(above)) if len(above) else 0.0
    beyond = best[best > least]
    if len(beyond) < LAW_SCORES:
        return expected, float(len(best) / max(np.sum(words * np.exp(-expected * best)), 1e-9))
    gain, excess = np.maximum(best - least, 0.0), float(np.mean(beyond - least))

    def slope(rate: float) -> float:
        weight = words * np.exp(-rate * gain)
        return 1 / rate - excess + float(np.sum(gain * weight) / np.sum(weight))

    low, high = 1e-6, 1.0
    while slope(high) > 0 and high < 1e6:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    return low, float(len(beyond) * np.exp(low * least) / np.sum(words * np.exp(-low * gain)))


def _rate(model: Model) -> float:
    """The root of E[exp(rate * score)] = 1 in clean text; a score's chance there is what its log-odds say of the rest."""
    scores = np.array([*model.lexicon.values(), model.others])
    chance = np.exp(-np.array([*model.lexicon.values()])) * DENSITY / len(model.lexicon)
    chance = np.append(chance, 1 - chance.sum())
    low, high = 1e-6, 1.0
    while np.sum(chance * np.exp(high * scores)) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if np.sum(chance * np.exp(middle * scores)) < 1 else (low, middle)
    return low


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> tuple[float, float, float]:
    """Penalised logistic regression by Newton's method, with weights not below 0."""
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - penalty * weights
        bend = (design * (p * (1 - p))[:, None]).T @ design + penalty * np.eye(3)
        step = np.linalg.solve(bend, slope)
        weights = weights + step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(weights[0]), max(float(weights[1]), 0.0), max(float(weights[2]), 0.0)


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``passages`` (word places from 0, and sum) of every whole text.

    Reported are all significant passages in text order. Null and empty texts have none and the score of a
    text without a toxic word. Repeated rows stay; columns of the same names are replaced.
    """
    limit = -np.log(-np.log1p(-SIGNIFICANT))

    def make(texts: list[str | None]) -> list[list]:
        scores, spans = [], []
        for t in texts:
            found, words = model.passages(t)
            scores.append(model.probability(model.features(found, words)))
            spans.append(
                [{"first_word": a, "last_word": b, "score": s} for a, b, s in found if model.surprise(s, words) > limit]
            )
        return [scores, spans]

    return with_columns(df, text, [T.StructField("score", T.DoubleType()), T.StructField("passages", PASSAGES)], make)
