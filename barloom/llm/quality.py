"""Quality rules by weak supervision: rules vote or abstain, and how far each is right is learned without labels.

Every rule looks at one measure of a text and votes *good* up to one border, *bad* from another, and abstains
between them. Expectation-maximisation over the counted vote patterns estimates how many documents are good and, for
each rule, how often its vote is right on good and on bad documents. A document's quality is the probability of being
good given all votes; an abstention says nothing. Everything is DataFrame functions: the texts are read once,
and each step of the estimation is one aggregate over the distinct patterns, at most 3 to the number of rules.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.expressions import let
from barloom.llm.tables import plain_names, stored

# White space between words, signs that count as symbols, common short words of English, German, French, Spanish.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
COMMON = (
    "the of and to in is that for it as was with be by on "
    "der die das und ein eine ist von zu den im mit auf für "
    "le la les de des et un une est que dans pour qui au "
    "el los las y en por con para del se"
).split()

#: A text with fewer words, or with more than this percentage of repeated words, fails before any vote.
LEAST_WORDS = 50
MOST_REPEATED = 50

#: Made-up votes that each rule starts with, and how many of them are right on good and on bad documents: a rule
#: looks for one fault, which most bad documents do not have. Below, the share of good documents assumed at first.
PRIOR_VOTES, RIGHT_ON_GOOD, RIGHT_ON_BAD = 20.0, 0.95, 0.3
PRIOR_GOOD = 0.75
ROUNDS = 100
SETTLED = 1e-9


@dataclass(frozen=True)
class Rule:
    """Good up to ``good``, bad from ``bad`` on, in a measure where less is better."""

    name: str
    measure: Callable[[], Column]
    good: float
    bad: float


def _share(column: str) -> Callable[[], Column]:
    return lambda: F.try_divide(F.col(column), F.col("n_words"))


RULES = [
    Rule("symbols", _share("n_symbols"), 0.02, 0.1),
    Rule("repeated_words", _share("n_repeat_words"), 0.1, 0.3),
    Rule("repeated_lines", lambda: F.try_divide(F.col("n_dup_lines"), F.col("n_lines")), 0.05, 0.3),
    Rule("stutter", _share("n_same_as_before"), 0.02, 0.1),
    Rule("without_letters", _share("n_without_letters"), 0.05, 0.2),
    Rule("shouting", lambda: F.try_divide(F.col("n_capitals"), F.col("word_chars")), 0.06, 0.2),
    Rule("marks", _share("n_marks"), 0.02, 0.1),
    # three words more, so that a short text does not fail by chance
    Rule("common_words", lambda: 1 - F.try_divide(F.col("n_common") + 3, F.col("n_words")), 0.9, 0.96),
    Rule("word_length", lambda: F.abs(_share("word_chars")() - 6), 2.5, 4.0),
]


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that stand in the text twice or more, the first included.

    The windows are sorted with their places; equal neighbours are repeats. A place covers as many
    words as lie before the next repeated place, three at most.
    """
    window = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(window(i).alias("w"), i.alias("i")))

    def places(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(ordered, j)["w"] == x["w"], F.lit(False))
        repeats = F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.sort_array(F.transform(repeats, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        lengths = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
        return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, x: total + x)

    found = let(F.sort_array(windows), lambda ordered: let(places(ordered), covered))
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(found)


def _count(words: Column, keep: Callable[..., Column]) -> Column:
    return F.size(F.filter(words, keep)).cast("long")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with what the rules look at: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, ...``.

    The text column is left out; columns of these names are replaced. A null text has no words and counts of 0.
    Lines without a word count neither as lines nor as repeats.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    without = lambda chars: F.length(F.translate(whole, chars, "")).cast("long")
    # only white space that Spark's trim knows as blanks may stand at the ends once it is all one sign
    blank = F.trim(F.translate(whole, SPACES, " " * len(SPACES)))
    words = F.filter(F.split(blank, " +"), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated(w).alias("n_repeat_words"),
            _count(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False))).alias("n_same_as_before"),
            _count(w, lambda x: F.lower(x).isin(COMMON)).alias("n_common"),
        ),
    )
    of_lines = let(
        lines,
        lambda s: F.struct(F.size(s).cast("long").alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines")),
    )
    added = {
        "word_chars": without(SPACES),
        "n_symbols": F.length(whole).cast("long") - without(SYMBOLS),
        "n_marks": F.regexp_count(whole, F.lit(r"[!?]{2}")).cast("long"),
        "n_capitals": F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long"),
        "n_without_letters": F.regexp_count(whole, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]+(?![^\x20\x09-\x0D])")).cast("long"),
    }
    named = ["n_words", "n_repeat_words", "n_same_as_before", "n_common", "n_lines", "n_dup_lines", *added]
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c not in named]
    rows = docs.select(*kept, of_words.alias("_words"), of_lines.alias("_lines"), *[v.alias(c) for c, v in added.items()])
    return rows.select(*kept, "_words.*", "_lines.*", *added)


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def votes(rules: list[Rule] = RULES) -> Column:
    """One tinyint for each rule: 1 good, -1 bad, 0 abstains (also where its measure is undefined)."""

    def vote(rule: Rule) -> Column:
        value = rule.measure()
        return F.when(value >= rule.bad, -1).when(value <= rule.good, 1).otherwise(0).cast("tinyint")

    return F.array(*[vote(rule) for rule in rules])


@dataclass(frozen=True)
class Model:
    """Share of good documents, and for each rule how often it is right on good and on bad documents."""

    good: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def quality(self, vote: str = "votes") -> Column:
        """Probability that a document with these votes is good."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for j, (g, b) in enumerate(zip(self.right_on_good, self.right_on_bad, strict=True)):
            cast = F.get(F.col(vote), F.lit(j))
            odds = odds + F.when(cast == 1, math.log(g / (1 - b))).when(cast == -1, math.log((1 - g) / b)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def start(rules: int) -> Model:
    return Model(PRIOR_GOOD, (RIGHT_ON_GOOD,) * rules, (RIGHT_ON_BAD,) * rules)


def fit(patterns: DataFrame, rules: int = len(RULES)) -> Model:
    """Expectation-maximisation over ``votes, n``: distinct vote patterns and how many documents have them.

    Each round computes every pattern's quality under the last model, and from it the expected number of good
    documents, of votes and of right votes: one aggregate. A rule starts with ``PRIOR_VOTES`` made-up votes, of which
    ``RIGHT_ON_GOOD`` or ``RIGHT_ON_BAD`` are right, so one that never votes keeps that. Without documents the start is the result.
    """
    model = start(rules)
    good, bad = F.col("n") * F.col("q"), F.col("n") * (1 - F.col("q"))
    sums = [F.sum("n"), F.sum(good)]
    for j in range(rules):
        cast = F.get(F.col("votes"), F.lit(j))
        sums += [
            F.sum(F.when(cast != 0, good)), F.sum(F.when(cast == 1, good)),
            F.sum(F.when(cast != 0, bad)), F.sum(F.when(cast == -1, bad)),
        ]
    for _ in range(ROUNDS):
        n, of_good, *found = (x or 0.0 for x in patterns.withColumn("q", model.quality()).agg(*sums).first())
        share = lambda right, cast, prior: (right + PRIOR_VOTES * prior) / (cast + PRIOR_VOTES)
        new = Model(
            (of_good + PRIOR_VOTES * PRIOR_GOOD) / (n + PRIOR_VOTES),
            tuple(share(found[4 * j + 1], found[4 * j], RIGHT_ON_GOOD) for j in range(rules)),
            tuple(share(found[4 * j + 3], found[4 * j + 2], RIGHT_ON_BAD) for j in range(rules)),
        )
        changed = max(map(abs, (x - y for x, y in zip(_numbers(new), _numbers(model), strict=True))))
        model = new
        if changed < SETTLED:
            break
    return model


def _numbers(model: Model) -> tuple[float, ...]:
    return (model.good, *model.right_on_good, *model.right_on_bad)


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows without their text, with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality, kept``.

    Columns of these names are replaced. ``quality`` is the probability of being good; ``kept`` is
    false where ``base_failed``, else whether good is at least as likely as bad. A null or empty text has no words and fails.
    Repeated rows count each. The model is learned from the documents that pass the base
    rules; where there are none, all have failed already.
    """
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    inner, at, back = plain_names(docs)
    rows = measured(inner, at[text]).select(
        *[c for name, c in at.items() if name != text], *shown, base_failed().alias("base_failed"), votes().alias("votes")
    )
    rows = stored(rows, "quality-votes")
    counted = rows.where(~F.col("base_failed")).groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    patterns = stored(counted.repartitionByRange(1, "votes").sortWithinPartitions("votes"), "quality-patterns")
    rows = rows.withColumn("quality", fit(patterns).quality())
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    made = [*shown, "base_failed", "quality", "kept"]
    return rows.select(*[F.col(c).alias(name) for name, c in at.items() if name != text and name not in made], *made)
