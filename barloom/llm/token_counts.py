"""Token counts of a unigram tokenizer without making its tokens.

For each word a dynamic programme over its characters carries the best score of any
segmentation and that segmentation's number of pieces. An Aho-Corasick automaton lists
the vocabulary's matches, for each end the longest first. A later match wins only with a
strictly higher score, which is the tokenizer's own rule for ties.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barloom.llm.arrow import with_columns

CACHED_WORDS = 300_000
#: Fixed value: the sign that stands for a space in vocabularies of this family.
SPACE = "▁"
#: Fixed value: an unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
LOWEST = float("-inf")


class UnigramCounter:
    """Pieces with scores; an unknown character counts as many pieces as it has bytes (byte fallback)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.matches = ahocorasick.Automaton()
        for piece, score in pieces:
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        n = len(word)
        score = [0.0] + [LOWEST] * n
        count = [0] * (n + 1)
        closed = 0

        def close(end: int) -> None:
            """After all matches that end here: the last character as an unknown one, if no piece is that character."""
            if word[end - 1] not in self.single and score[end - 1] + self.unknown > score[end]:
                score[end] = score[end - 1] + self.unknown
                count[end] = count[end - 1] + len(word[end - 1].encode())

        for last, (size, value) in self.matches.iter(word):
            while closed < last:
                closed += 1
                close(closed)
            end, start = last + 1, last + 1 - size
            if score[start] + value > score[end]:
                score[end], count[end] = score[start] + value, count[start] + 1
        while closed < n:
            closed += 1
            close(closed)
        return count[n]

    def count(self, texts: list[str | None]) -> list[int]:
        out = []
        for text in texts:
            words = (SPACE + text.replace(" ", SPACE)).split(SPACE)[1:] if text else []
            if text and text[0] in (" ", SPACE):
                words = words[1:]
            if len(self.words) > CACHED_WORDS:
                self.older, self.words = self.words, {}
            for word in set(words).difference(self.words):
                held = self.older.get(word)
                self.words[word] = self.count_word(SPACE + word) if held is None else held
            out.append(sum(map(self.words.__getitem__, words)))
        return out


@lru_cache(maxsize=1)
def counter(path: str) -> UnigramCounter:
    """The ordinary pieces of a model file and their scores, read once in each Python worker."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    ids = [i for i in range(model.vocab_size()) if not any(is_special(i) for is_special in special)]
    return UnigramCounter([(model.id_to_piece(i), model.get_score(i)) for i in ids])


def count_tokens(df: DataFrame, path: str, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of every whole text (long).

    A text is split before every space, which becomes part of the word that it precedes; a
    text that does not begin with one gets one. Null and empty texts have 0 tokens. Other
    columns and repeated rows stay, a column named like ``count`` is replaced. ``path`` is
    a model file that every executor can read.
    """

    def make(texts: list[str | None]) -> list[list]:
        return [counter(path).count(texts)]

    return with_columns(df, text, [T.StructField(count, T.LongType())], make)
