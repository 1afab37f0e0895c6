"""Byte-level BPE: encoding by a walk through the trie of distinct words, and decoding.

The encoding of a word is the chain of *last tokens* of its prefixes: among the
tokens that end a prefix exactly one can stand after the last token of what is
left of it without the two being merged differently. So each trie node carries
one last token, found from the nodes above it, and a prefix that many words share
is encoded once. The distinct words are visited in byte order, which is the
depth-first order of their trie; only the path from the root is held.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barloom.llm.arrow import with_columns

#: Fixed value: how byte-level tokenizers of this family split text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_WORDS = 200_000
WORDS_AT_ONCE = 200_000
LONG_TEXT = 1_000_000
NEVER = 1 << 40


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges of a byte-level BPE file as an automaton over symbols: bytes first, then merges by rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        model, letters = stored["model"], _byte_letters()
        ids: dict[str, int] = model["vocab"]
        raw = {token: bytes(letters[c] for c in token) for token in ids if all(c in letters for c in token)}
        self.added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.bytes_of_id = {i: raw[t] for t, i in ids.items() if t in raw}
        self.bytes_of_id |= {i: t.encode() for t, i in self.added.items()}
        by_letter = {b: c for c, b in letters.items()}
        self.content = [bytes([b]) for b in range(256)]
        self.id_of = [ids[by_letter[b]] for b in range(256)]
        self.parts: list[tuple[int, int]] = [(-1, -1)] * 256
        symbol = {c: b for c, b in letters.items()}
        self.merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            whole = left + right
            self.merged[symbol[left], symbol[right]] = symbol[whole] = len(self.content)
            self.parts.append((symbol[left], symbol[right]))
            self.content.append(raw[whole])
            self.id_of.append(ids[whole])
        self.packed = [np.uint32(i).astype("<u4").tobytes() for i in self.id_of]
        self._build()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}

    def _build(self) -> None:
        """Automaton of all symbols: for each state its children, and the symbols that end there, longest first."""
        self.next: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for s, content in enumerate(self.content):
            if s >= 256 and not self._whole(s):
                continue
            at = 0
            for b in content:
                to = self.next[at].get(b)
                if to is None:
                    to = self.next[at][b] = len(self.next)
                    self.next.append({})
                    ends.append(-1)
                at = to
            ends[at] = s
        self.back = [0] * len(self.next)
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.next]
        queue = [0]
        for at in queue:
            for b, to in self.next[at].items():
                f = self.back[at]
                while at and f and b not in self.next[f]:
                    f = self.back[f]
                self.back[to] = self.next[f].get(b, 0) if at else 0
                own = [(ends[to], len(self.content[ends[to]]))] if ends[to] >= 0 else []
                self.ending[to] = own + self.ending[self.back[to]]
                queue.append(to)

    def _whole(self, s: int) -> bool:
        """Whether the bytes of a merge are encoded as that merge: nothing joins its halves in another way before."""
        left, right = self.parts[s]
        return self._apart(left, right, s)

    def _apart(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether two symbols stay unmerged side by side until merge ``before``.

        Goes back in time through the merges that made the symbols at the seam;
        a merge across it would have come first if its rank is lower than that of the
        merge that took either side away, or the same and further left.
        """
        left_until = right_until = NEVER
        first = True
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < left_until and across <= right_until and not (first and across == before):
                return False
            first = False
            if left < 256 and right < 256:
                return True
            if left > right:
                left_until, left = left, self.parts[left][1]
            else:
                right_until, right = right, self.parts[right][0]

    def _encode_sorted(self, words: list[bytes]) -> Iterator[bytes]:
        """Packed ids of words in byte order; ``last`` and ``states`` are the path in their trie."""
        last: list[tuple[int, int]] = [(-1, 0)]
        states = [0]
        previous = b""
        goto, back, ending, fits, apart, packed = self.next, self.back, self.ending, self.fits, self._apart, self.packed
        for word in words:
            shared = 0
            for x, y in zip(previous, word, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for depth in range(shared, len(word)):
                b = word[depth]
                while state and b not in goto[state]:
                    state = back[state]
                state = goto[state].get(b, 0)
                states.append(state)
                for candidate in ending[state]:
                    s, size = candidate
                    before = last[depth + 1 - size][0]
                    if before < 0:
                        break
                    key = before << 20 | s
                    fit = fits.get(key)
                    if fit is None:
                        fit = fits[key] = apart(before, s)
                    if fit:
                        break
                last.append(candidate)
            previous, at, out = word, len(word), []
            while at:
                s, size = last[at]
                out.append(packed[s])
                at -= size
            out.reverse()
            yield b"".join(out)
        if len(fits) > CACHED_WORDS:
            fits.clear()

    def _hold(self, words: set[str]) -> dict[str, bytes]:
        """A look-up that has all these words; those not held yet are encoded in one walk.

        Words of the last two generations are held, so that frequent ones stay and memory is bounded.
        """
        if len(self.words) > CACHED_WORDS:
            self.older, self.words = self.words, {}
        new = words.difference(self.words)
        known = new.intersection(self.older)
        self.words.update((w, self.older[w]) for w in known)
        pairs = sorted((w.encode("utf-8", "surrogatepass"), w) for w in new.difference(known))
        self.words.update(zip([w for _, w in pairs], self._encode_sorted([b for b, _ in pairs]), strict=True))
        return self.words

    @lru_cache(maxsize=1)  # noqa: B019  one vocabulary lives as long as its worker
    def _special(self) -> regex.Pattern | None:
        names = sorted(self.added, key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def segments(self, text: str) -> list[str]:
        """Texts between special tokens, at odd places the special tokens themselves."""
        if not any(name in text for name in self.added):
            return [text]
        return self._special().split(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null and empty give none."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        count = 0

        def flush() -> None:
            nonlocal count
            held = self._hold(set().union(*[words for _, words in waiting]))
            for at, words in waiting:
                out[at].append(b"".join(map(held.__getitem__, words)))
            waiting.clear()
            count = 0

        for i, text in enumerate(texts):
            for k, part in enumerate(self.segments(text or "")):
                if k % 2:
                    flush()
                    out[i].append(np.uint32(self.added[part]).astype("<u4").tobytes())
                    continue
                if len(part) <= LONG_TEXT:
                    found = iter((splitter(part).findall(part),))
                else:
                    words = (m.group() for m in splitter(part).finditer(part))
                    found = iter(lambda words=words: list(islice(words, WORDS_AT_ONCE)), [])
                for some in found:
                    waiting.append((i, some))
                    count += len(some)
                    if count >= WORDS_AT_ONCE:
                        flush()
        flush()
        return [b"".join(p) for p in out]

    def decode(self, packed: list[bytes | None]) -> list[str]:
        """Texts of packed ids; unknown ids give nothing, broken UTF-8 the replacement character."""
        table = self.bytes_of_id
        out = []
        for ids in packed:
            numbers = np.frombuffer(ids or b"", "<u4").tolist()
            out.append(b"".join([table.get(i, b"") for i in numbers]).decode("utf-8", "replace"))
        return out


@lru_cache(maxsize=1)
def _patterns() -> tuple[regex.Pattern, regex.Pattern, regex.Pattern]:
    """The splitting pattern; letters and digits newer than Python's own tables; the pattern that knows none of them."""
    unassigned = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    newer = list(map(ord, regex.findall(r"[\p{L}\p{N}]", unassigned)))
    runs, start = [], None
    for i, c in enumerate(newer):
        start = c if start is None else start
        if i + 1 == len(newer) or newer[i + 1] != c + 1:
            runs.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    late = "[" + "".join(runs) + "]" if runs else r"[^\s\S]"
    older = PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:{late}|[^\s\p{{L}}\p{{N}}])")
    older = older.replace(r"\p{L}+|", rf"(?:(?!{late})\p{{L}})+|").replace(r"\p{N}+|", rf"(?:(?!{late})\p{{N}})+|")
    return regex.compile(PATTERN), regex.compile(late), regex.compile(older)


def splitter(text: str) -> regex.Pattern:
    """The pattern to split a text by; the tokenizers library counts newer letters and digits as signs."""
    plain, late, older = _patterns()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return older if late.search(text) else plain
    return plain


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once in each Python worker."""
    return Vocabulary(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens") -> DataFrame:
    """Add the token ids of every whole text (binary, little-endian unsigned 32-bit) and their number (long).

    Null and empty texts give no tokens. Special tokens written out in a text are
    encoded as such. Other columns stay; columns with the names of the new ones
    are replaced. Rows are independent: repeated rows stay, an empty table gives an empty one.
    ``path`` is a vocabulary file that every executor can read.
    """

    def make(texts: list[str | None]) -> list[list]:
        packed = vocabulary(path).encode(texts)
        return [packed, [len(p) // 4 for p in packed]]

    return with_columns(df, text, [T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType())], make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of packed token ids; null and empty give an empty text."""

    def make(packed: list[bytes | None]) -> list[list]:
        return [vocabulary(path).decode(packed)]

    return with_columns(df, ids, [T.StructField(text, T.StringType())], make)
