"""Order MinHash fingerprints of whole texts, in DataFrame functions only.

A text is cut into tokens, and each run of ``KMER`` tokens is numbered by its occurrence, so
that a repeated run counts as often as it stands there. The hash functions are one hash of run and number, turned
to start at each of 2 ** ``BINS_LOG2`` places on its circle of values. Under each of them the ``PICKED`` least runs are selected, put back
into text order, and hashed as a tuple: one entry of the signature. Two texts agree in an entry only if the
same runs are selected in the same order, which edits and moved passages both make less likely. Every entry is
an ordered pair as soon as a text has two runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KMER = 3
BINS_LOG2 = 6
PICKED = 2
#: Runs without ASCII white space, cut after eight characters so that texts without any have tokens too.
TOKEN = r"[^\x20\x09-\x0D]{1,8}"
#: A packed element: hash above, place in the text below (places beyond 2**24 wrap around).
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1


def _hash(x: Column) -> Column:
    return F.shiftright(x, PLACE_BITS)


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BINS_LOG2)


#: Sorted as signed numbers, the bins run from -_HALF to _HALF - 1.
_HALF = 1 << (BINS_LOG2 - 1)


def _start(x: Column) -> Column:
    return F.shiftright(x, 64 - BINS_LOG2)


def _from_to(lo: Column, hi: Column) -> Column:
    lo, hi = lo.cast("long"), hi.cast("long")
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<long>"))


def _packed(value: Column, place: Column) -> Column:
    return F.shiftleft(value, PLACE_BITS).bitwiseOR(place)


def _changes(array: Column, of, back: int = 1):
    """For a filter over a sorted array: whether ``of`` differs from that of the element ``back`` before."""
    return lambda x, i: (i < back) | (of(F.get(array, i - back)) != of(x))


def with_signature(df: DataFrame, text: str, signature: str = "signature") -> DataFrame:
    """Add the signature (array of longs, bin above and tuple hash below) of a text column.

    Texts with fewer than ``KMER`` tokens have one run of all of them, which is every entry; null and empty texts and those of
    white space only have an empty signature, all others one entry for each hash function. Equal texts have equal signatures. Every step is a
    column of its own, so that none is computed again for each element of an array.
    """
    kept = [c for c in df.columns if c != signature]
    token, run, number, firsts, repeats, starts, chosen, picked = (F.col(f"_{i}") for i in range(8))
    step = df.withColumn("_0", F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0)))
    runs = F.transform(token, lambda x, i: F.xxhash64(x, *[F.get(token, i + k) for k in range(1, KMER)]))
    count = F.greatest(F.size(token) - (KMER - 1), F.least(F.size(token), F.lit(1)))
    step = step.withColumn("_1", F.slice(runs, F.lit(1), count))
    places = F.transform(run, lambda x, i: _packed(x, i.cast("long").bitwiseAND(F.lit(_PLACE))))
    step = step.withColumn("_2", F.sort_array(places))
    step = step.withColumn("_3", F.filter(number, _changes(number, _hash)))
    again = F.filter(number, lambda x, i: ~_changes(number, _hash)(x, i))
    step = step.withColumn("_4", F.when(F.size(firsts) < F.size(number), again).otherwise(F.array().cast("array<long>")))
    index = F.when(F.size(repeats) > 0, F.sequence(F.lit(0), F.size(repeats) - 1)).otherwise(F.array().cast("array<int>"))
    first = F.filter(index, lambda i: (i == 0) | (_hash(F.get(repeats, i - 1)) != _hash(F.get(repeats, i))))
    step = step.withColumn("_5", first)

    def numbered(start: Column, j: Column) -> Column:
        same = F.slice(repeats, start + 1, F.coalesce(F.get(starts, j + 1), F.size(repeats)) - start)
        return F.transform(same, lambda x, n: _packed(F.xxhash64(_hash(x), n), x.bitwiseAND(F.lit(_PLACE))))

    both = F.sort_array(F.concat(firsts, F.flatten(F.transform(starts, numbered))))
    step = step.withColumn("_6", F.when(F.size(repeats) > 0, both).otherwise(firsts))
    step = step.withColumn("_7", F.filter(chosen, _changes(chosen, _bin, PICKED)))

    def entries(x: Column, i: Column) -> Column:
        """The entries of the hash functions under which this is the least element: those that start behind the one before."""
        other = F.when(F.size(picked) > 1, F.get(picked, F.pmod(i + 1, F.size(picked))))
        in_order = other.isNull() | (x.bitwiseAND(F.lit(_PLACE)) <= other.bitwiseAND(F.lit(_PLACE)))
        pair = F.when(in_order, F.xxhash64(_hash(x), _hash(other))).otherwise(F.xxhash64(_hash(other), _hash(x)))
        before = _start(F.get(picked, i - 1))
        # the circle closes: behind the last element the first one is the least again
        around = F.concat(_from_to(F.lit(-_HALF), _start(x)), _from_to(_start(F.element_at(picked, -1)) + 1, F.lit(_HALF - 1)))
        starts = F.when(i == 0, around).otherwise(_from_to(before + 1, _start(x)))
        low = pair.bitwiseAND(F.lit(0xFFFFFFFF))
        return F.transform(starts, lambda b: F.shiftleft(b.bitwiseAND(F.lit(2 * _HALF - 1)), 32).bitwiseOR(low))

    return step.withColumn(signature, F.flatten(F.transform(picked, entries))).select(*kept, signature)


def likeness(a: Column, b: Column) -> Column:
    """The part of the hash functions under which both have the same entry; 1 for two empty signatures, 0 beside an empty one."""
    bins = F.size(F.array_union(F.transform(a, lambda x: F.shiftright(x, 32)), F.transform(b, lambda x: F.shiftright(x, 32))))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def as_string(signature: Column) -> Column:
    """Ten hexadecimal digits for each entry; empty for an empty signature."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 10, "0"))), "")
