"""URL rules looked up in a sorted array of digests.

The index is one file: 64-bit digests of all keys in order, the keys themselves, and a note for each key: for a rule, where its host
ends and its verdict.
Every executor gets a copy of it (``SparkContext.addFile``), which its workers map into
memory. A batch of keys is digested and found by one vectorised binary search; a hit counts
only if the stored key is the same, so that equal digests of different keys do no harm.
"""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.arrow import batch_limit, pieces

#: The most rules that pass through the driver into one index file; more are looked up by a join.
INDEXED_RULES = 1_000_000
_GIVEN: set[tuple[str, str]] = set()
#: Upper-case letters that hosts are lower-cased by.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class DigestIndex:
    """Keys of a file written by ``write_index``, found by digest and confirmed by string."""

    def __init__(self, path: str):
        n = int(np.memmap(path, "<u8", "r", 0, 1)[0])
        self.digests = np.memmap(path, "<u8", "r", 8, n) if n else np.zeros(0, "<u8")
        #: Where each key starts, then where each note does, both in the bytes that follow.
        self.starts = np.memmap(path, "<u8", "r", 8 + 8 * n, 2 * n + 1)
        at = 16 + 24 * n
        self.blob = np.memmap(path, "u1", "r", at) if os.path.getsize(path) > at else np.zeros(0, "u1")

    def find(self, keys: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """The place of each key in the index, -1 if it is not there."""
        wanted = np.fromiter(map(digest, keys), np.uint64, len(keys))
        found = np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.digests, wanted)
        left = np.arange(len(keys))
        while len(left):
            left = left[at[left] < len(self.digests)]
            left = left[self.digests[at[left]] == wanted[left]]
            same = np.fromiter((self.key(int(at[i])) == keys[i] for i in left), bool, len(left))
            found[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
        return found

    def key(self, place: int) -> bytes:
        return self.blob[int(self.starts[place]) : int(self.starts[place + 1])].tobytes()

    def note(self, place: int) -> bytes:
        return self.key(len(self.digests) + place)


def write_index(keys: Iterable[bytes], path: str, digest=xxhash.xxh64_intdigest, notes: Mapping[bytes, bytes] | None = None) -> None:
    """Distinct keys in the order of their digests and their notes (empty without any) in the same order, preceded by digests and places."""
    ordered = sorted((digest(k), k) for k in set(keys))
    noted = [(notes or {}).get(k, b"") for _, k in ordered]
    starts = np.cumsum([0, *(len(k) for _, k in ordered), *map(len, noted)]).astype("<u8")
    with open(path, "wb") as f:
        f.write(np.array([len(ordered)], "<u8").tobytes())
        f.write(np.array([d for d, _ in ordered], "<u8").tobytes())
        f.write(starts.tobytes())
        f.write(b"".join(k for _, k in ordered))
        f.write(b"".join(noted))


@lru_cache(maxsize=4)
def _mapped(name: str) -> DigestIndex:
    return DigestIndex(SparkFiles.get(name))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without it."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(df: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Add ``host, path, rule, verdict`` to every row; columns of these names are replaced.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains, if the url's path
    starts with the rule's. Of those that fit, the longest (host and path together, then host)
    wins; without one the rule is null and the verdict ``default``. Of rules given more than once, the
    smallest verdict counts; rules with a null in them fit nothing. Null and malformed urls have an empty
    host and path. Repeated rows stay.
    """
    split = df.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    split = split.drop("rule", "verdict")
    clean = rules.where("host is not null and path is not null and verdict is not null")
    clean = clean.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    if clean.limit(INDEXED_RULES + 1).count() > INDEXED_RULES:
        return _judge_by_join(split, clean, default)
    return _judge_by_index(split, clean, default)


def _give_out(spark: SparkSession, notes: Mapping[bytes, bytes]) -> str:
    """The name under which executors find the index of some keys; the same keys and notes are given out once."""
    name = f"urls-{xxhash.xxh3_128_hexdigest(repr(sorted(notes.items())).encode())}.idx"
    if (spark.sparkContext.applicationId, name) not in _GIVEN:
        path = f"{tempfile.mkdtemp(prefix='urls-')}/{name}"
        write_index(notes, path, notes=notes)
        spark.sparkContext.addFile(path)
        _GIVEN.add((spark.sparkContext.applicationId, name))
    return name


def _judge_by_index(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    listed = sorted((r.host, r.path, r.verdict) for r in rules.collect())
    spark = df.sparkSession
    batch_limit(spark)
    split_at: dict[bytes, dict[int, str]] = {}
    for h, p, v in listed:
        split_at.setdefault((h + p).encode(), {})[len(h)] = v
    by_key_name = _give_out(spark, {k: json.dumps(verdicts).encode() for k, verdicts in split_at.items()})
    by_host_name = _give_out(spark, {h.encode(): b"" for h, _, _ in listed})
    sizes = sorted({len(p) for _, p, _ in listed})
    schema = T.StructType([*df.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_key, by_host = _mapped(by_key_name), _mapped(by_host_name)
        for batch in batches:
            for part in pieces(batch, "path"):
                chosen = _longest(by_key, by_host, sizes, part.column("host").to_pylist(), part.column("path").to_pylist())
                rule = pa.array([c[0] for c in chosen], pa.string())
                verdict = pa.array([default if c[1] is None else c[1] for c in chosen], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, rule, verdict], [*part.schema.names, "rule", "verdict"])

    return df.mapInArrow(run, schema)


def _longest(by_key, by_host, sizes, hosts, paths) -> list[tuple[str | None, str | None]]:
    """For each url the longest rule string that fits, and its verdict."""
    labels = {h: [h, *(h[i + 1 :] for i, c in enumerate(h) if c == ".")] for h in set(hosts)}
    suffixes = list({s for found in labels.values() for s in found})
    known = {s for s, at in zip(suffixes, by_host.find([s.encode() for s in suffixes]), strict=True) if at >= 0}
    fitting = {h: [s for s in found if s in known] for h, found in labels.items()}
    owner, keys, lengths = [], [], []
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        for suffix in fitting[host]:
            for size in sizes:
                if size <= len(path):
                    owner.append(i)
                    keys.append((suffix + path[:size]).encode())
                    lengths.append((len(suffix) + size, len(suffix)))
    best: list[tuple[tuple[int, int], str, str] | None] = [None] * len(hosts)
    places = by_key.find(keys)
    noted = {at: json.loads(by_key.note(at)) for at in set(places[places >= 0].tolist())}
    for k in np.flatnonzero(places >= 0):
        verdict = noted[int(places[k])].get(str(lengths[k][1]))
        held = best[owner[k]]
        if verdict is not None and (held is None or lengths[k] > held[0]):
            best[owner[k]] = (lengths[k], keys[k].decode(), verdict)
    return [(None, None) if b is None else (b[1], b[2]) for b in best]


def _judge_by_join(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for rules of any number: distinct host and path by every suffix of the host."""
    labels = F.split("host", r"\.")
    cut = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = df.select("host", "path").distinct().select("host", "path", F.explode(cut).alias("_suffix"))
    given = rules.select(F.col("host").alias("_host"), F.col("path").alias("_start"), "verdict")
    fits = asked.join(given, (F.col("_suffix") == F.col("_host")) & F.col("path").startswith(F.col("_start")))
    rule = F.concat("_host", "_start")
    best = F.max(F.struct(F.length(rule), F.length("_host"), rule.alias("rule"), "verdict")).alias("_best")
    found = fits.groupBy(F.col("host").alias("_h"), F.col("path").alias("_p")).agg(best)
    joined = df.join(found, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    verdict = F.coalesce("_best.verdict", F.lit(default))
    return joined.select(*df.columns, F.col("_best.rule").alias("rule"), verdict.alias("verdict"))
