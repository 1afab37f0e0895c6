"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

Texts with equal shingle sets are one class, so copies never meet in pairs. Classes that
share a band of their signatures are candidates. Each bucket is first verified against one of
its members only, which joins a group of copies with as many pairs as members; what is
left are pairs of different components, which are all verified.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.arrow import batch_limit, pieces
from barloom.llm.ordering import numbered
from barloom.llm.shingles import mixed, shingle_set
from barloom.llm.tables import plain_names, stored

#: At a similarity of 0.75 two documents share no band once in 400,000 times.
BANDS, BAND_ROWS = 48, 5
REGISTERS = BANDS * BAND_ROWS
ELEMENTS_AT_ONCE = 100_000
#: A link: 100 * intersection >= 75 * union.
PERCENT = 75
#: Four bits of each register, for a look at a pair before its texts are compared. At a similarity of 0.75 it
#: has 184 equal ones in the mean, with a deviation of 6.6 at most: fewer than these once in 300,000 pairs.
NIBBLE_WORDS = REGISTERS // 16
EQUAL_NIBBLES = 154
#: Bits of a map of each document's shingles. Common shingles have common bits, and a document has no more shingles
#: without a bit of their own than it has shingles beyond bits; so two maps bound an intersection from above.
MAP_BITS = 4096
#: Ids that are broadcast, at most (16 MB); more are joined by shuffling both sides.
SENT_IDS = 1_000_000
#: Members of a bucket that are compared with each other at a time.
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 14
#: Pairs of different components that are left in the buckets are compared at once if there are at most so many for
#: each document in a bucket; else another round of one comparison per member comes first, three times at most.
PAIRS_EACH = 50_000
STAR_ROUNDS = 3
_STEP = 0x9E3779B97F4A7C15
_BAND_MULTIPLIERS = np.array([xxhash.xxh64_intdigest(b"band", i) | 1 for i in range(BAND_ROWS)], np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash signatures: a row of registers for each set (infinite for an empty one).

    Every element draws, round by round, a number in [0, 1) and the next register of a
    random permutation of its own; the register keeps the least number plus round. Values of
    round j are at least j, so a set is done once all its registers are below j + 1.
    """
    out = np.full((len(sets), REGISTERS), np.inf)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order: np.ndarray | None = None
    for j in range(REGISTERS):
        if not len(elements):
            break
        draw = mixed(elements + np.uint64((_STEP * (j + 1)) % (1 << 64)))
        value = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + j
        pick = (j + mixed(draw) % np.uint64(REGISTERS - j)).astype(np.int64)
        if order is None:
            register = pick
        else:
            rows = np.arange(len(elements))
            register = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, j]
        np.minimum.at(flat, owner * REGISTERS + register, value)
        left = out.max(axis=1) >= j + 1
        stays = left[owner]
        if order is None:
            elements, owner, pick = elements[stays], owner[stays], pick[stays]
            order = np.tile(np.arange(REGISTERS, dtype=np.uint8), (len(elements), 1))
            order[np.arange(len(elements)), pick] = 0
        elif not stays.all():
            elements, owner, order = elements[stays], owner[stays], order[stays]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of registers."""
    bits = signature.view(np.uint64).reshape(-1, BANDS, BAND_ROWS)
    keys = (mixed(bits) * _BAND_MULTIPLIERS).sum(axis=2, dtype=np.uint64)
    return mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def nibbles(signature: np.ndarray) -> np.ndarray:
    """Four bits of each register, sixteen registers to a word."""
    bits = (mixed(signature.view(np.uint64)) >> np.uint64(60)).reshape(-1, NIBBLE_WORDS, 16)
    return (bits << (4 * np.arange(16, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)


def shingle_map(shingles: np.ndarray) -> bytes:
    """The bits that a set of shingles is spread over."""
    there = np.zeros(MAP_BITS, bool)
    there[(shingles % np.uint64(MAP_BITS)).astype(np.int64)] = True
    return np.packbits(there).tobytes()


def promising(one: Column, other: Column) -> Column:
    """Whether enough nibbles of two sketches are equal for a link."""
    differing = F.lit(0)
    for i in range(NIBBLE_WORDS):
        x = F.get(one, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return differing <= REGISTERS - EQUAL_NIBBLES


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, bands, nibbles, map`` of each row; digests are equal if and only if the sets are."""
    keys = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = [shingle_set(t) for t in part.column("text").to_pylist()]
                bands: list[np.ndarray] = []
                words: list[np.ndarray] = []
                start, held = 0, 0
                for i, s in enumerate(sets):
                    held += len(s)
                    if held >= ELEMENTS_AT_ONCE or i + 1 == len(sets):
                        signature = signatures(sets[start : i + 1])
                        bands.extend(band_keys(signature))
                        words.extend(nibbles(signature))
                        start, held = i + 1, 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([b if len(s) else [] for s, b in zip(sets, bands, strict=True)], keys),
                        pa.array(words, keys),
                        pa.array(map(shingle_map, sets), pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands", "nibbles", "map"],
                )

    schema = "doc_id long, n_shingles long, digest binary, bands array<long>, nibbles array<long>, map binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _listed(rows: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
    """Rows whose key is (left_semi) or is not (left_anti) among distinct ``id``; so many at most are sent to the rows."""
    listed = ids.select(F.col("id").alias("_id"))
    if listed.limit(SENT_IDS + 1).count() <= SENT_IDS:
        listed = F.broadcast(listed)
    return rows.join(listed, F.col(key) == F.col("_id"), how)


def similar(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs ``a, b`` of document ids those whose full shingle sets are similar enough."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = _listed(texts, "doc_id", ids, "left_semi")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_id, held_text, held = None, None, None
        for batch in batches:
            for part in pieces(batch, "a_text"):
                linked = []
                for b, a_text, b_text in zip(*(part.column(c).to_pylist() for c in ("b", "a_text", "b_text")), strict=True):
                    if held is None or held_id != b or held_text != b_text:
                        held_id, held_text, held = b, b_text, shingle_set(b_text)
                    own = shingle_set(a_text)
                    common = len(np.intersect1d(own, held, assume_unique=True))
                    linked.append(100 * common >= PERCENT * (len(own) + len(held) - common) and common > 0)
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    batch_limit(docs.sparkSession)
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges of each partition as a forest: every node beside the least node it reaches in it (union-find)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(x), root(y)
                parent[max(x, y)] = min(x, y)
        nodes = [n for n in parent if root(n) != n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())], ["u", "v"]
        )

    return edges.mapInArrow(run, "u long, v long")


def _stars(state: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none."""
    u, v = state.select("u"), state.select(F.col("v").alias("u"))
    twice = u.groupBy("u").count().where("count > 1").select("u")
    return not twice.union(u.join(v, "u", "left_semi")).limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least reachable node) for every node of ``a, b`` edges that is not its own component.

    Union-find joins the edges of each partition; across partitions, neighbours are hung on the
    least node in turn above and below each node (large and small star) until only stars are left.
    """
    state = stored(_contracted(edges.select("a", "b")).distinct(), "links")
    while not _stars(state):
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = stored(hung.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _looked_at(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Of pairs ``a, b`` those whose sketches promise a link."""
    one = marks.select(F.col("id").alias("a"), F.col("nibbles").alias("one"))
    other = marks.select(F.col("id").alias("b"), F.col("nibbles").alias("other"))
    return pairs.join(one, "a").join(other, "b").where(promising(F.col("one"), F.col("other"))).select("a", "b").distinct()


def _verified(found: list[DataFrame], tested: list[DataFrame], pairs: DataFrame, docs: DataFrame) -> None:
    """Test pairs that have not been tested; add them to ``tested`` and the links among them to ``found``."""
    for done in tested:
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    pairs = stored(pairs, "pairs")
    tested.append(pairs)
    found.append(stored(similar(pairs, docs), "linked"))


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id, text``).

    Null and empty texts, and those without words, have no shingles and are linked with nothing.
    Rows that share a doc_id are one document: what any of them is linked with, all are. A null
    doc_id names no document: its row is its own, with a null component, and kept.
    """
    batch_limit(docs.sparkSession)
    sketch = stored(sketches(docs), "sketches")
    known = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    classes = stored(classes, "classes")
    first = classes.select(F.col("rep").alias("doc_id"), "digest")
    reps = known.join(first, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
    reps = reps.select(F.col("doc_id").alias("id"), "n_shingles", "bands", "nibbles", "map")
    buckets = reps.select("id", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader != last")
    candidates = stored(buckets.join(shared.select("key", "leader"), "key"), "buckets")
    marks = stored(reps.join(candidates.select("id").distinct(), "id", "left_semi"), "marks")

    found: list[DataFrame] = []
    tested: list[DataFrame] = []
    star = candidates.where("id != leader").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    _verified(found, tested, _looked_at(star.distinct(), marks), docs)
    several = known.select("doc_id", "digest").distinct().groupBy("doc_id").count().where("count > 1")
    of_several = known.select("doc_id", "digest").join(several, "doc_id", "left_semi").join(classes, "digest")
    of_several = of_several.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b")
    found.append(stored(of_several.distinct(), "linked"))
    for turn in range(STAR_ROUNDS):
        joined = components(_union(found))
        labelled = candidates.select("key", "band", "id").join(joined, F.col("id") == F.col("node"), "left")
        labelled = labelled.select("key", "band", "id", F.coalesce("component", "id").alias("component"))
        parts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("members"))
        mixed_keys = parts.groupBy("key").agg(
            F.count(F.lit(1)).alias("parts"),
            F.sum("members").alias("members"),
            F.sum(F.col("members") * F.col("members")).alias("alike"),
        )
        mixed_keys = stored(mixed_keys.where("parts > 1"), "mixed-buckets")
        sums = mixed_keys.agg(F.sum("members"), F.sum((F.col("members") * F.col("members") - F.col("alike")) / 2)).first()
        if not sums[0]:
            break
        rest = labelled.join(mixed_keys.select("key", "members"), "key")
        if sums[1] <= PAIRS_EACH * sums[0] / BANDS or turn + 1 == STAR_ROUNDS:
            _verified(found, tested, _across(rest, marks), docs)
            joined = components(_union(found)) if found[-1].limit(1).count() else joined
            break
        heads = rest.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)), "id", "component")).alias("head"))
        heads = heads.select("key", F.col("head.id").alias("head"), F.col("head.component").alias("of"))
        ends = [F.greatest("id", "head").alias("a"), F.least("id", "head").alias("b")]
        ended = rest.join(heads, "key").where("component != of").select(*ends).distinct()
        _verified(found, tested, _looked_at(ended, marks), docs)

    label = classes.join(joined, F.col("rep") == F.col("node"), "left")
    label = label.select("digest", F.coalesce("component", "rep").alias("_component"), "rows", "rep")
    label = label.where("rows > 1 or _component != rep").select("digest", "_component")
    placed = sketch.select("doc_id", "n_shingles", "digest").join(label, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("_component", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def _across(rest: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs of members of a bucket that are not in one component and whose sizes, sketches and maps allow a link.

    A bucket is compared block by block, so that no task gets more than two blocks of one at a time. A pair comes
    from the first bucket that both share, and so once.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = rest.withColumn("blocks", blocks).withColumn("block", own)
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", "band", "id", "component", "block", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    tasks = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["key", "low", "high"]
    dealt = rows.join(marks, "id").repartition(tasks, *group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_compared, "a long, b long")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The promising pairs of each run of rows of one ``key, low, high``."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        group = np.column_stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "low", "high")])
        starts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist()]
        yield _pairs(table.slice(0, starts[-1]), starts)
        held = table.slice(starts[-1])
    if held is not None and held.num_rows:
        yield _pairs(held, [0, held.num_rows])


def _pairs(table: pa.Table, starts: list[int]) -> pa.RecordBatch:
    """Pairs within the runs of rows that begin and end at ``starts``."""
    out: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    if table.num_rows:
        ids, component, size, block, band = (
            table.column(c).to_numpy().astype(np.int64) for c in ("id", "component", "n_shingles", "block", "band")
        )
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        words, bands = (
            np.vstack(table.column(c).to_numpy()).astype(np.int64).view(np.uint64) for c in ("nibbles", "bands")
        )
        maps = np.frombuffer(b"".join(table.column("map").to_pylist()), np.uint64).reshape(table.num_rows, -1)
        unmapped = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        for start, end in zip(starts, starts[1:], strict=False):
            one = other = np.arange(start, end)
            if low[start] != high[start]:
                one, other = one[block[start:end] == low[start]], other[block[start:end] == high[start]]
            for at in range(0, len(one), 32):
                x, y = one[at : at + 32, None], other[None, :]
                can = (component[x] != component[y]) & (100 * np.minimum(size[x], size[y]) >= PERCENT * np.maximum(size[x], size[y]))
                if low[start] == high[start]:
                    can &= x < y
                i, j = np.nonzero(can)
                if not len(i):
                    continue
                i, j = one[at + i], other[j]
                for part in range(0, len(i), PAIRS_AT_ONCE):
                    a, b = i[part : part + PAIRS_AT_ONCE], j[part : part + PAIRS_AT_ONCE]
                    differing = words[a] ^ words[b]
                    differing |= differing >> np.uint64(2)
                    differing |= differing >> np.uint64(1)
                    differing &= np.uint64(0x1111111111111111)
                    near = np.bitwise_count(differing).sum(axis=1) <= REGISTERS - EQUAL_NIBBLES
                    a, b = a[near], b[near]
                    first = (bands[a] == bands[b]).argmax(axis=1) == band[a]
                    a, b = a[first], b[first]
                    common = np.bitwise_count(maps[a] & maps[b]).sum(axis=1, dtype=np.int64)
                    common += np.minimum(unmapped[a], unmapped[b])
                    can_be = 100 * common >= PERCENT * (size[a] + size[b] - common)
                    a, b = ids[a[can_be]], ids[b[can_be]]
                    out.append(np.column_stack([np.maximum(a, b), np.minimum(a, b)]))
    pairs = np.concatenate(out)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents of which each stands for its group: those with the least doc_id in their component.

    All columns of ``docs`` stay. Rows without a doc_id stay. Where rows with different texts share a doc_id, each text is a document
    of its own (in the order of doc_id and digest), so no text goes unless one that is like it stays; of rows with
    the same doc_id and text that with the least hash of its columns stays.
    """
    inner, at, back = plain_names(docs)
    rows = inner.withColumn("named", F.col(at["doc_id"]).cast("long")).withColumn("said", F.col(at["text"]))
    ids = rows.where("named is not null").groupBy("named").agg(F.count(F.lit(1)).alias("rows"))
    if ids.where("rows > 1").isEmpty():
        grouped = stored(groups(docs.select("doc_id", "text")), "groups")
        dropped = grouped.where("not kept").select(F.col("doc_id").alias("id")).distinct()
        return back(_listed(rows, "named", dropped, "left_anti"))
    rows = rows.withColumn("digest", F.coalesce(F.sha2("said", 256), F.lit("")))
    texts = rows.where("named is not null").select("named", "digest").distinct()
    numbers = numbered(texts, [F.col("named"), F.col("digest")], "place")
    placed = rows.join(numbers, ["named", "digest"], "left")
    named = placed.where("place is not null")
    grouped = groups(named.select(F.col("place").alias("doc_id"), F.col("said").alias("text")).dropDuplicates(["doc_id"]))
    kept = stored(grouped.where("kept").select(F.col("doc_id").alias("place")), "groups")
    hashed = [f.name for f in inner.schema.fields if not {"map", "variant"} & set(re.findall(r"\w+", f.dataType.simpleString()))]
    marked = named.join(kept, "place", "left_semi").withColumn("mark", F.xxhash64(*hashed))
    least = marked.groupBy("place").agg(F.min("mark").alias("mark"))
    one = marked.join(least, ["place", "mark"], "left_semi").dropDuplicates(["place", "mark"])
    return back(one.unionByName(placed.where("place is null").withColumn("mark", F.lit(0).cast("long"))))
