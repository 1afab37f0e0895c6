"""Exact top-k by inner product: columnar branch-and-bound over blocks of vectors.

Candidates and queries are packed into blocks of bounded size, dimension by dimension. Each
block of queries meets every block of candidates once; the scores are accumulated over a few
dimensions at a time for all candidates of a block, and after each step those are given up that
cannot reach the k-th best score any more, whatever their remaining dimensions hold.

Blocks meet in the cells of a grid: a cell is a group of blocks of queries and a group of blocks
of candidates, and one task's work. Both kinds of blocks are dealt to the cells by one shuffle,
so there is no join that could be made by a broadcast; of a cell, a task holds the candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from barloom.llm.arrow import batch_limit
from barloom.llm.tables import stored

CANDIDATES, QUERIES = 2048, 256
#: Values of a block (one vector more at most), and of the candidates that a task holds (one block more at most).
BLOCK_VALUES, HELD_VALUES = 1 << 17, 1 << 24
#: Products of components that are worth a cell where there are cells for all cores (some seconds), and the values that a found row counts as.
CELL_PRODUCTS, ROW_VALUES = 1 << 33, 6
#: Blocks in an Arrow batch.
BLOCKS_AT_ONCE = 128
#: Where more than one in so many pairs of vectors are left, whole blocks are multiplied.
FEW = 64
#: Dimensions accumulated between two looks at the bounds.
STEP = 16
#: Sums of products up to the first are exact in doubles, up to the second in 64-bit integers; beyond, Python's integers are used.
EXACT, LONG = 2.0**53, 2.0**63
#: Relative rounding of a score or bound that is looked at as a double.
ROUNDING = 1e-12

_BLOCK = "block long, n int, dims int, ids binary, marks binary, data binary"
#: A block's number: its partition, and the vectors before it there.
_PART_BITS = 33


def _packed(df: DataFrame, size: int, scale: float) -> DataFrame:
    """Rows ``id, mark, vector`` as blocks of at most ``size`` scaled vectors, dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, deepest = TaskContext.get().partitionId(), 0, 0
        ids: list[int] = []
        marks: list[int] = []
        vectors: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            nonlocal made, deepest
            dims = deepest
            data = np.zeros((dims, len(vectors)), "<f8")
            for i, v in enumerate(vectors):
                data[: len(v), i] = v
            small = np.abs(data).max(initial=0) < 2**15
            content = data.astype("<i2") if small else data
            row = [[(part << _PART_BITS) + made], [len(ids)], [dims], [np.array(ids, "<i8").tobytes()], [np.array(marks, "<i8").tobytes()], [content.tobytes()]]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["block", "n", "dims", "ids", "marks", "data"]
            made, deepest = made + len(ids), 0
            ids.clear(), marks.clear(), vectors.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for i, mark, vector in zip(*(batch.column(c) for c in ("id", "mark", "vector")), strict=True):
                values = np.floor(np.array(vector.values.to_numpy(zero_copy_only=False), "<f8") * scale)
                ids.append(i.as_py())
                marks.append(mark.as_py())
                vectors.append(values)
                deepest = max(deepest, len(values))
                if len(ids) == size or len(ids) * deepest >= BLOCK_VALUES:
                    yield block()
        if ids:
            yield block()

    return df.mapInArrow(run, _BLOCK)


class _Block:
    """Vectors dimension by dimension, and the length of what is left of each from every step on."""

    def __init__(self, n: int, dims: int, ids: bytes, data: bytes):
        kind = "<i2" if len(data) == 2 * n * dims else "<f8"
        self.ids = np.frombuffer(ids, "<i8")
        self.data = np.frombuffer(data, kind).reshape(dims, n).astype(float)
        self.most = max(float(np.abs(self.data).max(initial=0)), 1.0)
        squares = self.data * self.data
        sums = [squares[at : at + STEP].sum(axis=0) for at in range(0, dims, STEP)] + [np.zeros(n)]
        self.left = np.sqrt(np.cumsum(sums[::-1], axis=0)[::-1])


def _whole(data: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers."""
    return np.array([int(x) for x in data.ravel()], object).reshape(data.shape)


def _as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and any(not -(2**63) <= s < 2**63 for s in scores):
        raise OverflowError("an inner product does not fit a long")
    return scores.astype(np.int64)


class _Best:
    """The k best of one block of queries so far, as longs in the order of queries and ranks; smaller ids win ties."""

    def __init__(self, block: _Block, k: int):
        self.block, self.k = block, k
        self.query, self.score, self.found = (np.zeros(0, np.int64) for _ in range(3))

    def _last(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which queries have k, and the last of those: score and id."""
        n = np.bincount(self.query, minlength=len(self.block.ids))
        full, at = n == self.k, np.cumsum(n) - 1
        out = [np.zeros(len(n), np.int64) for _ in range(2)]
        for values, known in zip(out, (self.score, self.found), strict=True):
            values[full] = known[at[full]]
        return full, *out

    def meet(self, rows: _Block) -> None:
        own, depth = self.block, min(len(self.block.data), len(rows.data))
        queries, data = own.data[:depth], rows.data[:depth]
        reach = depth * own.most * rows.most
        exact = reach < EXACT
        if not exact:
            queries, data = (x.astype(np.int64) if reach < LONG else _whole(x) for x in (queries, data))
        full, last, last_id = self._last()
        floor = np.where(full, last - np.abs(last.astype(float)) * ROUNDING, -np.inf)
        same = own.ids[:, None] == rows.ids
        # All pairs as a matrix first, those that are left as lists later: q and c are the places of their queries and candidates.
        q, c = np.ogrid[: len(own.ids), : len(rows.ids)]
        score, before = np.zeros(same.shape, queries.dtype), 0
        room = np.empty(same.shape) if exact else None  # for products, so that not every step makes a matrix
        for cut in [*range(STEP, depth, STEP), depth]:
            if score.ndim == 2:
                score += np.matmul(queries[before:cut].T, data[before:cut], out=room)
            else:
                for d in range(before, cut):
                    score += queries[d, q] * data[d, c]
            before, step = cut, -(-cut // STEP)
            so_far = score.astype(float, copy=False)
            slack = np.multiply(own.left[step, q] * (1 + 1e-9), rows.left[step, c], out=room if score.ndim == 2 else None)
            if not exact:
                slack += np.abs(so_far) * ROUNDING
            if score.ndim == 2 and len(rows.ids) >= self.k and not full.all():
                least, at = np.where(same, -np.inf, so_far - slack - 1), len(rows.ids) - self.k
                floor = np.maximum(floor, np.partition(least, at, axis=1)[:, at])
            slack += so_far
            stays = ~(slack < (floor - 1)[q])
            if score.ndim == 2:
                if cut < depth and exact and np.count_nonzero(stays) * FEW > stays.size:
                    continue
                stays &= ~same
                q, c = np.nonzero(stays)
            else:
                q, c = q[stays], c[stays]
            score = score[stays]
        score, ids = _as_long(score), rows.ids[c]
        better = ~full[q] | (score > last[q]) | (score == last[q]) & (ids < last_id[q])
        q, score, ids = (np.concatenate([x, y[better]]) for x, y in ((self.query, q), (self.score, score), (self.found, ids)))
        order = np.lexsort((ids, ~score, q))
        q = q[order]
        best = np.arange(len(q)) - np.searchsorted(q, q) < self.k
        self.query, self.score, self.found = q[best], score[order][best], ids[order][best]


def _grid(candidates: Row, queries: Row, k: int, least: int, most: int) -> tuple[int, int]:
    """Groups of queries and of candidates whose cells have least shuffled: ``least`` to ``most`` cells, less if blocks are few, more if memory needs it.

    Each query goes to all groups of candidates and has ``k`` rows from each, each candidate goes to all groups of queries.
    """
    tasks = min(most, max(least, queries["n_values"] * candidates["n"] // CELL_PRODUCTS))
    moved = queries["n_values"] + ROW_VALUES * k * queries["n"]
    columns = round(math.sqrt(tasks * candidates["n_values"] / max(moved, 1)))
    columns = max(1, -(-candidates["n_values"] // HELD_VALUES), min(columns, candidates["n_blocks"]))
    lines = max(1, min(-(-tasks // columns), queries["n_blocks"]))
    return lines, max(columns, min(-(-tasks // lines), candidates["n_blocks"]))


def _dealt(blocks: DataFrame, groups: int, vectors: int, group: str) -> DataFrame:
    """Blocks in ``groups`` groups of equally many vectors, as nearly as whole blocks allow."""
    part, inside = F.shiftright("block", _PART_BITS), F.col("block").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    counts = blocks.groupBy(part.alias("_part")).agg(F.sum("n").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = (F.col("_before") + inside) * groups / max(vectors, 1)
    return blocks.join(F.broadcast(offsets), part == F.col("_part")).withColumn(group, F.floor(place).cast("int"))


def search(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 64.0) -> DataFrame:
    """For each query its ``k`` highest integer inner products: ``query_id, rank, vec_id, score``.

    Both sides have ``vec_id, embedding``. Components become floor(scale * x), exactly, however large. Vectors that are null or hold
    null or non-finite components take no part, nor do those without an id.
    Vectors of other lengths count as filled with zeros; a score that does not fit a long and could be among the best is an error. Rows with the query's
    id are its own. Ranks start at 1, ties go to smaller ids. Repeated candidates are candidates each;
    a query repeated with the same vector is one query.
    """
    spark = vectors.sparkSession
    batch_limit(spark, BLOCKS_AT_ONCE)

    def clean(df: DataFrame) -> DataFrame:
        values = F.col("embedding").cast("array<double>")
        bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        rows = df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
        return rows.select(F.col("vec_id").cast("long").alias("id"), F.xxhash64(values).alias("mark"), values.alias("vector"))

    candidates = stored(_packed(clean(vectors), CANDIDATES, scale), "candidate-blocks")
    asked = clean(queries).dropDuplicates(["id", "mark", "vector"])
    asked = stored(_packed(asked, QUERIES, scale), "query-blocks")
    sizes = [F.count(F.lit(1)).alias("n_blocks")]
    sizes += [F.coalesce(F.sum(x), F.lit(0)).alias(n) for n, x in (("n", F.col("n")), ("n_values", F.col("n").cast("long") * F.col("dims")))]
    size, asked_size = candidates.agg(*sizes).first(), asked.agg(*sizes).first()
    least, most = spark.sparkContext.defaultParallelism, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines, columns = _grid(size, asked_size, k, least, most)
    row = [(F.col("_line") * columns + F.col("_column")).alias("cell"), "asks", "n", "dims", "ids", "marks", "data"]

    def each(groups: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    held = _dealt(candidates, columns, size["n"], "_column").select("*", F.lit(False).alias("asks"), each(lines).alias("_line"))
    asking = _dealt(asked, lines, asked_size["n"], "_line").select("*", F.lit(True).alias("asks"), each(columns).alias("_column"))
    cells = held.select(*row).unionByName(asking.select(*row))
    cells = cells.repartitionById(lines * columns, "cell").sortWithinPartitions("cell", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["cell"] != cell:
                    cell, blocks = row["cell"], []
                packed = row["n"], row["dims"], row["ids"], row["data"]
                if not row["asks"]:
                    blocks.append(packed)  # as they are: small ones take a quarter of the room
                    continue
                best, marks = _Best(_Block(*packed), k), np.frombuffer(row["marks"], "<i8")
                for rows in blocks:
                    best.meet(_Block(*rows))
                columns = [best.block.ids[best.query], marks[best.query], best.found, best.score]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["query_id", "mark", "vec_id", "score"])

    found = cells.mapInArrow(run, "query_id long, mark long, vec_id long, score long")
    ranked = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
