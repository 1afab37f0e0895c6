import random

import pytest
from helpers import as_tables, sql_rows

from barloom.llm import queries, topk


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, k=20):
    import math

    good = [(i, v) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in good]
    out = []
    for q, a in {(i, tuple(v)) for i, v in good if i % 20 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("dims", [1, 15, 16, 40])
def test_as_sql(spark, monkeypatch, dims):
    rng = random.Random(dims)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, rng.gauss(0, 0.3)]) for _ in range(dims)], 0) for i in range(300)]
    rows += [(300 + i, rows[20][1], 1) for i in range(40)]
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 5)
    frame = embeddings(spark, rows)
    as_tables(monkeypatch, queries, embeddings=frame)
    got = sorted(map(tuple, queries.op8_topk(spark, "").collect()))
    assert got == brute(rows)
    assert got == sorted(sql_rows(queries.ORACLE["op8_topk"], embeddings=frame.toPandas()))


def test_odd_vectors(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 0), (20, None, 0), (40, [1.0, None], 0), (60, [nan, 1.0], 0), (80, [inf, 1.0], 0), (None, [1.0, 1.0], 0),
        (1, [1.0], 0), (2, [1.0, 1.0, 5.0], 0), (3, [], 0), (100, [], 0), (4, [-1.0, 3.0e4], 0), (5, [2.0, 1.0], 0), (5, [2.0, 1.0], 0),
        (120, [2.0**40, 0.0], 0), (0, [1.0, 2.0], 0),
    ]
    as_tables(monkeypatch, queries, embeddings=embeddings(spark, rows))
    assert sorted(map(tuple, queries.op8_topk(spark, "").collect())) == brute(rows)


def test_scores_beyond_whole_doubles(spark, monkeypatch):
    """2^54 + 1 and 2^54 differ; products near 2^60 and vectors of 1e20 and 3e30 are exact; found scores keep their digits."""
    big = 2.0**21  # 2^27 after scaling
    cases = [
        [(0, [big, 1 / 64], 0), (1, [big, 0.0], 0), (2, [big, 1 / 64], 0)],
        [(0, [2.0**24, 3 / 64, 1.0], 0)] + [(i, [2.0**24, i / 64, -1.0], 0) for i in range(1, 60)],
        [(0, [1.0, 0.0], 0), (1, [0.0, 1e20], 0), (2, [2.0, 0.0], 0), (20, [0.0, 1 / 64], 0)],
        [(20, [3e30, 0.0], 0), (1, [0.0, 1e20], 0), (2, [0.0, 3.0], 0), (40, [0.0, -1.0], 0)],
    ]
    for k, rows in enumerate(cases):
        frame = embeddings(spark, rows)
        as_tables(monkeypatch, queries, embeddings=frame)
        monkeypatch.setattr(topk, "CANDIDATES", 2)
        expected = [r for r in brute(rows)]
        if any(abs(s) >= 2**63 for *_, s in expected):
            with pytest.raises(Exception, match="does not fit a long"):
                queries.op8_topk(spark, "").collect()
            continue
        assert sorted(map(tuple, queries.op8_topk(spark, "").collect())) == expected
        if k != 3:
            assert expected == sorted(sql_rows(queries.ORACLE["op8_topk"], embeddings=frame.toPandas()))


def test_large_and_small_blocks_meet(spark, monkeypatch):
    """Blocks of small and of large vectors, many dimensions: bounds are cautious where scores are rounded to be compared."""
    rng = random.Random(6)
    monkeypatch.setattr(topk, "CANDIDATES", 8)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rows = [(i, [rng.choice([1.0, 2.0**22, 2.0**23 + 1]) * rng.choice([-1, 1]) + rng.randrange(64) / 64 for _ in range(40)], 0) for i in range(120)]
    as_tables(monkeypatch, queries, embeddings=embeddings(spark, rows))
    import numpy as np

    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v, _ in rows]
    assert sorted(map(tuple, queries.op8_topk(spark, "").collect())) == brute(rows)


def test_fewer_than_k_and_none(spark, monkeypatch):
    for rows in ([(0, [1.0], 0)], [], [(1, [1.0], 0)], [(0, [1.0], 0), (7, [2.0], 0)]):
        as_tables(monkeypatch, queries, embeddings=embeddings(spark, rows))
        assert sorted(map(tuple, queries.op8_topk(spark, "").collect())) == brute(rows)


def test_driver_holds_no_blocks(spark, monkeypatch):
    """However many groups of candidates the queries go to, no copy of them goes through the driver: broadcasts are held to 1.5 MB."""
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(256)], 0) for i in range(1000)]
    monkeypatch.setattr(topk, "CANDIDATES", 8)
    as_tables(monkeypatch, queries, embeddings=embeddings(spark, rows))
    held = {"spark.sql.maxBroadcastTableSize": "1500k", "spark.sql.autoBroadcastJoinThreshold": "10m", "spark.sql.shuffle.partitions": "64"}
    before = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        got = queries.op8_topk(spark, "").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    import numpy as np

    assert sorted(map(tuple, got)) == brute([(i, [float(np.float32(x)) for x in v], 0) for i, v, _ in rows])


def test_cells(spark, monkeypatch):
    """Many cells: every pair of blocks meets in one of them, groups have about equally many vectors, and a task holds few candidates."""
    monkeypatch.setattr(topk, "CANDIDATES", 16)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "CELL_PRODUCTS", 1)
    monkeypatch.setattr(topk, "HELD_VALUES", 600)
    rng = random.Random(10)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5]) for _ in range(rng.choice([3, 20]))], 0) for i in range(500)]
    as_tables(monkeypatch, queries, embeddings=embeddings(spark, rows))
    assert sorted(map(tuple, queries.op8_topk(spark, "").collect())) == brute(rows)

    blocks = spark.createDataFrame([((p << 33) + at, 10 if at < 30 else 3) for p in (0, 2, 5) for at in (0, 10, 20, 30)], "block long, n int")
    sizes = [sum(r.n for r in g) for g in _groups(topk._dealt(blocks, 4, 99, "g").collect())]
    assert len(sizes) == 4 and sum(sizes) == 99 and max(sizes) - min(sizes) <= 10


def _groups(rows):
    return [[r for r in rows if r.g == g] for g in sorted({r.g for r in rows})]


def test_grid():
    from pyspark.sql import Row

    def size(n, dims, per):
        return Row(n_blocks=-(-n // per), n=n, n_values=n * dims)

    def cells(n, least, most):
        lines, columns = topk._grid(size(n, 64, 2048), size(n // 20, 64, 256), 20, least, most)
        assert n * 64 / columns <= topk.HELD_VALUES
        return lines, columns

    assert topk._grid(size(0, 0, 9), size(0, 0, 9), 20, 8, 400) == (1, 1)
    assert cells(10_000, 8, 400) == (2, 5)
    lines, columns = cells(50_000_000, 8, 400)
    assert lines * columns < 2_000
    shuffled = [lines * n * 64 + columns * n // 20 * (64 + 6 * 20) for n in (600_000, 6_000_000) for lines, columns in [cells(n, 12, 100)]]
    assert shuffled[1] < 12 * shuffled[0] and shuffled[0] < 20 * 600_000 * 64


def test_few_are_left():
    """Bounds leave few pairs after some dimensions; lists of pairs give the same best as whole blocks, ties by id across blocks too."""
    import numpy as np

    rng = np.random.default_rng(11)
    x = np.floor(rng.normal(0, 40, (1500, 50)) * np.exp(-np.arange(50) / 6))
    x[700:900] = x[5:205]
    ids = rng.permutation(1500)

    def block(rows):
        return topk._Block(len(rows), 50, ids[rows].astype("<i8").tobytes(), x[rows].T.astype("<f8").tobytes())

    asked = np.arange(0, 1500, 23)
    best = topk._Best(block(asked), 7)
    for at in range(0, 1500, 300):
        best.meet(block(np.arange(at, at + 300)))
    scores = (x[asked] @ x.T).astype(int)
    for i, q in enumerate(asked):
        order = [r for r in np.lexsort((ids, -scores[i])) if r != q][:7]
        assert best.found[best.query == i].tolist() == ids[order].tolist()
        assert best.score[best.query == i].tolist() == scores[i, order].tolist()
