"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed. Spark multiplies it with a few vectors at a time: every task centres its
vectors, projects them and sums the products back, and the sums are aggregated by dimension. The
driver holds the search space, whose size depends on the dimensions alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.arrow import ship
from barloom.llm.tables import stored

#: Pairs improved at once beyond those wanted, so that a near tie is not decided too early.
GUARDS = 2
INNER, OUTER = 8, 100
#: Ritz vectors kept where the search space is cut back, and its largest size, as multiples of the pairs improved at once.
KEPT, LARGEST = 2, 8
#: An eigenvalue up to this part of the largest is zero in double precision: there is nothing to whiten.
ZERO = 1e-12
#: Integers up to this are added without leaving 64 bits.
SAFE = 2**62

Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Directions of ``new`` outside the bases, as orthonormal columns; those that are nothing but rounding are left out."""
    for _ in range(2):
        for base in bases:
            new = new - base @ (base.T @ new)
        sizes = np.linalg.norm(new, axis=0)
        new = new[:, sizes > 0] / sizes[sizes > 0]
        if new.shape[1]:
            q, r = np.linalg.qr(new)
            new = q[:, np.abs(np.diag(r)) > 1e-10]
    return new


def minres(product: Product, right: np.ndarray, steps: int, enough: np.ndarray) -> np.ndarray:
    """Approximate solutions of symmetric systems, one for each column, with one common product a step.

    A column stops when its residual is at most ``enough``.
    """
    beta = np.linalg.norm(right, axis=0)
    going = beta > enough
    v, v_old = right / np.where(beta > 0, beta, 1), np.zeros_like(right)
    x, w, w_old = (np.zeros_like(right) for _ in range(3))
    c, c_old, s, s_old, eta = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta), beta.copy()
    for _ in range(steps):
        if not going.any():
            break
        av = product(v)
        alpha = (v * av).sum(axis=0)
        next_v = av - alpha * v - beta * v_old
        next_beta = np.linalg.norm(next_v, axis=0)
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, next_beta)
        going &= rho > 0
        safe = np.where(rho > 0, rho, 1)
        next_w = (v - s_old * beta * w_old - (s * alpha + c_old * c * beta) * w) / safe
        c_old, c, s_old, s = c, delta / safe, s, next_beta / safe
        x = np.where(going, x + c * eta * next_w, x)
        eta = -s * eta
        going &= (np.abs(eta) > enough) & (next_beta > 0)
        v_old, v = v, next_v / np.where(next_beta > 0, next_beta, 1)
        beta, w_old, w = next_beta, w, next_w
    return x


def jacobi_davidson(product: Product, dims: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator, falling, and unit eigenvectors as columns.

    Each round takes the Ritz pairs of the search space. Leading pairs whose residual (by a product of their own) is
    rounding only are locked; for the others the correction equation, projected away from locked and
    current vectors, is solved by a few steps of MINRES, and the corrections widen the space.
    """
    wanted = min(wanted, dims)
    block = min(wanted + GUARDS, dims)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dims, block)))
    image = product(space)
    further = _orthonormal(image, space)
    if further.shape[1]:
        space, image = np.hstack([space, further]), np.hstack([image, product(further)])
    locked, values = np.zeros((dims, 0)), []
    largest = 0.0
    for _ in range(OUTER):
        theta, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        order = np.argsort(-theta)
        theta, turn = theta[order], turn[:, order]
        largest = max(largest, float(np.abs(theta).max()), *map(abs, values), 0.0)
        enough = max(dims, 32) * np.finfo(float).eps * largest
        many = min(block - locked.shape[1], len(theta))
        ritz = space @ turn[:, :many]
        ritz /= np.linalg.norm(ritz, axis=0)
        image_of = image @ turn[:, :many]
        rest = image_of - ritz * theta[:many]
        rest -= locked @ (locked.T @ rest)
        small = np.linalg.norm(rest, axis=0) <= enough
        first = int(np.argmin(small)) if not small.all() else many
        first = min(first, wanted - len(values))
        if first:
            fresh = product(ritz[:, :first])
            theta[:first] = (ritz[:, :first] * fresh).sum(axis=0)
            sizes = np.linalg.norm(fresh - ritz[:, :first] * theta[:first], axis=0)
            right = sizes <= 2 * enough
            first = int(np.argmin(right)) if not right.all() else first
        if first:
            locked = np.hstack([locked, ritz[:, :first]])
            values += list(map(float, theta[:first]))
            if len(values) == wanted:
                break
            turn = turn[:, first:]
            space, image = space @ turn, image @ turn
            image = image - locked @ (locked.T @ image)
            continue
        whole = space.shape[1] + locked.shape[1] >= dims
        if whole or space.shape[1] + many > LARGEST * block:
            # cut back (or, with every direction in the space, start again from it) with images free of carried rounding
            space = _orthonormal(space @ turn[:, : space.shape[1] if whole else KEPT * block], locked)
            image = product(space)
            image = image - locked @ (locked.T @ image)
            continue
        away = np.hstack([locked, ritz])

        def projected(t: np.ndarray, away: np.ndarray = away, theta: np.ndarray = theta[:many]) -> np.ndarray:
            t = t - away @ (away.T @ t)
            out = product(t) - t * theta
            return out - away @ (away.T @ out)

        right = -(rest - away @ (away.T @ rest))
        aims = np.maximum(enough / 4, 1e-3 * np.linalg.norm(right, axis=0))
        more = _orthonormal(minres(projected, right, INNER, aims), locked, space)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((dims, 1)), locked, space)
        fresh = product(more)
        space, image = np.hstack([space, more]), np.hstack([image, fresh - locked @ (locked.T @ fresh)])
    else:
        raise ArithmeticError(f"{len(values)} of {wanted} eigenvectors after {OUTER} rounds")
    order = np.argsort(-np.array(values), kind="stable")
    vectors = np.linalg.qr(locked[:, order])[0]
    return np.array(values)[order], vectors


@dataclass(frozen=True)
class Model:
    """What whitening needs: size and exact sums of the fit list, eigenvalues and vectors, and the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def dims(self) -> int:
        return len(self.sums)


def scaled(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """``vec_id, x``: floor(scale * component) as longs, without vectors that are null or hold null or non-finite components.

    Values beyond the range of a long become its ends.
    """
    values = F.col("embedding").cast("array<double>")
    bad = F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull()).where(~bad)
    return rows.select("vec_id", F.transform(values, lambda c: F.floor(c * scale)).alias("x"))


def _filled(x: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of longs, shorter ones filled with zeros."""
    lengths = np.diff(x.offsets.to_numpy())
    flat = x.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


class _Centre:
    """Takes the mean S/n from whole numbers: first its integer part, exactly, then the fraction."""

    def __init__(self, n: int, sums: list[int]):
        parts = [divmod(s, n) for s in sums]
        self.whole = np.array([q for q, _ in parts], np.int64)
        self.rest = [r for _, r in parts]
        self.fraction = np.array([r / n for r in self.rest])
        self.n = n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if x.size and max(abs(int(x.min())), abs(int(x.max()))) > SAFE:
            return (x.astype(object) - self.whole.astype(object)).astype(float) - self.fraction
        return (x - self.whole) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2 for each row, exact; none where it leaves a long."""
        if not x.size:
            return [0] * len(x)
        reach = max(abs(int(x.min())), abs(int(x.max()))) + int(np.abs(self.whole).max()) + 2
        if reach * self.n < 2**31 or (reach * self.n) ** 2 * x.shape[1] < SAFE:
            off = (x - self.whole) * self.n - np.array(self.rest, np.int64)
            return (off * off).sum(axis=1).tolist()
        off = (x.astype(object) - self.whole.astype(object)) * self.n - np.array(self.rest, object)
        return [d if d < 2**63 else None for d in (off * off).sum(axis=1).tolist()]


def _summed(rows: DataFrame, dims: int, width: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list[list]:
    """The sum of ``part`` (lines by ``width``) over batches of vectors: added up in each task, then line by line by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = part(_filled(batch.column("x"), dims))
                total = made if total is None else total + made
        if total is not None:
            to = pa.float64() if kind == "double" else pa.decimal128(38, 0)
            values = [pa.array(column.tolist(), to) for column in total.T]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *values], ["line", *names])

    names = [f"y{i}" for i in range(width)]
    found = rows.select("x").mapInArrow(run, ", ".join(["line int", *(f"{c} {kind}" for c in names)]))
    summed = found.groupBy("line").agg(*[F.sum(c).alias(c) for c in names])
    return [list(r)[1:] for r in sorted(summed.collect())]


def _column_sums(x: np.ndarray) -> np.ndarray:
    if x.size and max(abs(int(x.min())), abs(int(x.max()))) * len(x) >= SAFE:
        return x.astype(object).sum(axis=0)[:, None]
    return x.sum(axis=0).astype(object)[:, None]


def fit(vectors: DataFrame, components: int = 4, seed: int = 13) -> Model:
    """Model of ``x`` vectors (as ``scaled`` makes them): the fit list holds each distinct one once.

    Vectors of other lengths count as filled with zeros to the longest. Components stop where the
    eigenvalue is zero in double precision; a list without two different vectors has none.
    """
    ship(vectors.sparkSession)
    dims = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return Model(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    rows = stored(vectors.select(filled.alias("x")).distinct(), "whitening-list")
    n = rows.count()
    sums = [int(line[0]) for line in _summed(rows, dims, 1, _column_sums, "decimal(38,0)")]
    centre = _Centre(n, sums)

    def product(u: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            return c.T @ (c @ u)

        return np.array(_summed(rows, dims, u.shape[1], part)) / n

    [[squares]] = _summed(rows, dims, 1, lambda x: np.array([[np.square(centre(x)).sum()]]))
    trace = squares / n
    if not trace > 0:
        return Model(n, tuple(sums), np.zeros(0), np.zeros((dims, 0)), trace, 0.0)
    values, directions = jacobi_davidson(product, dims, components, seed)
    real = values > ZERO * values[0]
    values, directions = values[real], directions[:, real]
    turn = directions / np.sqrt(values)
    k = len(values)
    mean = np.array(_summed(rows, dims, 1, lambda x: (centre(x) @ turn).sum(axis=0)[:, None]))[:, 0] / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = centre(x) @ turn - mean
        return w.T @ w

    error = np.abs(np.array(_summed(rows, dims, k, spread)) / n - np.eye(k)).max()
    return Model(n, tuple(sums), values, directions, trace, float(error))


def whiten(vectors: DataFrame, model: Model) -> DataFrame:
    """A row for each vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``vectors`` has ``vec_id, x``. Repeated and null ids are rows like others. ``deviation`` is null where it leaves a long. Without
    components (no vectors, or all alike) there are no rows.
    """
    ship(vectors.sparkSession)
    k, n, dims = len(model.values), model.n, model.dims
    if not k:
        centre, turn = None, None
    else:
        centre, turn = _Centre(n, list(model.sums)), model.vectors / np.sqrt(model.values)
    explained = model.values / model.trace if k else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _filled(batch.column("x"), dims)
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(rows), n), pa.int64()),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(rows)),
                    pa.array((centre(x) @ turn).ravel(), pa.float64()),
                    pa.array(np.tile(explained, len(x)), pa.float64()),
                    pa.array(np.full(len(rows), model.identity_error), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return vectors.select("vec_id", "x").mapInArrow(run, schema)
