"""Whitening of embeddings by a Chebyshev-filtered subspace iteration.

Vectors stay where they are. A block Q of a few more columns than wanted is multiplied by the
covariance V of the centred rows X, again and again:

1. Rayleigh-Ritz: one product gives VQ, the small matrix Q'VQ its eigenvectors, and these the
   residuals VQ - QE. If the wanted ones are small enough, the components are certified.
2. Else the block is filtered: a Chebyshev polynomial of V, by its three-term recurrence of
   one product a degree, which is at most 1 on the unwanted part of the spectrum (0 up to the
   block's least Ritz value) and grows fast above. QR makes it orthonormal again.

Of vectors up to ``WIDEST`` long V is summed by one pass over the rows, X'X of every partition,
and the products need no further one. Of longer ones V is never formed: each product is a pass
that sums X'(XQ), and the driver holds only such blocks (a row for each dimension).

Partial sums are added up by tasks before the driver takes a bounded number of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palabre.llm.common import stage

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries from here on (about 4e12) have no exact double of their scaled form.
_LARGEST = 2.0**52 / SCALE
#: Components, and columns of the block besides them.
COMPONENTS, GUARD = 8, 24
#: Most products of one filter, and rounds before it gives up.
DEGREE, ROUNDS = 20, 60
#: A component is certified at a residual of this share of the largest eigenvalue.
TOLERANCE = 1e-14
#: An eigenvalue below this share of the largest one counts as zero: nothing to scale by.
ZERO = 1e-12
#: Up to so many dimensions the covariance is formed: 8 MB, which every partition sends once. That is
#: less than its blocks of all passes, of which an iteration takes about a hundred.
WIDEST = 1024
#: Tasks that add up the partial sums of all partitions.
_ADDERS = 4


@dataclass(frozen=True)
class Whitening:
    """Means, components (columns), their eigenvalues and what certifies them."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    #: The largest residual as a share of the largest eigenvalue.
    residual: float
    #: The largest absolute entry of the whitened covariance minus the identity.
    identity_error: float
    passes: int

    @property
    def whole(self) -> np.ndarray:
        """The means' whole parts; what is beyond them is ``rest``, so centring is exact."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])


def scaled_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: the usable vectors as whole numbers, ``floor(1024 c) + 100000`` of each entry.

    Rows whose vector is null, empty or holds a null, a NaN or an infinite entry go, and so do
    rows with an entry beyond 4e12 (whose scaled form no double holds exactly) and
    vectors of another length than most have (of equally common ones the longest).
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    # NaN is greater than all numbers, so it fails the comparison too.
    usable = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(_LARGEST))) & (F.size(v) > 0)
    x = F.transform(v, lambda c: F.floor(c * SCALE) + F.lit(SHIFT))
    scaled = stage(rows.filter(usable).select(F.col(f"`{id_column}`").alias("vec_id"), F.size(v).alias("d"), x.alias("x")), "vectors")
    common = scaled.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    return scaled.filter(F.col("d") == (common["d"] if common else 0)).select("vec_id", "x")


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(
    rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], first: int, kind: type = np.float64
) -> np.ndarray | None:
    """The sum over all batches of ``of(matrix of whole numbers)``, None without rows.

    ``first`` is the number of rows and ``kind`` the type of what ``of`` returns. Each partition sends one partial sum; a few tasks add them up in order.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), None
        for batch in batches:
            if len(batch):
                one = of(_matrix(batch.column("x")))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part % _ADDERS], pa.int64()), pa.array([part], pa.int64()),
                 pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())],
                names=["adder", "part", "total"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("total").to_pylist():
                one = np.frombuffer(raw, kind)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    sent = rows.select("x").mapInArrow(partial, "adder long, part long, total binary")
    summed = sent.repartition(_ADDERS, "adder").sortWithinPartitions("part").mapInArrow(add, "total binary")
    totals = [np.frombuffer(r["total"], kind) for r in summed.collect()]  # a row for each adder
    return np.sum(totals, axis=0).reshape(first, -1) if totals else None


def _exact_sums(x: np.ndarray) -> np.ndarray:
    """Counts and sums of the upper and lower parts of whole numbers; none can overflow."""
    ones = np.full(x.shape[1], len(x), dtype=np.int64)
    return np.stack([ones, (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)])


class _Covariance:
    """Products with the covariance, each of one pass over the rows."""

    def __init__(self, rows: DataFrame, n: int, sums: tuple[int, ...]) -> None:
        self.rows, self.n, self.passes = rows, n, 0
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([float(Fraction(s % n, n)) for s in sums])

    def _pass(self, of: Callable[[np.ndarray], np.ndarray], first: int) -> np.ndarray:
        whole, rest = self.whole, self.rest
        self.passes += 1
        return _summed(self.rows, lambda x: of((x - whole) - rest), first) / self.n

    def matrix(self) -> np.ndarray:
        """The covariance itself."""
        v = self._pass(lambda centred: centred.T @ centred, len(self.whole))
        return (v + v.T) / 2

    def variances(self) -> np.ndarray:
        return self._pass(lambda centred: np.einsum("ij,ij->j", centred, centred), 1)

    def times(self, q: np.ndarray) -> np.ndarray:
        return self._pass(lambda centred: centred.T @ (centred @ q), len(q))

    def of(self, w: np.ndarray) -> np.ndarray:
        """The covariance of the projections on the columns of ``w``."""

        def gram(centred: np.ndarray) -> np.ndarray:
            z = centred @ w
            return z.T @ z

        return self._pass(gram, w.shape[1])


def chebyshev_filter(
    times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, cut: float, degree: int
) -> np.ndarray:
    """The Chebyshev polynomial of ``V`` that is small on the eigenvalues 0 to ``cut``, applied to ``q``.

    ``vq`` is the product that the first step needs, known already.
    """
    half = cut / 2
    before, now = q, (vq - half * q) / half
    for _ in range(degree - 1):
        # Both terms are scaled alike, which the recurrence allows and large degrees need.
        size = np.linalg.norm(now)
        before, now = before / size, now / size
        before, now = now, 2 * (times(now) - half * now) / half - before
    return now


def subspace_iteration(
    times: Callable[[np.ndarray], np.ndarray],
    dimensions: int,
    components: int = COMPONENTS,
    guard: int = GUARD,
    tolerance: float = TOLERANCE,
) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues (falling), their vectors and the largest residual's share.

    ``times`` multiplies a block by the symmetric, non-negative matrix. It ends when every
    wanted residual is within ``tolerance``, or when rounding lets them fall no further.
    """
    columns = min(dimensions, components + guard)
    wanted = min(components, dimensions)
    q, _ = np.linalg.qr(np.random.default_rng(12).standard_normal((dimensions, columns)))
    best, stuck = np.inf, 0
    for _ in range(ROUNDS):
        vq = times(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        if values[0] <= 0:
            return values[:wanted], q[:, :wanted], 0.0
        residual = float(np.linalg.norm((vq - q * values)[:, :wanted], axis=0).max() / values[0])
        stuck = stuck + 1 if residual > best / 2 else 0
        best = min(best, residual)
        close = residual <= 1e3 * tolerance
        if residual <= tolerance or columns == dimensions or (stuck >= 2 and close) or values[-1] <= ZERO * values[0]:
            break
        cut = float(values[-1])
        grown = np.arccosh(max(2 * values[wanted - 1] / cut - 1, 1 + 1e-12))
        degree = int(np.clip(np.ceil(np.arccosh(max(residual / tolerance, 2.0) * 10) / grown), 2, DEGREE))
        q, _ = np.linalg.qr(chebyshev_filter(times, q, vq, cut, degree))
    return values[:wanted], q[:, :wanted], residual


def fit_whitening(rows: DataFrame, components: int = COMPONENTS, widest: int = WIDEST) -> Whitening | None:
    """The components of stored ``rows (vec_id, x)``; None if there is no row.

    Vectors longer than ``widest`` are multiplied by passes over the rows.
    Components whose eigenvalue is zero are left out: there may be fewer than asked for.
    """
    sums = _summed(rows, _exact_sums, 3, np.int64)
    if sums is None:
        return None
    n = int(sums[0, 0])
    exact = tuple((int(high) << 26) + int(low) for high, low in zip(sums[1], sums[2], strict=True))
    covariance = _Covariance(rows, n, exact)
    if len(exact) <= widest:
        formed = covariance.matrix()
        trace, times = float(np.trace(formed)), formed.__matmul__
    else:
        trace, times = float(covariance.variances().sum()), covariance.times
    if trace == 0:
        none = np.empty((len(exact), 0))
        return Whitening(n, exact, none, np.empty(0), trace, 0.0, 0.0, covariance.passes)
    values, vectors, residual = subspace_iteration(times, len(exact), components)
    real = values > ZERO * values[0]
    values, vectors = values[real], vectors[:, real]
    # Of the two signs the one that makes the largest entry positive.
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(len(values))])
    error = covariance.of(vectors / np.sqrt(values)) - np.eye(len(values))
    return Whitening(n, exact, vectors, values, trace, residual, float(np.abs(error).max()), covariance.passes)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The exact sum over the dimensions of (n x - S)^2; None where a long can't hold it."""
    most = max(abs(n * int(edge) - s) for edge in (x.min(), x.max()) for s in sums) if x.size else 0
    if most * most * x.shape[1] < 1 << 63 and n * int(np.abs(x).max(initial=0)) < 1 << 63:
        off = n * x - np.array(sums, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    totals = (sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [t if t < 1 << 63 else None for t in totals]


_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """Each row of ``rows (vec_id, x)`` on each component, in units of its standard deviation."""
    n, sums, whole, rest = model.n, model.sums, model.whole, model.rest
    project = model.vectors / np.sqrt(model.values)
    shares = model.values / model.trace if model.trace else model.values
    k, error = len(model.values), model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch) or not k:
                continue
            x = _matrix(batch.column("x"))
            each = np.repeat(np.arange(len(x)), k)
            far = pa.array(_deviations(x, n, sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n)),
                    far.take(pa.array(each)),
                    pa.array((((x - whole) - rest) @ project).reshape(-1)),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                names=[c.split()[0] for c in _SCHEMA.split(", ")],
            )

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, _SCHEMA)


def whiten_embeddings(
    embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The usable vectors (see ``scaled_vectors``) on the largest components of all of them.

    Returns ``vec_id, component, n, deviation, whitened, explained, identity_error``: the
    number of vectors, the exact sum over dimensions of (n x - S)^2 (null if no long
    holds it), the projection over the component's standard deviation, its share of the
    variance, and the largest absolute entry of the whitened covariance minus the identity.
    There are fewer components if the vectors vary in fewer directions, so equal vectors
    (or a single one) have none and give no rows; nor does an empty table. Repeated rows
    count each, rows without an id too; further columns are not read.
    """
    rows = scaled_vectors(embeddings, id_column, vector)
    model = fit_whitening(rows, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], _SCHEMA)
    return whiten(rows, model)
