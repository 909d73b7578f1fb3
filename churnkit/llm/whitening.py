"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of the fit list (each distinct quantised vector once) is never formed. A pass over the data gives V Q for a thin
Q: each task sums its blocks' centred products, Spark adds the tasks' sums by row of the product. A filter of degree m is the
three-term Chebyshev recurrence over m such passes; it damps the spectrum in [0, smallest Ritz value of the block] and lets the leading
directions grow. QR and a Rayleigh-Ritz step on one more pass follow, until every wanted pair is certified: its
residual |V q - e q| is below ``tol`` times its distance to the nearest other Ritz value, or at the rounding of the pass itself.

Vectors that are null or hold null or non-finite components take no part; shorter vectors count as padded with zeros. Rows with
a null id and repeated rows are returned each. Components are as many as V has positive eigenvalues (beyond rounding), at most
``k``: equal vectors throughout, one vector, or an empty table give no rows. Of equal eigenvalues any orthonormal basis is given.
A component beyond 2 ** 53 after scaling is an error; a deviation beyond a long is null. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnkit.llm.knn import quantised, usable
from churnkit.session import materialize, ship_package

LONG = 2 ** 63


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _pack(dims: int, per_block: int):
    """Vectors as blocks of bytes, each with its count and its exact sum a dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, per_block):
                x = _matrix(b.slice(at, per_block).column(0), dims)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int64()), pa.array([x.sum(axis=0).tolist()], pa.list_(pa.int64())),
                     pa.array([x.astype("<i8").tobytes()], pa.binary())], names=["rows", "sums", "x"])
    return run


class FitList:
    """The distinct vectors in packed blocks, with n and S; the operator V Q as one distributed pass."""

    def __init__(self, vectors: DataFrame, dims: int, per_block: int = 4096):
        self.dims = dims
        distinct = vectors.groupBy("x").agg(F.count("*").alias("copies")).select("x")     # combined before the shuffle
        self.blocks = materialize(distinct.mapInArrow(_pack(dims, per_block), "rows long, sums array<long>, x binary"), "whiten-blocks")
        self.n = self.blocks.agg(F.sum("rows")).first()[0] or 0
        sums = self.blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()   # a row a dimension
        self.s = np.zeros(dims, np.int64)
        for r in sums:
            self.s[r["i"]] = r["s"]

    def _summed(self, partial, height: int, width: int) -> np.ndarray:
        """The sum over all tasks of a height x width matrix that ``partial`` gives for a block."""
        dims, mean = self.dims, self.s / self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((height, width))
            for b in batches:
                for v in b.column(0):
                    total += partial(np.frombuffer(v.as_buffer(), "<i8").reshape(-1, dims) - mean)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(height, dtype=np.int32)), *map(pa.array, np.ascontiguousarray(total.T))],
                                             names=["i", *(f"c{j}" for j in range(width))])

        names = [f"c{j}" for j in range(width)]
        parts = self.blocks.select("x").mapInArrow(run, "i int, " + ", ".join(f"{c} double" for c in names))
        out = np.zeros((height, width))
        for r in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():      # height rows, model-sized
            out[r["i"]] = [r[c] for c in names]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q."""
        return self._summed(lambda c: c.T @ (c @ q), self.dims, q.shape[1]) / self.n

    def trace(self) -> float:
        return float(self._summed(lambda c: np.array([[np.einsum("ij,ij->", c, c)]]), 1, 1)[0, 0]) / self.n

    def covariance_of(self, w: np.ndarray) -> np.ndarray:
        """The covariance of the vectors projected on the columns of ``w``."""
        def partial(c: np.ndarray) -> np.ndarray:
            z = c @ w
            return z.T @ z
        return self._summed(partial, w.shape[1], w.shape[1]) / self.n


def chebyshev(times, q: np.ndarray, aq: np.ndarray, top: float, cut: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of ``degree`` in V, applied to q (aq = V q): of size at most one on [0, cut], one at
    ``top`` after scaling. Takes degree - 1 passes."""
    half = cut / 2
    sigma = first = half / (half - top)
    y = (aq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / first - sigma)
        q, y = y, (times(y) - half * y) * (2 * nxt / half) - (sigma * nxt) * q
        sigma = nxt
    return y


def leading(times, dims: int, k: int, block: int, degree: int, tol: float, max_rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns): the ``k`` leading pairs of V, certified, by falling eigenvalue."""
    width = min(dims, max(block, k + 1))
    q, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((dims, width)))
    best = None
    for _ in range(max_rounds):
        aq = times(q)
        values, turn = np.linalg.eigh((q.T @ aq + aq.T @ q) / 2)
        order = np.argsort(-values)
        values, turn = values[order], turn[:, order]
        q, aq = q @ turn, aq @ turn
        top = max(values[0], 0.0)
        rounding = 4 * np.finfo(float).eps * np.sqrt(dims) * top
        want = min(k, width)
        residual = np.linalg.norm(aq - q * values, axis=0)[:want]
        gap = np.array([min((abs(values[j] - values[i]) for i in range(width) if i != j), default=top) for j in range(want)])
        if (residual <= np.maximum(tol * gap, rounding)).all() or top == 0:
            return values[:want], q[:, :want]
        if best is not None and residual.max() <= 64 * rounding and residual.max() >= best / 2:
            return values[:want], q[:, :want]                 # no further than the pass's own rounding lets it
        best = min(residual.max(), best or np.inf)
        cut = min(max(values[-1], 1e-3 * top), 0.999 * top)
        q, _ = np.linalg.qr(chebyshev(times, q, aq, top, cut, degree))
    raise RuntimeError(f"eigenvectors not certified in {max_rounds} rounds: residuals {residual}")


def _deviation(x: np.ndarray, n: int, s: np.ndarray) -> tuple[np.ndarray, list]:
    """n x - S as doubles, and the exact sums of its squares (None beyond a long)."""
    most = n * float(np.abs(x).max(initial=0)) + float(np.abs(s).max(initial=0))
    if most * most * x.shape[1] < 2.0 ** 62:
        d = n * x - s
        return d.astype(float), (d * d).sum(axis=1).tolist()
    d = n * x.astype(object) - s.astype(object)
    squares = [sum(int(v) * int(v) for v in row) for row in d]
    return d.astype(float), [v if v < LONG else None for v in squares]


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 4, scale: float = 256.0,
           block: int = 32, degree: int = 8, tol: float = 1e-13, max_rounds: int = 200) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row a vector and component.

    ``block`` is the width of the iterated subspace and ``degree`` that of the filter: they change the number of passes only."""
    ship_package(vectors.sparkSession)
    vec = F.col(f"`{embedding}`")
    small = F.forall(vec, lambda c: F.abs(c.cast("double")) * scale < 2.0 ** 53)
    rows = vectors.where(usable(vec)).select(
        F.col(f"`{vec_id}`").alias("vec_id"),
        F.when(small, quantised(vec, scale)).otherwise(F.raise_error(F.lit("a scaled component is beyond 2 ** 53"))).alias("x"))
    rows = materialize(rows, "whiten-rows")
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    out = T.StructType([rows.schema["vec_id"], *(T.StructField(n, t) for n, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType())))])
    if not dims:
        return vectors.sparkSession.createDataFrame([], out)
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))))
    fit = FitList(rows, dims)
    trace = fit.trace()
    values, axes = leading(fit.times, dims, min(k, dims), block, degree, tol, max_rounds)
    real = values > 16 * np.finfo(float).eps * dims * max(trace, 0.0)
    values, axes = values[real], axes[:, real]
    if not len(values):
        return vectors.sparkSession.createDataFrame([], out)
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])        # one sign, so reruns agree
    w, explained = axes / np.sqrt(values), values / trace
    error = float(np.abs(fit.covariance_of(w) - np.eye(len(values))).max())
    n, s, arrow, c = fit.n, fit.s, to_arrow_schema(out), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, deviation = _deviation(_matrix(b.column(1), dims), n, s)
            m = b.num_rows * c
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), c))).cast(arrow.types[0]),
                pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), b.num_rows)), pa.array(np.full(m, n, np.int64)),
                pa.array([v for v in deviation for _ in range(c)], pa.int64()), pa.array(((d / n) @ w).reshape(-1)),
                pa.array(np.tile(explained, b.num_rows)), pa.array(np.full(m, error))], names=arrow.names)

    return rows.select("vec_id", "x").mapInArrow(run, out)
