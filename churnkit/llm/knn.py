"""Exact top-k inner-product search as a Voronoi join.

Queries and data are grouped by the nearest of a fixed number of pivots. Each data cell is summarised
by its pivot, its radius and its longest vector. For a query q and a cell with pivot p, radius r and
longest norm m no score exceeds ``min(q.p + |q| r, |q| m)``. A query is first solved in its own cell, which gives
a lower bound of its k-th score; then it is replicated only to those cells whose bound reaches it. Cells are
stored in blocks of bounded size, so that a cell with most of the data is many tasks, and queries travel in
blocks too, one copy for each data block: the join has a key a data block. Every block solves its queries locally; of its results a
task passes on k a query, and the k best of those are ranked.

Components beyond a long after scaling, and scores beyond a long, are an error.
Vectors that are null or hold null or non-finite components, and rows without an id, take no part. Rows with the
query's id are its own and no candidates. Shorter vectors count as padded with zeros. Ties go to the smaller id.
Repeated data rows are candidates each; repeated query rows are answered each. Empty table: empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnkit.session import materialize, ship_package


def quantised(vec: Column, scale: float) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vec.isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floats where every sum is below 2 ** 53, in longs below 2 ** 62, else in Python's integers."""
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0)) * q.shape[1]
    if most < 2.0 ** 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 2.0 ** 62:
        return q @ x.T
    return q.astype(object) @ x.astype(object).T


def _longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and len(scores) and not -2 ** 63 <= scores.min() <= scores.max() < 2 ** 63:
        raise OverflowError("a score is beyond a long")
    return scores.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    at = np.arange(len(ids))
    if len(ids) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(ids) - k)[len(ids) - k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _cell_of(pivots: np.ndarray):
    """Adds cell, dist (to its pivot) and norm to (row, id, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (pivots * pivots).sum(axis=1) / 2
        for b in batches:
            x = _matrix(b.column(2), pivots.shape[1]).astype(float)
            cell = (x @ pivots.T - half).argmax(axis=1)
            dist = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            norm = np.sqrt((x * x).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(dist), pa.array(norm)],
                                             names=["row", "id", "v", "cell", "dist", "norm"])
    return run


def _pack(dims: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        v = np.concatenate([_matrix(c, dims) for c in t.column("v").chunks]) if t.num_rows else np.zeros((0, dims), np.int64)
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "salt": pa.array([key[1].as_py()], pa.int64()),
                         "rows": pa.array([t.column("row").to_numpy().tobytes()], pa.binary()),
                         "ids": pa.array([t.column("id").to_numpy().tobytes()], pa.binary()),
                         "v": pa.array([v.astype("<i8").tobytes()], pa.binary())})
    return run


def _blocks(rows: DataFrame, dims: int, per_block: int) -> DataFrame:
    """(cell, salt, rows, ids, v): a cell's vectors in blocks of about ``per_block``, numbered, packed as bytes."""
    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / per_block).alias("blocks"))
    salted = rows.join(sizes, "cell").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("blocks")))
    return salted.select("cell", "salt", "row", "id", "v").groupBy("cell", "salt").applyInArrow(
        _pack(dims), "cell int, salt long, rows binary, ids binary, v binary")


def _solve(dims: int, k: int):
    """k best of every query of a query block within one data block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                q_rows, q_ids, q, ids, x = (b.column(i)[r].as_py() for i in range(5))
                q_rows, q_ids, ids = (np.frombuffer(z, "<i8") for z in (q_rows, q_ids, ids))
                q, x = (np.frombuffer(z, "<i8").reshape(-1, dims) for z in (q, x))
                out = []
                for at in range(0, len(q), 64):                    # bounded score matrices
                    for i, s in enumerate(_scores(q[at:at + 64], x), at):
                        other = np.flatnonzero(ids != q_ids[i])
                        s = _longs(s[other])
                        best = _best(s, ids[other], k)
                        out.append((np.full(len(best), q_rows[i]), np.full(len(best), q_ids[i]), ids[other[best]], s[best]))
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["row", "query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5,
          scale: float = 256.0, pivots: int = 64, per_block: int = 4096, query_block: int = 512) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query row.

    ``is_query`` is a condition over the columns of ``vectors``. ``pivots`` and the block sizes only change
    the speed."""
    ship_package(vectors.sparkSession)
    vec = F.col(f"`{embedding}`")
    small = F.forall(vec, lambda x: F.abs(x.cast("double")) * scale < 2.0 ** 63)
    rows = vectors.where(usable(vec) & F.col(f"`{vec_id}`").isNotNull()).select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.when(small, quantised(vec, scale)).otherwise(
            F.raise_error(F.lit("a scaled component is beyond a long"))).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "knn-vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))))
    spark = vectors.sparkSession
    chosen = rows.select("v").orderBy(F.xxhash64("id"), "id", "row").limit(pivots).collect()      # `pivots` vectors
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centre = np.unique(np.array([r["v"] for r in chosen], float), axis=0)
    celled = materialize(rows.select("row", "id", "v").mapInArrow(
        _cell_of(centre), "row long, id long, v array<long>, cell int, dist double, norm double"), "knn-cells")
    summary = celled.groupBy("cell").agg(F.max("dist").alias("r"), F.max("norm").alias("m")).collect()   # a row a pivot
    cells = np.array([s["cell"] for s in summary])
    radius, longest = np.array([s["r"] for s in summary]), np.array([s["m"] for s in summary])

    blocks = materialize(_blocks(celled.select("row", "id", "v", "cell"), dims, per_block), "knn-blocks").select("cell", "salt", "ids", "v")
    numbers = blocks.groupBy("cell").agg(F.max("salt").alias("last"))          # a cell's block numbers end there
    queries = celled.join(rows.where("is_query").select("row"), "row", "left_semi").select("row", "id", "v", "cell")

    def solved(asked: DataFrame) -> DataFrame:
        packed = _blocks(asked, dims, query_block).select("cell", F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("v").alias("q"))
        sent = packed.join(numbers, "cell").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), "last")))   # a key for each data block
        pairs = sent.join(blocks, ["cell", "salt"]).select("q_rows", "q_ids", "q", "ids", "v")
        return pairs.mapInArrow(_solve(dims, k), "row long, query_id long, vec_id long, score long")

    def best_of(found: DataFrame) -> DataFrame:
        """The k best of each query with their rank; Spark limits each task's rows to k a query before it shuffles them."""
        order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    home = materialize(solved(queries), "knn-home")
    reach = best_of(home).where(F.col("rank") == k).select("row", F.col("score").alias("bound"))
    open_to = queries.join(reach, "row", "left").select("row", "id", "v", "cell", "bound")

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column(2), dims).astype(float)
            size = np.sqrt((q * q).sum(axis=1))[:, None]
            most = np.minimum(q @ centre[cells].T + size * radius, size * longest)
            bound = b.column(4).cast(pa.float64()).to_numpy(zero_copy_only=False)[:, None]
            slack = 1e-9 * (1 + size * (longest + radius))            # rounding of the bound itself
            own = b.column(3).to_numpy()[:, None] == cells
            at, cell = np.nonzero(~own & ~(most + slack < bound))     # no bound yet (NaN): every cell
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(at)) for i in range(3)), pa.array(cells[cell].astype(np.int32))],
                                             names=["row", "id", "v", "cell"])

    away = solved(open_to.mapInArrow(elsewhere, "row long, id long, v array<long>, cell int"))
    return best_of(home.unionByName(away)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
