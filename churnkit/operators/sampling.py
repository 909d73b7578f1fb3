"""Exact, reproducible ranks, stratified splits, folds and nested samples.

Every operator here ranks rows by ``md5('<seed>:<key>')`` inside a stratum. A plain
``row_number() over (partition by label ...)`` would put each label -- a 2-value key, so
one stratum may hold most rows -- into a single task. ``hash_rank`` ranks in two steps:

1. count rows per (stratum, first ``prefix_len`` hex digits of the hash): a table of at
   most strata x 16**prefix_len rows, whose exclusive prefix sums are the offsets;
2. ``row_number`` inside each (stratum, prefix) bucket plus the bucket's offset, joined
   on those columns (broadcast without strata, where 16**prefix_len rows are the bound; otherwise
   Spark picks the join from the sizes it measures).

md5 is uniform, so buckets stay even however skewed the strata are. With ``limit`` the
buckets that start beyond the limit are dropped before the window (top-n by hash).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_PREFIX = 4  # 65,536 buckets per stratum


def hash_key(key: str | Column, seed: int | str = 42) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def hash_rank(df: DataFrame, key: str, strata: list[str] | tuple = (), seed: int | str = 42,
              out: str = "rank", prefix_len: int = DEFAULT_PREFIX,
              limit: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based rank of each row inside its stratum, ordered by md5(seed:key), key."""
    strata = list(strata)
    h = df.withColumn("_h", hash_key(key, seed)).withColumn("_b", F.substring("_h", 1, prefix_len))
    counts = h.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*strata).orderBy("_b") if strata else Window.orderBy("_b")
    offsets = counts.select(*strata, "_b",
                            (F.sum("_n").over(wb) - F.col("_n")).alias("_off"))
    if limit is not None:
        offsets = offsets.where(F.col("_off") < limit)
    # without strata at most 16**prefix_len rows; with strata the join is left to Spark's size rules
    side = offsets if strata else F.broadcast(offsets)
    ranked = h.join(side, [*strata, "_b"], "inner")
    w = Window.partitionBy(*strata, "_b").orderBy("_h", key)
    ranked = ranked.withColumn(out, (F.row_number().over(w) + F.col("_off")).cast("bigint"))
    if limit is not None:
        ranked = ranked.where(F.col(out) <= limit)
    return ranked.drop("_h", "_b", "_off")


def stratum_counts(df: DataFrame, label: str) -> dict:
    """Rows per label (a small table: one row per class)."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def test_quotas(counts: dict, test_pct: int = 20) -> dict:
    """Per-class test counts: total ceil(n*pct/100), split by largest remainder.

    Ties on the remainder go to the smaller label, so the result is deterministic."""
    n = sum(counts.values())
    n_test = -(-n * test_pct // 100)
    base, rema = {}, []
    for lab, c in counts.items():
        q, r = divmod(n_test * c, n) if n else (0, 0)
        base[lab] = q
        rema.append((-r, lab))
    left = n_test - sum(base.values())
    for _, lab in sorted(rema, key=lambda t: (t[0], t[1]))[:left]:
        base[lab] += 1
    return base


def _label_map(mapping: dict, label_col: str, default) -> Column:
    expr = None
    for lab, v in mapping.items():
        cond = F.col(label_col) == F.lit(lab)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def stratified_split(df: DataFrame, key: str, label: str, test_pct: int = 20,
                     seed: int | str = 42, n_folds: int = 3) -> DataFrame:
    """Add ``split`` ('train' / 'test', exact class quotas) and ``fold`` (train rows only).

    Test rows are the first quota rows of each class in hash order; the remaining train
    rows are dealt round-robin into ``n_folds`` folds, so folds are stratified too."""
    quotas = test_quotas(stratum_counts(df, label), test_pct)
    ranked = hash_rank(df, key, [label], seed, out="_r")
    quota = _label_map(quotas, label, 0)
    is_test = F.col("_r") <= quota
    return (ranked
            .withColumn("split", F.when(is_test, "test").otherwise("train"))
            .withColumn("fold", F.when(is_test, F.lit(None).cast("int"))
                        .otherwise(F.pmod(F.col("_r") - quota - 1, F.lit(n_folds)).cast("int")))
            .drop("_r"))


def saved_count(n: int, pct) -> int:
    """floor(n * pct / 100) computed exactly for int or decimal percentages."""
    return int((Decimal(n) * Decimal(str(pct))) // Decimal(100))


def nested_sample(df: DataFrame, key: str, n: int, seed: int | str = 42,
                  out: str = "sample_rank") -> DataFrame:
    """The first n rows by md5(seed:key): samples of one seed are nested (n1 <= n2 => subset)."""
    return hash_rank(df, key, (), seed, out=out, limit=n)


def bounded_sample(df: DataFrame, key: str, cap: int = 200, seed: int | str = 42,
                   out: str = "sample_rank") -> DataFrame:
    """min(cap, N) rows: the nested sample with n = cap (a sampling operator by design)."""
    return nested_sample(df, key, cap, seed, out)
