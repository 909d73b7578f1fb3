"""Quantile sketches kept as columns: built a group at a time, stored, and merged over groups and days.

KLL sketches (Karnin, Lang & Liberty, 2016) of Spark's own aggregates. A sketch is a few kilobytes however many values it
has seen, so a day's table is summarised once, and any later question about any union of groups merges the stored sketches
and reads no values again. A quantile's rank is within ``rank_error`` of the asked one; sketches that have seen
at most k values are exact. ``profile.box_stats`` is the exact way where values must be exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_K = 4096


def rank_error(k: int = DEFAULT_K) -> float:
    """Normalised rank error of a merged sketch (99 % of quantiles are closer), by the sketch's published fit."""
    return 2.296 / k ** 0.9021


def sketch_by(df: DataFrame, by: list[str], value: str, k: int = DEFAULT_K) -> DataFrame:
    """(by, n, sketch): one mergeable sketch a group; NULL and NaN take no part. Partial sketches meet after the shuffle."""
    x = F.col(value).cast("double")
    clean = df.where(x.isNotNull() & ~F.isnan(x))
    return clean.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))


def merge_by(sketches: DataFrame, by: list[str], k: int = DEFAULT_K) -> DataFrame:
    """Stored sketches merged to coarser groups; no ``by``: one row for all."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double(F.col("sketch"), F.lit(k)).alias("sketch"))


def quantiles(sketches: DataFrame, keep: list[str], ranks: dict[str, float]) -> DataFrame:
    """(keep, n, a column a rank): the values at the named ranks."""
    q = F.kll_sketch_get_quantile_double("sketch", F.lit(list(ranks.values())))
    return sketches.select(*keep, "n", q.alias("_q")).select(*keep, "n", *[F.col("_q")[i].alias(c) for i, c in enumerate(ranks)])
