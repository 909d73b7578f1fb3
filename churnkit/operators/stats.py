"""Exact order statistics and running sums over value ranges that the data choose.

A running sum over all values, or ``percentile`` as a global aggregate, ends in ONE task. Here the values are cut into
ranges of about equal numbers of rows: a mergeable quantile sketch (KLL) of the values gives the cut points, so values crowded
into a narrow interval are spread as evenly as any others. The scan has two levels: range totals (one row a range) are
summed up in order and broadcast back, and a window inside each range does the rest. Work per task is bounded by the rows of
one range; results do not depend on where the cuts fall, so the sketch's error costs balance only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_SKETCH = 65535         # the largest accuracy parameter a KLL sketch takes


def range_count(df: DataFrame) -> int:
    """As many ranges as the session's shuffles have tasks, but at least two a core; the cut points are a plan literal."""
    spark = df.sparkSession
    return min(8192, max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def cut_points(df: DataFrame, value: str, ranges: int) -> list[float]:
    """At most ``ranges`` - 1 ascending values that cut the rows into about equal parts: one aggregate, no sort."""
    ranks = [i / ranges for i in range(1, ranges)]
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(min(MAX_SKETCH, max(200, 8 * ranges))))
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    row = clean.agg(F.when(F.count(F.lit(1)) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(ranks))).alias("q")).first()
    return sorted(set(row["q"] or []))


def range_of(value: Column, cuts: list[float]) -> Column:
    """How many cut points are below the value: a binary search in the JVM."""
    if not cuts:
        return F.lit(0)
    bits = len(cuts).bit_length()
    padded = F.lit(cuts + [float("inf")] * (2 ** bits - 1 - len(cuts)))
    steps = F.lit([2 ** b for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.element_at(padded, at + step) < value, at + step).otherwise(at))


def prefix_sum(df: DataFrame, order_col: str, value_col: str, out: str = "prefix", total: str | None = None,
               ranges: int | None = None) -> DataFrame:
    """Adds the sum of ``value_col`` over the rows with a smaller ``order_col`` (distinct, not NULL), and the ``total`` of all.

    ``df`` is read three times: pass a stage table or a cached one."""
    cuts = cut_points(df, order_col, ranges or range_count(df))
    b = df.where(F.col(order_col).isNotNull()).withColumn("_r", range_of(F.col(order_col).cast("double"), cuts))
    totals = b.groupBy("_r").agg(F.sum(value_col).alias("_t"))
    every = [F.sum("_t").over(Window.partitionBy()).alias(total)] if total else []
    offsets = totals.select("_r", (F.sum("_t").over(Window.orderBy("_r")) - F.col("_t")).alias("_o"), *every)
    w = Window.partitionBy("_r").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return (b.join(F.broadcast(offsets), "_r")          # one row a range: at most 8192
            .withColumn(out, F.coalesce(F.sum(value_col).over(w), F.lit(0)) + F.col("_o"))
            .drop("_r", "_o"))


def running_count(counts: DataFrame, value: str = "v", count: str = "c", ranges: int | None = None) -> DataFrame:
    """Adds ``before`` (rows with a smaller value) and ``n_total`` to a (value, count) table."""
    return prefix_sum(counts, value, count, "before", "n_total", ranges)


def exact_median(df: DataFrame, col: str | Column) -> float | None:
    """Median with linear interpolation (same as ``percentile(x, 0.5)``), NULLs ignored."""
    from churnkit.session import materialize

    x = F.col(col) if isinstance(col, str) else col
    counts = (df.select(x.cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
              .groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    return median_from_counts(materialize(counts, "value-counts"))


def median_from_counts(counts: DataFrame) -> float | None:
    """Median of a distribution given as distinct values ``v`` with counts ``c``, a stage or cached table."""
    r = running_count(counts)
    lo_k = F.floor((F.col("n_total") - 1) / 2) + 1        # 1-based ranks of the middle value(s)
    hi_k = F.floor(F.col("n_total") / 2) + 1
    covers = lambda k: (F.col("before") < k) & (F.col("before") + F.col("c") >= k)
    rows = sorted(r.where(covers(lo_k) | covers(hi_k))          # <= 2 rows: sort on the driver
                  .select("v", "before", "c", "n_total", lo_k.alias("lo_k"), hi_k.alias("hi_k"))
                  .collect(), key=lambda x: x["v"])
    if not rows:
        return None
    n = rows[0]["n_total"]
    lo = [x["v"] for x in rows if x["before"] < x["lo_k"] <= x["before"] + x["c"]][0]
    hi = [x["v"] for x in rows if x["before"] < x["hi_k"] <= x["before"] + x["c"]][0]
    if n % 2 == 1:
        return lo
    return 0.5 * lo + 0.5 * hi          # the same interpolation as Spark's percentile
