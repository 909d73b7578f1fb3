"""Profiling: KPIs, churn by segment, histograms, box statistics, correlations.

All of these are single-scan aggregates with map-side partial aggregation; the shuffle
carries one row per (task, group), so a segment holding a third of all customers costs
no more than any other. Outputs are small (bounded by the number of segments / bins /
column pairs).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.functions.expr import cents, ratio_half_up
from churnkit.schema import LABEL
from churnkit.session import ship_package

SEGMENT_DIMENSIONS = ["Contract", "InternetService", "PaymentMethod"]


def _churn_aggs() -> list:
    return [
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col(LABEL)).cast("bigint").alias("churned"),
        F.sum(cents("MonthlyCharges")).alias("_cents"),
    ]


def _rates(df: DataFrame) -> DataFrame:
    return (df.withColumn("churn_rate", ratio_half_up(F.col("churned"), F.col("customers"), 4))
            .withColumn("avg_monthly_charges",
                        ratio_half_up(F.col("_cents"), F.col("customers"), 0) / 100)
            .drop("_cents"))


def kpi_summary(featured: DataFrame) -> DataFrame:
    """Customers, churned, churn rate, revenue and revenue at risk -- one pass."""
    churn = F.col(LABEL) == 1
    agg = featured.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(F.col(LABEL)).cast("bigint").alias("churned_customers"),
        F.sum(cents("MonthlyCharges")).alias("_cents"),
        F.sum(F.when(churn, cents("MonthlyCharges")).otherwise(0)).alias("_churn_cents"),
    )
    return agg.select(
        "total_customers", "churned_customers",
        ratio_half_up(F.col("churned_customers"), F.col("total_customers"), 4).alias("churn_rate"),
        (ratio_half_up(F.col("_cents"), F.col("total_customers"), 0) / 100).alias("avg_monthly_revenue"),
        (F.coalesce(F.col("_cents"), F.lit(0)) / 100).alias("total_monthly_revenue"),
        (F.coalesce(F.col("_churn_cents"), F.lit(0)) / 100).alias("churned_monthly_revenue"),
        (F.coalesce(F.col("_churn_cents"), F.lit(0)) * 12 / 100).alias("annual_revenue_loss"),
    )


def churn_rate_by(featured: DataFrame, dimension: str) -> DataFrame:
    """Churn rate (and customers, churned, mean monthly charge) per value of one column."""
    return _rates(featured.groupBy(F.col(dimension).alias("segment")).agg(*_churn_aggs()))


def churn_segments(featured: DataFrame, dimensions: list[str] = SEGMENT_DIMENSIONS) -> DataFrame:
    """All single-column segment reports in ONE scan (one exploded row a dimension)."""
    exploded = featured.select(
        F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"),
                                     F.col(d).cast("string").alias("segment"))
                            for d in dimensions])).alias("g"),
        LABEL, "MonthlyCharges")
    return _rates(exploded.groupBy("g.dimension", "g.segment").agg(*_churn_aggs()))


def churn_new_vs_rest(featured: DataFrame) -> DataFrame:
    """Churn of new customers (tenure <= 6) against the rest, with the rate ratio.

    The ratio needs the other group's totals: a window over the 2-row aggregate (the
    window input is bounded by the number of groups, not by the data)."""
    per = featured.groupBy("is_new_customer").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(F.col(LABEL)).cast("bigint").alias("churned"))
    whole = Window.partitionBy()
    other_n = F.sum("customers").over(whole) - F.col("customers")
    other_c = F.sum("churned").over(whole) - F.col("churned")
    return per.select(
        "is_new_customer", "customers", "churned",
        ratio_half_up(F.col("churned"), F.col("customers"), 4).alias("churn_rate"),
        ratio_half_up(F.col("churned").cast("decimal(18,0)") * other_n.cast("decimal(18,0)"), F.col("customers").cast("decimal(18,0)") * other_c.cast("decimal(18,0)"), 4)
        .alias("rate_ratio_vs_other"))


def churn_counts(featured: DataFrame) -> DataFrame:
    return featured.groupBy(LABEL).agg(F.count(F.lit(1)).alias("customers"))


def _value_counts(df: DataFrame, column: str, by: str) -> DataFrame:
    """(by, x, c): rows per group and value. Combined map-side, so a group holding most rows costs
    each task its distinct values; every later step of a report reads this one shuffle."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(by), F.col(column).alias("x")).agg(F.count(F.lit(1)).alias("c")))


def histogram(featured: DataFrame, column: str, bins: int = 30, by: str = LABEL) -> DataFrame:
    """Fixed-width histogram split by ``by``; its range is a scalar subquery over the same counts."""
    counts = _value_counts(featured, column, by)
    lo = counts.agg(F.min("x").cast("double")).scalar()
    hi = counts.agg(F.max("x").cast("double")).scalar()
    ranged = counts.select(by, "c", F.col("x").cast("double").alias("x"), lo.alias("lo"), hi.alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / F.lit(float(bins))).otherwise(F.lit(1.0))
    b = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("w")).cast("int"), F.lit(bins - 1))
    return (ranged.withColumn("w", width)
            .groupBy(b.alias("bin"), F.col(by))
            .agg(F.sum("c").alias("n"), F.first("lo").alias("lo"), F.first("w").alias("w"))
            .select("bin", by, "n",
                    F.round(F.col("lo") + F.col("bin") * F.col("w"), 4).alias("bin_lo"),
                    F.round(F.col("lo") + (F.col("bin") + 1) * F.col("w"), 4).alias("bin_hi")))


def box_stats(featured: DataFrame, column: str = "MonthlyCharges", by: str = LABEL,
              exact: bool = True) -> DataFrame:
    """min / quartiles / max, 1.5 IQR whiskers and outlier count per group.

    ``exact`` uses ``percentile`` over the value counts (each group's distinct values); set False for
    ``percentile_approx`` on columns with unbounded distinct values."""
    counts = _value_counts(featured, column, by)
    x = F.col("x")
    at = [0.25, 0.5, 0.75]
    if exact:
        q = counts.groupBy(by).agg(F.sum("c").alias("n"), F.min(x).alias("min"), F.max(x).alias("max"),
                                   F.percentile(x, at, F.col("c")).alias("_q"))
    else:
        q = featured.groupBy(by).agg(
            F.count(column).alias("n"), F.min(column).alias("min"), F.max(column).alias("max"),
            F.percentile_approx(F.col(column), at, 10000).alias("_q")).where("n > 0")
    q = q.select(by, "n", "min", "max", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    fences = q.select(by, (F.col("q1") - spread).alias("_lf"), (F.col("q3") + spread).alias("_uf"))
    inner = (counts.join(fences, by)
             .groupBy(by).agg(
                 F.min(F.when(x >= F.col("_lf"), x)).alias("lower_whisker"),
                 F.max(F.when(x <= F.col("_uf"), x)).alias("upper_whisker"),
                 F.sum(F.when((x < F.col("_lf")) | (x > F.col("_uf")), F.col("c")).otherwise(0))
                 .cast("bigint").alias("n_outliers")))
    return (q.join(inner, by)
            .select(by, "n", *[F.round(c, 4).alias(c) for c in
                               ("min", "q1", "median", "q3", "max", "lower_whisker", "upper_whisker")],
                    "n_outliers"))


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of numeric type, in table order."""
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    """Columns of string type (the categoricals), in table order."""
    from pyspark.sql.types import StringType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def correlation_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson matrix as a long table (col_a, col_b, r), r rounded to 4 places, each pair over the rows that have both.

    One pass of masked matrix products in Arrow batches, whatever is NULL: a task sums, for every pair, the count, both sums and squares and the
    products over the rows where both values are there; Spark adds the tasks' k x k sums up. Values are taken from their column's
    minimum, so a column that is constant over a pair's rows has no spread at all and gives NULL. NaN counts as NULL."""
    cols = columns or numeric_columns(df)
    k = len(cols)
    x = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]
    values = df.select(*x)
    least = values.agg(*[F.min(f"x{i}").alias(f"x{i}") for i in range(k)]).first()
    low = np.array([least[f"x{i}"] or 0.0 for i in range(k)])
    sums = ("n", "sa", "sb", "saa", "sbb", "sab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), k, k))
        for b in batches:
            v = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns]) - low if k else np.zeros((0, 0))
            there = ~np.isnan(v)
            v, m = np.where(there, v, 0.0), there.astype(float)
            total += np.stack([m.T @ m, v.T @ m, m.T @ v, (v * v).T @ m, m.T @ (v * v), v.T @ v])
        at = np.indices((k, k)).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), *(pa.array(t.ravel()) for t in total)], names=["i", "j", *sums])

    ship_package(df.sparkSession)
    pairs = values.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in sums))
    total = pairs.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])            # k * k rows
    n = F.col("n")
    covariance = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), n)

    def squares(total: str, of: str) -> Column:           # about their mean; nothing where only rounding is left
        left = F.col(of) - F.try_divide(F.col(total) * F.col(total), n)
        return F.when(left > 1e-12 * F.col(of), left).otherwise(0.0)

    spread = F.sqrt(squares("sa", "saa") * squares("sb", "sbb"))
    names = F.lit(cols)
    return total.select(names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"),
                        (F.round(F.try_divide(covariance, spread), 4) + 0.0).alias("r"))
