"""Revenue impact of churn-reduction scenarios as aggregates over a hash sample.

The saved customers of a scenario are the first ``floor(n_churned * pct / 100)``
churners in md5 order (``sampling.nested_sample``), so scenarios are nested and the
whole sensitivity table is ONE job: rank the churners once (only the hash buckets that
can reach the largest scenario are ranked), tag each ranked churner with every scenario
whose size covers its rank (``explode(filter(scenarios, ...))`` -- a range join against a
7-row literal, no shuffle), then one grouped aggregate by scenario.

Money is summed as integer cents and costs as integer mills (0.30 of a cent amount is
exact there); dollars are rounded half-up to cents only at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions.expr import cents, mills_to_dollars, ratio_half_up, signed_ratio_half_up
from churnkit.operators.sampling import hash_rank, saved_count
from churnkit.schema import KEY, LABEL

# Campaign assumptions.
CAMPAIGN_COST_PER_CUSTOMER = 50      # dollars per saved customer
DISCOUNT_SHARE_MILLS_PER_CENT = 3    # 10 % x 3 months = 0.30 x charge = 3 mills per cent
RETAINED_MONTHS = 12
SENSITIVITY_PCTS = [1, 2, 3, 5, 7, 10, 15]


def _pct_text(pct) -> str:
    return f"{float(pct)}%"


def _base_counts(featured: DataFrame) -> tuple[int, int]:
    r = featured.agg(F.count(F.lit(1)).alias("n"),
                     F.coalesce(F.sum(F.col(LABEL)), F.lit(0)).cast("bigint").alias("c")).first()
    return int(r["n"]), int(r["c"])


def _scenario_sums(featured: DataFrame, takes: dict, seed=42) -> DataFrame:
    """Per scenario: sum of cents and rows over the first ``take`` churners by hash."""
    spark = featured.sparkSession
    limit = max(takes.values()) if takes else 0
    churners = featured.where(F.col(LABEL) == 1).select(KEY, cents("MonthlyCharges").alias("c"))
    scen = F.array(*[F.struct(F.lit(k).alias("sid"), F.lit(int(v)).alias("take"))
                     for k, v in takes.items()])
    if limit <= 0:
        return spark.createDataFrame([(k, 0, 0) for k in takes], "sid string, s_cents bigint, s_rows bigint")
    ranked = hash_rank(churners, KEY, (), seed, out="r", limit=limit)
    tagged = ranked.select("c", F.explode(F.filter(scen, lambda s: F.col("r") <= s["take"])).alias("s"))
    sums = tagged.groupBy(F.col("s.sid").alias("sid")).agg(
        F.sum("c").cast("bigint").alias("s_cents"), F.count(F.lit(1)).alias("s_rows"))
    all_sids = spark.createDataFrame([(k,) for k in takes], "sid string")
    # left join from the few-row scenario list, so scenarios without rows stay (as zeros)
    return (all_sids.join(sums, "sid", "left")
            .select("sid", F.coalesce("s_cents", F.lit(0)).alias("s_cents"),
                    F.coalesce("s_rows", F.lit(0)).alias("s_rows")))


def revenue_sensitivity(featured: DataFrame, pcts=SENSITIVITY_PCTS, seed=42) -> DataFrame:
    """reduction_pct, customers_saved, annual_revenue_recovered, total_cost, net_impact, roi_pct.

    Like the reference, a scenario that saves 0 customers still samples one churner for
    revenue but charges the campaign on the 0 saved."""
    spark = featured.sparkSession
    _, n_churned = _base_counts(featured)
    saved = {str(p): saved_count(n_churned, p) for p in pcts}
    takes = {k: (max(v, 1) if n_churned else 0) for k, v in saved.items()}
    sums = _scenario_sums(featured, takes, seed)
    meta = spark.createDataFrame([(str(p), int(p), saved[str(p)]) for p in pcts],
                                 "sid string, reduction_pct int, customers_saved bigint")
    df = meta.join(sums, "sid")
    recovered = F.col("s_cents") * (RETAINED_MONTHS * 10)
    cost = (F.col("customers_saved") * (CAMPAIGN_COST_PER_CUSTOMER * 1000)
            + F.col("s_cents") * DISCOUNT_SHARE_MILLS_PER_CENT)
    net = recovered - cost
    return df.select(
        "reduction_pct", "customers_saved",
        mills_to_dollars(recovered).alias("annual_revenue_recovered"),
        mills_to_dollars(cost).alias("total_cost"),
        mills_to_dollars(net).alias("net_impact"),
        F.when(cost > 0, signed_ratio_half_up(net * 100, cost, 1)).otherwise(F.lit(0.0)).alias("roi_pct"),
    )


def revenue_report(featured: DataFrame, pct=5.0, seed=42) -> DataFrame:
    """One-row report for one scenario (flat columns; see ``revenue_report_nested``)."""
    base = featured.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum(F.col(LABEL)), F.lit(0)).cast("bigint").alias("churned_customers"),
        F.coalesce(F.sum(cents("MonthlyCharges")), F.lit(0)).alias("_cents"),
        F.coalesce(F.sum(F.when(F.col(LABEL) == 1, cents("MonthlyCharges"))), F.lit(0)).alias("_ch"),
    )
    b = base.first()
    n, n_churned = int(b["total_customers"]), int(b["churned_customers"])
    saved = saved_count(n_churned, pct)
    sums = _scenario_sums(featured, {"s": saved}, seed)
    df = _attach_one_row(base, sums.where(F.col("sid") == "s").drop("sid"))
    saved_c = F.lit(saved).cast("bigint")
    monthly_rec = F.col("s_cents")
    campaign_mills = saved_c * (CAMPAIGN_COST_PER_CUSTOMER * 1000)
    discount_mills = F.col("s_cents") * DISCOUNT_SHARE_MILLS_PER_CENT
    cost = campaign_mills + discount_mills
    annual_mills = monthly_rec * (RETAINED_MONTHS * 10)
    net = annual_mills - cost
    return df.select(
        F.lit(f"Reduce churn by {float(pct)}%").alias("scenario"),
        "total_customers", "churned_customers",
        ratio_half_up(F.col("churned_customers") * 100, F.col("total_customers"), 2).alias("churn_rate"),
        (ratio_half_up(F.col("_cents"), F.col("total_customers"), 0) / 100).alias("avg_monthly_revenue_per_customer"),
        (F.col("_cents") / 100).alias("total_monthly_revenue"),
        (F.col("_ch") * RETAINED_MONTHS / 100).alias("annual_revenue_loss_from_churn"),
        F.lit(_pct_text(pct)).alias("churn_reduction_target"),
        saved_c.alias("customers_saved"),
        ratio_half_up((F.col("churned_customers") - saved_c) * 100, F.col("total_customers"), 2)
        .alias("new_churn_rate"),
        (monthly_rec / 100).alias("monthly_revenue_recovered"),
        mills_to_dollars(annual_mills).alias("annual_revenue_recovered"),
        mills_to_dollars(campaign_mills).alias("retention_campaign_cost"),
        mills_to_dollars(discount_mills).alias("discount_cost"),
        mills_to_dollars(cost).alias("total_retention_cost"),
        mills_to_dollars(net).alias("net_annual_impact"),
        F.when(cost > 0, signed_ratio_half_up(net * 100, cost, 1)).otherwise(F.lit(0.0)).alias("roi_pct"),
    )


def _attach_one_row(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a 1-row table to another 1-row table (no join needed)."""
    row = one_row.first()
    out = left
    for c in one_row.columns:
        out = out.withColumn(c, F.lit(row[c] if row is not None else 0).cast("bigint"))
    return out


def revenue_report_nested(featured: DataFrame, pct=5.0, seed=42,
                          pcts=SENSITIVITY_PCTS) -> DataFrame:
    """The report as one row of nested structs plus the sensitivity list (JSON-ready)."""
    flat = revenue_report(featured, pct, seed)
    sens = sorted(revenue_sensitivity(featured, pcts, seed).collect(), key=lambda r: r["reduction_pct"])
    sens_col = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in r.__fields__]) for r in sens])
    return flat.select(
        "scenario",
        F.struct("total_customers", "churned_customers", "churn_rate",
                 F.col("avg_monthly_revenue_per_customer"), "total_monthly_revenue",
                 "annual_revenue_loss_from_churn").alias("current_metrics"),
        F.struct("churn_reduction_target", "customers_saved", "new_churn_rate").alias("intervention"),
        F.struct("monthly_revenue_recovered", "annual_revenue_recovered", "retention_campaign_cost",
                 "discount_cost", "total_retention_cost", "net_annual_impact",
                 "roi_pct").alias("financial_impact"),
        sens_col.alias("sensitivity_analysis"),
    )


def sample_churners(featured: DataFrame, pct=5.0, seed=42) -> DataFrame:
    """The saved churners of one scenario: customerID, sample_rank, MonthlyCharges."""
    _, n_churned = _base_counts(featured)
    n = saved_count(n_churned, pct)
    churners = featured.where(F.col(LABEL) == 1).select(KEY, "MonthlyCharges")
    if n <= 0:
        return churners.limit(0).withColumn("sample_rank", F.lit(0).cast("bigint"))
    return hash_rank(churners, KEY, (), seed, out="sample_rank", limit=n)
