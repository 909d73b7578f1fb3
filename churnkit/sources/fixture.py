"""The ``subscriber`` table derived from the driver's TPC-H-style tables.

The reference reads one subscriber CSV that is not shipped; this module derives a table
with the same 21 columns from ``customer``, ``orders`` and ``events`` so every query's
work grows with the given tables. The rules are integer arithmetic, CASE and equi-joins,
so DuckDB reproduces them exactly (see ``plans/oracle.py``).

Plan shape: orders and error events are pre-aggregated per customer (partial
aggregation runs map-side, so a customer holding a third of all orders costs one row
per task after the combine), then both LEFT JOINed on the customer key. The two joins
share the key, so the second reuses the first's partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.schema import RAW_COLUMNS

# Fixed values: (multiplier, threshold) of the add-on service rules.
ADDON_RULES = {
    "OnlineSecurity": (13, 4),
    "OnlineBackup": (17, 5),
    "DeviceProtection": (19, 5),
    "TechSupport": (23, 4),
    "StreamingTV": (29, 5),
    "StreamingMovies": (31, 5),
}
# Payment method by nation key modulo 4.
PAYMENT_BY_NATION_MOD4 = ["Electronic check", "Mailed check", "Bank transfer (automatic)",
                          "Credit card (automatic)"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents_text(x: Column) -> Column:
    """Decimal text of an integer amount in cents, e.g. 123456 -> '1234.56'."""
    whole = ((x - x % 100) / 100).cast("bigint").cast("string")
    return F.concat(whole, F.lit("."), F.lpad((x % 100).cast("string"), 2, "0"))


def subscriber_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw subscriber records (TotalCharges and Churn as strings), one per customer."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n_orders = (read_table(spark, sf_dir, "orders")
                .groupBy(F.col("o_custkey").alias("k_o"))
                .agg(F.count(F.lit(1)).alias("n_orders")))
    n_err = (read_table(spark, sf_dir, "events")
             .where(F.col("event_type") == "error")
             .groupBy(F.col("user_id").alias("k_e"))
             .agg(F.count(F.lit(1)).alias("n_err")))
    base = (cust
            .join(n_orders, F.col("c_custkey") == F.col("k_o"), "left")
            .join(n_err, F.col("c_custkey") == F.col("k_e"), "left")
            .select(F.col("c_custkey").alias("k"), "c_nationkey", "c_mktsegment",
                    F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                    F.coalesce("n_err", F.lit(0)).alias("n_err")))
    k = F.col("k")

    def yes_no(cond: Column) -> Column:
        return F.when(cond, "Yes").otherwise("No")

    tenure = F.when(k % 97 == 0, F.lit(0)).otherwise(
        ((F.col("n_orders") * 5 + k % 31) % 73).cast("int")).cast("int")
    internet = (F.when(F.col("c_mktsegment") == "BUILDING", "No")
                .when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "Fiber optic")
                .otherwise("DSL"))
    phone = F.when(k % 10 == 9, "No").otherwise("Yes")
    df = base.select(
        "*",
        tenure.alias("tenure"),
        internet.alias("InternetService"),
        phone.alias("PhoneService"),
    )
    addons = {
        name: F.when(F.col("InternetService") == "No", "No internet service")
        .when((k * m) % 10 < t, "Yes").otherwise("No")
        for name, (m, t) in ADDON_RULES.items()
    }
    contract = (F.when((F.col("tenure") <= 24) & (k % 5 < 4), "Month-to-month")
                .when(k % 3 == 0, "Two year")
                .when(k % 3 == 1, "One year")
                .otherwise("Month-to-month"))
    nat = F.col("c_nationkey") % 4
    payment = F.when(nat == 0, PAYMENT_BY_NATION_MOD4[0])
    for i, label in enumerate(PAYMENT_BY_NATION_MOD4[1:], start=1):
        payment = payment.when(nat == i, label)
    mcc = (F.lit(1800) + (k * 37) % 2000
           + F.when(F.col("InternetService") == "Fiber optic", 6000)
           .when(F.col("InternetService") == "DSL", 3000).otherwise(0))
    df = df.select(
        "*",
        *[c.alias(n) for n, c in addons.items()],
        contract.alias("Contract"),
        payment.alias("PaymentMethod"),
        mcc.alias("mcc"),
    )
    contract_pts = (F.when(F.col("Contract") == "Month-to-month", 30)
                    .when(F.col("Contract") == "One year", 10).otherwise(3))
    churn_score = (contract_pts
                   + F.when(F.col("tenure") <= 6, 25).otherwise(0)
                   + F.when(F.col("InternetService") == "Fiber optic", 15).otherwise(0)
                   + F.when(F.col("n_err") > 12, 10).otherwise(0))
    total_cents = F.col("mcc") * F.col("tenure")
    out = df.select(
        F.concat(F.lit("C"), F.lpad(k.cast("string"), 7, "0")).alias("customerID"),
        F.when(k % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(k % 6 == 0, 1).otherwise(0).cast("int").alias("SeniorCitizen"),
        yes_no((k * 7) % 10 < 5).alias("Partner"),
        yes_no((k * 11) % 10 < 3).alias("Dependents"),
        "tenure",
        "PhoneService",
        F.when(F.col("PhoneService") == "No", "No phone service")
        .when(k % 5 < 2, "Yes").otherwise("No").alias("MultipleLines"),
        "InternetService",
        *ADDON_RULES.keys(),
        "Contract",
        yes_no((k * 3) % 10 < 6).alias("PaperlessBilling"),
        "PaymentMethod",
        (F.col("mcc").cast("double") / 100).alias("MonthlyCharges"),
        F.when(F.col("tenure") == 0, F.lit(" ")).otherwise(_cents_text(total_cents))
        .alias("TotalCharges"),
        yes_no(churn_score > (k * 53) % 100).alias("Churn"),
    )
    return out.select(*RAW_COLUMNS)


# --- fixed linear scorecard ----------------------------------------------------------
# Scorecard intercept and (weight, centre) per feature, in vector order.
SCORECARD_INTERCEPT = -1.2
SCORECARD = [
    ("tenure", -0.03, 32.0),
    ("MonthlyCharges", 0.02, 65.0),
    ("security_bundle_count", -0.3, 0.0),
    ("is_new_customer", 0.6, 0.0),
    ("contract_risk_score", 0.9, 2.0),
]
