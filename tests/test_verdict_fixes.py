"""Counts beyond 2^63, pairwise correlation with NULLs, missing charges and probabilities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnkit.functions.expr import ratio_half_up, risk_tier
from churnkit.operators.evaluate import roc_auc
from churnkit.operators.offers import with_offers
from churnkit.operators.profile import correlation_long


def test_large_ratio_and_small_auc(spark):
    df = spark.createDataFrame([(8_500_000_000_000_000_000, 10**19 // 10)], "a long, b long")
    got = df.select(ratio_half_up(F.col("a").cast("decimal(19,0)") * F.lit(2), F.col("b").cast("decimal(19,0)") * F.lit(20), 4)).first()[0]
    assert got == 0.85
    rows = [(float(p), int(y)) for p, y in zip(np.linspace(0.01, 0.99, 40), [0, 1] * 20)]
    auc = roc_auc(spark.createDataFrame(rows, "p double, Churn int")).first()
    want = np.mean([(a > b) + 0.5 * (a == b) for a, y in rows if y for b, z in rows if not z])
    assert auc["roc_auc"] == pytest.approx(want, abs=1e-4)


def test_correlation_drops_nulls_pairwise(spark):
    import pandas as pd

    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, None, 90.0], "b": [2.0, 4.1, 5.9, 8.0, 50.0, None]})
    df = spark.createDataFrame([(None if pd.isna(x) else float(x), None if pd.isna(y) else float(y)) for x, y in pdf.values], "a double, b double")
    got = {(r.col_a, r.col_b): r.r for r in correlation_long(df).collect()}
    assert got["a", "b"] == pytest.approx(pdf["a"].corr(pdf["b"]), abs=1e-4) and got["a", "a"] == 1.0


def test_missing_probability_and_charge(spark):
    assert spark.range(1).select(risk_tier(F.lit(None).cast("double"))).first()[0] is None
    row = spark.createDataFrame([(0.9, None)], "p double, MonthlyCharges double").withColumn(
        "drivers", F.array(F.struct(F.lit("TotalCharges").alias("feature"))))
    assert with_offers(row).first()["offers"][0]["amount"] == 0
