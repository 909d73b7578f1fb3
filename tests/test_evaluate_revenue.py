"""Metrics against Spark evaluators; revenue arithmetic and edge cases."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from churnkit.operators import evaluate, revenue, scoring


def test_metrics_equal_spark_evaluators(spark, raw, fm):
    s = scoring.scorecard_score(fm.engineer(fm.clean(raw))).withColumn(
        "prediction", (F.col("p") >= 0.5).cast("int"))
    m = evaluate.class_metrics(s, "Churn", "prediction").first()
    a = evaluate.roc_auc(s, "Churn", "p").first()
    ev = s.select(F.col("Churn").cast("double").alias("label"), F.col("prediction").cast("double"),
                  F.col("p"))
    mc = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricLabel=1.0)
    assert round(mc.setMetricName("precisionByLabel").evaluate(ev), 4) == m["precision"]
    assert round(mc.setMetricName("recallByLabel").evaluate(ev), 4) == m["recall"]
    assert round(mc.setMetricName("fMeasureByLabel").evaluate(ev), 4) == m["f1"]
    assert round(mc.setMetricName("accuracy").evaluate(ev), 4) == m["accuracy"]
    bc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="p", numBins=0)
    assert abs(bc.evaluate(ev) - a["roc_auc"]) < 1e-4


def test_zero_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "Churn int, prediction int")
    m = evaluate.class_metrics(df).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def _featured(spark, n_churn, n_stay, monthly=71.83):
    rows = [(f"C{i:05d}", 1, monthly) for i in range(n_churn)] + \
           [(f"S{i:05d}", 0, 50.0) for i in range(n_stay)]
    return spark.createDataFrame(rows, "customerID string, Churn int, MonthlyCharges double")


def test_revenue_five_percent_arithmetic(spark):
    r = revenue.revenue_report(_featured(spark, 1869, 5174), 5.0).first()
    assert r["customers_saved"] == 93
    assert r["monthly_revenue_recovered"] == round(93 * 71.83, 2)
    assert r["retention_campaign_cost"] == 4650.0
    assert r["discount_cost"] == round(93 * 71.83 * 0.3 + 1e-9, 2)
    assert abs(r["total_retention_cost"] - (4650 + r["discount_cost"])) < 1e-9
    assert abs(r["net_annual_impact"] - (r["annual_revenue_recovered"] - r["total_retention_cost"])) < 0.011
    assert r["roi_pct"] == round(r["net_annual_impact"] / r["total_retention_cost"] * 100, 1)
    assert r["scenario"] == "Reduce churn by 5.0%"


def test_readme_five_percent_row_arithmetic():
    # README: 93 saved, recovered 80,163 / year -> cost 6,654, net 73,509, ROI 1,105 %
    monthly = 80163 / 12
    cost = 93 * 50 + 0.3 * monthly
    assert round(cost) == 6654 and round(80163 - cost) == 73509
    assert round((80163 - cost) / cost * 100) == 1105


def test_no_churners_gives_zeros(spark):
    r = revenue.revenue_report(_featured(spark, 0, 10), 5.0).first()
    assert r["customers_saved"] == 0 and r["net_annual_impact"] == 0.0 and r["roi_pct"] == 0.0
    s = revenue.revenue_sensitivity(_featured(spark, 0, 10)).collect()
    assert len(s) == 7 and all(x["total_cost"] == 0.0 for x in s)


def test_sensitivity_saved_zero_quirk(spark):
    # 50 churners: 1 % saves 0 but still samples one churner for revenue
    s = {x["reduction_pct"]: x for x in revenue.revenue_sensitivity(_featured(spark, 50, 5, 40.0)).collect()}
    assert s[1]["customers_saved"] == 0 and s[1]["annual_revenue_recovered"] == 480.0
    assert s[1]["total_cost"] == 12.0
    assert s[2]["customers_saved"] == 1 and s[2]["total_cost"] == 62.0


def test_correlation_constant_column_is_null(spark):
    from churnkit.operators.profile import correlation_long

    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in correlation_long(df).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] == 1.0 and got[("a", "a")] is None
