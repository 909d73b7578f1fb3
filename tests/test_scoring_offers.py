"""Tiers, ranked drivers, offers and the retention message (golden demo message)."""

from pyspark.sql import functions as F

from churnkit.functions.expr import prediction, risk_tier
from churnkit.operators import offers, scoring

DRIVER_T = "array<struct<feature:string,value:double,shap_impact:double,direction:string>>"


def test_tiers_and_prediction(spark):
    df = spark.createDataFrame([(0.8,), (0.6,), (0.4,), (0.5,), (0.81,)], "p double")
    got = [(r[0], r[1]) for r in df.select(risk_tier(F.col("p")), prediction(F.col("p"))).collect()]
    assert got == [("High", 1), ("Moderate", 1), ("Low", 0), ("Moderate", 1), ("Critical", 1)]


def test_ranked_drivers_ties_by_feature_order(spark):
    df = spark.createDataFrame([("c", [1.0, 2.0, 3.0], [0.5, -0.5, 0.7])],
                               "customerID string, attr_values array<double>, attr_impacts array<double>")
    d = df.select(scoring.ranked_drivers(["a", "b", "c"], 3).alias("d")).first()["d"]
    assert [x["feature"] for x in d] == ["c", "a", "b"]
    assert [x["direction"] for x in d] == ["increases", "increases", "decreases"]
    z = spark.createDataFrame([("c", [1.0], [0.0])],
                              "customerID string, attr_values array<double>, attr_impacts array<double>")
    assert z.select(scoring.ranked_drivers(["a"], 1)[0]["direction"]).first()[0] == "decreases"


def _msg_df(spark, drivers, p=0.85, tenure=3, monthly=89.5, cid="7590-VHVEG"):
    return spark.createDataFrame(
        [(cid, tenure, monthly, p, [(f, 0.0, 0.1, "increases") for f in drivers])],
        f"customerID string, tenure int, MonthlyCharges double, p double, drivers {DRIVER_T}")


def test_golden_demo_message(spark):
    df = offers.with_offers(_msg_df(spark, ["Contract_Month-to-month", "tenure", "MonthlyCharges"]))
    r = df.select("driver_classes", "offers",
                  offers.message_text(F.col("customerID"), F.col("tenure"), F.col("MonthlyCharges")).alias("m")).first()
    assert r["driver_classes"] == ["contract_flexibility", "new_customer", "pricing"]
    assert [o["offer"] for o in r["offers"]] == ["annual_plan", "price_lock", "new_customer_bonus"]
    expected = "\n".join([
        "Dear Customer #7590-VHVEG,",
        "",
        "Your first months with us should go well. This letter is about how we can help with that.",
        "",
        "What we can do for you:",
        "",
        "- Yearly contract: change to it and each month costs 20% less, $215 in a year.",
        "- Lower bill: $13 off every month for half a year, and no price rise meanwhile.",
        "- Television and films: one month of both streaming packages at no charge.",
        "",
        "We hold this for you for two days.",
        "",
        "Answer this letter or call the number on your bill, and we arrange the rest.",
        "",
        "If something else troubles you, tell us that too.",
        "",
        "Kind regards",
        "Customer Care",
        "Your telephone company",
    ])
    assert r["m"] == expected
    named = df.select(offers.message_text(F.col("customerID"), F.col("tenure"), F.col("MonthlyCharges"), "555 1", "Ours").alias("m")).first()["m"]
    assert "call 555 1," in named and named.endswith("\nOurs")


def test_empty_drivers_give_loyalty_credit(spark):
    df = offers.with_offers(_msg_df(spark, [], p=0.5, tenure=30, monthly=70.0))
    r = df.select("offers", offers.message_text(F.col("customerID"), F.col("tenure"),
                                                F.col("MonthlyCharges")).alias("m")).first()
    assert [o["offer"] for o in r["offers"]] == ["loyalty_credit"]
    assert offers.OFFER_LOYALTY.replace("{amount}", "7") in r["m"]
    assert "After 30 months you know us well" in r["m"]
    assert offers.URGENCY["moderate"] in r["m"]


def test_half_even_amounts_like_python_format(spark):
    # '{:.0f}' rounds the binary value half to even: 70 * 0.15 = 10.5 -> '10'
    df = spark.createDataFrame([(70.0,), (30.0,), (89.5,)], "m double")
    got = [r[0] for r in df.select(offers.whole_dollars(F.col("m") * 0.15)).collect()]
    assert got == ["{:.0f}".format(70.0 * 0.15), "{:.0f}".format(30.0 * 0.15), "{:.0f}".format(89.5 * 0.15)]


def test_driver_class_precedence(spark):
    feats = ["Contract_One year", "tenure_group_1-2yr", "monthly_charge_per_service", "TechSupport_Yes",
             "InternetService_Fiber optic", "PaymentMethod_Electronic check", "gender_Male",
             "OnlineSecurity_No internet service"]
    df = spark.createDataFrame([(f,) for f in feats], "feature string")
    got = [r[0] for r in df.select(offers.driver_class(F.col("feature"))).collect()]
    assert got == ["contract_flexibility", "new_customer", "pricing", "service_gap", "service_quality",
                   "billing", "general", "service_gap"]


def test_scorecard_additivity(spark, raw, fm):
    s = scoring.scorecard_score(fm.engineer(fm.clean(raw)))
    for r in s.select("p", "attr_impacts").collect():
        z = -1.2 + sum(r["attr_impacts"])
        assert abs(1 / (1 + __import__("math").exp(-z)) - r["p"]) < 1e-12
