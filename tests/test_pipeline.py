"""End-to-end jobs: stages -> training (saved, reloaded) -> analysis -> revenue JSON."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnkit.sources.models import load_model
from churnkit.operators import attribution as A
from churnkit.operators import train
from churnkit.plans import pipeline
from churnkit.sources import io

SMALL = {"gbt": {"maxIter": 3}, "gbt_weighted": {"maxIter": 3}, "mlp": {"epochs": 3, "hidden": (8,)}}


def test_pipeline_end_to_end(spark, raw, tmp_path):
    out = str(tmp_path)
    feats = pipeline.build_pipeline(raw, f"{out}/stages")
    res = pipeline.run_training(spark, feats.paths["encoded"], feats.model, out, overrides=SMALL)
    comp = io.read_comparison(spark, f"{out}/comparison")
    assert sorted(r["model"] for r in comp.collect()) == ["GradientBoosting", "NeuralNetwork", "WeightedGradientBoosting"]
    meta = io.read_json_report(spark, f"{out}/metadata", io.METADATA_SCHEMA).first()
    assert meta["n_features"] == 45 and meta["n_train"] + meta["n_test"] == raw.count()
    assert meta["best_model"] == train.DISPLAY[res.best]
    # reloaded models score like the fitted ones
    test = io.read_split(spark, f"{out}/split", "test").drop("split", "fold")
    assembled = feats.model.assemble(test)
    for kind, model in res.models.items():
        again = load_model(spark, f"{out}/models/{kind}")
        a = model.transform(assembled).select(vector_to_array("probability")[1]).collect()
        b = again.transform(assembled).select(vector_to_array("probability")[1]).collect()
        assert a == b
    top = pipeline.run_analysis(spark, res.models["gbt"], feats.model, f"{out}/split", out, "gbt")
    assert top.count() <= 20
    long = spark.read.parquet(f"{out}/attributions")
    assert long.select("customerID").distinct().count() == test.count()
    assert long.groupBy("customerID").count().where("count <> 45").count() == 0
    rep = pipeline.run_revenue(feats.model.engineer(feats.model.clean(raw)), out)
    back = spark.read.json(f"{out}/revenue_report").first()
    assert back["scenario"] == "Reduce churn by 5.0%"
    assert len(back["sensitivity_analysis"]) == 7
    assert rep.first()["financial_impact"]["roi_pct"] == back["financial_impact"]["roi_pct"]


def test_tree_shap_direct_path_matches_tables(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    rows = [(f"c{i}", Vectors.dense(rng.normal(size=4).tolist()), float(rng.integers(0, 2))) for i in range(150)]
    df = spark.createDataFrame(rows, ["customerID", "features", "label"])
    m = GBTClassifier(maxIter=3, maxDepth=4, seed=2).fit(df)
    tab = A.tree_shap(m, df).orderBy("customerID").collect()
    monkeypatch.setattr(A, "TABLE_BUDGET", 0)           # every leaf through the direct form
    direct = A.explainer_for(m)
    x = np.array([r["attr_values"] for r in tab])
    phi, margin = direct.explain(x, 4)
    assert np.abs(phi - np.array([r["attr_impacts"] for r in tab])).max() < 1e-12
    assert np.abs(margin - np.array([r["margin"] for r in tab])).max() < 1e-12


def test_align_fills_and_orders(spark, fm):
    df = spark.createDataFrame([("a", 1, 5)], "customerID string, Churn int, tenure int")
    out = fm.align(df)
    assert out.columns == ["customerID", "Churn", *fm.feature_names]
    r = out.first()
    assert r["tenure"] == 5 and r["gender_Male"] == 0
    assert F is not None
