"""The model store, scoring with its models in streams, and the queries that share them."""

import json
import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnkit.operators import train
from churnkit.operators.features import FeatureModel
from churnkit.plans import jobs
from churnkit.sources.models import ModelStore, load_model
from churnkit.sources.requests import requests_from_subscribers
from churnkit.streaming.scoring import score_stream, score_stream_with_quarantine, stored_scorer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small_models():
    """Fits of a few seconds in place of the untuned configurations; a store of their own follows from the parameters."""
    kept = dict(train.GBT_DEFAULT), dict(train.GBT_WEIGHTED_DEFAULT), dict(train.MLP_DEFAULT)
    train.GBT_DEFAULT.update(maxIter=6, maxDepth=3)
    train.GBT_WEIGHTED_DEFAULT.update(maxIter=4, maxDepth=3)
    train.MLP_DEFAULT.update(hidden=(8,), epochs=6)
    yield
    for d, k in zip((train.GBT_DEFAULT, train.GBT_WEIGHTED_DEFAULT, train.MLP_DEFAULT), kept):
        d.update(k)


@pytest.fixture(scope="module")
def toy(spark):
    rows = spark.range(200).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), ((F.col("id") % 7) > 3).cast("double").alias("label"))
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


def fit(toy, n):
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(maxIter=n, maxDepth=2, seed=1).fit(toy)


def test_a_version_is_fitted_once(spark, toy, tmp_path):
    store, fits = ModelStore(spark, str(tmp_path)), []

    def once():
        fits.append(1)
        return fit(toy, 2)

    a = store.get("m", "rows-1", {"n": 2}, once)
    b = ModelStore(spark, str(tmp_path)).get("m", "rows-1", {"n": 2}, once)
    assert a.version == b.version and a.path == b.path and len(fits) == 1
    store.get("m", "rows-2", {"n": 2}, once)
    store.get("m", "rows-1", {"n": 3}, once)
    assert len(fits) == 3 and len(store.versions("m")) == 3 and store.latest("m") == store.version("rows-1", {"n": 3})
    assert store.find("m", "unknown") is None and store.versions("none") == [] and store.latest("none") is None
    score = lambda m: [r[0] for r in m.transform(toy).select(vector_to_array("probability")[1]).collect()]
    assert score(a.model) == score(b.model)


def test_an_unpublished_model_does_not_count(spark, toy, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    version = store.version("rows", {})
    store._rename, rename = lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")), store._rename
    with pytest.raises(RuntimeError):
        store.publish("m", version, fit(toy, 1))
    store._rename = rename
    assert store.find("m", version) is None and store.versions("m") == []
    assert store.publish("m", version, fit(toy, 1)).version == version


def test_the_first_of_two_writers_wins(spark, toy, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    version = store.version("rows", {})
    first = store.publish("m", version, fit(toy, 1), by="first")
    second = store.publish("m", version, fit(toy, 2), by="second")
    assert second.path == first.path and second.meta["by"] == "first"
    assert sorted(os.listdir(tmp_path / "m" / version)) == sorted([os.path.basename(first.path), ".published.json.crc", "published.json"]) or \
        sorted(os.listdir(tmp_path / "m" / version)) == sorted([os.path.basename(first.path), "published.json"])


def test_other_objects_and_damaged_models(spark, fm, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    kept = store.publish("features", "v", fm)
    assert isinstance(kept.model, FeatureModel) and kept.model.to_json() == fm.to_json()
    path = str(tmp_path / "other")
    spark.createDataFrame([(json.dumps({"class": "os.path", "model": "{}"}),)], "value string").coalesce(1).write.text(path)
    with pytest.raises(ValueError):
        load_model(spark, path)


def test_queries_share_the_stored_models(spark, small_models, monkeypatch):
    fits = []
    fit_model = train.fit_model
    monkeypatch.setattr(train, "fit_model", lambda kind, *a, **k: fits.append(kind) or fit_model(kind, *a, **k))
    spark.conf.set("churnkit.model.store", jobs.stage_path(spark, "store-of-a-test"))
    try:
        comparison = jobs.q_train_compare(spark, SF).collect()
        assert sorted(fits) == sorted(jobs.KINDS) and [r["model"] for r in comparison] == [train.DISPLAY[k] for k in jobs.KINDS]
        best = {r["metric"]: r["value"] for r in jobs.q_best_per_metric(spark, SF).collect()}
        assert best == {m: max(r[m] for r in comparison) for m in train.METRICS}
        meta = jobs.q_model_metadata(spark, SF).first()
        assert meta["best_roc_auc"] == best["roc_auc"] and meta["n_train"] + meta["n_test"] == 150
        assert jobs.q_tree_importance(spark, SF).count() <= 20 and jobs.q_kernel_attribution(spark, SF).count() == 150
        assert sorted(fits) == sorted(jobs.KINDS)
    finally:
        spark.conf.unset("churnkit.model.store")


def test_stream_with_the_model_equals_the_batch_queries(spark, small_models):
    streamed = {r["customerID"]: r for r in jobs.q_stream_model_scoring(spark, SF).collect()}
    batch = {r["customerID"]: r for r in jobs.q_model_score_batch(spark, SF).collect()}
    messages = {r["customer_id"]: r for r in jobs.q_model_retention_messages(spark, SF).collect()}
    broken = {r["customerID"] for r in jobs.q_stream_quarantine(spark, SF).collect()}
    assert 0 < len(streamed) < len(batch) and len(streamed) + jobs.q_stream_quarantine(spark, SF).count() == len(batch)
    assert not broken & set(streamed)
    for key, r in streamed.items():
        if r["profile"]["tenure"] == 0:                # no total yet: a request takes a month's charge, the table the median
            continue
        same = batch[key].asDict(recursive=True)
        assert {c: r.asDict(recursive=True)[c] for c in same} == same
        assert r["message"] == (messages[key]["message"] if key in messages else None)
        assert (r["offers"] is None) == (key not in messages) and r["profile"]["customer_id"] == key


def test_restart_goes_on_with_the_named_version(spark, small_models, raw, tmp_path):
    inputs = jobs.training_inputs(spark, SF)
    store = ModelStore(spark, str(tmp_path / "store"))
    rows, _ = inputs.training()
    for n in (2, 3):
        model = train.fit_model("gbt", rows, overrides={"maxIter": n})
        store.publish("gbt", f"v{n}", model, features=inputs.features.to_json())
    requests = requests_from_subscribers(raw)
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def run(where, version=None):
        requests.where(where).write.mode("append").json(src)
        scorer = stored_scorer(store, "gbt", version)
        score_stream(spark, src, out, ck, scorer.features, scorer).awaitTermination()
        return {r["model_version"]: r["n"] for r in spark.read.parquet(out).groupBy("model_version").agg(F.count("*").alias("n")).collect()}

    assert run("customerID < 'C0000050'", "v2") == {"v2": 50}
    assert run("customerID >= 'C0000050' AND customerID < 'C0000100'", "v2") == {"v2": 100}
    assert run("customerID >= 'C0000100'") == {"v2": 100, "v3": raw.count() - 100}
    scorer = stored_scorer(store, "gbt")
    score_stream_with_quarantine(spark, src, str(tmp_path / "k2"), str(tmp_path / "k2ck"), scorer.features, scorer).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "k2/valid")).count() == raw.count()
    with pytest.raises(LookupError):
        stored_scorer(store, "nothing")
