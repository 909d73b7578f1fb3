"""Registered queries that run Spark ML fits or a stream: model training, attribution and stream scoring.

DuckDB replays the streams' results; it cannot replay the fits, so pytest checks their
properties instead (additivity against brute force, stream = batch, metrics = evaluators).

Every query reads the given tables. Models come from the model store under the fingerprint of the subscriber table
just read: the first query over a table's rows fits and publishes a model, later ones, also in other processes, load it, and a changed
row leads to a new fit. Nothing is kept in the process.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators import attribution, offers, sampling, scoring, train
from churnkit.operators.features import FeatureModel
from churnkit.plans.catalog import request_lines
from churnkit.schema import KEY, LABEL, PROFILE_TEXTS
from churnkit.session import materialize, stage_path
from churnkit.sources.fixture import subscriber_raw
from churnkit.sources.models import Artifact, ModelStore, table_fingerprint
from churnkit.streaming.scoring import carry_profile, score_stream, score_stream_with_quarantine, stored_scorer

KINDS = ("gbt", "gbt_weighted", "mlp")
MODEL_NAME = {k: f"churn-{k}" for k in (*KINDS, "leafwise")}


@dataclass
class Inputs:
    """The subscriber table, its split and what is learned from it. The encoded rows carry the profile texts
    that encoding would drop, so that scored rows need no join back to their profile."""

    raw: DataFrame
    features: FeatureModel
    rows: DataFrame             # encoded, with split and fold
    fingerprint: str

    @property
    def split(self) -> DataFrame:
        return self.rows.select(KEY, LABEL, "split", "fold")

    @property
    def test(self) -> DataFrame:
        return self.training(False)[1]

    def training(self, checkpointed: bool = True) -> tuple[DataFrame | None, DataFrame]:
        rows = self.features.assemble(self.rows)
        return train.prepare_training(rows) if checkpointed else (None, train.test_rows(rows))


def training_inputs(spark: SparkSession, sf: str) -> Inputs:
    raw = materialize(subscriber_raw(spark, sf))
    fm = FeatureModel.fit(raw)
    encoded = fm.transform(carry_profile(raw))
    rows = materialize(sampling.stratified_split(encoded, KEY, LABEL, 20, 42, 3), "split-rows")
    return Inputs(raw, fm, rows, table_fingerprint(raw))


def fitted(inputs: Inputs, kinds=KINDS, overrides: dict | None = None) -> dict[str, Artifact]:
    """The stored models of these inputs; those not stored yet are fitted concurrently and published, with the
    feature model that their vectors come from. ``overrides``: parameters a kind that differ from the untuned ones."""
    store, changed = ModelStore(inputs.raw.sparkSession), overrides or {}
    params = {k: {"kind": k, "params": {**train.default_params(k), **changed.get(k, {})}, "features": inputs.features.to_json(), "split": [20, 42, 3]} for k in kinds}
    versions = {k: store.version(inputs.fingerprint, params[k]) for k in kinds}
    found = {k: a for k in kinds if (a := store.find(MODEL_NAME[k], versions[k])) is not None}
    missing = [k for k in kinds if k not in found]
    if missing:
        rows, _ = inputs.training()
        models = train.fit_concurrently({k: (lambda k=k: train.fit_model(k, rows, overrides=changed.get(k))) for k in missing})
        for k in missing:
            found[k] = store.publish(MODEL_NAME[k], versions[k], models[k], inputs=inputs.fingerprint, kind=k,
                                     features=inputs.features.to_json())
    return found


def q_train_compare(spark, sf) -> DataFrame:
    """Model comparison on the held-out split (untuned configurations)."""
    return _comparison(training_inputs(spark, sf)).drop("position")


def _comparison(inputs: Inputs) -> DataFrame:
    models = fitted(inputs)
    test = materialize(inputs.test, "test")
    rows = [train.evaluate_model(train.DISPLAY[k], models[k].model, test).withColumn("position", F.lit(i)) for i, k in enumerate(KINDS)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _test_attributions(inputs: Inputs) -> DataFrame:
    return attribution.tree_shap(fitted(inputs, ("gbt",))["gbt"].model, inputs.test, n_features=len(inputs.features.feature_names))


def q_leafwise_compare(spark, sf) -> DataFrame:
    """Trees grown leaf by leaf, a few of them, on the held-out split, and how well their attributions add up."""
    inputs = training_inputs(spark, sf)
    model = fitted(inputs, ("leafwise",), {"leafwise": {"trees": 12, "max_depth": -1}})["leafwise"].model
    test = materialize(inputs.test, "test")
    expl = attribution.tree_shap(model, test, n_features=len(inputs.features.feature_names))
    off = F.abs(F.aggregate("attr_impacts", F.lit(0.0), lambda a, b: a + b) + F.col("base_value") - F.col("margin"))
    exact = expl.agg((F.max(off) < 1e-9).alias("attributions_add_up"))
    return train.evaluate_model(train.DISPLAY["leafwise"], model, test).join(exact)          # one row each


def q_tree_attribution(spark, sf) -> DataFrame:
    """TreeSHAP of the boosted model for every test customer: top-5 drivers (long)."""
    inputs = training_inputs(spark, sf)
    return scoring.drivers_long(_test_attributions(inputs), inputs.features.feature_names, 5)


def q_tree_importance(spark, sf) -> DataFrame:
    """Global importance (mean |TreeSHAP|) over the test split, top 20."""
    inputs = training_inputs(spark, sf)
    return scoring.global_importance(_test_attributions(inputs), inputs.features.feature_names, 20)


def q_tree_importance_spread(spark, sf) -> DataFrame:
    """L6 on the boosted model: TreeSHAP quartiles of the top 20 features, split by high / low value."""
    inputs = training_inputs(spark, sf)
    expl = materialize(_test_attributions(inputs), "attributions")   # read thrice
    return scoring.importance_spread(expl, inputs.features.feature_names, exact=False, top=20)


def _network_rows(spark, sf) -> tuple[Inputs, DataFrame, DataFrame]:
    """(inputs, test rows, background of at most 200 of them)."""
    inputs = training_inputs(spark, sf)
    rows = materialize(inputs.test.select(KEY, "features"), "test")
    return inputs, rows, materialize(sampling.bounded_sample(rows, KEY, 200), "background")


def q_sampled_attribution(spark, sf) -> DataFrame:
    """Monte-Carlo Shapley of the network for every test row, against a background of <= 200 of them."""
    inputs, rows, background = _network_rows(spark, sf)
    names = inputs.features.feature_names
    expl = attribution.sampled_shapley(fitted(inputs, ("mlp",))["mlp"].model, rows, background, len(names), permutations=8)
    return scoring.drivers_long(expl, names, 5)


def q_kernel_attribution(spark, sf) -> DataFrame:
    """Kernel SHAP of the network for every test row, against one weighted centre of the background."""
    inputs, rows, background = _network_rows(spark, sf)
    names = inputs.features.feature_names
    expl = attribution.kernel_shap(fitted(inputs, ("mlp",))["mlp"].model, rows, attribution.background_centres(background, 1), len(names))
    return scoring.drivers_long(expl, names, 5)


def _request_files(spark, sf) -> tuple[str, DataFrame]:
    """A folder with JSON requests in ``in``, some of them broken (``request_lines``), and the subscriber table they come from."""
    raw = materialize(subscriber_raw(spark, sf))
    base = stage_path(spark, f"stream-{uuid.uuid4().hex}")
    request_lines(raw).write.mode("overwrite").text(f"{base}/in")
    return base, raw


def q_stream_scoring(spark, sf) -> DataFrame:
    """K1: JSON request files, broken ones among them, scored by a file stream (availableNow), read back."""
    base, raw = _request_files(spark, sf)
    score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", FeatureModel.fit(raw), fmt="json").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def q_stream_quarantine(spark, sf) -> DataFrame:
    """K2: the requests the stream puts aside, with their errors."""
    base, raw = _request_files(spark, sf)
    score_stream_with_quarantine(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", FeatureModel.fit(raw)).awaitTermination()
    return spark.read.parquet(f"{base}/out/quarantine").select(KEY, "error")


def q_stream_model_scoring(spark, sf) -> DataFrame:
    """K1 with the trained model: the requests scored in the stream by the stored version, with factor records,
    offers and the message, read back from the sink."""
    base, _ = _request_files(spark, sf)
    artifact = fitted(training_inputs(spark, sf), ("gbt",))["gbt"]
    scorer = stored_scorer(ModelStore(spark), artifact.name, artifact.version)
    score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", scorer.features, scorer).awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("model_version")


def _model_explained(inputs: Inputs, keep=()) -> DataFrame:
    """All customers with their TreeSHAP drivers (wide, per row)."""
    return attribution.explained(fitted(inputs, ("gbt",))["gbt"].model, inputs.features, inputs.rows, list(keep))


def q_model_score_batch(spark, sf) -> DataFrame:
    """Batch scoring with the trained model: p, prediction, tier, up to 5 factor records."""
    inputs = training_inputs(spark, sf)
    return scoring.score_batch(_model_explained(inputs), inputs.features.feature_names, records=True)


def q_model_retention_messages(spark, sf) -> DataFrame:
    """Messages for p > 0.4 with the model's own drivers and the profile carried along."""
    inputs = training_inputs(spark, sf)
    carried = [f"_{c}" for c in PROFILE_TEXTS]
    scored = (_model_explained(inputs, ["tenure", "MonthlyCharges", *carried])
              .withColumn("drivers", scoring.ranked_drivers(inputs.features.feature_names, 5))
              .withColumnsRenamed({f"_{c}": c for c in PROFILE_TEXTS}))
    return offers.retention_messages(scored)


def q_model_metadata(spark, sf) -> DataFrame:
    """AG17: best model by AUC (ties by position) with dataset counts."""
    inputs = training_inputs(spark, sf)
    comp = _comparison(inputs)
    best = comp.orderBy(F.desc("roc_auc"), "position").first()["position"]
    return train.metadata(comp, KINDS[best], len(inputs.features.feature_names), inputs.split)


def q_search_compare(spark, sf) -> DataFrame:
    """The random search of the compared families, each over its budget's draws of its full grid, all of them judged on all three
    folds, its results table in the store's folder under the inputs' fingerprint (so it resumes), the winner of each with its mean AUC."""
    inputs = training_inputs(spark, sf)
    rows, _ = inputs.training()
    n, cores, found = rows.count(), spark.sparkContext.defaultParallelism, []
    for kind in KINDS:
        points = train.draw_grid(train.SEARCH_GRID[kind], train.SEARCH_BUDGET[kind])
        version = ModelStore(spark).version(inputs.fingerprint, {"search": kind, "points": points})
        best = train.search(kind, rows, points, f"{ModelStore(spark).root}/search-{kind}/{version}", keep=1.0,
                            parallelism=train.fits_at_once(n, train.TASK_ROWS[kind], cores))
        found.append((train.DISPLAY[kind], best["candidate"], json.dumps(best["params"], sort_keys=True), round(best["roc_auc"], 4)))
    return spark.createDataFrame(found, "model string, candidate int, params string, mean_roc_auc double")


def q_best_per_metric(spark, sf) -> DataFrame:
    """AG20 / E4: unpivot the comparison and take the best model per metric."""
    return train.best_per_metric(_comparison(training_inputs(spark, sf)))


JOB_QUERIES = {
    "train_compare": q_train_compare,
    "leafwise_compare": q_leafwise_compare,
    "tree_attribution": q_tree_attribution,
    "tree_importance": q_tree_importance,
    "tree_importance_spread": q_tree_importance_spread,
    "sampled_attribution": q_sampled_attribution,
    "kernel_attribution": q_kernel_attribution,
    "stream_scoring": q_stream_scoring,
    "stream_quarantine": q_stream_quarantine,
    "stream_model_scoring": q_stream_model_scoring,
    "model_score_batch": q_model_score_batch,
    "model_retention_messages": q_model_retention_messages,
    "model_metadata": q_model_metadata,
    "best_per_metric": q_best_per_metric,
    "search_compare": q_search_compare,
}
