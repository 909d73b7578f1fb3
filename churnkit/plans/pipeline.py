"""End-to-end jobs: feature pipeline, training run, attribution analysis, revenue report.

Each job is a short driver program over DataFrames; stage outputs go to the caller's
folder (on a cluster: shared storage), which also cuts lineage between stages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from churnkit.operators import attribution, revenue, sampling, scoring, train
from churnkit.operators.features import FeatureModel
from churnkit.schema import KEY, LABEL
from churnkit.session import materialize
from churnkit.sources import io


@dataclass
class FeaturePipelineResult:
    model: FeatureModel
    paths: dict


def build_pipeline(raw: DataFrame, out_dir: str) -> FeaturePipelineResult:
    """G4 + A3: fit, then write cleaned / featured / encoded (each written once; later
    stages read the written parent, so nothing is recomputed)."""
    spark = raw.sparkSession
    fm = FeatureModel.fit(raw)
    fm.save(spark, f"{out_dir}/feature_model")
    paths = io.write_stages({"cleaned": fm.clean(raw)}, out_dir)
    cleaned = io.read_stage(spark, paths["cleaned"])
    paths.update(io.write_stages({"featured": fm.engineer(cleaned)}, out_dir))
    featured = io.read_stage(spark, paths["featured"])
    paths.update(io.write_stages({"encoded": fm.encode(featured)}, out_dir))
    return FeaturePipelineResult(fm, paths)


def run_training(spark: SparkSession, encoded_path: str, feature_model: FeatureModel, out_dir: str,
                 tune: bool = False, budgets: dict | None = None, overrides: dict | None = None,
                 parallelism: int = 2) -> train.TrainResult:
    """Split, fit the three families, compare, save models / comparison / metadata / split."""
    encoded = io.read_stage(spark, encoded_path)
    split = sampling.stratified_split(encoded.select(KEY, LABEL), KEY, LABEL, 20, 42, 3)
    io.write_split(encoded.join(split.select(KEY, "split", "fold"), KEY), f"{out_dir}/split")
    split = spark.read.parquet(f"{out_dir}/split").select(KEY, LABEL, "split", "fold")
    tr, te = train.prepare_training(feature_model.assemble(
        spark.read.parquet(f"{out_dir}/split").drop("split", "fold")), split)
    res = train.train_and_compare(tr, te, tune=tune,
                                  budgets=budgets, overrides=overrides, parallelism=parallelism)
    train.save_models(spark, res, f"{out_dir}/models")
    io.write_comparison(res.comparison.drop("position"), f"{out_dir}/comparison")
    io.write_json_report(train.metadata(res.comparison, res.best, len(feature_model.feature_names), split),
                         f"{out_dir}/metadata")
    return res


def run_analysis(spark: SparkSession, model, feature_model: FeatureModel, split_path: str,
                 out_dir: str, kind: str = "gbt") -> DataFrame:
    """L4: attributions for the test split (TreeSHAP for trees, sampled otherwise),
    saved long (A8), and the top-20 importance table written as JSON."""
    test = io.read_split(spark, split_path, "test").drop("split", "fold")
    assembled = feature_model.assemble(test)
    if kind in ("gbt", "gbt_weighted"):
        expl = attribution.tree_shap(model, assembled)
    else:
        rows = assembled.select(KEY, "features")
        background = materialize(sampling.bounded_sample(rows, KEY, 200), "background")
        expl = attribution.sampled_shapley(model, rows, background, len(feature_model.feature_names))
    expl = materialize(expl, "attributions")
    io.write_attributions(scoring.attributions_long(expl, feature_model.feature_names),
                          f"{out_dir}/attributions")
    top = scoring.global_importance(expl, feature_model.feature_names, 20)
    io.write_json_report(top, f"{out_dir}/importance")
    return top


def run_revenue(featured: DataFrame, out_dir: str, pct=5.0) -> DataFrame:
    """AG18 + AG19 + A6: the nested revenue report written as JSON."""
    rep = revenue.revenue_report_nested(featured, pct)
    io.write_json_report(rep, f"{out_dir}/revenue_report")
    return rep

