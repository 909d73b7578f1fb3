"""Registered queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query starts from the driver tables through ``sources.fixture.subscriber_raw``, so
its work grows with them. Learned statistics (median, contract means, category levels)
come from ``FeatureModel.fit`` over the same whole table, like the reference pipeline.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators import evaluate, offers, profile, revenue, sampling, scoring, sketches, sparse, train
from churnkit.operators.features import FeatureModel, category_levels, churn_flag
from churnkit.operators.validation import validate_records
from churnkit.schema import DOMAINS, KEY, LABEL, NUMERIC_FEATURES, RANGES
from churnkit.session import materialize, stage_path
from churnkit.sources import io
from churnkit.sources.fixture import read_table, subscriber_raw
from churnkit.sources.requests import read_request_bodies, read_requests, request_elements, requests_from_subscribers, with_request_defaults

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------------- shared inputs
def _raw(spark, sf):
    """The derived subscriber stage table, materialised once per query: the fit and every
    branch of the plan (ranks, splits, prefix sums) then read it instead of re-aggregating
    orders and events."""
    return materialize(subscriber_raw(spark, sf))


def _fit(spark, sf):
    raw = _raw(spark, sf)
    return raw, FeatureModel.fit(raw)


def _featured(spark, sf):
    raw, fm = _fit(spark, sf)
    return fm.engineer(fm.clean(raw))


def _labelled(spark, sf):
    """What the reports read: the raw columns with the binary label and the new-customer flag. No learned
    statistic, no stage: each report prunes it to its own columns."""
    raw = subscriber_raw(spark, sf)
    return (raw.withColumn(LABEL, churn_flag(raw))
            .withColumn("is_new_customer", (F.col("tenure") <= 6).cast("int")))


def _unfitted(spark, sf, *columns: str):
    """Engineered rows without the columns that need a learned statistic: no fit, no stage. Given ``columns``, those only, as a
    stage that several branches of a plan may read."""
    fm = FeatureModel(0.0, {}, 0.0)
    rows = fm.engineer(fm.clean(subscriber_raw(spark, sf))).drop("TotalCharges", "avg_monthly_spend", "overpay_ratio")
    return materialize(rows.select(*columns)) if columns else rows


def _scored(spark, sf):
    """Rows scored by the fixed scorecard, whose features are no learned ones, with all drivers ranked."""
    scored = scoring.scorecard_score(_unfitted(spark, sf))
    return scored.withColumn("drivers", scoring.ranked_drivers(scoring.SCORECARD_FEATURES, None))


def _split(spark, sf):
    return sampling.stratified_split(_unfitted(spark, sf, KEY, LABEL), KEY, LABEL, test_pct=20, seed=42, n_folds=3)


def _scored_test(spark, sf):
    """The test rows with their score: split and score are columns of one table, so nothing is joined."""
    rows = _unfitted(spark, sf, KEY, LABEL, *scoring.SCORECARD_FEATURES)
    test = sampling.stratified_split(rows, KEY, LABEL, 20, 42, 3).where(F.col("split") == "test")
    return scoring.scorecard_score(test).withColumn("prediction", (F.col("p") >= 0.5).cast("int"))


# ----------------------------------------------------------------------- the queries
def q_clean_subscribers(spark, sf):
    raw, fm = _fit(spark, sf)
    return fm.clean(raw)


def q_features_engineered(spark, sf):
    return _featured(spark, sf)


def q_features_encoded(spark, sf):
    raw, fm = _fit(spark, sf)
    return fm.transform(raw)


def q_encoder_categories(spark, sf):
    return category_levels(subscriber_raw(spark, sf))


def q_features_for_requests(spark, sf):
    raw, fm = _fit(spark, sf)
    req = with_request_defaults(requests_from_subscribers(raw))
    return fm.align(fm.transform(req))


def q_request_validation(spark, sf):
    return validate_records(subscriber_raw(spark, sf))


def q_kpi_summary(spark, sf):
    return profile.kpi_summary(_labelled(spark, sf))


def q_churn_by_contract(spark, sf):
    return profile.churn_rate_by(_labelled(spark, sf), "Contract")


def q_churn_by_internet(spark, sf):
    return profile.churn_rate_by(_labelled(spark, sf), "InternetService")


def q_churn_by_payment(spark, sf):
    return profile.churn_rate_by(_labelled(spark, sf), "PaymentMethod")


def q_churn_segments_grouping_sets(spark, sf):
    return profile.churn_segments(_labelled(spark, sf))


def q_churn_new_vs_rest(spark, sf):
    return profile.churn_new_vs_rest(_labelled(spark, sf))


def q_churn_counts(spark, sf):
    return profile.churn_counts(_labelled(spark, sf))


def q_hist_tenure(spark, sf):
    return profile.histogram(_labelled(spark, sf), "tenure", 30)


def q_hist_monthly(spark, sf):
    return profile.histogram(_labelled(spark, sf), "MonthlyCharges", 30)


def q_box_monthly(spark, sf):
    return profile.box_stats(_labelled(spark, sf), "MonthlyCharges")


def q_correlation_matrix(spark, sf):
    return profile.correlation_long(_featured(spark, sf))


def q_stratified_split(spark, sf):
    return _split(spark, sf).select(KEY, LABEL, "split")


def q_stratified_folds(spark, sf):
    return _split(spark, sf).where(F.col("split") == "train").select(KEY, LABEL, "fold")


def q_sample_churners(spark, sf):
    return revenue.sample_churners(_unfitted(spark, sf, KEY, LABEL, "MonthlyCharges"), 5.0)


def q_background_sample(spark, sf):
    test = _split(spark, sf).where(F.col("split") == "test").select(KEY)
    return sampling.bounded_sample(test, KEY, 200)


def q_revenue_report(spark, sf):
    return revenue.revenue_report(_unfitted(spark, sf, KEY, LABEL, "MonthlyCharges"), 5.0)


def q_revenue_sensitivity(spark, sf):
    return revenue.revenue_sensitivity(_unfitted(spark, sf, KEY, LABEL, "MonthlyCharges"))


def q_score_batch(spark, sf):
    return scoring.score_batch(scoring.scorecard_score(_unfitted(spark, sf)), scoring.SCORECARD_FEATURES)


def q_score_bands(spark, sf):
    return scoring.score_bands(scoring.scorecard_score(_unfitted(spark, sf)))


def q_top_drivers(spark, sf):
    return scoring.drivers_long(scoring.scorecard_score(_unfitted(spark, sf)), scoring.SCORECARD_FEATURES, 5)


def q_driver_classes(spark, sf):
    top3 = scoring.drivers_long(scoring.scorecard_score(_unfitted(spark, sf)), scoring.SCORECARD_FEATURES, 3)
    return top3.select(KEY, "driver_rank", "feature", offers.driver_class(F.col("feature")).alias("driver_class"))


def q_global_importance(spark, sf):
    return scoring.global_importance(scoring.scorecard_score(_unfitted(spark, sf)), scoring.SCORECARD_FEATURES)


def q_importance_spread(spark, sf):
    return scoring.importance_spread(scoring.scorecard_score(_unfitted(spark, sf, *scoring.SCORECARD_FEATURES)), scoring.SCORECARD_FEATURES)


def q_retention_messages(spark, sf):
    return offers.retention_messages(_scored(spark, sf))


def q_retention_response(spark, sf):
    return offers.retention_response(_scored(spark, sf))


def q_offer_mix(spark, sf):
    return offers.offer_mix(_scored(spark, sf))


def q_class_metrics(spark, sf):
    return evaluate.class_metrics(_scored_test(spark, sf), LABEL, "prediction")


def q_roc_auc(spark, sf):
    return evaluate.roc_auc(_scored_test(spark, sf), LABEL, "p")


def q_dataset_metadata(spark, sf):
    raw, fm = _fit(spark, sf)
    split = sampling.stratified_split(fm.clean(raw).select(KEY, LABEL), KEY, LABEL, 20, 42, 3)
    return evaluate.dataset_metadata(split, len(fm.feature_names))


def q_standardize(spark, sf):
    raw, fm = _fit(spark, sf)
    encoded = fm.transform(raw)
    split = sampling.stratified_split(encoded.select(KEY, LABEL), KEY, LABEL, 20, 42, 3)
    return evaluate.standardize_fit_apply(
        encoded, split.where(F.col("split") == "train").select(KEY), NUMERIC_FEATURES)


def q_prompt_table(spark, sf):
    return offers.prompt_table(_scored(spark, sf))


def q_features_sparse(spark, sf):
    """F9 / AG13 by lookup: the entries of the sparse feature vectors that are not zero."""
    raw, fm = _fit(spark, sf)
    return sparse.nonzero_entries(sparse.vectorize(fm, fm.engineer(fm.clean(raw))), [KEY])


def request_lines(raw, *keep: str):
    """(keep, value): the table's records as JSON requests, some broken by the first hex digit of md5(customerID): 0 cut off,
    1 tenure is text, 2 unknown contract, 3 charge out of range, 4 no customerID."""
    requests = requests_from_subscribers(raw)
    kind = F.substring(F.md5(F.col(KEY)), 1, 1)
    changed = {"Contract": F.when(kind == "2", "Weekly").otherwise(F.col("Contract")),
               "MonthlyCharges": F.when(kind == "3", 500.0).otherwise(F.col("MonthlyCharges")),
               KEY: F.when(kind != "4", F.col(KEY))}
    line = F.to_json(F.struct(*[changed.get(c, F.col(c)).alias(c) for c in requests.columns]))
    line = F.when(kind == "0", F.substring(line, 1, 60)).when(
        kind == "1", F.regexp_replace(line, r'"tenure":-?\d+', '"tenure":"unknown"')).otherwise(line)
    return requests.select(*keep, line.alias("value"))


def q_request_batches(spark, sf):
    """The requests posted as arrays of at most 100, broken ones among them, read from a request log and
    answered element by element."""
    raw, fm = _fit(spark, sf)
    lines = request_lines(raw, KEY).groupBy(F.substring(KEY, 1, 6).alias("post")).agg(
        F.sort_array(F.collect_list(F.struct(KEY, "value"))).alias("e"))             # at most 100 a post
    body = F.concat(F.lit("["), F.array_join(F.transform("e", lambda x: x["value"]), ","), F.lit("]"))
    log = stage_path(spark, f"posts-{uuid.uuid4().hex}")
    lines.select(F.concat_ws("\t", "post", body)).write.text(log)
    answers = scoring.score_elements(request_elements(read_request_bodies(spark, log)), fm)
    return answers.withColumn("churn_prediction", F.col("churn_prediction").cast("double"))      # NULLs compare as NaN


def _digit(tag: str) -> Column:
    """The first hex digit of md5(tag:customerID): which rows a made fault strikes."""
    return F.substring(F.md5(F.concat(F.lit(f"{tag}:"), F.col(KEY))), 1, 1)


def q_request_defaults(spark, sf):
    """JSON requests that lack about a fifth of their fields each, read back and completed, so that every default is taken."""
    requests = requests_from_subscribers(subscriber_raw(spark, sf))
    fields = [c for c in requests.columns if c != KEY]
    path = stage_path(spark, f"requests-{uuid.uuid4().hex}")
    requests.select(KEY, *[F.when(~_digit(c).isin("0", "1", "2"), F.col(c)).alias(c) for c in fields]).write.json(path)
    return with_request_defaults(read_requests(spark, path).drop(io.CORRUPT))


# Values that break the rule of their field: numbers out of range, any other text not allowed.
BROKEN_VALUES = {"SeniorCitizen": 5, "tenure": 99, "MonthlyCharges": 500.0, "TotalCharges": "99999"}


def q_request_rules(spark, sf):
    """Records in which each field is wrong in a sixteenth of the rows, and the total no number in another, so that every
    rule but the stream's own is broken, many together."""
    raw = subscriber_raw(spark, sf)
    fields = [*DOMAINS, *RANGES]
    changed = {c: F.when(_digit(f"bad {c}") == "0", F.lit(BROKEN_VALUES.get(c, "other"))).otherwise(F.col(c)) for c in fields}
    changed["TotalCharges"] = F.when(_digit("bad TotalCharges") == "1", "n/a").otherwise(changed["TotalCharges"])
    return validate_records(raw.withColumns(changed))


def q_revenue_quantiles(spark, sf):
    """Quantiles of order totals by month from sketches of days: built once a day, stored, merged."""
    orders = read_table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    days = materialize(sketches.sketch_by(orders, ["day"], "o_totalprice"), "day-sketches")
    months = sketches.merge_by(days.withColumn("month", F.date_format("day", "yyyy-MM")), ["month"])
    return sketches.quantiles(months, ["month"], {"p05": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95})


# Three fixed rules whose scores SQL can replay: the scorecard, the contract alone, the tenure alone.
RULE_MODELS = ("scorecard", "contract_rule", "tenure_rule")


def _rule_comparison(spark, sf):
    test = materialize(_scored_test(spark, sf).select(
        LABEL, F.col("p").alias("scorecard"),
        F.when(F.col("contract_risk_score") == 3, 0.6).when(F.col("contract_risk_score") == 1, 0.1).otherwise(0.3).alias("contract_rule"),
        (F.lit(0.75) - F.lit(0.01) * F.col("tenure").cast("double")).alias("tenure_rule")), "rule-scores")
    rows = [evaluate.score_metrics(test, LABEL, m).select(F.lit(m).alias("model"), *train.METRICS, F.lit(i).alias("position"))
            for i, m in enumerate(RULE_MODELS)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def q_rule_compare(spark, sf):
    """The comparison of three rules on the test split, through the comparison sink and back."""
    path = stage_path(spark, f"comparison-{uuid.uuid4().hex}")
    io.write_comparison(_rule_comparison(spark, sf).drop("position"), path)
    return io.read_comparison(spark, path)


def q_rule_best_per_metric(spark, sf):
    """AG20 / E4 / E5: the rules' comparison unpivoted, the best a metric."""
    return train.best_per_metric(_rule_comparison(spark, sf))


def q_csv_roundtrip(spark, sf):
    """A1: the raw records written as CSV and read back with the fixed schema."""
    path = stage_path(spark, f"csv-{uuid.uuid4().hex}")
    io.write_raw_csv(subscriber_raw(spark, sf), path)
    return io.read_raw_csv(spark, path).drop(io.CORRUPT)


def q_attributions_saved(spark, sf):
    """The scorecard's attributions, long, through their sink and back."""
    path = stage_path(spark, f"attributions-{uuid.uuid4().hex}")
    scored = scoring.scorecard_score(_unfitted(spark, sf))
    io.write_attributions(scoring.attributions_long(scored, scoring.SCORECARD_FEATURES), path)
    return spark.read.parquet(path).select(KEY, "feature", F.round("value", 4).alias("value"), F.round("impact", 4).alias("impact"))


# rows-only entries that run models / streams are registered in ``plans.jobs``.
QUERIES: dict[str, Query] = {
    "clean_subscribers": q_clean_subscribers,
    "features_engineered": q_features_engineered,
    "features_encoded": q_features_encoded,
    "encoder_categories": q_encoder_categories,
    "features_for_requests": q_features_for_requests,
    "request_validation": q_request_validation,
    "kpi_summary": q_kpi_summary,
    "churn_by_contract": q_churn_by_contract,
    "churn_by_internet": q_churn_by_internet,
    "churn_by_payment": q_churn_by_payment,
    "churn_segments_grouping_sets": q_churn_segments_grouping_sets,
    "churn_new_vs_rest": q_churn_new_vs_rest,
    "churn_counts": q_churn_counts,
    "hist_tenure": q_hist_tenure,
    "hist_monthly": q_hist_monthly,
    "box_monthly": q_box_monthly,
    "correlation_matrix": q_correlation_matrix,
    "stratified_split": q_stratified_split,
    "stratified_folds": q_stratified_folds,
    "sample_churners": q_sample_churners,
    "background_sample": q_background_sample,
    "revenue_report": q_revenue_report,
    "revenue_sensitivity": q_revenue_sensitivity,
    "score_batch": q_score_batch,
    "score_bands": q_score_bands,
    "top_drivers": q_top_drivers,
    "driver_classes": q_driver_classes,
    "global_importance": q_global_importance,
    "importance_spread": q_importance_spread,
    "retention_messages": q_retention_messages,
    "retention_response": q_retention_response,
    "offer_mix": q_offer_mix,
    "class_metrics": q_class_metrics,
    "roc_auc": q_roc_auc,
    "dataset_metadata": q_dataset_metadata,
    "standardize": q_standardize,
    "prompt_table": q_prompt_table,
    "features_sparse": q_features_sparse,
    "request_batches": q_request_batches,
    "request_defaults": q_request_defaults,
    "request_rules": q_request_rules,
    "revenue_quantiles": q_revenue_quantiles,
    "rule_compare": q_rule_compare,
    "rule_best_per_metric": q_rule_best_per_metric,
    "csv_roundtrip": q_csv_roundtrip,
    "attributions_saved": q_attributions_saved,
}
