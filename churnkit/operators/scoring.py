"""Scores, tiers, ranked drivers and attribution summaries.

A *scored table* has the key, the probability ``p`` and, for attribution, two arrays
aligned with a feature list: ``attr_values`` (the row's feature values) and
``attr_impacts`` (their contributions in log-odds, or probability for the sampled
explainer). Everything downstream (tier, prediction, top-k drivers, offers, messages)
works on that shape whatever model produced it, row-locally: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.functions.expr import logistic, prediction, risk_tier, score_band
from churnkit.operators.validation import with_errors
from churnkit.schema import KEY, REQUEST
from churnkit.sources.fixture import SCORECARD, SCORECARD_INTERCEPT
from churnkit.sources.requests import with_request_defaults


# ------------------------------------------------------------------ scorecard
def scorecard_score(encoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Fixed linear model: z = b + sum w_j (x_j - c_j); p = logistic(z).

    phi_j = w_j (x_j - c_j) is the exact attribution of feature j (log-odds, against the
    centre c). Unknown contract risk is imputed with 2 as in the assembler."""
    phis = []
    for name, w, c in SCORECARD:
        x = F.col(name)
        if name == "contract_risk_score":
            x = F.coalesce(x, F.lit(2))
        phis.append((F.lit(float(w)) * (x.cast("double") - F.lit(float(c)))))
    z = F.lit(float(SCORECARD_INTERCEPT))
    for phi in phis:
        z = z + phi
    keep = keep if keep is not None else [c for c in encoded.columns]
    names = [n for n, _, _ in SCORECARD]
    return encoded.select(
        *keep,
        F.array(*[F.col(n).cast("double") if n != "contract_risk_score"
                  else F.coalesce(F.col(n), F.lit(2)).cast("double") for n in names]).alias("attr_values"),
        F.array(*phis).alias("attr_impacts"),
        logistic(z).alias("p"),
    )


SCORECARD_FEATURES = [n for n, _, _ in SCORECARD]


# ---------------------------------------------------------------------- drivers
def ranked_drivers(feature_names: list[str], k: int | None = 5,
                   values: str = "attr_values", impacts: str = "attr_impacts") -> Column:
    """Top-k drivers by |impact| desc, ties by feature order, as
    ARRAY<STRUCT<feature, value, shap_impact, direction, pos>> -- sorted per row, no shuffle."""
    names = F.array(*[F.lit(n) for n in feature_names])
    items = F.transform(
        F.arrays_zip(names.alias("feature"), F.col(values).alias("value"), F.col(impacts).alias("impact")),
        lambda s, i: F.struct(
            (-F.abs(s["impact"])).alias("neg_abs"),
            i.alias("pos"),
            s["feature"].alias("feature"),
            s["value"].alias("value"),
            s["impact"].alias("impact")))
    ordered = F.sort_array(items)
    if k is not None:
        ordered = F.slice(ordered, 1, k)
    return F.transform(ordered, lambda d: F.struct(
        d["feature"].alias("feature"),
        d["value"].alias("value"),
        d["impact"].alias("shap_impact"),
        F.when(d["impact"] > 0, "increases").otherwise("decreases").alias("direction"),
        d["pos"].alias("pos")))


def drivers_long(scored: DataFrame, feature_names: list[str], k: int = 5) -> DataFrame:
    """(customerID, driver_rank, feature, value, shap_impact, direction), impacts to 4 places."""
    return (scored.select(KEY, F.posexplode(ranked_drivers(feature_names, k)).alias("i", "d"))
            .select(KEY, (F.col("i") + 1).alias("driver_rank"), F.col("d.feature").alias("feature"),
                    F.round(F.col("d.value"), 4).alias("value"),
                    F.round(F.col("d.shap_impact"), 4).alias("shap_impact"),
                    F.col("d.direction").alias("direction")))


# -------------------------------------------------------------------- batch scoring
def factor_records(feature_names: list[str], k: int = 5) -> Column:
    """The row's top ``k`` factors (fewer, if it has fewer features) as
    ARRAY<STRUCT<feature, value, shap_impact, direction>>, numbers to 4 places."""
    return F.transform(ranked_drivers(feature_names, k), lambda d: F.struct(
        d["feature"].alias("feature"), F.round(d["value"], 4).alias("value"),
        F.round(d["shap_impact"], 4).alias("shap_impact"), d["direction"].alias("direction")))


def score_batch(scored: DataFrame, feature_names: list[str], k: int = 5, records: bool = False) -> DataFrame:
    """p to 4 places, prediction (p >= 0.5), tier on the unrounded p, top driver names.

    ``records`` adds ``top_factors``, the up to ``k`` factor records of the row."""
    drivers = ranked_drivers(feature_names, k)
    return scored.select(
        *([factor_records(feature_names, k).alias("top_factors")] if records else []),
        KEY,
        F.round(F.col("p"), 4).alias("churn_probability"),
        prediction(F.col("p")).alias("churn_prediction"),
        risk_tier(F.col("p")).alias("risk_level"),
        *[drivers[i]["feature"].alias(f"top_factor_{i + 1}") for i in range(3)],
    )


def score_elements(elements: DataFrame, feature_model) -> DataFrame:
    """The batch endpoint's answer, a row an element of ``sources.requests.request_elements``: source, position, n_elements, customerID,
    churn_probability, churn_prediction, risk_level, or the error and no score. One projection: no element waits for another."""
    judged = with_errors(elements, "wrong").drop("wrong", "element")
    fine = F.col("error").isNull()
    fields = {f.name for f in REQUEST.fields}
    kept = judged.select(*[F.when(fine, F.col(c)).alias(c) if c in fields and c != KEY else F.col(c) for c in judged.columns])
    encoded = feature_model.transform(with_request_defaults(kept))
    others = [c for c in judged.columns if c not in fields or c == KEY]
    scored = scorecard_score(encoded, keep=others)
    answer = {"churn_probability": F.round("p", 4), "churn_prediction": prediction(F.col("p")), "risk_level": risk_tier(F.col("p"))}
    return scored.select(*others, *[F.when(fine, c).alias(n) for n, c in answer.items()])


def score_bands(scored: DataFrame) -> DataFrame:
    return scored.groupBy(score_band(F.col("p")).alias("band")).agg(
        F.count(F.lit(1)).alias("customers"))


# ------------------------------------------------------------ global summaries (AG16, L6)
def attributions_long(scored: DataFrame, feature_names: list[str]) -> DataFrame:
    """(customerID, feature, value, impact): the long attribution table."""
    names = F.array(*[F.lit(n) for n in feature_names])
    return (scored.select(KEY, F.explode(F.arrays_zip(names.alias("feature"),
                                                      F.col("attr_values").alias("value"),
                                                      F.col("attr_impacts").alias("impact"))).alias("a"))
            .select(KEY, "a.feature", "a.value", "a.impact"))


def global_importance(scored: DataFrame, feature_names: list[str], top: int = 20) -> DataFrame:
    """Mean |impact| per feature, top ``top`` by importance (ties by feature order).

    Aggregated wide (one pass, one row) and exploded: no shuffle on the feature key."""
    n = len(feature_names)
    wide = scored.agg(*[F.avg(F.abs(F.col("attr_impacts")[i])).alias(f"m{i}") for i in range(n)])
    rows = wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f).alias("feature"), F.col(f"m{i}").alias("importance"))
        for i, f in enumerate(feature_names)])).alias("r")).select("r.*")
    w = Window.orderBy(F.desc("importance"), "pos")  # over <= 45 rows (bounded)
    return (rows.withColumn("importance_rank", F.row_number().over(w))
            .where(F.col("importance_rank") <= top)
            .select("importance_rank", "feature", F.round("importance", 4).alias("importance")))


def importance_spread(scored: DataFrame, feature_names: list[str], exact: bool = True,
                      top: int | None = None) -> DataFrame:
    """Bee-swarm as a table: impact quartiles per feature, split at the feature's mean value.

    ``exact`` holds each group's distinct impacts: a scorecard has few, a fitted model one a row, so
    those pass False (``percentile_approx``). ``top`` keeps the most important features only.

    One pass for the means (one row), one grouped percentile pass over (feature, half)."""
    n = len(feature_names)
    means = scored.agg(*[F.avg(F.col("attr_values")[i]).alias(f"v{i}") for i in range(n)]).first()
    names = F.array(*[F.lit(f) for f in feature_names])
    mean_arr = F.array(*[F.lit(float(means[f"v{i}"]) if means[f"v{i}"] is not None else 0.0)
                         for i in range(n)])
    long = scored.select(F.explode(F.arrays_zip(
        names.alias("feature"), F.col("attr_values").alias("value"),
        F.col("attr_impacts").alias("impact"), mean_arr.alias("mean"))).alias("a"))
    half = F.when(F.col("a.value") > F.col("a.mean"), "high").otherwise("low")
    if top is not None:
        best = global_importance(scored, feature_names, top).select(F.col("feature").alias("_f"))
        long = long.join(F.broadcast(best), F.col("a.feature") == F.col("_f"), "left_semi")   # <= top rows
    return (long.groupBy(F.col("a.feature").alias("feature"), half.alias("value_half"))
            .agg(F.count(F.lit(1)).alias("n"),
                 (F.percentile(F.col("a.impact"), [0.25, 0.5, 0.75]) if exact else
                  F.percentile_approx(F.col("a.impact"), [0.25, 0.5, 0.75], 10000)).alias("q"))
            .select("feature", "value_half", "n",
                    F.round(F.col("q")[0], 4).alias("impact_q1"),
                    F.round(F.col("q")[1], 4).alias("impact_median"),
                    F.round(F.col("q")[2], 4).alias("impact_q3")))
