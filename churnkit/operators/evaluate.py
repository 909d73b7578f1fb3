"""Classification metrics, exact ROC AUC, dataset metadata and standardisation.

* ``class_metrics``: confusion counts in one aggregate pass, then integer arithmetic
  (precision / recall / F1 are 0 on an empty denominator), rounded half-up to 4 places.
* ``roc_auc``: exact rank statistic. Group by score (ties share credit), then the count
  of negatives below each score is a prefix sum over ranges of scores that a quantile
  sketch cuts (``stats.prefix_sum``), so no single task sees all distinct scores,
  however close together they are.
"""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.expr import ratio_half_up
from churnkit.operators.stats import prefix_sum
from churnkit.schema import KEY, LABEL
from churnkit.session import materialize


def confusion(df: DataFrame, label: str = LABEL, pred: str = "prediction") -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return df.agg(cnt(y & p).alias("tp"), cnt(~y & p).alias("fp"),
                  cnt(~y & ~p).alias("tn"), cnt(y & ~p).alias("fn"))


def _zero_div(num: Column, den: Column) -> Column:
    return F.coalesce(ratio_half_up(num, den, 4), F.lit(0.0))


def class_metrics(df: DataFrame, label: str = LABEL, pred: str = "prediction") -> DataFrame:
    c = confusion(df, label, pred)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select("tp", "fp", "tn", "fn",
                    _zero_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                    _zero_div(tp, tp + fp).alias("precision"),
                    _zero_div(tp, tp + fn).alias("recall"),
                    _zero_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def score_metrics(df: DataFrame, label: str = LABEL, score: str = "p", threshold: float = 0.5) -> DataFrame:
    """One row: confusion counts at the threshold, the four metrics from them, n_pos, n_neg and the exact roc_auc.

    Everything follows from the positives and negatives at each score, grouped once and staged, so ``df`` (a model's
    scores) is computed once. Rows without a score take no part. Ties count half."""
    per = materialize(df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("neg")), "scores")
    wide = lambda c, n: c.cast(f"decimal({n},0)")
    at = lambda c, hit: F.coalesce(F.sum(F.when(hit, F.col(c))), F.lit(0)).cast("bigint")
    hit = F.col("s") >= threshold
    agg = prefix_sum(per, "s", "neg", "neg_below").agg(
        at("pos", F.lit(True)).alias("n_pos"), at("neg", F.lit(True)).alias("n_neg"),
        at("pos", hit).alias("tp"), at("neg", hit).alias("fp"), at("neg", ~hit).alias("tn"), at("pos", ~hit).alias("fn"),
        F.sum(wide(wide(F.col("pos"), 18) * wide(2 * F.col("neg_below") + F.col("neg"), 19), 38)).alias("num2"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return agg.select("tp", "fp", "tn", "fn",
                      _zero_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                      _zero_div(tp, tp + fp).alias("precision"),
                      _zero_div(tp, tp + fn).alias("recall"),
                      _zero_div(2 * tp, 2 * tp + fp + fn).alias("f1"), "n_pos", "n_neg",
                      ratio_half_up(F.col("num2"), wide(F.col("n_pos"), 18) * wide(2 * F.col("n_neg"), 19), 4).alias("roc_auc"))


def roc_auc(df: DataFrame, label: str = LABEL, score: str = "p") -> DataFrame:
    """n_pos, n_neg, roc_auc (exact, ties counted half)."""
    return score_metrics(df, label, score).select("n_pos", "n_neg", "roc_auc")


def dataset_metadata(split_df: DataFrame, n_features: int) -> DataFrame:
    """n_features, n_train, n_test, churn_rate (whole table), one pass."""
    return split_df.agg(
        F.lit(n_features).alias("n_features"),
        F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("bigint").alias("n_train"),
        F.sum(F.when(F.col("split") == "test", 1).otherwise(0)).cast("bigint").alias("n_test"),
        ratio_half_up(F.sum(F.col(LABEL)), F.count(F.lit(1)), 4).alias("churn_rate"))


def standardize_fit_apply(df: DataFrame, train_keys: DataFrame, columns: list[str],
                          key: str = KEY) -> DataFrame:
    """Fit the scaler on the training rows (semi join on the key), apply it to every row."""
    def prep(d: DataFrame) -> DataFrame:
        sel = d.select(key, *[(F.coalesce(F.col(c).cast("double"), F.lit(2.0))
                               if c == "contract_risk_score" else F.col(c).cast("double")).alias(c)
                              for c in columns])
        return VectorAssembler(inputCols=columns, outputCol="_v", handleInvalid="keep").transform(sel)

    train = prep(df.join(train_keys, key, "left_semi"))
    model = StandardScaler(inputCol="_v", outputCol="_z", withMean=True, withStd=True).fit(train)
    z = model.transform(prep(df)).select(key, vector_to_array("_z").alias("_a"))
    return z.select(key, *[F.round(F.col("_a")[i], 4).alias(f"z_{c}") for i, c in enumerate(columns)])
