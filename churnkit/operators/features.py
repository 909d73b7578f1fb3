"""Cleaning, feature engineering and one-hot encoding as one fitted transformer.

``FeatureModel.fit`` learns, in a few aggregate jobs, everything the features depend on:
the median of the parsed TotalCharges, the mean MonthlyCharges per contract type and
the category levels of every categorical column. These grow with the levels, not the rows, and are held as literals, so ``transform`` is a pure
projection: no join, no shuffle, usable unchanged on batch tables and on streams, and
identical at training and at scoring time (train/serve parity).
"""

from __future__ import annotations

import json
from decimal import Decimal
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.schema import (CATEGORICAL_COLS, CONTRACT_RISK, KEY, LABEL, NO_SERVICE_VALUES,
                             NUMERIC_FEATURES, ORDERED_CATEGORICALS, SECURITY_COLS,
                             SERVICE_COLS, STREAMING_COLS, TENURE_BOUNDS, TENURE_LABELS)

# A plain decimal or exponent number, optionally padded; anything else is missing.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

_TOTAL = "__TotalCharges"


def parse_number(c: Column) -> Column:
    """Safe numeric cast: malformed text, blanks and NaN become NULL (never raises)."""
    if isinstance(c, str):
        c = F.col(c)
    parsed = F.when(c.rlike(NUMERIC_TEXT), F.trim(c).try_cast("double"))
    return F.when(F.isnan(parsed), F.lit(None).cast("double")).otherwise(parsed)


def _total_charges_double(df: DataFrame) -> Column:
    dtype = df.schema["TotalCharges"].dataType
    if isinstance(dtype, T.StringType):
        return parse_number(F.col("TotalCharges"))
    c = F.col("TotalCharges").cast("double")
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def churn_flag(df: DataFrame) -> Column:
    dtype = df.schema[LABEL].dataType
    if isinstance(dtype, T.StringType):
        return F.coalesce((F.col(LABEL) == "Yes").cast("int"), F.lit(0))      # a missing label is no churn
    return F.coalesce(F.col(LABEL).cast("int"), F.lit(0))


def tenure_group(tenure: Column) -> Column:
    """Right-closed buckets (0,6], (6,12], ... (72, inf); tenure <= 0 or NULL gives NULL."""
    expr = F.when(tenure <= 0, F.lit(None).cast("string"))
    for bound, label in zip(TENURE_BOUNDS, TENURE_LABELS):
        expr = expr.when(tenure <= bound, label)
    return expr.when(tenure > TENURE_BOUNDS[-1], TENURE_LABELS[-1])


def count_equal(cols: list[str], value: str) -> Column:
    return sum((F.when(F.col(c) == value, 1).otherwise(0) for c in cols), F.lit(0))


def contract_risk(contract: Column) -> Column:
    expr = None
    for name, score in CONTRACT_RISK.items():
        expr = F.when(contract == name, score) if expr is None else expr.when(contract == name, score)
    return expr.cast("int")


def money_sum(c: str | Column) -> Column:
    """Exact sum of an amount with at most two decimals (DECIMAL, not floating point)."""
    if isinstance(c, str):
        c = F.col(c)
    return F.sum(c.cast("decimal(12,2)"))


@dataclass
class FeatureModel:
    """Learned statistics for cleaning / engineering / encoding."""

    median_total: float
    contract_means: dict[str, float]
    overall_mean: float
    categories: dict[str, list[str]] = field(default_factory=dict)

    # ------------------------------------------------------------------ fit
    @classmethod
    def fit(cls, df: DataFrame) -> "FeatureModel":
        """Learn the statistics from a raw or cleaned subscriber table.

        The median is exact without a single-task merge (``stats.exact_median``); the
        levels and contract means come from one grouped aggregate."""
        from churnkit.operators.stats import median_from_counts

        # ONE scan: (column, level) pairs for every categorical plus ("__total", value)
        # pairs of the parsed TotalCharges, aggregated together. The result is bounded
        # by the category levels + distinct totals and is cached while it is read twice.
        total = _total_charges_double(df)
        entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"),
                            F.lit(None).cast("double").alias("v")) for c in CATEGORICAL_COLS]
        entries.append(F.struct(F.lit(_TOTAL).alias("column_name"),
                                F.lit(None).cast("string").alias("category"), total.alias("v")))
        agg = (df.select(F.explode(F.array(*entries)).alias("p"), F.col("MonthlyCharges"))
               .select("p.column_name", "p.category", "p.v", "MonthlyCharges")
               .groupBy("column_name", "category", "v")
               .agg(F.count(F.lit(1)).alias("n"),
                    money_sum("MonthlyCharges").alias("s"),
                    F.count("MonthlyCharges").alias("n_m"))
               .cache())
        # the learned levels live in the model, like the labels of a fitted string indexer
        levels = agg.where(F.col("column_name") != _TOTAL).collect()
        median = median_from_counts(agg.where((F.col("column_name") == _TOTAL) & F.col("v").isNotNull())
                                    .select("v", F.col("n").alias("c")))
        agg.unpersist()
        categories: dict[str, list[str]] = {c: [] for c in CATEGORICAL_COLS}
        means: dict[str, float] = {}
        all_n = 0
        dec_sum = Decimal(0)
        for row in levels:
            if row["category"] is not None:
                categories[row["column_name"]].append(row["category"])
            if row["column_name"] == "Contract":
                if row["s"] is not None:
                    dec_sum += row["s"]
                all_n += row["n_m"]
                if row["category"] is not None and row["n_m"]:
                    means[row["category"]] = float(row["s"]) / row["n_m"]
        for vals in categories.values():
            vals.sort()
        overall = float(dec_sum) / all_n if all_n else 0.0
        return cls(median_total=round(median, 6) if median is not None else 0.0,
                   contract_means=means, overall_mean=overall, categories=categories)

    # ------------------------------------------------------------- encoder
    def levels(self) -> dict[str, list[str]]:
        out = {c: list(self.categories.get(c, [])) for c in CATEGORICAL_COLS}
        out.update({c: list(v) for c, v in ORDERED_CATEGORICALS.items()})
        return out

    def dummy_columns(self) -> list[tuple[str, str, str]]:
        """(source column, level, feature name) for every kept level (first level dropped)."""
        out = []
        for c, vals in self.levels().items():
            for v in vals[1:]:
                out.append((c, v, f"{c}_{v}"))
        return out

    @property
    def feature_names(self) -> list[str]:
        return list(NUMERIC_FEATURES) + [name for _, _, name in self.dummy_columns()]

    # ----------------------------------------------------------- transform
    def clean(self, df: DataFrame) -> DataFrame:
        """Safe cast + median imputation of TotalCharges; binary label if present."""
        cols = []
        for name in df.columns:
            if name == "TotalCharges":
                cols.append(F.coalesce(_total_charges_double(df), F.lit(float(self.median_total)))
                            .alias("TotalCharges"))
            elif name == LABEL:
                cols.append(churn_flag(df).alias(LABEL))
            else:
                cols.append(F.col(name))
        return df.select(*cols)

    def _overpay_base(self) -> Column:
        expr = None
        for name, mean in sorted(self.contract_means.items()):
            cond = F.col("Contract") == name
            expr = F.when(cond, F.lit(float(mean))) if expr is None else expr.when(cond, F.lit(float(mean)))
        fallback = F.lit(float(self.overall_mean))
        return fallback if expr is None else expr.otherwise(fallback)

    def engineer(self, clean: DataFrame) -> DataFrame:
        """The 11 engineered columns, one projection."""
        tenure = F.col("tenure")
        sec = count_equal(SECURITY_COLS, "Yes")
        stream = count_equal(STREAMING_COLS, "Yes")
        services = sum((F.when(F.col(c).isNotNull() & ~F.col(c).isin(*NO_SERVICE_VALUES), 1)
                        .otherwise(0) for c in SERVICE_COLS), F.lit(0))
        num_services = F.greatest(services, F.lit(1))
        return clean.select(
            "*",
            tenure_group(tenure).alias("tenure_group"),
            (F.col("TotalCharges") / F.greatest(tenure, F.lit(1)).cast("double")).alias("avg_monthly_spend"),
            sec.alias("security_bundle_count"),
            (sec >= 2).cast("int").alias("has_security_bundle"),
            stream.alias("streaming_bundle_count"),
            (stream == 2).cast("int").alias("has_streaming_bundle"),
            (tenure <= 6).cast("int").alias("is_new_customer"),
            contract_risk(F.col("Contract")).alias("contract_risk_score"),
            num_services.alias("num_services"),
            (F.col("MonthlyCharges") / num_services.cast("double")).alias("monthly_charge_per_service"),
            F.try_divide(F.col("MonthlyCharges"), self._overpay_base()).alias("overpay_ratio"),
        )

    def encode(self, featured: DataFrame) -> DataFrame:
        """One-hot with the learned levels (first level dropped); unseen values encode as all 0."""
        keep = [c for c in featured.columns
                if c not in CATEGORICAL_COLS and c not in ORDERED_CATEGORICALS]
        dummies = [F.when(F.col(src) == lit, 1).otherwise(0).alias(name)
                   for src, lit, name in self.dummy_columns()]
        return featured.select(*keep, *dummies)

    def transform(self, df: DataFrame) -> DataFrame:
        """clean -> engineer -> encode, keyed by customerID when present."""
        return self.encode(self.engineer(self.clean(df)))

    def assemble(self, encoded: DataFrame, output_col: str = "features") -> DataFrame:
        """VectorAssembler over the 45 features; unknown contract risk imputed with 2."""
        prepared = encoded.withColumn(
            "contract_risk_score", F.coalesce(F.col("contract_risk_score"), F.lit(2)))
        assembler = VectorAssembler(inputCols=self.feature_names, outputCol=output_col,
                                    handleInvalid="keep")
        return assembler.transform(prepared)

    def align(self, encoded: DataFrame) -> DataFrame:
        """Training column list: missing -> 0, extra dropped, fixed order (key/label kept)."""
        present = set(encoded.columns)
        head = [c for c in (KEY, LABEL) if c in present]
        return encoded.select(*head, *[
            (F.coalesce(F.col(f"`{c}`"), F.lit(0)) if c in present else F.lit(0)).alias(c)
            for c in self.feature_names])

    # ------------------------------------------------------------ persist
    def to_json(self) -> str:
        return json.dumps({"median_total": self.median_total,
                           "contract_means": self.contract_means,
                           "overall_mean": self.overall_mean,
                           "categories": self.categories}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FeatureModel":
        d = json.loads(text)
        return cls(d["median_total"], d["contract_means"], d["overall_mean"], d["categories"])

    def save(self, spark, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1) \
            .write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> "FeatureModel":
        return cls.from_json(spark.read.text(path).first()[0])


def category_levels(df: DataFrame) -> DataFrame:
    """The encoder table: (column_name, category, level_index, dropped, feature_name).

    One scan: explode (column, value) pairs, ``distinct`` (partial aggregation map-side,
    so the shuffle carries at most one row per level per task), then number the levels
    of each column in two steps: within each (column, first three characters) and after the
    count of those before. Ordered categoricals (tenure_group) keep their fixed level order.
    NULLs are no level; an empty table leaves only the ordered levels."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"))
        for c in CATEGORICAL_COLS]))
    levels = (df.select(pairs.alias("p")).select("p.*")
              .where(F.col("category").isNotNull()).distinct()
              .withColumn("_b", F.substring("category", 1, 3)))
    counts = levels.groupBy("column_name", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("column_name").orderBy("_b")) - F.col("_n")
    offsets = counts.select("column_name", "_b", before.alias("_off"))
    within = F.row_number().over(Window.partitionBy("column_name", "_b").orderBy("category"))
    numbered = (levels.join(offsets, ["column_name", "_b"])
                .select("column_name", "category", (within + F.col("_off") - 1).cast("int").alias("level_index")))
    fixed = df.sparkSession.createDataFrame(
        [(c, v, i) for c, vals in ORDERED_CATEGORICALS.items() for i, v in enumerate(vals)],
        "column_name string, category string, level_index int")
    out = numbered.unionByName(fixed)
    return out.select(
        "column_name", "category", "level_index",
        (F.col("level_index") == 0).cast("int").alias("dropped"),
        F.when(F.col("level_index") > 0, F.concat_ws("_", "column_name", "category")).alias("feature_name"))
