"""One-hot encoding of any number of levels as sparse vectors.

The learned levels are the labels of an index stage, looked up in a hash table, and an encoder writes one entry of
a sparse vector a column: no output column and no CASE branch a level, so the plan has the size of the column list
and a row that of its categories, whether there are five levels or fifty thousand. Feature order and values are those of
``FeatureModel.assemble``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.operators.features import FeatureModel
from churnkit.schema import NUMERIC_FEATURES


def sparse_encoder(feature_model: FeatureModel, featured: DataFrame, output_col: str = "features") -> PipelineModel:
    """Index, encode and assemble stages for engineered rows; of ``featured`` only the schema is used.

    Each column's first level, unseen levels and NULL share the index behind the labels, which the encoder leaves out: all zeros, as in
    ``encode``. Columns with fewer than two levels add no feature."""
    levels = {c: v for c, v in feature_model.levels().items() if len(v) > 1}
    at, hot = [f"_i_{c}" for c in levels], [f"_h_{c}" for c in levels]
    index = PipelineModel([StringIndexerModel.from_labels(v[1:], c, i, handleInvalid="keep") for (c, v), i in zip(levels.items(), at)])
    encode = OneHotEncoder(inputCols=at, outputCols=hot, dropLast=True).fit(index.transform(featured.limit(0)))
    assemble = VectorAssembler(inputCols=[*NUMERIC_FEATURES, *hot], outputCol=output_col, handleInvalid="keep")
    return PipelineModel([index, encode, assemble])


def vectorize(feature_model: FeatureModel, featured: DataFrame, output_col: str = "features") -> DataFrame:
    """Engineered rows with their sparse feature vector; unknown contract risk imputed with 2, as in ``assemble``."""
    known = featured.withColumn("contract_risk_score", F.coalesce(F.col("contract_risk_score"), F.lit(2)))
    helpers = [c for name in feature_model.levels() for c in (f"_i_{name}", f"_h_{name}")]
    return sparse_encoder(feature_model, known, output_col).transform(known).drop(*helpers)


def nonzero_entries(vectorized: DataFrame, keep: list[str], features_col: str = "features") -> DataFrame:
    """(keep, feature_index, value) of the entries that are not zero, whatever form a vector is stored in."""
    v = F.unwrap_udt(features_col)
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    sparse = F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.alias("i"), x.alias("x")))
    entries = F.when(v["indices"].isNull(), dense).otherwise(sparse)
    return (vectorized.select(*keep, F.explode(F.filter(entries, lambda e: e["x"] != 0)).alias("e"))
            .select(*keep, F.col("e.i").alias("feature_index"), F.col("e.x").alias("value")))
