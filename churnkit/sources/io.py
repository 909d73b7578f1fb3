"""Sources and sinks: raw CSV, stage tables, split table, reports, models, attributions.

* Raw subscriber CSV is read with an explicit schema (no inference pass over the data)
  in PERMISSIVE mode; malformed lines keep their text in ``_corrupt_record``.
* Stage tables are Parquet (typed, columnar: later reads prune columns and push filters).
* The split is written partitioned by ``split`` so reading the test rows prunes files.
* Small reports (JSON) read back with an explicit schema; a missing path gives an empty
  DataFrame of that schema instead of an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.schema import SUBSCRIBER_RAW

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, keep_corrupt: bool = True) -> DataFrame:
    """A1: subscriber CSV with header, fixed schema, malformed lines kept aside."""
    schema = T.StructType(SUBSCRIBER_RAW.fields + ([T.StructField(CORRUPT, T.StringType())]
                                                  if keep_corrupt else []))
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def write_raw_csv(df: DataFrame, path: str) -> None:
    """The writer keeps white space as it is: a blank amount is no missing one."""
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_stages(stages: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """A3: write each stage table (cleaned / featured / encoded) and return the paths."""
    paths = {}
    for name, df in stages.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(p)
        paths[name] = p
    return paths


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A2: read a stage table back (typed; no re-inference)."""
    return spark.read.parquet(path)


def write_split(df: DataFrame, path: str) -> None:
    """A4: the table with its ``split`` column, partitioned by split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, which: str = "test") -> DataFrame:
    """A4: rows of one split (partition pruning: only that folder is listed and read)."""
    return spark.read.parquet(path).where(F.col("split") == which)


def write_json_report(df: DataFrame, path: str) -> None:
    """Small report tables as JSON (one file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON report with a fixed schema; a missing path yields an empty DataFrame."""
    try:
        return spark.read.schema(schema).json(path)
    except Exception as e:  # noqa: BLE001 -- Spark raises AnalysisException for a missing path
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


COMPARISON_SCHEMA = "model string, accuracy double, precision double, recall double, f1 double, roc_auc double"
METADATA_SCHEMA = ("best_model string, best_roc_auc double, best_f1 double, n_features int, "
                   "n_train bigint, n_test bigint, churn_rate double")


def write_comparison(df: DataFrame, path: str) -> None:
    """A5: model comparison table (Parquet, plus CSV for humans)."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/parquet")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/parquet")


def write_attributions(long_df: DataFrame, path: str) -> None:
    """Long attribution table (customerID, feature, value, impact)."""
    long_df.write.mode("overwrite").parquet(path)
