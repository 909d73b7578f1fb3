"""No cap on levels or explained rows, no machine-local folder on a cluster, no stale model."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnkit.operators.attribution import sampled_shapley
from churnkit.operators.features import FeatureModel, category_levels
from churnkit.operators.sampling import bounded_sample
from churnkit.operators.scoring import factor_records
from churnkit.session import ensure_checkpoint_dir, materialize, scratch_tables, ship_package, stage_path
from churnkit.sources.models import table_fingerprint


def test_fifty_thousand_levels(spark, raw):
    row = raw.limit(1)
    wide = (spark.range(50_000).crossJoin(row.drop("PaymentMethod"))
            .withColumn("PaymentMethod", F.format_string("m%05d", F.col("id"))).drop("id"))
    got = category_levels(wide).where("column_name = 'PaymentMethod'").orderBy("level_index").collect()
    assert [(r["category"], r["level_index"]) for r in got] == [(f"m{i:05d}", i) for i in range(50_000)]
    assert len(FeatureModel.fit(wide).categories["PaymentMethod"]) == 50_000


def test_category_levels_of_an_empty_table(raw):
    assert {r["column_name"] for r in category_levels(raw.limit(0)).collect()} == {"tenure_group"}


def test_every_row_is_explained(spark):
    df = spark.createDataFrame([(f"c{i}", Vectors.dense([float(i % 7), float(i % 5)]), float(i % 2))
                                for i in range(450)], ["customerID", "features", "label"])
    model = LogisticRegression(maxIter=5).fit(df)
    rows = df.select("customerID", "features")
    background = bounded_sample(rows, "customerID", 20)
    got = sampled_shapley(model, rows, background, 2, permutations=3)
    assert got.count() == 450 and got.select("customerID").distinct().count() == 450
    assert sampled_shapley(model, rows, background.limit(0), 2).count() == 0


def test_factor_records_hold_every_field(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [0.1, -0.5, 0.00004])], "attr_values array<double>, attr_impacts array<double>")
    got = df.select(factor_records(["a", "b", "c"], 5).alias("r")).first()["r"]
    assert [tuple(x) for x in got] == [("b", 2.0, -0.5, "decreases"), ("a", 1.0, 0.1, "increases"), ("c", 3.0, 0.0, "increases")]


def test_unset_checkpoint_dir_is_an_error_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_fingerprint_follows_the_rows_only(spark, raw):
    whole = table_fingerprint(raw)
    assert whole == table_fingerprint(raw.repartition(5).select(*reversed(raw.columns)))
    changed = raw.withColumn("tenure", F.when(F.col("customerID") == "C0000007", 1 + F.col("tenure")).otherwise(F.col("tenure")))
    others = [changed, raw.where("customerID <> 'C0000007'"), raw.unionByName(raw.where("customerID = 'C0000007'")), raw.drop("gender"), raw.limit(0),
              raw.withColumn("gender", F.col("Partner")).withColumn("Partner", F.col("Dependents"))]
    assert len({whole, *map(table_fingerprint, others)}) == 1 + len(others)


def test_stage_tables_go_with_their_block(spark):
    with scratch_tables(spark):
        a = materialize(spark.range(5))
        where = a.inputFiles()[0]
        out = stage_path(spark, "kept-by-a-test")
        a.write.mode("overwrite").parquet(out)
    gone = os.path.dirname(where.removeprefix("file://"))
    assert not os.path.exists(gone) and spark.read.parquet(out).count() == 5
    assert os.path.exists(os.path.dirname(materialize(spark.range(2)).inputFiles()[0].removeprefix("file://")))


def test_fits_side_by_side_ship_the_package_once():
    """A cluster's file server refuses a second file of a name, so the later of two fits would fail."""
    class Context:
        listFiles: list[str] = []

        def addPyFile(self, path):
            if any(os.path.basename(f) == os.path.basename(path) and f != path for f in self.listFiles):
                raise ValueError(f"File {os.path.basename(path)} was already registered with a different path")
            self.listFiles = [*self.listFiles, path]
            time.sleep(0.1)

    class Conf(dict):
        set = dict.__setitem__

    class Session:
        def __init__(self, context):
            self.sparkContext, self.conf = context, Conf()

    one = Session(Context())
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(ship_package, [one, one]))
    ship_package(Session(one.sparkContext))                             # another session of the same context
    assert len(one.sparkContext.listFiles) == 1
    other = Session(Context())                                          # a context of its own gets its own
    ship_package(other)
    assert len(other.sparkContext.listFiles) == 1
