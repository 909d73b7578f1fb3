"""Training, random search with stratified cross-validation, evaluation and selection.

Three model families, fitted on the assembled 45-feature vector:

* ``gbt``          boosted trees (depth-wise), the first boosted model of the reference;
* ``gbt_weighted`` boosted trees with a positive-class weight column (recall oriented);
* ``leafwise``     trees grown leaf by leaf (``boosting``), not one of the compared three;
* ``mlp``          a network with ReLU or tanh units, L2 and mini-batch Adam (``network``), whose
                   model holds its scaler.

Random search draws n distinct candidates from the full grid with a seeded RNG (index
decoding of the mixed-radix grid, never materialising it) and judges them on the
stratified ``fold`` column of ``sampling.stratified_split`` (``search``): results are rows of
a table, so a search that was cut off goes on where it was, and weak candidates stop after one fold.
Fits run on executors; ``parallelism`` overlaps candidate fits from driver threads.
The training table is checkpointed once (lineage cut, survives executor loss) and reused
by every fit.
"""

from __future__ import annotations

import json
import math
import random
import threading
import uuid
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnkit.operators.boosting import LeafwiseClassifier
from churnkit.operators.evaluate import score_metrics
from churnkit.operators.network import NetworkClassifier
from churnkit.schema import KEY, LABEL
from churnkit.session import scratch_tables, stage_path

# Rows of a task in a fit, while there are cores left: a tree level costs a scan, a network step a matrix product a row.
TASK_ROWS = {"gbt": 50_000, "gbt_weighted": 50_000, "mlp": 4_000, "leafwise": 4_000}
MOST_TASK_ROWS = 500_000           # rows of a task beyond one task a core
MOST_FITS = 4                      # fits of a search side by side: the driver holds their trees and starts all of their jobs
GBT_CHECKPOINT = 5                 # boosting steps between two checkpoints of the residuals' lineage: every task of a tree loads the trees since

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]

# The search spaces (reference grids mapped onto Spark ML parameters).
GBT_GRID = {
    "maxIter": [100, 200, 300, 500],
    "maxDepth": [3, 5, 7, 9],
    "stepSize": [0.01, 0.05, 0.1, 0.2],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
    "minInstancesPerNode": [1, 3, 5],
    "minInfoGain": [0.0, 0.1, 0.2],
    "pos_weight": [1, 2, 3],
}
GBT_WEIGHTED_GRID = {
    "maxIter": [100, 200, 300, 500],
    "maxDepth": [3, 5, 7, 9],
    "stepSize": [0.01, 0.05, 0.1, 0.2],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
    "minInstancesPerNode": [5, 10, 20],
    "pos_weight": [1, 2, 3],
}
LEAFWISE_GRID = {
    "trees": [100, 200, 300, 500],
    "max_depth": [3, 5, 7, -1],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "num_leaves": [15, 31, 63, 127],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "feature_fraction": [0.7, 0.8, 0.9, 1.0],
    "min_child_samples": [5, 10, 20],
    "pos_weight": [1, 2, 3],
}
MLP_GRID = {
    "hidden": [(128, 64), (256, 128, 64), (128, 64, 32), (64, 32)],
    "activation": ["relu", "tanh"],
    "alpha": [0.0001, 0.001, 0.01],
    "learning_rate": [0.001, 0.005, 0.01],
    "steps": [8, 16, 32],              # batches an epoch: their size grows with the data
}
# Untuned configurations and search budgets.
GBT_DEFAULT = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.1}
GBT_WEIGHTED_DEFAULT = {**GBT_DEFAULT, "pos_weight": 3}
MLP_DEFAULT = {"hidden": (128, 64, 32), "activation": "relu", "alpha": 0.0001, "learning_rate": 0.002, "steps": 8, "epochs": 500}
LEAFWISE_DEFAULT = {"trees": 300, "max_depth": 5, "num_leaves": 31, "learning_rate": 0.1}
SEARCH_GRID = {"gbt": GBT_GRID, "gbt_weighted": GBT_WEIGHTED_GRID, "mlp": MLP_GRID, "leafwise": LEAFWISE_GRID}
SEARCH_BUDGET = {"gbt": 40, "gbt_weighted": 40, "mlp": 20, "leafwise": 40}
DISPLAY = {"leafwise": "LeafwiseGradientBoosting", "gbt": "GradientBoosting", "gbt_weighted": "WeightedGradientBoosting", "mlp": "NeuralNetwork"}


def draw_grid(grid: dict, n: int, seed: int = 42) -> list[dict]:
    """n distinct points of the cartesian grid, drawn without replacement (seeded)."""
    keys = list(grid)
    sizes = [len(grid[k]) for k in keys]
    total = 1
    for s in sizes:
        total *= s
    idx = random.Random(seed).sample(range(total), min(n, total))
    out = []
    for i in idx:
        point = {}
        for k, s in zip(reversed(keys), reversed(sizes)):
            i, r = divmod(i, s)
            point[k] = grid[k][r]
        out.append({k: point[k] for k in keys})
    return out


def with_weights(df: DataFrame, weights=(1, 2, 3), label: str = LABEL) -> DataFrame:
    """One weight column per positive-class weight w: w for label 1, else 1."""
    for w in weights:
        df = df.withColumn(f"w{w}", F.when(F.col(label) == 1, float(w)).otherwise(1.0))
    return df


def _gbt(params: dict, seed: int = 42) -> GBTClassifier:
    p = dict(params)
    w = p.pop("pos_weight", 1)
    est = GBTClassifier(featuresCol="features", labelCol="label", seed=seed, checkpointInterval=GBT_CHECKPOINT,
                        cacheNodeIds=False, weightCol=f"w{w}", **p)
    return est


def fit_concurrently(fits: dict) -> dict:
    """Run independent fits from driver threads (Spark schedules their jobs side by side,
    filling cores an iterative fit leaves idle between its short stages)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, len(fits))) as pool:
        futures = {k: pool.submit(fn) for k, fn in fits.items()}
        return {k: f.result() for k, f in futures.items()}


@dataclass
class TrainResult:
    models: dict = field(default_factory=dict)       # kind -> fitted model (Spark ML)
    comparison: DataFrame | None = None             # model, accuracy, precision, recall, f1, roc_auc
    best: str | None = None


def default_params(kind: str) -> dict:
    """What an untuned fit of a family runs with."""
    return {"gbt": GBT_DEFAULT, "gbt_weighted": GBT_WEIGHTED_DEFAULT, "mlp": MLP_DEFAULT, "leafwise": LEAFWISE_DEFAULT}[kind]


def estimator(kind: str, params: dict, seed: int = 42):
    return {"mlp": NetworkClassifier, "leafwise": LeafwiseClassifier}[kind](seed=seed, **params) if kind in ("mlp", "leafwise") else _gbt(params, seed)


def fit_model(kind: str, train: DataFrame, tune: bool = False, budget: int | None = None, seed: int = 42,
              parallelism: int = 2, overrides: dict | None = None, results: str | None = None):
    """Fit one family; with ``tune`` the winner of a random search over the folds, refitted on all training rows.

    ``results`` is the search's table (see ``search``); a folder of its own by default."""
    if not tune:
        return estimator(kind, {**default_params(kind), **(overrides or {})}, seed).fit(spread(train, TASK_ROWS[kind]))
    points = [{**p, **(overrides or {})} for p in draw_grid(SEARCH_GRID[kind], budget or SEARCH_BUDGET[kind], seed)]
    results = results or stage_path(train.sparkSession, f"search-{uuid.uuid4().hex}")
    best = search(kind, train, points, results, seed=seed, parallelism=parallelism)
    return estimator(kind, best["params"], seed).fit(spread(train, TASK_ROWS[kind]))


SEARCH_SCHEMA = "candidate int, params string, fold int, roc_auc double"


def search(kind: str, train: DataFrame, points: list[dict], results: str, folds: int = 3, keep: float = 0.5,
           seed: int = 42, parallelism: int = 2, max_fits: int | None = None) -> dict | None:
    """Random search over the stratified ``fold`` column whose results are a table, so a lost driver resumes.

    Every candidate is fitted without fold 0 and judged on it; the better ``keep`` share (at least one) goes on to the other folds
    (1.0: cross-validation of all). Each (candidate, fold) is a row of the Parquet table at ``results`` as soon as it is judged, and what
    the table holds is not fitted again; a table of other candidates is an error. The winner has the highest mean AUC of those judged
    on all folds, ties to the earlier candidate: {candidate, params, roc_auc, fits (of this run)}. ``max_fits`` ends
    this run early and returns None."""
    from concurrent.futures import ThreadPoolExecutor

    spark = train.sparkSession
    spark.createDataFrame([], SEARCH_SCHEMA).write.mode("append").parquet(results)
    texts = [json.dumps(p, sort_keys=True) for p in points]
    done: dict[tuple[int, int], float] = {}
    for r in spark.read.schema(SEARCH_SCHEMA).parquet(results).collect():          # candidates x folds rows
        if r["candidate"] >= len(texts) or texts[r["candidate"]] != r["params"]:
            raise ValueError(f"{results} holds another search: candidate {r['candidate']} is {r['params']}")
        done[r["candidate"], r["fold"]] = r["roc_auc"]
    fits, writing = 0, threading.Lock()

    def judge(c: int, f: int) -> None:
        with scratch_tables(spark):                     # a search makes hundreds of fits, each with blocks of the training rows
            model = estimator(kind, points[c], seed).fit(spread(train.where(F.col("fold") != f), TASK_ROWS[kind]))
            scored = positive_probability(model, train.where(F.col("fold") == f)).select(F.col("label").cast("int").alias(LABEL), "p")
            auc = score_metrics(scored, LABEL, "p").first()["roc_auc"]
        with writing:                                   # one append at a time: they share a commit folder
            spark.createDataFrame([(c, texts[c], f, auc)], SEARCH_SCHEMA).coalesce(1).write.mode("append").parquet(results)
        done[c, f] = auc

    def judge_all(pairs: list[tuple[int, int]]) -> bool:
        nonlocal fits
        todo = [p for p in pairs if p not in done]
        now = todo if max_fits is None else todo[:max(0, max_fits - fits)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(lambda p: judge(*p), now))
        fits += len(now)
        return len(now) == len(todo)

    score = lambda a: -1.0 if a is None else a  # noqa: E731 -- a fold of one class has no AUC
    if not points or not judge_all([(c, 0) for c in range(len(points))]):
        return None
    order = sorted(range(len(points)), key=lambda c: (-score(done[c, 0]), c))
    going = sorted(order[:max(1, math.ceil(keep * len(points)))])
    if not judge_all([(c, f) for c in going for f in range(1, folds)]):
        return None
    mean = {c: sum(score(done[c, f]) for f in range(folds)) / folds for c in going}
    best = max(going, key=lambda c: (mean[c], -c))
    return {"candidate": best, "params": points[best], "roc_auc": mean[best], "fits": fits}


def positive_probability(model, df: DataFrame) -> DataFrame:
    """Score with a fitted model: adds p (class-1 probability) and prediction (p >= 0.5)."""
    scored = model.transform(df)
    return (scored.withColumn("p", vector_to_array("probability")[1])
            .withColumn("prediction", (F.col("p") >= 0.5).cast("int")))


def evaluate_model(name: str, model, test: DataFrame) -> DataFrame:
    """One row: model, accuracy, precision, recall, f1, roc_auc (test split); the model runs once, in one job."""
    scored = positive_probability(model, test).select(F.col("label").cast("int").alias(LABEL), "p")
    row = score_metrics(scored, LABEL, "p").first()
    return test.sparkSession.createDataFrame([(name, *(row[m] for m in METRICS))],
                                             "model string, accuracy double, precision double, recall double, f1 double, roc_auc double")


def spread(train: DataFrame, rows_per_task: int) -> DataFrame:
    """The training rows in tasks of ``rows_per_task`` rows, up to one task a core, and of MOST_TASK_ROWS at most: iterative fits
    scan them thousands of times, each time for the price of the tasks' start and answer, and AQE would coalesce them into one task. Takes a count."""
    return train.repartition(fit_tasks(train.count(), rows_per_task, train.sparkSession.sparkContext.defaultParallelism))


def fit_tasks(rows: int, rows_per_task: int, cores: int) -> int:
    return max(1, min(-(-rows // rows_per_task), max(cores, -(-rows // MOST_TASK_ROWS))))


def fits_at_once(rows: int, rows_per_task: int, cores: int) -> int:
    """Fits that fill the cores, two at least: one fit's jobs are short and leave cores idle between them."""
    return max(2, min(MOST_FITS, cores // fit_tasks(rows, rows_per_task, cores)))


def prepare_training(assembled: DataFrame, split: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) with label DOUBLE, weight columns and folds; train is checkpointed. ``assembled`` carries its split and
    fold, or ``split`` has them by key."""
    rows = assembled if split is None else assembled.join(split.select(KEY, "split", "fold"), KEY)
    return _rows_of(rows, "train").checkpoint(eager=True), test_rows(rows)     # training rows are read by every fit


def _rows_of(rows: DataFrame, part: str) -> DataFrame:
    rows = with_weights(rows.where(F.col("split") == part).withColumn("label", F.col(LABEL).cast("double")))
    return rows.select(KEY, "features", "label", "fold", "w1", "w2", "w3")


def test_rows(rows: DataFrame) -> DataFrame:
    """The test part of assembled rows that carry their split."""
    return _rows_of(rows, "test")


def train_and_compare(train: DataFrame, test: DataFrame, kinds=("gbt", "gbt_weighted", "mlp"), tune: bool = False,
                      budgets: dict | None = None, overrides: dict | None = None,
                      parallelism: int = 2) -> TrainResult:
    """Fit every family, evaluate on the test split, union the rows, pick the best by AUC."""
    res = TrainResult()
    res.models = fit_concurrently(
        {k: (lambda k=k: fit_model(k, train, tune, (budgets or {}).get(k), 42, parallelism,
                                   (overrides or {}).get(k))) for k in kinds})
    rows = []
    for pos, kind in enumerate(kinds):
        rows.append(evaluate_model(DISPLAY[kind], res.models[kind], test).withColumn("position", F.lit(pos)))
    comp = rows[0]
    for r in rows[1:]:
        comp = comp.unionByName(r)
    res.comparison = comp.orderBy("position")
    best = comp.orderBy(F.desc("roc_auc"), "position").first()
    res.best = [k for k in kinds if DISPLAY[k] == best["model"]][0]
    return res


def best_per_metric(comparison: DataFrame) -> DataFrame:
    """Metric-wise best model: unpivot then top-1 per metric (ties by position)."""
    long = comparison.unpivot(["model", "position"], METRICS, "metric", "value")
    w = Window.partitionBy("metric").orderBy(F.desc("value"), "position")  # <= 3 rows per metric
    return (long.withColumn("r", F.row_number().over(w)).where(F.col("r") == 1)
            .select("metric", F.col("model").alias("best_model"), "value"))


def metadata(comparison: DataFrame, best_kind: str, n_features: int, split: DataFrame) -> DataFrame:
    """best_model, best_roc_auc, best_f1, n_features, n_train, n_test, churn_rate."""
    best = comparison.where(F.col("model") == DISPLAY[best_kind]).first()
    agg = split.agg(
        F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("bigint").alias("n_train"),
        F.sum(F.when(F.col("split") == "test", 1).otherwise(0)).cast("bigint").alias("n_test"),
        (F.sum(F.col(LABEL)) / F.count(F.lit(1))).alias("churn_rate"))
    return agg.select(F.lit(best["model"]).alias("best_model"), F.lit(best["roc_auc"]).alias("best_roc_auc"),
                      F.lit(best["f1"]).alias("best_f1"), F.lit(n_features).alias("n_features"),
                      "n_train", "n_test", "churn_rate")


def save_models(spark: SparkSession, res: TrainResult, path: str) -> None:
    from churnkit.sources.models import save_model

    for kind, model in res.models.items():
        save_model(spark, model, f"{path}/{kind}")
