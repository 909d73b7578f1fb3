"""TreeSHAP against brute force; sampled Shapley additivity; training helpers."""

import math

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnkit.operators.sampling import bounded_sample
from churnkit.operators import attribution as A
from churnkit.operators import train


def brute_force_path_shap(nodes: dict[int, dict], x: np.ndarray) -> tuple[np.ndarray, float]:
    """Exact Shapley over all feature subsets with the
    recursive path-dependent expectation (exponential; tiny trees only)."""
    feats = sorted({n["feat"] for n in nodes.values() if n["left"] >= 0})

    def expect(nid, s):
        n = nodes[nid]
        if n["left"] < 0:
            return n["pred"]
        f = n["feat"]
        if f in s:
            go_left = (x[f] <= n["thr"][0]) if not (n["ncat"] and n["ncat"] > 0) else (x[f] in set(n["thr"]))
            return expect(n["left"] if go_left else n["right"], s)
        lc, rc = nodes[n["left"]]["cover"], nodes[n["right"]]["cover"]
        return (lc * expect(n["left"], s) + rc * expect(n["right"], s)) / (lc + rc)

    d = len(feats)
    phi = np.zeros(int(max(feats) + 1) if feats else 0)
    import itertools
    for i in feats:
        others = [f for f in feats if f != i]
        for r in range(d):
            for sub in itertools.combinations(others, r):
                wgt = math.factorial(r) * math.factorial(d - r - 1) / math.factorial(d)
                phi[i] += wgt * (expect(0, set(sub) | {i}) - expect(0, set(sub)))
    return phi, expect(0, set())


def _toy(spark, n=200, d=3, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(f"c{i:04d}", Vectors.dense(rng.integers(0, 5, d).astype(float).tolist()),
             float(rng.integers(0, 2))) for i in range(n)]
    return spark.createDataFrame(rows, ["customerID", "features", "label"])


def test_tree_shap_matches_brute_force(spark):
    df = _toy(spark)
    m = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(df)
    nodes = A._tree_nodes(m)
    out = A.tree_shap(m, df).toPandas()
    raw = {r[0]: r[1] for r in m.transform(df).select(
        "customerID", vector_to_array("rawPrediction")[1]).collect()}
    for _, r in out.head(30).iterrows():
        x = np.array(r.attr_values)
        tot, base = np.zeros(3), 0.0
        for t, w in zip(sorted(nodes), m.treeWeights):
            phi, e = brute_force_path_shap(nodes[t], x)
            tot[:len(phi)] += 2 * w * phi
            base += 2 * w * e
        assert np.abs(tot - np.array(r.attr_impacts)).max() < 1e-9
        assert abs(base - r.base_value) < 1e-9
        assert abs(r.base_value + sum(r.attr_impacts) - 2 * raw[r.customerID]) < 1e-9


def test_leaf_table_direct_agree():
    z = np.array([0.3, 0.6, 0.8])
    tab = A.leaf_table(z, 1.7)
    o = ((np.arange(8)[:, None] >> np.arange(3)[None, :]) & 1).astype(float)
    assert np.allclose(tab, A.leaf_values_direct(o, z, 1.7))


def test_sampled_shapley_additive_and_linear(spark):
    df = _toy(spark, n=60, d=3, seed=2)
    lr = LogisticRegression(maxIter=20).fit(df)
    ex = df.limit(5)
    background = bounded_sample(df.select("customerID", "features"), "customerID", 20)
    out = A.sampled_shapley(lr, ex, background, 3, permutations=6).collect()
    probs = {r[0]: r[1] for r in lr.transform(ex).select("customerID", vector_to_array("probability")[1]).collect()}
    for r in out:
        # efficiency: sum of impacts + mean background score = f(x) exactly
        assert abs(sum(r["attr_impacts"]) + r["base_value"] - probs[r["customerID"]]) < 1e-9


def test_points_carry_their_row_once(spark, monkeypatch):
    """Points are sorted by key to be gathered: each holds its own features, one of them the explained row."""
    df = _toy(spark, n=40, d=4, seed=3)
    lr = LogisticRegression(maxIter=20).fit(df)
    background = bounded_sample(df.select("customerID", "features"), "customerID", 10)
    seen = []

    class Watched:
        def transform(self, points):
            seen.append(points)
            return lr.transform(points)

    sampled = A.sampled_shapley(Watched(), df, background, 4, permutations=3)
    kernel = A.kernel_shap(Watched(), df, A.background_centres(background, 2), 4)
    x = {r[0]: r[1] for r in df.select("customerID", vector_to_array("features")).collect()}
    assert {r["customerID"]: r["attr_values"] for r in sampled.collect()} == x == {r["customerID"]: r["attr_values"] for r in kernel.collect()}
    assert any(abs(i) > 1e-3 for r in sampled.collect() for i in r["attr_impacts"])
    assert all(p.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism for p in (seen[0], seen[-1]))   # not the few that their bytes fill
    for points in (seen[0], seen[-1]):
        arrays = [F.sum(F.col(c).isNotNull().cast("int")).alias(c) for c, kind in points.dtypes if kind.startswith("array")]
        most = points.groupBy("customerID").agg(*arrays, F.count(F.lit(1)).alias("n")).first()
        assert most["n"] >= 3 * 5 and most["_x"] == 1 and (points is not seen[0] or most["_place"] == 3)


def test_tasks_of_a_fit_grow_with_the_cores():
    """Not with the rows, until a task has MOST_TASK_ROWS: each of the thousands of passes pays for every task."""
    assert [train.fit_tasks(n, 50_000, 12) for n in (0, 1, 50_001, 720_000, 4_320_000)] == [1, 1, 2, 12, 12]
    assert train.fit_tasks(3 * train.MOST_TASK_ROWS + 1, 4_000, 2) == 4


def test_draw_grid_distinct_and_seeded():
    a = train.draw_grid(train.GBT_GRID, 40, 42)
    b = train.draw_grid(train.GBT_GRID, 40, 42)
    assert a == b and len({tuple(sorted(p.items())) for p in a}) == 40
    assert all(set(p) == set(train.GBT_GRID) for p in a)


def test_small_search_runs(spark, raw, fm):
    from churnkit.operators import sampling

    enc = fm.transform(raw)
    split = sampling.stratified_split(enc.select("customerID", "Churn"), "customerID", "Churn")
    tr, te = train.prepare_training(fm.assemble(enc), split)
    model = train.fit_model("gbt", tr, tune=True, budget=2, overrides={"maxIter": 3})
    row = train.evaluate_model("GradientBoosting", model, te).first()
    assert 0.0 <= row["roc_auc"] <= 1.0
    comp = spark.createDataFrame([("A", 0.7, 0.5, 0.6, 0.55, 0.8, 0), ("B", 0.8, 0.4, 0.7, 0.5, 0.8, 1)],
                                 "model string, accuracy double, precision double, recall double, f1 double, "
                                 "roc_auc double, position int")
    best = {r["metric"]: r["best_model"] for r in train.best_per_metric(comp).collect()}
    assert best == {"accuracy": "B", "precision": "A", "recall": "B", "f1": "A", "roc_auc": "A"}
    assert F is not None
