"""Range splits that the data choose, quantile sketches, sparse encoding, Kernel SHAP, resumable search."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnkit.operators import attribution as A
from churnkit.operators import evaluate, profile, sketches, sparse, stats, train
from churnkit.operators.features import FeatureModel
from churnkit.operators.sampling import bounded_sample


# ------------------------------------------------------------------ ranges
@pytest.mark.parametrize("value", ["0.70 + id / 2000000", "1000 + id / 200", "CASE WHEN id < 19000 THEN id / 1e9 ELSE id END", "id - 10000"])
def test_crowded_values_spread_over_all_ranges(spark, value):
    df = spark.range(20_000).selectExpr(f"CAST({value} AS DOUBLE) AS v", "1 AS c")
    cuts = stats.cut_points(df, "v", 16)
    sizes = [r["n"] for r in df.groupBy(stats.range_of(F.col("v"), cuts).alias("r")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * 20_000 / 16
    x = stats.prefix_sum(df, "v", "c", "before", "total", ranges=16).orderBy("v").collect()
    assert [r["before"] for r in x] == list(range(20_000)) and x[0]["total"] == 20_000


def test_range_of_is_a_plain_search(spark):
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 7, 8, 20):
        cuts = sorted({round(float(c), 2) for c in rng.normal(size=n)})
        values = [-math.inf, *cuts, *(c + 0.001 for c in cuts), *rng.normal(size=20).tolist(), math.inf]
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        assert [r[1] for r in df.select("v", stats.range_of(F.col("v"), cuts)).collect()] == [sum(c < v for c in cuts) for v in values]


@pytest.mark.parametrize("ranges", [2, 5, 64])
def test_auc_and_median_do_not_depend_on_the_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(stats, "range_count", lambda df: ranges)
    rng = np.random.default_rng(1)
    p, y = np.round(0.70 + rng.random(800) / 100, 5), rng.integers(0, 2, 800)
    df = spark.createDataFrame(list(zip(p.tolist(), y.tolist())), "p double, Churn int").repartition(3)
    wins = sum(float((a > p[y == 0]).sum()) + 0.5 * float((a == p[y == 0]).sum()) for a in p[y == 1])
    got = evaluate.score_metrics(df, threshold=0.705).first()
    assert got["roc_auc"] == round(wins / (y.sum() * (1 - y).sum()), 4)
    hit = p >= 0.705
    assert (got["tp"], got["fp"], got["tn"], got["fn"]) == tuple(int(x.sum()) for x in (hit & (y == 1), hit & (y == 0), ~hit & (y == 0), ~hit & (y == 1)))
    assert stats.exact_median(df, "p") == pytest.approx(float(np.median(p)), abs=1e-15)
    same = evaluate.class_metrics(df.withColumn("prediction", (F.col("p") >= 0.705).cast("int"))).first()
    assert all(same[m] == got[m] for m in ("accuracy", "precision", "recall", "f1"))


def test_metrics_of_odd_tables(spark):
    kind = "p double, Churn int"
    empty = evaluate.score_metrics(spark.createDataFrame([], kind)).first()
    assert (empty["tp"], empty["n_pos"], empty["accuracy"], empty["roc_auc"]) == (0, 0, 0.0, None)
    one = evaluate.score_metrics(spark.createDataFrame([(0.5, 1), (0.5, 1), (None, 0)], kind)).first()
    assert (one["n_pos"], one["n_neg"], one["recall"], one["roc_auc"]) == (2, 0, 1.0, None)
    assert evaluate.score_metrics(spark.createDataFrame([(0.5, 1), (0.5, 0)], kind)).first()["roc_auc"] == 0.5
    assert stats.exact_median(spark.createDataFrame([], kind), "p") is None


# ------------------------------------------------------------------ sketches
def test_merged_sketches_stay_within_their_rank_error(spark):
    rng = np.random.default_rng(2)
    v = rng.lognormal(size=60_000)
    df = spark.createDataFrame([(int(i % 40), float(x)) for i, x in enumerate(v)], "day int, v double").repartition(9)
    days = sketches.sketch_by(df, ["day"], "v", k=256).withColumn("half", F.col("day") % 2)
    ranks = {f"q{i}": i / 20 for i in range(1, 20)}
    for keep, rows in ((["half"], 2), ([], 1)):
        got = sketches.quantiles(sketches.merge_by(days, keep, k=256), keep, ranks).collect()
        assert len(got) == rows
        for r in got:
            part = np.sort(v if not keep else v[np.arange(len(v)) % 40 % 2 == r["half"]])
            assert r["n"] == len(part)
            assert max(abs(np.searchsorted(part, r[c]) / len(part) - q) for c, q in ranks.items()) < 2 * sketches.rank_error(256)


def test_small_sketches_are_exact(spark, raw):
    df = raw.select(F.col("Churn"), F.col("MonthlyCharges").alias("v")).unionByName(spark.createDataFrame([("Yes", None), ("Yes", float("nan"))], "Churn string, v double"))
    got = sketches.quantiles(sketches.merge_by(sketches.sketch_by(df, ["Churn"], "v"), []), [], {"q1": 0.25, "q2": 0.5}).first()
    v = sorted(r["v"] for r in raw.select(F.col("MonthlyCharges").alias("v")).collect())
    assert (got["n"], got["q1"], got["q2"]) == (len(v), v[math.ceil(0.25 * len(v)) - 1], v[math.ceil(0.5 * len(v)) - 1])
    assert profile.box_stats(raw.withColumn("Churn", F.lit(1)), "MonthlyCharges").count() == 1


# ------------------------------------------------------------------ sparse encoding
def test_sparse_vectors_equal_the_assembled_ones(spark, raw, fm):
    odd = raw.withColumn("Contract", F.when(F.col("customerID") < "C0000005", "Weekly").otherwise(F.col("Contract"))).withColumn(
        "gender", F.when(F.col("customerID") > "C0000140", F.lit(None)).otherwise(F.col("gender")))
    featured = fm.engineer(fm.clean(odd))
    dense = {r["customerID"]: r["features"].toArray().tolist() for r in fm.assemble(fm.encode(featured)).collect()}
    rows = sparse.vectorize(fm, featured).select("customerID", "features").collect()
    assert len(rows) == len(dense) and all(r["features"].toArray().tolist() == dense[r["customerID"]] for r in rows)


def test_fifty_thousand_levels_encode_and_train(spark, raw):
    wide = (spark.range(50_000).crossJoin(raw.limit(1).drop("PaymentMethod", "customerID"))
            .withColumn("PaymentMethod", F.format_string("m%05d", F.col("id"))).withColumn("customerID", F.col("id").cast("string")))
    fm = FeatureModel.fit(wide)
    rows = sparse.vectorize(fm, fm.engineer(fm.clean(wide))).withColumn("label", (F.col("id") % 2).cast("double")).select("id", "features", "label")
    at = {r["id"]: r["features"] for r in rows.where("id IN (0, 1, 49999)").collect()}
    assert at[0].size > 50_000 and at[1].numNonzeros() == at[0].numNonzeros() + 1 == at[49999].numNonzeros()
    model = LogisticRegression(maxIter=2).fit(rows)
    assert model.numFeatures == at[0].size


# ------------------------------------------------------------------ Kernel SHAP
def _rows(spark, n, d, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] * x[:, 1] + x[:, 2] + 0.3 * rng.normal(size=n) > 0).astype(float)
    return spark.createDataFrame([(f"c{i:04d}", Vectors.dense(v.tolist()), t) for i, (v, t) in enumerate(zip(x, y.tolist()))], ["customerID", "features", "label"])


def _exact(f, x, centres):
    """Shapley values of the game v(S) = sum of w f(x on S, centre elsewhere), by all subsets."""
    d = len(x)
    value = {}
    for size in range(d + 1):
        for s in itertools.combinations(range(d), size):
            mixed = np.array([[x[i] if i in s else c[i] for i in range(d)] for c, _ in centres])
            value[s] = float(np.dot(f(mixed), [w for _, w in centres]))
    phi = np.zeros(d)
    for i in range(d):
        for s in value:
            if i not in s:
                weight = math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d)
                phi[i] += weight * (value[tuple(sorted((*s, i)))] - value[s])
    return phi, value[()]


def _scores(spark, model):
    def f(x):
        df = spark.createDataFrame([(i, Vectors.dense(v.tolist())) for i, v in enumerate(x)], ["i", "features"])
        return np.array([r[1] for r in model.transform(df).select("i", vector_to_array("probability")[1]).orderBy("i").collect()])
    return f


def test_kernel_shap_with_all_coalitions_is_exact(spark):
    df = _rows(spark, 200, 5)
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(df)
    centres = A.background_centres(bounded_sample(df.select("customerID", "features"), "customerID", 30), 2)
    assert abs(sum(w for _, w in centres) - 1) < 1e-12 and len(centres) == 2
    few = df.where("customerID < 'c0003'")
    for r in A.kernel_shap(model, few, centres, 5, pairs=15).collect():
        phi, base = _exact(_scores(spark, model), r["attr_values"], centres)
        assert np.abs(phi - r["attr_impacts"]).max() < 1e-9 and abs(base - r["base_value"]) < 1e-12


def test_kernel_shap_is_exact_on_linear_models_and_adds_up(spark):
    df = _rows(spark, 150, 12)
    model = LogisticRegression(maxIter=20).fit(df)
    centres = A.background_centres(df, 1)
    log_odds = {}
    for r in A.kernel_shap(model, df, centres, 12, pairs=14, link="logit").collect():
        linear = np.array(model.coefficients.toArray()) * (np.array(r["attr_values"]) - centres[0][0])
        assert np.abs(linear - r["attr_impacts"]).max() < 1e-8
        log_odds[r["customerID"]] = r["base_value"] + sum(r["attr_impacts"])
    for r in model.transform(df).select("customerID", vector_to_array("rawPrediction")[1].alias("z")).collect():
        assert abs(log_odds[r["customerID"]] - r["z"]) < 1e-8
    f = {r["customerID"]: r["f"] for r in model.transform(df).select("customerID", vector_to_array("probability")[1].alias("f")).collect()}
    for r in A.kernel_shap(model, df, centres, 12, pairs=14).collect():
        assert abs(r["base_value"] + sum(r["attr_impacts"]) - f[r["customerID"]]) < 1e-9
    assert A.kernel_shap(model, df, [], 12).count() == 0


def test_kernel_shap_needs_fewer_points_than_permutations(spark):
    d, df = 10, _rows(spark, 300, 10, 3)
    model = GBTClassifier(maxIter=8, maxDepth=4, seed=1).fit(df)
    centres = [([0.0] * d, 1.0)]
    few = df.where("customerID < 'c0012'").cache()
    background = spark.createDataFrame([("b", Vectors.dense([0.0] * d), 1)], ["customerID", "features", "sample_rank"])
    exact = {r["customerID"]: np.array(r["attr_impacts"]) for r in A.kernel_shap(model, few, centres, d, pairs=2 ** (d - 1) - 1).collect()}
    error = lambda out: np.mean([np.abs(exact[r["customerID"]] - r["attr_impacts"]).mean() for r in out.collect()])
    kernel = error(A.kernel_shap(model, few, centres, d, pairs=26))                                # 53 points a row
    sampled = error(A.sampled_shapley(model, few, background, d, permutations=8))                  # 88 points a row
    assert kernel < sampled


def test_paired_coalitions():
    for d, pairs in ((2, 5), (5, 15), (6, 40), (12, 30), (45, 90)):
        z, w = A.paired_coalitions(d, pairs)
        half = len(z) // 2
        assert (z[:half] ^ z[half:]).all() and half <= pairs and (w > 0).all() and (w[:half] == w[half:]).all()
        assert len({r.tobytes() for r in z}) == len(z) and abs(w.sum() - sum((d - 1) / (s * (d - s)) for s in range(1, d))) < 1e-9


# ------------------------------------------------------------------ search
def test_a_search_that_was_cut_off_goes_on(spark, raw, fm, tmp_path):
    from churnkit.operators import sampling

    rows, _ = train.prepare_training(fm.assemble(sampling.stratified_split(fm.transform(raw), "customerID", "Churn")))
    points = train.draw_grid({"maxIter": [2, 3], "maxDepth": [2, 3], "stepSize": [0.1, 0.3]}, 4)
    whole = train.search("gbt", rows, points, str(tmp_path / "a"))
    assert whole["fits"] == 4 + 2 * 2                                  # half of the candidates stop after fold 0
    cut = str(tmp_path / "b")
    assert train.search("gbt", rows, points, cut, max_fits=3) is None and train.search("gbt", rows, points, cut, max_fits=2) is None
    assert spark.read.parquet(cut).count() == 5
    rest = train.search("gbt", rows, points, cut)
    assert rest["fits"] == 3 and {k: rest[k] for k in ("candidate", "params", "roc_auc")} == {k: whole[k] for k in ("candidate", "params", "roc_auc")}
    assert train.search("gbt", rows, points, cut)["fits"] == 0
    table = lambda p: sorted(map(tuple, spark.read.parquet(p).collect()))
    assert table(cut) == table(str(tmp_path / "a"))
    with pytest.raises(ValueError):
        train.search("gbt", rows, points[::-1], cut)


def test_search_query_judges_the_whole_budget_on_all_folds(spark, monkeypatch):
    """As many draws of the full grids as the reference's searches make, for each of the compared families."""
    from churnkit.plans import jobs

    asked = {}

    def search(kind, rows, points, results, folds=3, keep=0.5, **_):
        asked[kind] = (points, folds, keep, sorted(r["fold"] for r in rows.select("fold").distinct().collect()))
        return {"candidate": 3, "params": points[3], "roc_auc": 0.812345, "fits": 0}

    monkeypatch.setattr(train, "search", search)
    got = jobs.q_search_compare(spark, "/root/testdata/sf0.001").collect()
    grids = {"gbt": (train.GBT_GRID, 40), "gbt_weighted": (train.GBT_WEIGHTED_GRID, 40), "mlp": (train.MLP_GRID, 20)}
    assert asked == {k: (train.draw_grid(grid, n), 3, 1.0, [0, 1, 2]) for k, (grid, n) in grids.items()}
    assert sum(len(points) * folds for points, folds, _, _ in asked.values()) == 300
    assert [(r["model"], r["candidate"], r["mean_roc_auc"]) for r in got] == [(train.DISPLAY[k], 3, 0.8123) for k in grids]


def test_search_of_all_folds_keeps_no_stage_tables(spark, raw, fm, tmp_path):
    import os

    from churnkit.operators import sampling
    from churnkit.session import checkpoint_dir

    rows, _ = train.prepare_training(fm.assemble(sampling.stratified_split(fm.transform(raw), "customerID", "Churn")))
    tables = lambda: {f for f in os.listdir(checkpoint_dir(spark).removeprefix("file://")) if f.startswith(("network-blocks", "scores"))}
    before, points = tables(), [{"hidden": (4,), "steps": 2, "epochs": e} for e in (1, 2)]
    best = train.search("mlp", rows, points, str(tmp_path / "a"), keep=1.0, parallelism=3)
    judged = {(r["candidate"], r["fold"]): r["roc_auc"] for r in spark.read.parquet(str(tmp_path / "a")).collect()}
    assert best["fits"] == 6 and set(judged) == {(c, f) for c in (0, 1) for f in (0, 1, 2)} and tables() == before
    mean = [sum(judged[c, f] for f in range(3)) / 3 for c in (0, 1)]
    assert (best["candidate"], best["roc_auc"]) == (mean.index(max(mean)), pytest.approx(max(mean)))


def test_fits_at_once_fill_the_cores():
    """A fit of one task leaves the others to its fellows; a fit that fills the cores has one beside it."""
    assert [train.fits_at_once(n, 50_000, 12) for n in (0, 50_000, 200_000, 300_000, 4_320_000)] == [4, 4, 3, 2, 2]
    assert train.fits_at_once(10, 50_000, 1) == 2
