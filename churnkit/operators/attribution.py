"""Per-row attribution of model scores as Spark jobs.

Tree ensembles (``tree_shap``): exact path-dependent TreeSHAP (Lundberg, Erion & Lee,
2018) in its per-leaf form. For a leaf L with value v, let D be the distinct features on
its root path; for j in D, z_j is the product of cover fractions (child / parent) of the
path's splits on j, and o_j(x) is 1 when x satisfies all of them. The path-dependent
expectation is E[f | x_S] = sum_L v_L prod_{j in S} o_j prod_{j not in S} z_j, whose
Shapley value for i in D is

    phi_i = v (o_i - z_i) sum_{S subset D \\ {i}} |S|! (d - |S| - 1)! / d!
                                    prod_{j in S} o_j prod_{j in D \\ S \\ {i}} z_j.

o is binary, so per leaf the d values depend only on the pattern of o: the driver
precomputes a (2^d x d) table per leaf from the saved model (node tables are bounded by
model size, not data), broadcasts it, and ``mapInArrow`` looks rows up in
batches -- a gather and a scatter-add per leaf, vectorised over the batch.
Spark's GBT margin is m = sum_t w_t tree_t(x) with P(1) = 1 / (1 + exp(-2 m)), so
impacts are reported in log-odds (x 2 w_t) and base + sum(impacts) = 2 m exactly.

Any model (``sampled_shapley``): Monte-Carlo permutation Shapley (Strumbelj & Kononenko,
2014). For each explained row and permutation k, the coalition path from a background
row to the explained row is materialised as d + 1 vectors and scored with the model's
own ``transform`` (distributed); consecutive differences are attributed to the feature
added at that step and averaged over permutations. Each row expands to m (d + 1) rows.

Any model, fewer points (``kernel_shap``): weighted least squares over paired coalitions against weighted centres of
the background.
"""

from __future__ import annotations

import itertools
import json
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnkit.functions.expr import logistic
from churnkit.schema import KEY
from churnkit.session import ship_package, stage_path

MAX_PATTERN_BITS = 10   # per-leaf tables up to 2^10 x 10; deeper leaves use the direct form
TABLE_BUDGET = 8_000_000  # doubles in all pattern tables (64 MB broadcast); the rest go direct


# ------------------------------------------------------------------ model -> leaf tables
def _tree_nodes(model) -> dict[int, dict[int, dict]]:
    """treeID -> node id -> node dict, read from the model's saved node table."""
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    path = stage_path(session, f"tree-model-{uuid.uuid4().hex}")   # shared checkpoint folder
    model.write().overwrite().save(path)
    rows = session.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, dict]] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = {
            "pred": r["prediction"], "cover": float(r["impurityStats"][0]) if r["impurityStats"] else float(r["rawCount"]),
            "left": r["leftChild"], "right": r["rightChild"],
            "feat": r["split"]["featureIndex"], "thr": list(r["split"]["leftCategoriesOrThreshold"] or []),
            "ncat": r["split"]["numCategories"]}
    return trees


def _leaves(nodes: dict[int, dict]) -> list[dict]:
    """Root-to-leaf walk: per leaf, value and per-feature (lo, hi] / category set and z."""
    out = []

    def walk(nid, cons, zs):
        n = nodes[nid]
        if n["left"] < 0:
            feats = sorted(cons)
            out.append({"v": n["pred"], "feats": feats, "cons": [cons[f] for f in feats],
                        "z": [zs[f] for f in feats]})
            return
        f = n["feat"]
        for child, go_left in ((n["left"], True), (n["right"], False)):
            c = dict(cons)
            z = dict(zs)
            frac = nodes[child]["cover"] / n["cover"] if n["cover"] > 0 else 0.0
            z[f] = z.get(f, 1.0) * frac
            if n["ncat"] is not None and n["ncat"] > 0:
                left_set = set(n["thr"])
                prev = c.get(f, ("cat", set(range(n["ncat"]))))[1]
                allowed = prev & left_set if go_left else prev - left_set
                c[f] = ("cat", allowed)
            else:
                lo, hi = c.get(f, ("num", -math.inf, math.inf))[1:] if f in c else (-math.inf, math.inf)
                thr = n["thr"][0]
                c[f] = ("num", lo, min(hi, thr)) if go_left else ("num", max(lo, thr), hi)
            walk(child, c, z)

    walk(min(nodes), {}, {})                           # the root has the smallest number
    return out


def _shapley_weights(d: int) -> np.ndarray:
    return np.array([math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)])


def leaf_table(z: np.ndarray, v: float) -> np.ndarray:
    """(2^d, d) Shapley values of one leaf for every pattern of o (bit j = o_j)."""
    d = len(z)
    codes = np.arange(2 ** d)
    o = ((codes[:, None] >> np.arange(d)[None, :]) & 1).astype(float)
    w = _shapley_weights(d)
    tab = np.zeros((2 ** d, d))
    for i in range(d):
        coef = np.zeros((2 ** d, d))
        coef[:, 0] = 1.0
        for j in range(d):
            if j == i:
                continue
            shifted = np.zeros_like(coef)
            shifted[:, 1:] = coef[:, :-1]
            coef = coef * z[j] + shifted * o[:, [j]]
        tab[:, i] = v * (o[:, i] - z[i]) * (coef @ w)
    return tab


def leaf_values_direct(o: np.ndarray, z: np.ndarray, v: float) -> np.ndarray:
    """Same as ``leaf_table`` for given rows' patterns o (B, d); used for deep leaves."""
    b, d = o.shape
    w = _shapley_weights(d)
    out = np.zeros((b, d))
    for i in range(d):
        coef = np.zeros((b, d))
        coef[:, 0] = 1.0
        for j in range(d):
            if j == i:
                continue
            shifted = np.zeros_like(coef)
            shifted[:, 1:] = coef[:, :-1]
            coef = coef * z[j] + shifted * o[:, [j]]
        out[:, i] = v * (o[:, i] - z[i]) * (coef @ w)
    return out


class TreeExplainerTables:
    """Flat, picklable description of an ensemble for the executors."""

    def __init__(self, trees: list[list[dict]], weights: list[float], scale: float, offset: float = 0.0):
        self.leaves = []   # (tree weight, v, feats, cons, z, table or None)
        self.offset = self.base = offset
        # pattern tables for the shallowest leaves first, within a fixed memory budget, so
        # the broadcast stays bounded whatever the ensemble's depth and size
        flat = [(w, lf) for t, w in zip(trees, weights) for lf in t]
        budget = TABLE_BUDGET
        with_table = set()
        for i in sorted(range(len(flat)), key=lambda i: len(flat[i][1]["z"])):
            d = len(flat[i][1]["z"])
            size = (2 ** d) * d
            if d <= MAX_PATTERN_BITS and size <= budget:
                with_table.add(i)
                budget -= size
        for i, (w, lf) in enumerate(flat):
            z = np.array(lf["z"], dtype=float)
            d = len(z)
            tab = leaf_table(z, lf["v"]) if i in with_table else None
            self.leaves.append((w * scale, lf["v"], np.array(lf["feats"], dtype=int), lf["cons"], z, tab))
            self.base += w * scale * lf["v"] * float(np.prod(z)) if d else w * scale * lf["v"]

        self._group()

    def _group(self, max_cells: int = 4_000_000) -> None:
        """Stack table leaves with numeric conditions by path length d, so a batch is
        explained with a few large numpy operations per group instead of per leaf."""
        self.groups = []
        self.loose = []
        by_d: dict[int, list[int]] = {}
        for i, (w, v, feats, cons, z, tab) in enumerate(self.leaves):
            if len(feats) and tab is not None and all(c[0] == "num" for c in cons):
                by_d.setdefault(len(feats), []).append(i)
            else:
                self.loose.append(i)
        self.max_cells = max_cells
        for d, idx in sorted(by_d.items()):
            lv = [self.leaves[i] for i in idx]
            self.groups.append({
                "d": d,
                "wv": np.array([l[0] * l[1] for l in lv]),
                "w": np.array([l[0] for l in lv]),
                "feats": np.stack([l[2] for l in lv]),
                "lo": np.array([[c[1] for c in l[3]] for l in lv]),
                "hi": np.array([[c[2] for c in l[3]] for l in lv]),
                "tab": np.stack([l[5] for l in lv]),
            })

    def explain(self, x: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
        """(impacts (B, n_features), margin (B,)) for a batch of feature rows."""
        b = x.shape[0]
        flat = np.zeros(b * n_features)
        margin = np.full(b, self.offset)
        row_base = np.arange(b)[:, None, None] * n_features
        for g in self.groups:
            d = g["d"]
            bits = 1 << np.arange(d)
            step = max(1, self.max_cells // max(1, b * d))
            for s in range(0, len(g["w"]), step):
                e = min(s + step, len(g["w"]))
                feats = g["feats"][s:e]
                xs = x[:, feats]                                   # (B, L, d)
                hi = g["hi"][s:e]                                  # a missing value (NaN) goes right at every split
                o = ~(xs <= g["lo"][s:e]) & ((xs <= hi) | np.isposinf(hi))
                code = (o * bits).sum(axis=-1)                     # (B, L)
                margin += o.all(axis=-1) @ g["wv"][s:e]
                vals = g["tab"][s:e][np.arange(e - s)[None, :], code] * g["w"][s:e][None, :, None]
                flat += np.bincount((row_base + feats[None]).ravel(), weights=vals.ravel(),
                                    minlength=b * n_features)
        phi = flat.reshape(b, n_features)
        for i in self.loose:
            w, v, feats, cons, z, tab = self.leaves[i]
            d = len(feats)
            if d == 0:
                margin += w * v
                continue
            o = np.empty((b, d), dtype=bool)
            for j, (f, c) in enumerate(zip(feats, cons)):
                col = x[:, f]
                if c[0] == "num":
                    o[:, j] = ~(col <= c[1]) & ((col <= c[2]) | np.isposinf(c[2]))
                else:
                    o[:, j] = np.isin(col, list(c[1]))
            margin += w * v * o.all(axis=1)
            if tab is not None:
                code = (o.astype(np.int64) << np.arange(d)[None, :]).sum(axis=1)
                phi[:, feats] += w * tab[code]
            else:
                phi[:, feats] += w * leaf_values_direct(o.astype(float), z, v)
        return phi, margin


def explainer_for(model, log_odds_scale: float = 2.0) -> TreeExplainerTables:
    """Tables for a GBT classification model (or a PipelineModel ending in one), kept with the model object
    and gone with it."""
    if hasattr(model, "stages"):
        model = model.stages[-1]
    kept = model.__dict__.setdefault("_explainer_tables", {})
    key = (log_odds_scale, TABLE_BUDGET)
    if key not in kept:
        kept[key] = _build_explainer(model, log_odds_scale)
    return kept[key]


def _build_explainer(model, log_odds_scale: float) -> TreeExplainerTables:
    if hasattr(model, "node_tables"):                      # leaf-wise trees, in log-odds from a base
        tables = model.node_tables()
        return TreeExplainerTables([_leaves(t) for t in tables], [1.0] * len(tables), 1.0, model.base)
    nodes = _tree_nodes(model)
    trees = [_leaves(nodes[t]) for t in sorted(nodes)]
    weights = list(getattr(model, "treeWeights", [1.0] * len(trees)))
    return TreeExplainerTables(trees, weights, log_odds_scale)


def _tasks(spark) -> int:
    """Tasks over which rows to explain are dealt: few bytes, much work, so AQE would put them into too few. As many as the session's
    shuffles have, which grows with the data, and two a core at least."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def tree_shap(model, assembled: DataFrame, features_col: str = "features",
              key: str = KEY, keep: list[str] | None = None, n_features: int | None = None) -> DataFrame:
    """key, attr_values, attr_impacts (log-odds), base_value, margin -- one pass in Arrow batches, on tables and streams.

    ``n_features`` is read from the vector's attributes, or else from a row, which a stream does not give."""
    tables = explainer_for(model)
    if n_features is None:
        n_features = len(assembled.select(features_col).schema[0].metadata.get("ml_attr", {})
                         .get("attrs", {}).get("numeric", [])) or None
    spark = assembled.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(tables)      # model-sized; Spark drops it when the plan is gone
    keep = keep or []
    # ~1 ms of Python per row: spread the rows before the explanation (a round-robin shuffle is cheap next to it)
    parts = _tasks(spark)
    src = (assembled.select(key, *keep, vector_to_array(features_col).alias("attr_values"))
           .repartition(parts))
    if n_features is None:
        n_features = len(src.first()["attr_values"])
    nf, at = int(n_features), 1 + len(keep)
    base = float(tables.base)
    schema = T.StructType([*src.schema.fields[:at], *(T.StructField(n, t) for n, t in (
        ("attr_values", T.ArrayType(T.DoubleType())), ("attr_impacts", T.ArrayType(T.DoubleType())),
        ("base_value", T.DoubleType()), ("margin", T.DoubleType())))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        t = bc.value
        for b in batches:
            x = b.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, nf)
            phi, margin = t.explain(x, nf)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * nf)
            lists = [pa.ListArray.from_arrays(ends, pa.array(v.ravel())) for v in (x, phi)]
            yield pa.RecordBatch.from_arrays(
                [c.cast(k) for c, k in zip([*b.columns[:at], *lists, pa.array(np.full(b.num_rows, base)), pa.array(margin + 0.0)], arrow.types)],
                names=arrow.names)

    return src.mapInArrow(run, schema)


def explained(model, feature_model, encoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Encoded rows scored by a boosted model with their attributions: key, ``keep``, attr_values, attr_impacts, base_value, margin, p.

    p comes from the same pass, whose margin is the model's log-odds. No row needs another, so streams work too."""
    rows = tree_shap(model, feature_model.assemble(encoded), keep=keep, n_features=len(feature_model.feature_names))
    return rows.withColumn("p", logistic(F.col("margin")))


# --------------------------------------------------------------- sampled (any model)
def sampled_shapley(model, explained: DataFrame, background: DataFrame, n_features: int,
                    features_col: str = "features", key: str = KEY, permutations: int = 8,
                    seed: int = 42, rank_col: str = "sample_rank") -> DataFrame:
    """Monte-Carlo permutation Shapley of P(class 1) for every row of ``explained``.

    ``explained``: (key, features), any number of rows with distinct keys; the cost is linear in
    them. ``background``: features with ``rank_col`` = 1..n, as ``sampling.bounded_sample`` numbers
    its rows; its size is the estimator's parameter. The explained rows are placed by key once: their
    points are exploded, scored and gathered again (permutations x (d + 1) per key) where they are.
    An empty background leaves no rows. Output: key, attr_values, attr_impacts (probability units),
    base_value (mean background score)."""
    d = n_features
    bg = background.select((F.col(rank_col) - 1).alias("bid"), vector_to_array(features_col).alias("b"))
    nb = bg.count()
    ex = explained.select(key, vector_to_array(features_col).alias("x")).repartition(_tasks(explained.sparkSession), key)
    if nb == 0:
        return ex.select(key, F.col("x").alias("attr_values"), F.col("x").alias("attr_impacts"),
                         F.lit(0.0).alias("base_value")).where(F.lit(False))
    perms = ex.select(key, "x", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("k"))
    perms = perms.withColumn("bid", F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col("k")), F.lit(nb)))
    perms = perms.join(F.broadcast(bg), "bid")         # as many rows as the parameter says
    features = F.sequence(F.lit(0), F.lit(d - 1))
    drawn = F.array_sort(F.transform(features, lambda i: F.struct(
        F.xxhash64(F.lit(seed), F.col(key), F.col("k"), i).alias("h"), i.alias("i"))))
    # place of each feature in the permutation, inverted once per (row, permutation)
    placed = F.array_sort(F.transform(drawn, lambda s, place: F.struct(s["i"].alias("i"), place.alias("place"))))
    perms = perms.select(key, "x", "k", "b", F.transform(placed, lambda s: s["place"]).alias("place"))
    point = F.transform(features, lambda i: F.when(F.col("place")[i] < F.col("j"), F.col("x")[i])
                        .otherwise(F.col("b")[i]))
    # the row and its permutation go along with one point each: the points are sorted by key to be gathered
    pts = (perms.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(d))))
           .select(key, "k", F.when((F.col("k") == 0) & (F.col("j") == 0), F.col("x")).alias("_x"),
                   F.when(F.col("j") == 0, F.col("place")).alias("_place"), "j", array_to_vector(point).alias(features_col)))
    scored = model.transform(pts).select(key, "k", "_x", "_place", "j",
                                         vector_to_array("probability")[1].alias("f"))
    per_perm = scored.groupBy(key, "k").agg(
        F.first("_x", ignorenulls=True).alias("x"), F.first("_place", ignorenulls=True).alias("place"),
        F.transform(F.sort_array(F.collect_list(F.struct("j", "f"))), lambda s: s["f"]).alias("f"))
    per_perm = per_perm.select(key, "k", "x", F.col("f")[0].alias("base_f"), F.transform(
        "place", lambda p: F.col("f")[p + 1] - F.col("f")[p]).alias("delta"))
    per_key = per_perm.groupBy(key).agg(
        F.first("x", ignorenulls=True).alias("x"), F.avg("base_f").alias("base_value"),
        F.transform(F.sort_array(F.collect_list(F.struct("k", "delta"))), lambda s: s["delta"]).alias("deltas"))
    mean = F.transform(features, lambda i: F.aggregate(
        "deltas", F.lit(0.0), lambda total, one: total + one[i]) / F.lit(float(permutations)))
    return per_key.select(key, F.col("x").alias("attr_values"), mean.alias("attr_impacts"), "base_value")


# ---------------------------------------------------------------- Kernel SHAP (any model)
def background_centres(background: DataFrame, k: int, features_col: str = "features", seed: int = 42) -> list[tuple[list[float], float]]:
    """(centre, weight) of ``k`` clusters of the background rows, weights summing to 1; one centre is their mean."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.stat import Summarizer

    if k == 1:
        row = background.agg(Summarizer.mean(F.col(features_col)).alias("m"), F.count(F.lit(1)).alias("n")).first()
        return [(list(map(float, row["m"])), 1.0)] if row["n"] else []
    model = KMeans(k=k, seed=seed, featuresCol=features_col, predictionCol="_c").fit(background)
    sizes = {r["_c"]: r["n"] for r in model.transform(background).groupBy("_c").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    return [(list(map(float, c)), sizes[i] / total) for i, c in enumerate(model.clusterCenters()) if sizes.get(i)]


def paired_coalitions(d: int, pairs: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(z, weight): at most 2 x ``pairs`` coalitions of d features, each with its complement, and their Shapley kernel weights.

    Sizes are enumerated from the outside (1 and d - 1 first) while a whole size fits; the mass of the other sizes is
    shared by coalitions drawn from them, repeated draws adding up."""
    rng, left = np.random.default_rng(seed), pairs
    rows: dict[bytes, float] = {}
    sizes = list(range(1, d // 2 + 1))
    mass = {s: (d - 1) / (s * (d - s)) * (1 if 2 * s == d else 2) for s in sizes}      # both of a pair
    drawn = []
    for s in sizes:
        whole = math.comb(d, s) // (2 if 2 * s == d else 1)
        if drawn or whole > left:
            drawn.append(s)
            continue
        for members in itertools.combinations(range(d), s):
            z = np.zeros(d, bool)
            z[list(members)] = True
            if 2 * s < d or z[0]:
                rows[z.tobytes()] = mass[s] / whole
        left -= whole
    if drawn and left:
        p = np.array([mass[s] for s in drawn])
        for s in rng.choice(drawn, left, p=p / p.sum()):
            z = np.zeros(d, bool)
            z[rng.permutation(d)[:s]] = True
            if 2 * s == d and not z[0]:
                z = ~z
            rows[z.tobytes()] = rows.get(z.tobytes(), 0.0) + p.sum() / left
    z = np.array([np.frombuffer(k, bool) for k in rows]).reshape(len(rows), d)
    w = np.array(list(rows.values())) / 2
    return np.concatenate([z, ~z]), np.concatenate([w, w])


def kernel_solution(z: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(g, h) with impacts = g (v - base) + h (f(x) - base): the weighted least squares over the coalitions, its impacts made
    to add up to f(x) - base. One small solve for all rows, as the coalitions are theirs alike."""
    x = z.astype(float)
    normal = np.linalg.pinv(x.T @ (x * w[:, None]))
    ones = normal.sum(axis=1)
    right = x.T * w
    return normal @ right - np.outer(ones, ones @ right) / ones.sum(), ones / ones.sum()


def kernel_shap(model, explained: DataFrame, centres: list[tuple[list[float], float]], n_features: int, features_col: str = "features",
                key: str = KEY, pairs: int | None = None, link: str = "identity", seed: int = 42) -> DataFrame:
    """Kernel SHAP (Lundberg & Lee, 2017) of P(class 1) for every row of ``explained`` (key, features; distinct keys).

    Each row is scored by the model's own ``transform`` at paired coalitions with the weighted ``centres`` of a background
    (``background_centres``), 2 x ``pairs`` x centres points a row, ``pairs`` = 2 d by default. The rows are placed by key once: their points
    are exploded, scored and gathered again where they are. Exact for a model that is linear in the ``link`` ('identity', 'logit') and, at
    any model, where ``pairs`` covers all coalitions. base_value + sum(impacts) = link(f(x)). No centres: no rows.
    Output: key, attr_values, attr_impacts, base_value."""
    d = n_features
    ex = explained.select(key, vector_to_array(features_col).alias("x")).repartition(_tasks(explained.sparkSession), key)
    if not centres:
        return ex.select(key, F.col("x").alias("attr_values"), F.col("x").alias("attr_impacts"), F.lit(0.0).alias("base_value")).where(F.lit(False))
    z, w = paired_coalitions(d, 2 * d if pairs is None else pairs, seed)
    z = np.concatenate([z, np.ones((1, d), bool)])                       # the last one is the row itself
    constant = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)  # noqa: E731 -- one literal in the plan
    shares = np.array([s for _, s in centres])
    probability = vector_to_array("probability")[1]
    at_centre = model.transform(explained.sparkSession.createDataFrame([(i, Vectors.dense(c)) for i, (c, _) in enumerate(centres)], ["c", features_col]))
    f_base = [r["f"] for r in at_centre.select("c", probability.alias("f")).orderBy("c").collect()]       # a row a centre
    mixed = F.zip_with("x", F.zip_with(F.split("z", ","), "b", lambda on, b: F.when(on == "0", b)), lambda v, b: F.coalesce(b, v))
    coalitions = constant([",".join("1" if on else "0" for on in row) for row in z], "array<string>")
    points = (ex.select(key, "x", F.posexplode(coalitions).alias("j", "z"))
              .select(key, "x", "j", "z", F.posexplode(constant([c for c, _ in centres], "array<array<double>>")).alias("c", "b"))
              .select(key, F.when((F.col("j") == 0) & (F.col("c") == 0), F.col("x")).alias("_x"),      # once a row: the points are sorted by key
                      "j", "c", array_to_vector(mixed).alias(features_col)))
    scored = model.transform(points).select(key, "_x", "j", "c", probability.alias("f"))
    rows = scored.groupBy(key).agg(F.first("_x", ignorenulls=True).alias("attr_values"), F.transform(
        F.sort_array(F.collect_list(F.struct("j", "c", "f"))), lambda s: s["f"]).alias("f"))
    g, h = kernel_solution(z[:-1], w)
    ship_package(explained.sparkSession)
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("attr_impacts", T.ArrayType(T.DoubleType())), T.StructField("base_value", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def linked(f: np.ndarray) -> np.ndarray:
        return np.log(f) - np.log1p(-f) if link == "logit" else f

    base = float(linked(shares @ np.array(f_base)))

    def run(batches):
        for b in batches:
            f = b.column(2).flatten().to_numpy().reshape(b.num_rows, len(z), len(centres))
            v = linked(f @ shares)
            phi = (v[:, :-1] - base) @ g.T + (v[:, -1:] - base) * h
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * d)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow.types[0]), b.column(1).cast(arrow.types[1]),
                                              pa.ListArray.from_arrays(ends, pa.array(phi.ravel())).cast(arrow.types[2]),
                                              pa.array(np.full(b.num_rows, base))], names=arrow.names)

    return rows.mapInArrow(run, schema)
