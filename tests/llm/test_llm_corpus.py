"""Operators over the whole corpus against brute force, held-out labels and edge tables."""

import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnkit.llm import knn, mixing, quality, simhash
from churnkit.llm.common import components
from churnkit.llm.queries import QUERIES

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
DOC = "doc_id long, text string, source string, n_chars long, size string, fp string"


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "The the THE", "a"), (3, "The the THE", "a"), (None, "x y z w", "b"), (5, "x y z w", None), (6, "w " * 50_000, "a")]
    return spark.createDataFrame([(i, t, s, 0, "clash", "clash") for i, t, s in rows], DOC)


def fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(docs, max_bits=3):
    fps = [(i, fingerprint(t)) for i, t in docs]
    u = sorted({f for _, f in fps})
    root = {f: f for f in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(u, 2):
        if bin(a ^ b).count("1") <= max_bits:
            root[find(a)] = find(b)
    least = {}
    for i, f in fps:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [(i, f"{f:016x}", least.get(find(f), i)) for i, f in fps]


def test_simhash_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r)[:3] for r in QUERIES["op2_simhash_groups"](spark, SF).collect()]
    assert sorted(got) == sorted(brute_groups(docs))


def test_simhash_edge_rows(edge):
    key = lambda r: tuple(map(str, r))
    want = brute_groups([(r.doc_id, r.text) for r in edge.collect()])
    assert sorted(map(tuple, simhash.simhash_groups(edge).collect()), key=key) == sorted(want, key=key)
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6]
    assert simhash.simhash_groups(edge.where(F.lit(False))).count() == 0


def test_crowded_keys_lose_no_link(spark):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 2**63))
    fps = {centre}
    for _ in range(150):
        fps.add(centre ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(1, 5), replace=False)))
    fps |= {int(x) for x in rng.integers(0, 2**63, 100)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = {(a, b) for a, b in itertools.combinations(sorted(fps), 2) if bin(a ^ b).count("1") <= 3}
    for hot in (5, 1000):
        assert {tuple(r) for r in simhash.near_links(df, hot=hot).collect()} == want


def test_dense_clouds_lose_no_link(spark):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 2**62))
    bits = [0, 1, 2, 3, 4, 20, 21, 22, 61]                  # within three blocks of ten: their key is hot there too
    cloud = {centre ^ sum(1 << b for b, x in zip(bits, f"{i:09b}") if x == "1") for i in range(512)}
    fps = {f - 2**64 if f >= 2**63 else f for f in ({f ^ (1 << 63) for f in list(cloud)[:60]} | cloud)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = {(a, b) for a, b in itertools.combinations(sorted(fps), 2) if ((a ^ b) % 2**64).bit_count() <= 3}
    for hot in (20, 400, 10_000):
        got = [tuple(r) for r in simhash.near_links(df, hot=hot).collect()]
        assert len(got) == len(want) and set(got) == want


def test_kept_rows_do_not_depend_on_the_layout(spark):
    rows = [(i % 3 if i % 4 else None, ("same text of a copy " * 3 if i % 2 else f"other words {i} stand here {i * 7}"), "s", i) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __id long")
    kept = [sorted(map(tuple, simhash.keep_one(docs.orderBy(*by).repartition(n)).collect()), key=str) for by, n in ((["__id"], 1), ([F.desc("__id")], 5))]
    mixed = [sorted(map(tuple, mixing.mix_documents(docs.orderBy(*by).repartition(n), per_bucket=4).collect()), key=str) for by, n in ((["__id"], 1), ([F.desc("__id")], 5))]
    assert kept[0] == kept[1] and mixed[0] == mixed[1] and len(mixed[0]) > 0


def test_mix_of_alike_rows_in_small_parts(spark):
    rows = [(None, "a b c", "s")] * 301 + [(i, "a b c", "s") for i in range(40)] + [(7, "d e f g", "t")] * 90 + [(None, "h", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    split, whole = (sorted(map(tuple, mixing.mix(docs, weights=(3, 1), share=1.2, per_bucket=n).collect()), key=str) for n in (8, 100_000))
    assert len(split) == len(whole) == len(rows)
    for got in (split, whole):
        for source, size in (("s", 3), ("t", 4), (None, 1)):
            mine = [r for r in got if r[1] == source]
            assert abs(sum(r[-1] for r in mine) - mine[0][4]) <= size and len({r[-2] for r in mine}) <= 2


def test_invalid_utf8_is_read_as_replacements(spark):
    raw = spark.sql("SELECT * FROM VALUES (1L, CAST(X'61FF62206320642065' AS STRING), 's'), (2L, 'a\ufffdb c d e', 's') AS t(doc_id, text, source)")
    assert len({r.fingerprint for r in simhash.simhash_groups(raw).collect()}) == 1
    assert len({r.score for r in quality.classify(raw).collect()}) == 1
    assert quality.keep_good(raw, threshold=-1.0).selectExpr("hex(text) AS h").where("h LIKE '61FF62%'").count() == 1
    assert simhash.keep_one(raw).count() == 1 and mixing.mix_documents(raw).count() > 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(40)] + [(7, 7), (500, 400), (400, 500)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in (*range(100, 140), 200)) and got[500] == got[400] == 400
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_top_k_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [0.0, 1.0]), (3, [1.0, 2.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [5.0]),
            (None, [9.0, 9.0]), (8, [float("inf"), 0.0]), (9, []), (2, [1.0, 2.0]), (2, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, score string")
    fine = [(i, np.floor(256 * np.array(list(v) + [0.0] * (2 - len(v)))).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, q in fine:
        if i % 50 == 0:
            best = sorted((-int(q @ x), j) for j, x in fine if j != i)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    for pivots, block in ((64, 4096), (2, 2)):
        got = knn.top_k(df, F.col("vec_id") % 50 == 0, pivots=pivots, per_block=block, query_block=1)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert knn.top_k(df.where(F.lit(False)), F.lit(True)).count() == 0


def test_mix_query_meets_targets_and_repeats(spark):
    rows = QUERIES["op6_source_mix"](spark, SF).orderBy("doc_id").collect()
    again = QUERIES["op6_source_mix"](spark, SF).orderBy("doc_id").collect()
    assert rows == again
    docs = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    size = {}
    for s, n in docs.values():
        size[s] = size.get(s, 0) + n
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    total, target, capped = 1.5 * sum(size.values()), {}, set()
    while True:
        left = total - sum(2 * size[s] for s in capped)
        target = {s: 2.0 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in size if x not in capped) for s in size}
        over = {s for s in size if target[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    taken = dict.fromkeys(size, 0)
    for r in rows:
        source, n = docs[r.doc_id]
        assert (r.size, r.source_size) == (n, size[source]) and r.target == pytest.approx(target[source])
        assert 0 <= r.taken <= 2 * n and (n == 0 or r.taken % n == 0)
        taken[source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= max(5, 0.01 * target[s])


def test_mix_edge_rows(edge):
    rows = mixing.mix(edge).collect()
    assert len(rows) == edge.count() and all(r.taken <= 2 * r.size for r in rows)
    assert {r.target for r in rows if r.source is None} == {8.0}
    assert mixing.mix(edge.where(F.lit(False))).count() == 0
    out = mixing.mix_documents(edge)
    assert out.columns == edge.columns and out.where("source = 'b'").count() <= 2


def test_multipliers_give_the_targets(spark):
    hist = spark.createDataFrame([("a", n, 3) for n in range(1, 40)] + [("b", 7, 1)], "source string, size long, c long")
    goals = spark.createDataFrame([("a", 2340, 900.0), ("b", 7, 14.0)], "source string, source_size long, target double")
    got = {r.source: r for r in mixing.multipliers(hist, goals, 2.0).collect()}
    t, mean = got["a"].t, got["a"].mean
    assert sum(3 * n * min(2.0, np.exp(t * n / mean)) for n in range(1, 40)) == pytest.approx(900.0, rel=1e-6) and got["b"].full


def test_quality_against_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op1_quality_classifier"](spark, SF).join(labels, "doc_id").collect()
    right = sum(r.kept == bool(r.quality) for r in rows)
    assert right >= 0.95 * len(rows)
    assert sum(not r.kept for r in rows if r.quality) <= 0.005 * len(rows)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(40_000) < 0.8
    right = np.array([[0.6, 0.98], [0.5, 0.99], [0.4, 0.97], [0.55, 0.95]])
    votes = np.empty((len(y), 4), int)
    for j, (bad, good) in enumerate(right):
        hit = rng.random(len(y)) < np.where(y, good, bad)
        votes[:, j] = np.where(rng.random(len(y)) < 0.1, quality.ABSTAIN, np.where(hit, y, ~y))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_weak_model(patterns, counts.astype(float))
    assert model.prior == pytest.approx(0.8, abs=0.03) and np.abs(model.right - right).max() < 0.06


def test_quality_edge_rows(edge):
    rows = quality.classify(edge).collect()
    assert len(rows) == edge.count()
    assert [r.kept for r in rows][:2] == [False, False] and rows[0].score == 0.0
    assert quality.classify(edge.where(F.lit(False))).count() == 0
    assert quality.keep_good(edge).columns == edge.columns


@pytest.mark.parametrize("key", ["CAST(NULL AS BIGINT)", "7L", "doc_id % 3"])
def test_quality_trains_where_ids_say_nothing(spark, key):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr(f"{key} AS doc_id", "text", "doc_id AS n")
    scorer = quality.fit(docs, sample_rows=200)[1]
    assert np.abs(scorer.weights).max() > 0.05
    rejected = 1 - quality.keep_good(docs, sample_rows=200).count() / docs.count()
    usual = 1 - quality.keep_good(spark.read.parquet(f"{SF}/documents.parquet")).count() / docs.count()
    assert 0 < rejected and abs(rejected - usual) < 0.08


def test_top_k_of_huge_components(spark):
    kind = "vec_id long, embedding array<double>"
    top = lambda rows: [tuple(r) for r in knn.top_k(spark.createDataFrame(rows, kind), F.col("vec_id") == 0, k=2, scale=1.0).orderBy("rank").collect()]
    assert top([(0, [2.0 ** 40, 1.0]), (1, [2.0 ** 22, 3.0]), (2, [-(2.0 ** 22), 7.0])]) == [(0, 1, 1, 2 ** 62 + 3), (0, 2, 2, -2 ** 62 + 7)]
    for rows in ([(0, [1e30, 1.0]), (1, [4e16, 1.0])], [(0, [2.0 ** 40]), (1, [2.0 ** 30])]):
        with pytest.raises(Exception, match="beyond a long"):
            top(rows)


def test_top_k_joins_on_blocks_not_cells(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plain = sorted(map(tuple, knn.top_k(df, F.col("vec_id") % 50 == 0).collect()))
    assert plain == sorted(map(tuple, knn.top_k(df, F.col("vec_id") % 50 == 0, pivots=1, per_block=3).collect())) and len(plain) == 40
    blocks = knn._blocks(df.selectExpr("vec_id AS row", "vec_id AS id", "transform(embedding, x -> CAST(x AS BIGINT)) AS v", "0 AS cell"), 2, 3)
    assert blocks.select("cell", "salt").distinct().count() == blocks.count() > 64


def test_mix_documents_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "a b c " * (i % 5), "s", i, -i, 2 * i) for i in range(60)], "doc_id long, text string, source string, __row int, __copies int, __copy int")
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and out.count() > 0 and out.where("__row <> doc_id OR __copies <> -doc_id OR __copy <> 2 * doc_id").count() == 0
