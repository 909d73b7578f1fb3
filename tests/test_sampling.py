"""Exact stratified split, folds, nested samples, two-step rank."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from churnkit.operators import sampling


def test_quotas_match_reference_counts():
    q = sampling.test_quotas({0: 5174, 1: 1869}, 20)
    assert q == {0: 1035, 1: 374} and sum(q.values()) == 1409


def test_hash_rank_equals_one_window(spark, raw):
    two = sampling.hash_rank(raw, "customerID", ["Churn"], prefix_len=1).select("customerID", "rank")
    w = Window.partitionBy("Churn").orderBy(sampling.hash_key("customerID"), "customerID")
    one = raw.select("customerID", F.row_number().over(w).alias("rank"))
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, one.collect()))


def test_split_disjoint_complete_exact(spark, raw):
    s = sampling.stratified_split(raw, "customerID", "Churn", 20, 42, 3).cache()
    assert s.count() == raw.count() == s.select("customerID").distinct().count()
    counts = {r["Churn"]: r["n"] for r in raw.groupBy("Churn").agg(F.count("*").alias("n")).collect()}
    quotas = sampling.test_quotas(counts, 20)
    got = {r["Churn"]: r["n"] for r in s.where("split = 'test'").groupBy("Churn").agg(F.count("*").alias("n")).collect()}
    assert got == quotas
    folds = s.where("split = 'train'").groupBy("Churn", "fold").count().collect()
    by = {}
    for r in folds:
        by.setdefault(r["Churn"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 and len(v) == 3 for v in by.values())
    assert s.where("split = 'test' and fold is not null").count() == 0


def test_nested_samples(raw):
    a = {r[0] for r in sampling.nested_sample(raw, "customerID", 10).select("customerID").collect()}
    b = {r[0] for r in sampling.nested_sample(raw, "customerID", 25).select("customerID").collect()}
    assert len(a) == 10 and len(b) == 25 and a <= b
    c = sampling.bounded_sample(raw, "customerID", 1000).count()
    assert c == raw.count()
