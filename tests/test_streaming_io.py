"""Stream scoring equals batch scoring; restart from checkpoint; IO round trips."""

import os

from pyspark.sql import functions as F

from churnkit.operators.validation import validate_records
from churnkit.sources import io
from churnkit.sources.requests import read_requests, requests_from_subscribers, with_request_defaults
from churnkit.streaming.scoring import scorecard_scorer, score_stream, score_stream_with_quarantine


def test_stream_equals_batch_with_restart(spark, raw, fm, tmp_path):
    req = requests_from_subscribers(raw)
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    req.where("customerID < 'C0000075'").write.json(src + "/part1")
    os.makedirs(src, exist_ok=True)
    q = score_stream(spark, src + "/*", out, ck, fm)
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    req.where("customerID >= 'C0000075'").write.json(src + "/part2")
    q = score_stream(spark, src + "/*", out, ck, fm)   # restart: only new files
    q.awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(out).collect()}
    batch = {tuple(r) for r in scorecard_scorer(fm.transform(with_request_defaults(req))).collect()}
    assert first == 75 and len(streamed) == raw.count() and streamed == batch


def test_stream_quarantine(spark, fm, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(
        '{"customerID": "Q1", "tenure": 5, "MonthlyCharges": 50.0, "Contract": "Weekly"}\n'
        '{"customerID": "Q2", "tenure": 5, "MonthlyCharges": 50.0}\n')
    q = score_stream_with_quarantine(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"), fm)
    q.awaitTermination()
    valid = spark.read.parquet(str(tmp_path / "out/valid"))
    bad = spark.read.parquet(str(tmp_path / "out/quarantine")).collect()
    assert [r["customerID"] for r in valid.collect()] == ["Q2"]
    assert bad[0]["customerID"] == "Q1" and "Contract_not_allowed" in bad[0]["error"]


def test_request_reader_keeps_bad_records(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text('{"customerID": "A", "tenure": 3}\n{not json}\n')
    df = read_requests(spark, str(p)).cache()
    assert df.count() == 2
    v = {r["customerID"]: r for r in validate_records(df).collect()}
    assert v["A"]["is_valid"] == 1 and v[None]["error"] == "malformed_record"


def test_csv_stage_and_split_roundtrip(spark, raw, fm, tmp_path):
    io.write_raw_csv(raw, str(tmp_path / "raw"))
    back = io.read_raw_csv(spark, str(tmp_path / "raw")).cache()
    assert back.count() == raw.count() and back.where(F.col("_corrupt_record").isNotNull()).count() == 0
    from churnkit.plans.pipeline import build_pipeline

    res = build_pipeline(back.drop("_corrupt_record"), str(tmp_path / "stages"))
    enc = io.read_stage(spark, res.paths["encoded"])
    assert len([c for c in enc.columns if c in fm.feature_names]) == 45
    from churnkit.operators import sampling

    split = sampling.stratified_split(enc, "customerID", "Churn")
    io.write_split(split, str(tmp_path / "split"))
    test = io.read_split(spark, str(tmp_path / "split"), "test")
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()
    assert test.count() == split.where("split = 'test'").count()
    empty = io.read_json_report(spark, str(tmp_path / "missing"), io.COMPARISON_SCHEMA)
    assert empty.count() == 0 and empty.columns[0] == "model"


def test_request_reader_json_array(spark, tmp_path):
    p = tmp_path / "batch.json"
    p.write_text('[{"customerID": "A", "tenure": 3, "MonthlyCharges": 89.5},\n'
                 ' {"customerID": "B", "Contract": "Two year"}]')
    df = with_request_defaults(read_requests(spark, str(p), multiline=True))
    got = {r["customerID"]: r for r in df.collect()}
    assert got["A"]["TotalCharges"] == 89.5 * 3 and got["B"]["Contract"] == "Two year"
    assert got["B"]["tenure"] == 1 and got["B"]["TotalCharges"] == 70.0
