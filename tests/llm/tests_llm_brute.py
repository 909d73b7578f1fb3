"""The pipeline by plain Python over the collected rows of a small table (the mix's copies by its own operator)."""

from churnkit.llm import quality, secret_scan
from churnkit.llm.mixing import mix
from test_llm_corpus import brute_groups


def brute_pipeline(spark, docs, library):
    scorer = quality.fit(docs)[1]
    rows = [r for r in docs.collect() if scorer(r.text) >= 0.5]
    first = {(i, c) for i, _, c in brute_groups([(r.doc_id, r.text) for r in rows])}
    rows = [r for r in rows if (r.doc_id, r.doc_id) in first]
    masked = [(r.doc_id, secret_scan.redact(r.text), r.source) for r in rows]
    table = spark.createDataFrame(masked, "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mix(table).collect()}
    return sorted((i, len(ids := library.encode(t)), tuple(ids)) for i, t, _ in masked for _ in range(copies[i]))
