"""The registered queries of the training-data operators, each over its whole tables, and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.bands import quality_bands
from churnkit.llm.byte_pieces import Ranks, digests
from churnkit.llm.chat import format_preferences, swapped_replies
from churnkit.llm.common import table
from churnkit.llm.knn import top_k
from churnkit.llm.lexical import search
from churnkit.llm.main_text import extract
from churnkit.llm.mixing import mix
from churnkit.llm.pieces import Model, round_trip
from churnkit.llm.quality import classify
from churnkit.llm.secret_scan import scan_secrets
from churnkit.llm.simhash import simhash_groups
from churnkit.llm.token_files import byte_bpe, token_counts, write_token_files
from churnkit.llm.whitening import whiten
from churnkit.session import stage_path

EOD = 50256          # the free id behind the rank file's 50,256 pieces


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_model_path() -> str:
    return tokenizer_path("piece_bpe_32k.model")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), Model.load(piece_model_path()))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, n_tokens): the documents' token files are written first, then scanned without an index."""
    folder = stage_path(spark, f"token-files-{uuid.uuid4().hex}")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, byte_bpe(tokenizer_path(tokenizer)), EOD)
    counts = token_counts(spark, folder, EOD)
    return manifest.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_preferences(swapped_replies(table(spark, sf_dir, "conversations")), ["conv_id"])


def op10_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def byte_ranks() -> Ranks:
    import public_tokenizers

    return Ranks.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), byte_ranks())


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_simhash_groups, op3_top_k, op4_secret_scan, op5_sentencepiece, op6_source_mix,
    op7_token_counts, op8_main_text, op9_preferences, op10_quality_bands, op11_lexical_search, op12_whitening, op13_byte_bpe)}

OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

_RENDER = """coalesce(array_to_string(list_transform({0}, lambda t: '<|im_start|>' || {1} || chr(10) || {2} || '<|im_end|>' || chr(10)), ''), '')"""
_MASK = """coalesce(array_to_string(list_transform({0}, lambda t: CAST(length({1}) + 13 AS VARCHAR) || 'm,' || CAST(length({2}) + 10 AS VARCHAR)
  || CASE WHEN t.role = 'assistant' THEN 't' ELSE 'm' END || ',1m'), ','), '')"""


def _safe(c: str) -> str:
    return f"replace(replace({c}, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')"


def _sql(form: str, turns: str) -> str:
    return form.format(turns, _safe("t.role"), _safe("t.text"))


OP9_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS a FROM c GROUP BY conv_id
), w AS (
  SELECT *, coalesce(list_max(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN a[i].role = 'assistant' THEN i ELSE 0 END)), 0) AS at FROM t
), p AS (
  SELECT w.conv_id, w.a, CASE WHEN w.at = 0 THEN w.a ELSE list_concat(list_concat(w.a[1:w.at - 1],
    CASE WHEN coalesce(o.at, 0) > 0 THEN o.a[o.at:o.at] ELSE w.a[1:0] END), w.a[w.at + 1:]) END AS b
  FROM w LEFT JOIN w AS o ON o.conv_id = xor(w.conv_id, 1)
), n AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1),
    lambda i: a[i].role <> b[i].role OR a[i].text <> b[i].text)) - 1, least(len(a), len(b))) AS k FROM p
)
SELECT conv_id, k AS n_prefix, len(a) > k OR len(b) > k AS differs, {_sql(_RENDER, "a[1:k]")} AS prompt,
  {_sql(_RENDER, "a[k + 1:]")} AS chosen, {_sql(_MASK, "a[k + 1:]")} AS chosen_mask,
  {_sql(_RENDER, "b[k + 1:]")} AS rejected, {_sql(_MASK, "b[k + 1:]")} AS rejected_mask
FROM n
"""

OP11_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS a
  FROM documents
), s AS (
  SELECT count(*) FILTER (WHERE len(a) > 0) AS n_docs, CAST(sum(len(a)) AS BIGINT) AS n_terms FROM t
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), f AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(a) AS n, unnest(a) AS term FROM t)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term
), c AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS v FROM f JOIN w USING (term), s
), z AS (
  SELECT item_id, r, doc_id, CAST(sum(v) AS BIGINT) AS score FROM i JOIN c USING (term) WHERE doc_id IS NOT NULL GROUP BY ALL
), o AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS n FROM z WHERE score > 0
)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM o WHERE n <= 50
"""

ORACLE = {"op3_top_k": OP3_SQL, "op9_preferences": OP9_SQL, "op11_lexical_search": OP11_SQL}
