"""Lexical search, whitening and byte-level BPE against brute force, the library and edge tables."""

import base64
import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnkit.llm import byte_pieces, lexical, whitening
from churnkit.llm.queries import ORACLE, QUERIES, byte_ranks

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


# ---------------------------------------------------------------- lexical search
def brute_search(docs, items, k):
    """The contract in plain Python; docs and items are lists of (id, text)."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, b in bags:
            m = 50 + (50 * b.total() * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m)) for t in terms if b[t])
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(i, n, d, -s) for n, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


DOCS = [(9, "The cat, the CAT and é日本!"), (2, "cat the the cat AND é日本"), (2, "the dog"), (None, "cat cat"), (4, None), (5, ""), (6, " ., "), (7, "the " * 300_000 + "dog"),
        *[(100 + i, "cat the the cat and é日本") for i in range(40)], *[(200 + i, f"dog{i} cat") for i in range(30)], (1, "unrelated words")]
ITEMS = [(1, "CAT dog é日本"), (1, "the"), (2, ""), (3, None), (None, "cat"), (4, "nothing here"), (5, "The the cat")]


@pytest.mark.parametrize("k,per_block", [(5, 1), (50, 1024), (1000, 2)])
def test_search_of_odd_rows_against_plain_python(spark, k, per_block):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in DOCS], "doc_id long, text string, key string, tf int").repartition(7)
    items = spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id int, text string, doc_id string")
    got = sorted(map(tuple, lexical.search(docs, items, k=k, per_block=per_block).collect()))
    assert got == brute_search(DOCS, ITEMS, k)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0 == lexical.search(docs, items.limit(0)).count()


def test_search_ranks_other_ids_as_strings(spark):
    docs = [(f"d{i % 17}", f"cat {'x ' * (i % 3)}") for i in range(60)]
    got = lexical.search(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame([("q", "cat x")], "item_id string, text string"), k=30)
    assert sorted(map(tuple, got.collect())) == brute_search(docs, [("q", "cat x")], 30)


def test_search_query_equals_sql(spark):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert sorted(map(tuple, QUERIES["op11_lexical_search"](spark, SF).collect())) == sorted(db.execute(ORACLE["op11_lexical_search"]).fetchall())


def test_copies_are_one_class(spark):
    vocabulary = spark.createDataFrame([(b"cat", 0), (b"the", 1)], "term binary, id long")
    docs = spark.createDataFrame([(i, "the cat sat") for i in range(500)] + [(900, "cat the")], "doc_id long, text string").repartition(5)
    bag = lexical.bags(docs, vocabulary, "doc_id", "text").where("key >= 0").withColumn("m", F.col("n")).withColumn("h", F.lit(0))
    assert sorted((r.first, len(r.bag)) for r in lexical.classes(bag).select("bag", F.col("first")).collect()) == [(0, 2), (900, 2)]     # equal hashes


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBZ09é日 \n-_~\x7f\x80", max_size=60), st.integers(1, 9))
def test_terms_do_not_depend_on_the_step(text, step):
    whole = Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)))
    before = lexical._STEP
    try:
        lexical._STEP = step
        assert {k.decode(): v for k, v in lexical.count_terms(text.encode()).items()} == whole
    finally:
        lexical._STEP = before


# ---------------------------------------------------------------- whitening
def dense_whitening(rows, k):
    """(n, x, S, values, axes) by a dense eigendecomposition."""
    x = np.array([np.floor(256 * np.array(v, float)) for _, v in rows])
    u = np.unique(x, axis=0)
    s, c = u.sum(0), u - u.sum(0) / len(u)
    values, axes = np.linalg.eigh(c.T @ c / len(u))
    return len(u), x, s, values[::-1][:k], axes[:, ::-1][:, :k], np.trace(c.T @ c) / len(u)


def check_whitening(got, rows, k=4):
    n, x, s, values, axes, trace = dense_whitening(rows, k)
    z = (x - s / n) @ axes / np.sqrt(values)
    mine = np.zeros_like(z)
    at = {i: j for j, (i, _) in enumerate(rows)}
    assert len(got) == len(rows) * len(values)
    for r in got:
        j = at[r.vec_id]
        mine[j, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[j], s))
        assert abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-10 and r.identity_error < 1e-9
    assert np.abs(mine * np.sign((mine * z).sum(0)) - z).max() < 1e-9 * np.abs(z).max()


def test_whitening_query_against_a_dense_eigendecomposition(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None]
    check_whitening(QUERIES["op12_whitening"](spark, SF).collect(), rows)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=6) * [9, 5, 3, 2, 1, 1]]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]                       # a third of the rows are one vector
    odd = [(None, rows[3][1]), (2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("-inf")] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, component int").repartition(6)
    got = whitening.whiten(df, block=5, degree=6).collect()
    assert sum(r.vec_id is None for r in got) == 4
    check_whitening([r for r in got if r.vec_id is not None], rows)


def test_whitening_of_few_and_short_vectors(spark):
    kind = "vec_id long, embedding array<double>"
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    assert make([]) == [] == make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == make([(1, [])])
    got = make([(1, [1.0]), (2, [0.0, 2.0]), (3, [0.0])])                       # padded: (256, 0), (0, 512), (0, 0)
    check_whitening(got, [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0])], 2)
    line = make([(i, [float(i), 2.0 * i, 3.0]) for i in range(9)])
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)


def test_whitening_of_equal_eigenvalues_and_large_numbers(spark):
    kind = "vec_id long, embedding array<double>"
    cube = [(j, [1.0 if j >> b & 1 else -1.0 for b in range(5)]) for j in range(32)]
    got = whitening.whiten(spark.createDataFrame(cube, kind)).collect()
    assert len(got) == 128 and max(r.identity_error for r in got) < 1e-9 and all(abs(r.explained - 0.2) < 1e-9 for r in got)
    big = whitening.whiten(spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0])], kind)).collect()
    assert all(r.deviation is None for r in big)
    with pytest.raises(Exception, match="2 \\*\\* 53"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], kind))


def test_chebyshev_filter_damps_the_unwanted_spectrum():
    values = np.linspace(1, 0, 40)
    q = np.ones((40, 1))
    times = lambda y: values[:, None] * y
    y = whitening.chebyshev(times, q, times(q), 1.0, 0.6, 12)[:, 0]
    assert abs(abs(y[0]) - 1) < 1e-9 and np.abs(y[values <= 0.6]).max() < 1e-5


# ---------------------------------------------------------------- byte-level BPE
@pytest.fixture(scope="module")
def ranks():
    return byte_ranks()


@pytest.fixture(scope="module")
def library(ranks):
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.data.splitlines())}
    return tiktoken.Encoding("own", pat_str=ranks.pattern, mergeable_ranks=table, special_tokens={})


LONG = "".join(f"word{i} {'  ' * (i % 3)}don't\n\n{'é日本。' * (i % 4)} \t{i}" for i in range(9000))
TEXTS = [None, "", " ", "a  b ", "it's 'sx' ''s", "  x　　y", "a\x1cb\x1f c", "<|endoftext|>", "\x00\x7f", "𝒳 ﬁ é", "!" * 5000, LONG,
         "x" * 200_000, "日本語" * 60_000, " " * 70_000, "a" + " " * 70_000 + "b", "\n" * 140_000 + "\tz", "y" + "　" * 66_000 + "\n"]


def test_byte_bpe_of_odd_texts(spark, ranks, library):
    docs = spark.createDataFrame([(i, t, b"c") for i, t in enumerate(TEXTS)] + [(None, "a b", b"c"), (1, "a b", b"c")], "doc_id long, text string, ids binary")
    want = sorted((str(i), ids := library.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest())[:3] for i, t in [*enumerate(TEXTS), (None, "a b"), (1, "a b")])
    got = byte_pieces.digests(docs, ranks).collect()
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got))) == sorted(
        str((None if i == "None" else int(i), len(ids), sha(ids), d)) for i, ids, d in want)
    assert byte_pieces.digests(docs.limit(0), ranks).count() == 0


def test_white_space_beyond_what_the_library_takes(ranks):
    codec = ranks.codec()
    n = 1_500_000
    assert codec.encode(" " * n + "x").tolist() == codec.whole.encode_ordinary(" " * (n - 1)) + codec.split.encode_ordinary(" x")
    assert codec.decode(codec.encode("a" + "\n" * n).tolist()) == b"a" + b"\n" * n


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'st19 !?\n\t　é日 \x1c", max_size=60), st.integers(1, 12))
def test_cuts_do_not_change_the_ids(ranks, library, text, segment):
    assert ranks.codec().encode(text, segment).tolist() == library.encode_ordinary(text)


def test_byte_bpe_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_decoding_of_nulls_and_invalid_text(spark, ranks):
    df = spark.createDataFrame([(1, [64, 65]), (2, None), (3, [])], "id long, ids array<int>")
    assert {r.id: bytes(r.decoded) for r in byte_pieces.decode(df, ranks, ["id"]).collect()} == {1: ranks.codec().decode([64, 65]), 2: b"", 3: b""}
    bad = spark.createDataFrame([(1, bytearray(b"a\xffb"))], "doc_id long, b binary").select("doc_id", F.col("b").cast("string").alias("text"))
    assert bytes(byte_pieces.decode(byte_pieces.encode(bad, ranks, ["doc_id"]), ranks, ["doc_id"]).first().decoded) == "a�b".encode()
