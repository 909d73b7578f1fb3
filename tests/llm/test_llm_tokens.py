"""Token files, piece encoding, preferences, and the pipeline."""

import dataclasses
import tempfile

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

import corpus_pipeline
from churnkit.llm import chat, pieces, token_files
from churnkit.llm.queries import EOD, QUERIES, byte_bpe, piece_model_path, tokenizer_path
from churnkit.session import stage_path

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return pieces.Model.load(piece_model_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


ODD = [None, "", " ", "  a  b ", "a\nb\n\n c\td", "▁x ▁", "日本語のテキスト" * 30, "x" * 400, "ab\x00cd ef", "#### ---- ....", "é ﬁ 𝒳 ​", "<s> </s> <0x41>"]


def test_pieces_equal_the_library_on_odd_texts(spark, model, library):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "a b", "c"), (1, "a b", "c")], "doc_id long, text string, ids string")
    rows = pieces.round_trip(docs, model).collect()
    assert len(rows) == len(ODD) + 2
    texts = {i: t for i, t in enumerate(ODD)}
    for r in rows:
        want = [library.encode(t or "") for t in ([texts[r.doc_id], "a b"] if r.doc_id == 1 else ["a b"] if r.doc_id is None else [texts[r.doc_id]])]
        assert r.ids in want and r.n_tokens == len(r.ids) and r.round_trip
    assert pieces.round_trip(docs.where(F.lit(False)), model).count() == 0


def test_texts_with_the_space_mark_do_not_come_back_exactly(spark):
    docs = spark.createDataFrame(list(enumerate(["a b", "a▁b", "▁x ▁", "", None])), "doc_id long, text string")
    rows = pieces.round_trip(docs, pieces.Model.load(piece_model_path())).orderBy("doc_id").collect()
    assert [(r.round_trip, r.exact) for r in rows] == [(True, True), (True, False), (True, False), (True, True), (True, True)]


def test_pieces_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op5_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(docs) and all(r.round_trip for r in rows)
    assert all(r.ids == library.encode(docs[r.doc_id]) for r in rows)


def test_blocks_do_not_change_the_ids(spark, model):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("doc_id", F.when(F.col("doc_id") < 190, F.col("doc_id")))
    a, b = (sorted(map(tuple, pieces.encode(docs, model, ["source"], block_chars=n).select("source", "text_hash", "ids").collect()), key=str) for n in (20_000, 10**9))
    assert a == b


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeinorst ▁\n.#-é日", max_size=40))
def test_merges_equal_the_library(model, library, text):
    assert [i for u in model.split(text) for i in model.unit_ids(model.parts(u))] == library.encode(text)


def test_viterbi_equals_the_library_as_unigram(spark, model):
    proto = pb.ModelProto()
    proto.ParseFromString(open(piece_model_path(), "rb").read())
    proto.trainer_spec.model_type = pieces.UNIGRAM
    for p in proto.pieces:                     # scores like log frequencies, no two alike
        if p.type == pieces.NORMAL:
            p.score = -float(np.log(30.0 - p.score if p.score > -1e8 else 40_000.0)) - 1e-6 * (hash(p.piece) % 1000)
    uni = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    ours = dataclasses.replace(model, kind=pieces.UNIGRAM, scores=tuple(p.score for p in proto.pieces))
    words = sorted({u for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).collect() for u in ours.split(r.text) if 2 <= len(u) <= pieces.MAX_WORD})[:600]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    score = lambda parts: sum(ours.scores[ours.ids[p]] if p in ours.ids else ours.missing for p in parts)
    for r in pieces.segment(df, ours, ["word"]).collect():
        at = [i for i in range(len(r.word) + 1) if r.cuts >> i & 1]
        cut = [r.word[a:b] for a, b in zip(at, at[1:])]
        assert "".join(cut) == r.word
        assert score(cut) == pytest.approx(score(ours.search(r.word)))
        if r.word.startswith("▁") and all(p in ours.ids for p in cut):
            assert score(cut) == pytest.approx(score(uni.encode(r.word[1:], out_type=str)), rel=1e-5)


def test_token_scan_stitches_blocks(spark):
    folder = stage_path(spark, f"scan-{np.random.default_rng().integers(1 << 40)}")
    _, base = token_files._store(folder)
    import os
    os.makedirs(base)
    rng, want = np.random.default_rng(3), []
    for f in range(3):
        lengths = [0, 0, 1, *rng.integers(0, 90, 40).tolist(), 700, 3]
        ids = np.concatenate([np.r_[rng.integers(0, 9, n), 9] for n in lengths])[:-1 if f == 1 else None].astype("<u2")
        ids.tofile(f"{base}/t{f}.bin")
        start = 0
        for i, n in enumerate(lengths):
            want.append((f"t{f}.bin", i, start, n, not (f == 1 and i == len(lengths) - 1)))
            start += n + 1
    np.zeros(0, "<u2").tofile(f"{base}/empty.bin")
    for block in (2, 14, 1 << 20):
        got = token_files.token_counts(spark, folder, 9, block_bytes=block)
        assert sorted(map(tuple, got.select("file", "ordinal", "start", "n_tokens", "closed").collect())) == sorted(want)


def test_token_query_against_the_tokenizer(spark):
    encode = byte_bpe(tokenizer_path("byte_bpe_50k.tiktoken"))()
    want = sorted((r.doc_id, len(encode(r.text))) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert sorted(map(tuple, QUERIES["op7_token_counts"](spark, SMALL).collect())) == want


def test_token_files_of_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (None, "a b <|endoftext|>", "c"), (2, "a b", "c")], "doc_id long, text string, file string").coalesce(1)
    folder = stage_path(spark, f"edge-{np.random.default_rng().integers(1 << 40)}")
    encode = byte_bpe(tokenizer_path("byte_bpe_50k.tiktoken"))
    manifest = token_files.write_token_files(docs, folder, encode, EOD)
    got = manifest.join(token_files.token_counts(spark, folder, EOD), ["file", "ordinal"]).orderBy("ordinal").collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(1, 0), (2, 0), (None, len(encode()("a b <|endoftext|>"))), (2, 2)]


def test_preferences_on_hand_made_turns(spark):
    t = "array<struct<role:string,text:string>>"
    a = [("user", "q"), ("assistant", "x")]
    df = spark.createDataFrame([(1, a, [("user", "q"), ("assistant", "y<|im_end|>")]), (2, a, a), (3, None, a), (4, [], None)], f"id int, chosen {t}, rejected {t}")
    rows = {r.id: r for r in chat.format_preferences(df, ["id"]).collect()}
    assert rows[1].prompt == "<|im_start|>user\nq<|im_end|>\n" and rows[1].n_prefix == 1
    assert rows[1].chosen == "<|im_start|>assistant\nx<|im_end|>\n" and rows[1].chosen_mask == "22m,11t,1m"
    assert rows[1].rejected == "<|im_start|>assistant\ny<| im_end|><|im_end|>\n"
    assert (rows[2].n_prefix, rows[2].differs, rows[2].chosen, rows[2].rejected) == (2, False, "", "")
    assert rows[3].prompt == "" and rows[3].chosen == "" and rows[3].differs and not rows[4].differs


def test_preferences_edge_rows(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (1, 0, None, None), (1, 0, "user", "z"), (2, None, "assistant", "only"), (None, 0, "user", "x"), (7, 0, "user", "u")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, chosen string")
    got = {r.conv_id: r for r in chat.format_preferences(chat.swapped_replies(df), ["conv_id"]).collect()}
    assert set(got) == {0, 1, 2, 7} and got[0].n_prefix == 1 and got[0].rejected == "" and got[7].differs is False and got[1].n_prefix == 2
    assert chat.swapped_replies(df.where(F.lit(False))).count() == 0


def test_preferences_plan_has_no_python(spark, capsys):
    QUERIES["op9_preferences"](spark, SMALL).explain()
    assert not any(x in capsys.readouterr().out for x in ("Python", "Arrow", "Pandas"))


def test_pipeline_stages(spark, library):
    from tests_llm_brute import brute_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
    want = brute_pipeline(spark, docs, library)
    got = sorted((r.doc_id, r.n_tokens, tuple(r.ids)) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == want


@pytest.mark.parametrize("kind,ids", [("string", ["a", None, "-7", "z" * 50] * 9), ("long", [-2 ** 63, 2 ** 63 - 1, 0, None] * 9), ("long", [*range(35), 10 ** 15]),
                                      ("long", [None] * 36), ("long", [5] * 36)])
def test_piece_ids_of_any_document_ids(spark, model, library, kind, ids):
    texts = [f"some words {i % 3} and more" if i % 2 else "the same text" for i in range(36)]
    docs = spark.createDataFrame([(a, t, i) for i, (a, t) in enumerate(zip(ids, texts))], f"doc_id {kind}, text string, __block int").repartition(3)
    rows = pieces.encode(docs, model, ["__block"], block_chars=60).collect()
    assert {r["__block"]: r.ids for r in rows} == {i: library.encode(t) for i, t in enumerate(texts)} and len(rows) == 36


def test_conversations_with_other_ids_have_no_neighbour(spark):
    rows = [("a", 0, "user", "q"), ("a", 1, "assistant", "x"), ("7", 0, "user", "only"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.format_preferences(chat.swapped_replies(df), ["conv_id"]).collect()}
    assert set(got) == {"a", "7"} and got["a"].n_prefix == 1 and got["a"].rejected == "" and not got["7"].differs
