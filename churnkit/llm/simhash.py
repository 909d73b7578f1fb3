"""SimHash near-duplicate groups: pigeonhole blocks, equi-join on blocks, Hamming check.

A fingerprint has 64 bits, cut into blocks. Two fingerprints that differ in at most ``max_bits`` bits
agree on all but ``max_bits`` blocks, so for some choice of ``blocks - max_bits`` blocks they share the
joined key. Each *distinct* fingerprint is put out once per choice and equi-joined on (choice, key); the
join condition verifies the distance, so only true links leave the join. Exact copies share a fingerprint
and never meet in a join. A key that more than ``hot`` distinct fingerprints share (a large cloud of near
copies) is left out of that join; its members are joined again on finer blocks, whose keys are longer.
Both members of any pair under a hot key are in that second join, so no link is lost. Under a key that is
still hot there, few bits are free: each member is put out with up to ``max_bits`` of them flipped and
equi-joined on the whole fingerprint, so its work does not grow with the cloud around it. Groups are
connected components of the links.

Null, empty or blank text: fingerprint zero, linked like any other. Invalid UTF-8 is read as U+FFFD. Null
doc_id: grouped by its fingerprint, never the smallest id of a group. Ties and repeated rows: same
fingerprint, same group. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.llm.common import components, field, free, per_text, row_hash
from churnkit.session import materialize

BITS = 64


def fingerprinter(width: int = 3, seed: int = 42):
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest

    def one(text: str | None) -> tuple:
        words = (text or "").encode().lower().split()       # bytes: only A-Z change, only ASCII blanks split
        if not words:
            return (0,)
        n = max(1, len(words) - width + 1)
        hashes = np.fromiter((digest(b" ".join(words[i:i + width]), seed) for i in range(n)), "<u8", n)
        ones = np.zeros(BITS, np.int64)
        for at in range(0, n, 65536):                        # bounded memory for very long texts
            part = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits = np.packbits(ones * 2 > n, bitorder="little")
        return (int(bits.view("<i8")[0]),)

    return one


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    return per_text(docs, [doc_id], text, lambda: fingerprinter(width, seed), [field("fp", T.LongType())])


def _masks(blocks: int, max_bits: int) -> list[int]:
    """The bits of each choice of ``blocks - max_bits`` blocks."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    part = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(blocks)]
    return [sum(part[i] for i in c) for c in combinations(range(blocks), blocks - max_bits)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _keys(fps: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """(fp, choice, key) for every choice of ``blocks - max_bits`` blocks."""
    masks = [_signed(m) for m in _masks(blocks, max_bits)]
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(masks)])
    return (fps.select("fp", F.explode(choices).alias("c"))
            .select("fp", F.col("c.choice").alias("choice"), F.col("fp").bitwiseAND(F.col("c.mask")).alias("key")))


def _crowded(keys: DataFrame, hot: int) -> DataFrame:
    """The (choice, key) that more than ``hot`` fingerprints share."""
    return materialize(keys.groupBy("choice", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot)
                       .select("choice", "key"), "simhash-hot")


def _near(keys: DataFrame, max_bits: int) -> DataFrame:
    """Pairs a < b under one key at most ``max_bits`` apart; the check is part of the join condition."""
    a = keys.select(F.col("fp").alias("a"), "choice", "key")
    b = keys.select(F.col("fp").alias("b"), F.col("choice").alias("choice_b"), F.col("key").alias("key_b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    on = (F.col("choice") == F.col("choice_b")) & (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b")) & near
    return a.join(b, on).select("a", "b")


def _flipped(members: DataFrame, choices: Sequence[int], blocks: int, max_bits: int) -> DataFrame:
    """Pairs a < b of ``members`` (fp, choice) that differ in at most ``max_bits`` bits outside the blocks of a choice.

    The broadcast table of flips is as large as the blocking says: 187,000 rows for 120 choices of 7 in 10 blocks."""
    masks = _masks(blocks, max_bits)
    flips = [(c, _signed(sum(1 << b for b in bits))) for c in choices for n in range(1, max_bits + 1)
             for bits in combinations([b for b in range(BITS) if not masks[c] >> b & 1], n)]
    table = members.sparkSession.createDataFrame(pd.DataFrame(flips, columns=["choice", "flip"]).astype({"choice": "int32", "flip": "int64"}))
    tried = (members.join(F.broadcast(table), "choice").select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("flip")).alias("b"))
             .where("a < b"))
    return tried.join(members.select(F.col("fp").alias("b")).distinct(), "b").select("a", "b")


def near_links(fps: DataFrame, max_bits: int = 3, blocks: int = 5, fine_blocks: int = 10, hot: int = 1000) -> DataFrame:
    """Distinct pairs (a, b), a < b, of the distinct ``fp`` values that differ in at most ``max_bits`` bits."""
    keys = _keys(fps, blocks, max_bits)
    crowded = _crowded(keys, hot)
    if crowded.isEmpty():
        return _near(keys, max_bits).distinct()
    keys = materialize(keys, "simhash-keys")
    members = keys.join(crowded, ["choice", "key"], "left_semi").select("fp").distinct()
    fine = materialize(_keys(members, fine_blocks, max_bits), "simhash-fine")
    dense = _crowded(fine, hot)
    links = (_near(keys.join(crowded, ["choice", "key"], "left_anti"), max_bits)
             .unionByName(_near(fine.join(dense, ["choice", "key"], "left_anti"), max_bits)))
    choices = sorted(r["choice"] for r in dense.select("choice").distinct().collect())     # a structural number of rows
    if choices:
        links = links.unionByName(_flipped(fine.join(dense, ["choice", "key"], "left_semi").select("fp", "choice"),
                                           choices, fine_blocks, max_bits))
    return links.distinct()


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42,
                   max_bits: int = 3, **blocking) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest doc_id reachable over links
    of fingerprints at most ``max_bits`` bits apart."""
    fps = materialize(fingerprints(docs, doc_id, text, width, seed).withColumnRenamed(doc_id, "doc_id"), "simhash-fp")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "simhash-nodes")
    roots = components(near_links(nodes.select("fp"), max_bits, **blocking), "a", "b")
    linked = materialize(nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "first_id", "root"), "simhash-linked")
    smallest = materialize(linked.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    # a fingerprint alone with one document is its own group and needs no row here
    named = (nodes.where("n > 1").join(linked, "fp", "left_anti").select("fp", F.col("first_id").alias("component_id"))
             .unionByName(linked.join(smallest, "root").select("fp", "component_id")))
    named = materialize(named, "simhash-named")
    out = fps.join(named, "fp", "left")
    return out.select(F.col("doc_id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id; of rows that repeat that id, the one with the
    smallest hash of its columns, whatever the layout of the files.

    A document whose group has no doc_id at all is kept once per group."""
    key, tie, name = (free(c, docs.columns) for c in ("__row", "__tie", "__id"))
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "simhash-docs")
    groups = simhash_groups(rows, key, text, **how)
    ids = groups.join(rows.select(key, F.col(f"`{doc_id}`").alias(name), row_hash(docs).alias(tie)), key)
    first = (ids.groupBy("component_id").agg(F.min(F.struct(F.col(name).isNull(), F.col(name), F.col(tie), F.col(key))).alias("m"))
             .select(F.col(f"m.{key}").alias(key)))
    return rows.join(first, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
