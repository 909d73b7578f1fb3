"""Ranked lexical search of every item over all documents, with equal bags of words scored once.

1. One pass over whole texts counts each document's terms; an equi-join with the items' vocabulary keeps those that
   an item asks for, so what is shuffled and stored is a document's bag restricted to that vocabulary.
2. Documents whose restricted bags and length factors m are alike have the same score for every item. They form a class:
   found by a hash, verified by equality of the whole bag, and represented by the smallest doc_id.
3. Every class is scored once against the items, which travel in blocks of bounded size; a task keeps the ``k`` best
   classes of an item by score and smallest doc_id. No further class can hold one of the ``k`` best documents.
4. The chosen classes are expanded to their members, at most ``k`` by ascending doc_id, and ranked.

Null or empty texts hold no term and count in nothing. Documents without a doc_id count in N, L and df but are not returned. Repeated
documents are documents each, also under one doc_id. Items without an id are left out; rows under one item_id are one item,
whose terms are theirs together; items without a match give no rows. Invalid UTF-8 is read as U+FFFD. Very long texts are counted a
megabyte at a time. ids that are no integers are ranked as strings. Other columns are not read, so their names do not matter. Empty
tables: empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnkit.session import materialize, ship_package, stage_path

# Term characters in UTF-8: ASCII letters and digits and all beyond ASCII.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_STEP = 1 << 20
_MARK = b""                # no term: the row that carries a task's number of documents and terms


def count_terms(text: bytes | None) -> Counter:
    """Occurrences of each term of a whole text, A-Z lower-cased."""
    counts: Counter = Counter()
    at, text = 0, text or b""
    while at < len(text):
        gap = _GAP.search(text, at + _STEP) if at + _STEP < len(text) else None
        end = gap.start() if gap else len(text)
        counts.update(_TERM.findall(text[at:end].lower()))
        at = end
    return counts


def _utf8(text: str) -> Column:
    return F.make_valid_utf8(F.col(f"`{text}`").cast("string")).cast("binary")


def _id(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return c.cast("long") if isinstance(df.schema[name].dataType, T.IntegralType) else c.cast("string")


def _counted(source: DataFrame, marks: bool) -> DataFrame:
    """(key, doc, n, term, tf) of (key, doc, text): a row a document and distinct term. ``marks`` adds a row a task, without a
    term, that holds its number of terms as n and of documents with a term as tf, under a key of its own."""
    schema = T.StructType([source.schema["key"], source.schema["doc"], T.StructField("n", T.LongType()), T.StructField("term", T.BinaryType()),
                           T.StructField("tf", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = n_docs = 0
        task_key = None

        def made(b: pa.RecordBatch, rows: list, ns: list, counts: list) -> pa.RecordBatch:
            at = pa.array(np.repeat(np.array(rows, np.int64), [len(c) for c in counts]))
            return pa.RecordBatch.from_arrays([
                b.column(0).take(at).cast(arrow.types[0]), b.column(1).take(at).cast(arrow.types[1]),
                pa.array(np.repeat(np.array(ns, np.int64), [len(c) for c in counts])),
                pa.array([t for c in counts for t in c], pa.binary()), pa.array([v for c in counts for v in c.values()], pa.int64())], names=arrow.names)

        for b in batches:
            rows, ns, counts, size = [], [], [], 0
            for i, v in enumerate(b.column(2)):
                c = count_terms(v.as_py())
                if not c:
                    continue
                n = c.total()
                total, n_docs, size = total + n, n_docs + 1, size + len(c)
                if marks and task_key is None:
                    task_key = -1 - b.column(0)[i].as_py()
                rows.append(i), ns.append(n), counts.append(c)
                if size >= 50_000:
                    yield made(b, rows, ns, counts)
                    rows, ns, counts, size = [], [], [], 0
            if rows:
                yield made(b, rows, ns, counts)
        if marks and n_docs:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((task_key, None, total, _MARK, n_docs), arrow.types)], names=arrow.names)

    return source.mapInArrow(run, schema)


def bags(docs: DataFrame, vocabulary: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, doc, n, bag): each document's terms within the vocabulary as sorted (id, tf); keys below zero carry the marks."""
    source = docs.select(F.monotonically_increasing_id().alias("key"), _id(docs, doc_id).alias("doc"), _utf8(text).alias("text"))
    wanted = vocabulary.unionByName(vocabulary.sparkSession.createDataFrame([(_MARK, -1)], "term binary, id long"))
    kept = _counted(source, True).join(wanted, "term")          # the size of the vocabulary decides how
    return kept.groupBy("key").agg(F.first("doc").alias("doc"), F.first("n").alias("n"),
                                   F.sort_array(F.collect_list(F.struct("id", "tf"))).alias("bag"))


def classes(bag: DataFrame) -> DataFrame:
    """(cls, h, m, bag, first): documents alike in bag and m, by hash and then by the whole bag; the smallest doc."""
    alike = bag.groupBy("h", "m", "bag").agg(F.min("doc").alias("first"))          # copies meet before the shuffle
    return materialize(alike.withColumn("cls", F.monotonically_increasing_id()), "lexical-classes")


class ItemBlock:
    """Some items as postings by term id: bounded, shipped to every task of one pass over the classes."""

    def __init__(self, rows: list, kind: pa.DataType):
        self.items = pa.array([r["item"] for r in rows], kind)
        sizes = [len(r["terms"]) for r in rows]
        ids = np.array([t["id"] for r in rows for t in r["terms"]], np.int64)
        order = np.argsort(ids, kind="stable")
        self.posting = np.repeat(np.arange(len(rows)), sizes)[order]
        self.ids, self.start, self.count = np.unique(ids[order], return_index=True, return_counts=True)
        self.weight = np.array([t["w"] for r in rows for t in r["terms"]], np.int64)[order][self.start]

    def scores(self, size: np.ndarray, ids: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """(bags, items) of exact scores; the bags are ``size`` entries each of ids and tf."""
        row = np.repeat(np.arange(len(size)), size)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        hit = self.ids[at] == ids
        row, at, tf = row[hit], at[hit], tf[hit]
        value = self.weight[at] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
        count = self.count[at]
        first = np.repeat(self.start[at] - np.r_[0, np.cumsum(count)[:-1]] if len(count) else count, count)
        cell = np.repeat(row, count) * len(self.items) + self.posting[first + np.arange(count.sum())]
        shape = (len(size), len(self.items))
        if float(value.max(initial=0)) * max(1, size.max(initial=0)) < 2.0 ** 53:       # sums exact in doubles
            return np.bincount(cell, np.repeat(value, count), shape[0] * shape[1]).astype(np.int64).reshape(shape)
        out = np.zeros(shape[0] * shape[1], np.int64)
        np.add.at(out, cell, np.repeat(value, count))
        return out.reshape(shape)


def _order(ids: np.ndarray) -> np.ndarray:
    return ids if ids.dtype.kind == "i" else ids.astype("U")          # by code point, as Spark orders strings


def _solve(shared, k: int, arrow: pa.Schema):
    """A task's ``k`` best classes of each item of a block, by score and smallest document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        n = len(block.items)
        item, score, first, cls = np.zeros(0, int), np.zeros(0, np.int64), None, np.zeros(0, np.int64)
        least = np.ones(n, np.int64)                       # a score that still counts
        for b in batches:
            step = max(1, (1 << 21) // max(1, n))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                bag, docs = part.column(1), _order(part.column(2).to_numpy(zero_copy_only=False))
                size = np.diff(bag.offsets.to_numpy())
                ids, tf = (f.to_numpy() for f in bag.flatten().flatten())
                s = block.scores(size, ids, tf, part.column(0).to_numpy())
                r, i = np.nonzero(s >= least)
                first = docs[:0] if first is None else first
                item, score = np.r_[item, i], np.r_[score, s[r, i]]
                first, cls = np.concatenate([first, docs[r]]), np.r_[cls, part.column(3).to_numpy()[r]]
                by = np.lexsort((cls, first, -score, item))
                item, score, first, cls = item[by], score[by], first[by], cls[by]
                begin = np.searchsorted(item, np.arange(n))
                best = np.arange(len(item)) - begin[item] < k
                item, score, first, cls = item[best], score[best], first[best], cls[best]
                begin = np.searchsorted(item, np.arange(n + 1))
                full = np.flatnonzero(np.diff(begin) == k)
                least[full] = score[begin[full] + k - 1]
        if len(item):
            yield pa.RecordBatch.from_arrays([block.items.take(pa.array(item)), pa.array(score), pa.array(first.tolist(), arrow.types[2]), pa.array(cls)],
                                             names=arrow.names)
    return run


def _blocks(items: DataFrame, per_block: int, postings: int) -> Iterator[list]:
    """The items in blocks of bounded size, streamed through the driver one at a time."""
    block, size = [], 0
    for r in items.toLocalIterator():
        if block and (len(block) >= per_block or size + len(r["terms"]) > postings):
            yield block
            block, size = [], 0
        block.append(r)
        size += len(r["terms"])
    if block:
        yield block


def _least(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """At most ``k`` rows a group by ``order``; Spark limits the groups before it shuffles them."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           k: int = 50, per_block: int = 1024, postings: int = 1 << 19) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item, equal scores by ascending doc_id.

    ``per_block`` and ``postings`` bound the items of one pass over the classes; they change the speed only."""
    spark = docs.sparkSession
    ship_package(spark)
    asked = items.where(F.col(f"`{item_id}`").isNotNull()).select(F.col(f"`{item_id}`").alias("key"), F.lit(None).cast("string").alias("doc"),
                                                                 _utf8(item_text).alias("text"))
    asked = materialize(_counted(asked, False).select(F.col("key").alias("item"), "term").distinct(), "lexical-items")
    vocabulary = materialize(asked.select("term").distinct().withColumn("id", F.monotonically_increasing_id()), "lexical-vocabulary")
    bag = materialize(bags(docs, vocabulary, doc_id, text), "lexical-bags")

    mark = bag.where("key < 0").agg(F.sum("n").alias("l"), F.sum(F.element_at("bag", 1)["tf"]).alias("n")).first()
    n_terms, n_docs = mark["l"] or 1, mark["n"] or 0
    bag = bag.where("key >= 0")
    df = bag.select(F.explode("bag.id").alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    wanted = (asked.join(vocabulary.join(df.withColumn("w", weight), "id"), "term").groupBy("item")
              .agg(F.collect_list(F.struct("id", "w")).alias("terms")))

    length = F.expr(f"50 + (50 * n * {n_docs}L) div {n_terms}L")
    bag = bag.where("doc is not null").withColumn("m", length).withColumn("h", F.xxhash64("bag", "m"))
    found = classes(bag)
    kind = T.StructType([asked.schema["item"], T.StructField("score", T.LongType()), found.schema["first"], T.StructField("cls", T.LongType())])
    kind = T.StructType([T.StructField(f.name, f.dataType, True) for f in kind])
    arrow = to_arrow_schema(kind)
    folder = stage_path(spark, f"lexical-best-{uuid.uuid4().hex}")
    spark.createDataFrame([], kind).write.parquet(folder)
    for block in _blocks(materialize(wanted, "lexical-asked"), per_block, postings):
        shared = spark.sparkContext.broadcast(ItemBlock(block, arrow.types[0]))
        best = found.select("m", "bag", "first", "cls").mapInArrow(_solve(shared, k, arrow), kind)
        _least(best, ["item"], [F.desc("score"), F.col("first"), F.col("cls")], k).drop("rank").write.mode("append").parquet(folder)
        shared.destroy()
    best = spark.read.schema(kind).parquet(folder)

    chosen = best.select("cls").distinct().join(found, "cls").select("cls", "h", "m", "bag")
    members = bag.join(chosen, ["h", "m", "bag"]).select("cls", "doc", "key")
    members = _least(members, ["cls"], [F.col("doc"), F.col("key")], k).select("cls", "doc", "key")
    ranked = _least(best.join(members, "cls"), ["item"], [F.desc("score"), F.col("doc"), F.col("key")], k)
    return ranked.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")
