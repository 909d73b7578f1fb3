"""Token counts of flat, unindexed token files by separator scan.

A token file is an array of fixed-width little-endian token ids; an end-of-document id closes each document.
There is no index, so files are cut into byte blocks that tasks read on their own, by range, from the shared store.
In each block a vectorised search finds the separators; a block gives its separator count, the tokens before the first
and after the last, and the lengths between. Documents that span blocks are stitched by a prefix scan over the block
summaries (one row a block).

Empty files and an empty folder: no rows. Two separators in a row: a document of 0 tokens. Tokens after the last
separator: a document with ``closed`` false. Very long documents: any number of blocks. Repeated documents count each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.session import materialize, ship_package


def _store(uri: str):
    """The file system and path of a folder or file that Spark names; a path without a scheme is local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, make_encoder: Callable[[], Callable[[str], Sequence[int]]], eod: int,
                      doc_id: str = "doc_id", text: str = "text", dtype: str = "<u2") -> DataFrame:
    """One token file a partition of ``docs``, and their manifest (file, ordinal, doc_id), written beside them.

    A file appears under its final name when it is complete; a task that runs again writes the same bytes. Null
    text: a document of 0 tokens."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():06d}.bin"
        draft = f"{base}/_draft-{task.partitionId()}-{task.taskAttemptId()}"
        encode, end, at, out = make_encoder(), np.array([eod], dtype).tobytes(), 0, None
        for b in batches:
            if out is None and b.num_rows:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(draft)
            for t in b.column(1):
                ids = np.array(encode(t.as_py() or ""), dtype)
                out.write(ids.tobytes() + end)
            ordinals = np.arange(at, at + b.num_rows)
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([name] * b.num_rows, pa.string()), pa.array(ordinals, pa.int64()), b.column(0)],
                                             names=["file", "ordinal", "doc_id"])
        if out is not None:
            out.close()
            store.move(draft, f"{base}/{name}")

    return materialize(source.mapInArrow(write, "file string, ordinal long, doc_id long"), "token-manifest")


def _scan(eod: int, dtype: str):
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "n_tokens", "n_ends", "head", "tail", "starts", "lengths"]
        kinds = [pa.string(), *[pa.int64()] * 5, *[pa.list_(pa.int64())] * 2]
        for b in batches:
            for path, block, start, size in zip(*(c.to_pylist() for c in b.columns)):
                store, at = _store(path)
                with store.open_input_file(at) as f:
                    ids = np.frombuffer(f.read_at(size // width * width, start), dtype)
                ends = np.flatnonzero(ids == eod)
                n = len(ids)
                head, tail = (int(ends[0]), n - 1 - int(ends[-1])) if len(ends) else (n, n)
                row = [path, block, n, len(ends), head, tail, ends[:-1] + 1, np.diff(ends) - 1]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    return run


def token_counts(spark: SparkSession, folder: str, eod: int, dtype: str = "<u2", block_bytes: int = 4 << 20) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document in the ``*.bin`` files of ``folder``.

    ``start`` is the position of its first token in the file."""
    ship_package(spark)
    width = np.dtype(dtype).itemsize
    step = max(1, block_bytes // width) * width
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").option("recursiveFileLookup", "true")
    files = listing.load(folder).select("path", "length").where(f"length >= {width}")        # names and sizes, no bytes
    n_blocks = files.agg(F.coalesce(F.sum(F.ceil(F.col("length") / step)), F.lit(0))).first()[0]
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))
    blocks = (files.select("path", "length", F.posexplode(starts).alias("block", "start"))
              .select("path", F.col("block").cast("long").alias("block"), "start", F.least(F.lit(step), F.col("length") - F.col("start")).alias("size")))
    spread = max(1, min(int(n_blocks), max(4 * spark.sparkContext.defaultParallelism, int(n_blocks) // 16)))
    scanned = materialize(blocks.repartition(spread, "path", "block").mapInArrow(
        _scan(eod, dtype), "file string, block long, n_tokens long, n_ends long, head long, tail long, starts array<long>, lengths array<long>"), "token-blocks")

    # prefix scan over the summaries: separators so far, and the tokens left open since the last one
    in_file = W.partitionBy("file").orderBy("block")
    sums = scanned.select("file", "block", "n_tokens", "n_ends", "tail")
    sums = sums.withColumn("ends", F.sum("n_ends").over(in_file)).withColumn("tokens", F.sum("n_tokens").over(in_file))
    left = F.sum(F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("n_tokens"))).over(W.partitionBy("file", "ends").orderBy("block"))
    sums = sums.withColumn("left_open", left)
    carried = sums.select("file", "block", F.coalesce(F.lag("left_open").over(in_file), F.lit(0)).alias("carry"),
                          (F.col("ends") - F.col("n_ends")).alias("before"), (F.col("tokens") - F.col("n_tokens")).alias("at"),
                          "left_open", "ends", "tokens", F.lead("block").over(in_file).isNull().alias("is_last"))
    carried = materialize(carried, "token-sums")
    whole = scanned.where("n_ends > 0").join(carried.select("file", "block", "carry", "before", "at"), ["file", "block"])
    # the block's first separator closes the document carried in; each later one a document of its own
    starts = F.concat(F.array(-F.col("carry")), F.col("starts"))
    lengths = F.concat(F.array(F.col("carry") + F.col("head")), F.col("lengths"))
    docs = whole.select("file", "before", "at", F.posexplode(F.arrays_zip(starts.alias("s"), lengths.alias("n"))).alias("i", "doc"))
    docs = docs.select("file", (F.col("before") + F.col("i")).alias("ordinal"), (F.col("at") + F.col("doc.s")).alias("start"),
                       F.col("doc.n").alias("n_tokens"), F.lit(True).alias("closed"))
    tail = carried.where("is_last AND left_open > 0").select(
        "file", F.col("ends").alias("ordinal"), (F.col("tokens") - F.col("left_open")).alias("start"), F.col("left_open").alias("n_tokens"), F.lit(False).alias("closed"))
    return docs.unionByName(tail).withColumn("file", F.element_at(F.split("file", "/"), -1))


def byte_bpe(path: str) -> Callable[[], Callable[[str], Sequence[int]]]:
    """A maker of a byte-level BPE encoder from a rank file (text of base64 pieces and ranks)."""
    def make():
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return make
