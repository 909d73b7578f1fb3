"""Byte-level BPE by the tiktoken library with a local rank file.

Texts are encoded whole. The pattern that splits a text into pieces lets no piece hold a non-space before a space,
so a long text is cut, before the library sees it, at places where a piece must end: between a non-space and the
white space after it, and before the last white space of a run. White space runs longer than a segment are one piece
(less their last character where text follows), which the library's backtracking pattern cannot take whole; they go to the
library with a pattern that does not split. All cuts leave the ids as they are.

Special tokens are not recognised: their strings are ordinary text. Null text: no ids. Empty text: no ids. Invalid
UTF-8 is read as U+FFFD, as Spark does. Very long texts: a segment at a time, so a task holds one text, its ids and one segment.
Repeated rows are rows each; other columns, whatever their names, are kept or left out as ``keep`` says. Decoding gives bytes: null ids
give no bytes, an id that the rank file lacks or a null id is an error. Empty table: empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from churnkit.llm.common import field
from churnkit.session import ship_package

# The White_Space property, which the splitting pattern calls \s.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])|(?<=[{SPACE}])(?=[{SPACE}][^{SPACE}])")
SEGMENT = 1 << 16          # code points a segment holds before it is cut at the next safe place
_FLUSH = 1 << 20           # ids or bytes an output batch holds at least, but for the last


@dataclass(frozen=True)
class Ranks:
    """A rank file's bytes and its splitting pattern: about a megabyte, shipped to the tasks."""

    data: bytes
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Ranks:
        with open(path, "rb") as f:
            return cls(f.read(), pattern)

    def codec(self) -> Codec:
        return _codec(self.data, self.pattern)


class Codec:
    def __init__(self, data: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(None, data.splitlines()))}
        self.split = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=table, special_tokens={})

    def encode(self, text: str | None, segment: int = SEGMENT) -> np.ndarray:
        """The ids of a whole text."""
        made = [np.array((self.whole if one else self.split).encode_ordinary(part), np.int32) for part, one in segments(text or "", segment)]
        return np.concatenate(made) if made else np.zeros(0, np.int32)

    def decode(self, ids: Sequence[int]) -> bytes:
        return self.split.decode_bytes(ids)


@lru_cache(maxsize=2)
def _codec(data: bytes, pattern: str) -> Codec:
    return Codec(data, pattern)


def segments(text: str, segment: int = SEGMENT) -> Iterator[tuple[str, bool]]:
    """(part, one): the parts of a text in order, cut where a piece must end; ``one`` marks a part that is one piece."""
    at = 0
    if len(text) > segment:
        for run in re.finditer(rf"[{SPACE}]{{{segment},}}", text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield from ((part, False) for part in _cut(text, at, run.start(), segment))
            yield text[run.start():end], True
            at = end
    yield from ((part, False) for part in _cut(text, at, len(text), segment))


def _cut(text: str, at: int, end: int, segment: int) -> Iterator[str]:
    while end - at > segment and (cut := _CUT.search(text, at + segment, end)) and cut.start() < end:
        yield text[at:cut.start()]
        at = cut.start()
    if at < end:
        yield text[at:end]


def _rows(source: DataFrame, make, kind: T.DataType, name: str, weigh) -> DataFrame:
    """The columns of ``source`` but the last, then ``name``: what ``make()``'s function gives for the last column."""
    schema = T.StructType([source.schema[i] for i in range(len(source.columns) - 1)] + [field(name, kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()

        def batch(kept: pa.RecordBatch, made: list) -> pa.RecordBatch:
            columns = [c.cast(t) for c, t in zip(kept.columns, arrow.types)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(made, arrow.types[-1])], names=arrow.names)

        for b in batches:
            made, start, weight = [], 0, 0
            kept = b.select(list(range(b.num_columns - 1)))
            for i, v in enumerate(b.column(b.num_columns - 1)):
                made.append(fn(v))
                weight += weigh(made[-1])
                if weight >= _FLUSH:
                    yield batch(kept.slice(start, len(made)), made)
                    made, start, weight = [], i + 1, 0
            if made:
                yield batch(kept.slice(start, len(made)), made)

    return source.mapInArrow(run, schema)


def encode(df: DataFrame, ranks: Ranks, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, then ids array<int>: the whole text's token ids."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(ranks)           # one rank file
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.make_valid_utf8(F.col(f"`{text}`").cast("string")).alias("__text"))

    def make():
        codec = shared.value.codec()
        return lambda v: codec.encode(v.as_py())

    return _rows(source, make, T.ArrayType(T.IntegerType(), True), "ids", len)


def decode(df: DataFrame, ranks: Ranks, keep: Sequence[str], ids: str = "ids") -> DataFrame:
    """The ``keep`` columns, then decoded binary: the bytes that the ids stand for."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").cast("array<int>").alias("__ids"))

    def make():
        codec = shared.value.codec()

        def one(v: pa.ListScalar) -> bytes:
            if not v.is_valid:
                return b""
            got = v.values.to_numpy(zero_copy_only=not v.values.null_count)
            return b"".join(codec.decode(got[i:i + SEGMENT].tolist()) for i in range(0, len(got), SEGMENT))
        return one

    return _rows(source, make, T.BinaryType(), "decoded", len)


def digests(docs: DataFrame, ranks: Ranks, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document: the ids encoded, then decoded again."""
    coded = encode(docs, ranks, [doc_id], text)
    back = decode(coded, ranks, [doc_id, "ids"])
    return back.select(F.col(f"`{doc_id}`").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.btrim(F.to_json("ids"), F.lit("[]")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
