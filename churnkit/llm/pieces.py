"""SentencePiece encoding and decoding over a relational lattice.

Encoding works on distinct words, not on texts. Every word is exploded into its substrings of bounded length;
an equi-join with the piece table leaves the lattice's edges; edges are grouped by word and folded with Spark's
higher-order ``aggregate``:

* unigram models: Viterbi. The fold visits the edges by their end, keeps the best score of every position and the
  start of the edge that gave it, and the path is read back from the end.
* BPE models: the library does not take the best-scoring path; it merges the adjacent pair whose piece scores best, again and
  again. No sum of scores gives that result, so here the fold applies the edges as merges, best score first, on
  a bit mask of the cuts inside the word. One pass over the sorted edges suffices where each piece is built from better-scoring
  ones; a word that holds another piece (runs of spaces) repeats the pass, one merge at a time.

A character without a piece becomes its UTF-8 bytes (byte fallback) or the unknown piece. Words longer than
``MAX_WORD`` characters (encoded blobs, scripts without spaces) are merged or searched by a linear-memory
routine in the task that meets them, with the same result.

Texts meet their words again in blocks: a block is a range of ids with a bounded number of characters. The distinct
words of each block travel to the lattice as packed lists, their ids come back in the same order, and the texts travel once,
compressed.

The normaliser is the model's identity one: a space is written as U+2581 and one is put in front. Null or empty text:
no ids. Null ids: a block of their own, split by a hash of the text like any overfull range. Repeated rows are encoded each.
Empty table: empty result. Very long texts and words are encoded whole. Decoding joins the pieces, turns bytes back
into text (malformed sequences into U+FFFD) and drops the space in front.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.llm.common import free
from churnkit.session import materialize, ship_package

SPACE = "▁"
MAX_WORD = 62           # cuts of a word fit into the bits of a long
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6       # piece types of the model format
UNIGRAM, BPE = 1, 2                                                   # model types of the model format


@dataclass(frozen=True)
class Model:
    """Pieces, scores and types of a model file; its size is that of a vocabulary."""

    kind: int
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]

    @staticmethod
    def load(path: str) -> Model:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser and a space in front")
        return Model(proto.trainer_spec.model_type, *zip(*((p.piece, p.score, p.type) for p in proto.pieces)))

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t in (NORMAL, USER)}

    @cached_property
    def byte_ids(self) -> tuple[int, ...]:
        """Ids of the 256 byte pieces; empty without byte fallback."""
        return tuple(i for i, t in enumerate(self.types) if t == BYTE)

    @cached_property
    def unknown(self) -> int:
        return self.types.index(UNKNOWN)

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.ids))

    @cached_property
    def alone(self) -> str:
        """White space that no longer piece holds: always a unit of its own."""
        joined = "".join(p for p in self.ids if len(p) > 1)
        return "".join(c for c in "\n\r\t" if c not in joined)

    @cached_property
    def units(self) -> re.Pattern:
        """Spans that no piece crosses: a run of spaces with the word behind it, or one character of ``alone``."""
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces that cross words")
        cut = f"{SPACE}{self.alone}"
        single = f"[{self.alone}]|" if self.alone else ""
        return re.compile(f"{single}{SPACE}+[^{cut}]*|[^{cut}]+")

    def split(self, text: str) -> list[str]:
        return self.units.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def unit_ids(self, parts: list[str]) -> list[int]:
        """Ids of the pieces of a unit; what is no piece is a single character."""
        out: list[int] = []
        for p in parts:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    @cached_property
    def irregular(self) -> frozenset[str]:
        """Pieces that, merged alone, do not come about by merges of ever lower score."""
        out = set()
        for p in self.ids:
            if len(p) > 1:
                steps: list[float] = []
                if self.merge(p, steps) != [p] or any(a <= b for a, b in zip(steps, steps[1:])):
                    out.add(p)
        return frozenset(out)

    def merge(self, unit: str, steps: list[float] | None = None) -> list[str]:
        """The pieces of one unit by best-first merges: a heap over a linked list."""
        ids, scores, n = self.ids, self.scores, len(unit)
        end, nxt, prev = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n:
                i = ids.get(unit[a:end[b]]) if end[b] - a <= self.longest else None
                if i is not None:
                    heapq.heappush(heap, (-scores[i], a, end[a], end[b]))

        for a in range(n - 1):
            offer(a, a + 1)
        while heap:
            score, a, mid, stop = heapq.heappop(heap)
            if end[a] != mid or mid >= n or end[mid] != stop or nxt[a] != mid:
                continue
            if steps is not None:
                steps.append(-score)
            end[a], nxt[a] = stop, nxt[mid]
            end[mid] = -1
            if nxt[a] < n:
                prev[nxt[a]] = a
            offer(a, nxt[a])
            offer(prev[a], a)
        out, a = [], 0
        while a < n:
            out.append(unit[a:end[a]])
            a = nxt[a]
        return out

    def search(self, unit: str) -> list[str]:
        """The pieces of one unit by Viterbi; ties go to the longer last piece."""
        best, start = [0.0] + [float("-inf")] * len(unit), [0] * (len(unit) + 1)
        for e in range(1, len(unit) + 1):
            for s in range(max(0, e - self.longest), e):
                i = self.ids.get(unit[s:e])
                score = best[s] + (self.scores[i] if i is not None else self.missing if e - s == 1 else float("-inf"))
                if score > best[e]:
                    best[e], start[e] = score, s
        out, e = [], len(unit)
        while e:
            out.append(unit[start[e]:e])
            e = start[e]
        return out[::-1]

    @cached_property
    def missing(self) -> float:
        """Score of a character without a piece: ten below the lowest."""
        return min((s for s, t in zip(self.scores, self.types) if t == NORMAL), default=0.0) - 10.0

    def parts(self, unit: str) -> list[str]:
        return self.merge(unit) if self.kind == BPE else self.search(unit)


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, score, place, irregular): the pieces that text can match, ``place`` by falling score with ties alike.

    A vocabulary, thus small enough to broadcast. Merges need no pieces of one character."""
    odd = model.irregular if model.kind == BPE else frozenset()
    place = {x: i for i, x in enumerate(sorted({model.scores[i] for i in model.ids.values()}, reverse=True))}
    rows = [(p, float(model.scores[i]), place[model.scores[i]], p in odd) for p, i in model.ids.items() if len(p) >= shortest(model)]
    return spark.createDataFrame(rows, "piece string, score double, place long, irregular boolean")


def shortest(model: Model) -> int:
    return 2 if model.kind == BPE else 1


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def lattice(words: DataFrame, pieces: DataFrame, lengths: tuple[int, int], keys: list[str], word: str = "word") -> DataFrame:
    """(keys, s, e, and the piece's columns): the edges of every word, e exclusive. ``keys`` identify a word.

    ``lengths``: the shortest and the longest piece."""
    short, long = lengths
    starts = F.sequence(F.lit(0), F.length(word) - short)
    spans = words.where(F.length(word) >= short).select(*keys, F.col(word).alias("__word"), F.explode(starts).alias("s"))
    spans = spans.select(*keys, "__word", "s", F.explode(F.sequence(F.lit(short), F.least(F.lit(long), F.length("__word") - F.col("s")))).alias("len"))
    spans = spans.select(*keys, "s", (F.col("s") + F.col("len")).alias("e"), F.substring(F.col("__word"), F.col("s") + 1, F.col("len")).alias("piece"))
    return spans.join(F.broadcast(pieces), "piece").drop("piece")


def _merged(edges: Column, size: Column, irregular: Column) -> Column:
    """Mask of the cuts left (bit i: a piece starts at i) after all merges.

    An edge is a long, place << 16 | s << 8 | e; sorted, the best come first and the leftmost of equals."""
    start = _bit(size + 1) - 1

    def s(x: Column) -> Column:
        return F.shiftright(x, 8).bitwiseAND(F.lit(255)).cast("int")

    def e(x: Column) -> Column:
        return x.bitwiseAND(F.lit(255)).cast("int")

    def inner(x: Column) -> Column:
        return _bit(e(x)) - _bit(s(x) + 1)

    def fits(cuts: Column, x: Column) -> Column:          # both ends are cuts, with one cut between
        ends = _bit(s(x)).bitwiseOR(_bit(e(x)))
        return (cuts.bitwiseAND(ends) == ends) & (F.bit_count(cuts.bitwiseAND(inner(x))) == 1)

    def join(cuts: Column, x: Column) -> Column:
        return cuts.bitwiseAND(F.bitwise_not(inner(x)))

    once = F.aggregate(edges, start, lambda cuts, x: F.when(fits(cuts, x), join(cuts, x)).otherwise(cuts))

    def step(cuts: Column, _: Column) -> Column:
        ready = F.filter(edges, lambda x: fits(cuts, x))
        return F.when(F.size(ready) > 0, join(cuts, F.get(ready, F.lit(0)))).otherwise(cuts)

    return F.when(irregular, F.aggregate(F.sequence(F.lit(1), size), start, step)).otherwise(once)


def _viterbi(edges: Column, size: Column, missing: float) -> Column:
    """Mask of the cuts on the best path. Edges are sorted by end, then start.

    The state holds the best score and the first cut of the best last edge for each position so far; a
    position without an edge of length one may be reached by the unknown character at ``missing``."""
    low = F.lit(float("-inf"))
    init = F.struct(F.array(F.lit(0.0)).alias("best"), F.array(F.lit(0)).alias("start"))

    def advance(state: Column, e: Column) -> Column:
        into = F.filter(edges, lambda x: x["e"] == e)
        single = F.exists(into, lambda x: x["s"] == e - 1)
        ways = F.transform(into, lambda x: F.struct((F.get(state["best"], x["s"]) + x["score"]).alias("v"), (-x["s"]).alias("neg"), x["s"].alias("s")))
        unknown = F.struct(F.when(single, low).otherwise(F.get(state["best"], e - 1) + missing).alias("v"), (1 - e).alias("neg"), (e - 1).alias("s"))
        top = F.array_max(F.concat(ways, F.array(unknown)))
        return F.struct(F.concat(state["best"], F.array(top["v"])).alias("best"), F.concat(state["start"], F.array(top["s"])).alias("start"))

    end = F.aggregate(F.sequence(F.lit(1), size), init, advance)
    back = F.aggregate(F.sequence(F.lit(1), size), F.struct(size.alias("at"), _bit(size).alias("cuts"), end["start"].alias("start")),
                       lambda a, _: F.when(a["at"] > 0, F.struct(
                           F.get(a["start"], a["at"]).alias("at"),
                           a["cuts"].bitwiseOR(_bit(F.get(a["start"], a["at"]))).alias("cuts"),
                           a["start"].alias("start"))).otherwise(a))
    return back["cuts"]


def segment(words: DataFrame, model: Model, keys: list[str], word: str = "word") -> DataFrame:
    """(keys, word, cuts) for distinct words of 1 to MAX_WORD characters: bit i of ``cuts`` is set if a piece starts at i.

    ``keys`` identify a word and include it. If ``words`` is partitioned by one of them, nothing is shuffled."""
    edges = lattice(words, piece_table(words.sparkSession, model), (shortest(model), model.longest), keys, word)
    if model.kind == BPE:
        edge = F.shiftleft("place", 16).bitwiseOR(F.shiftleft("s", 8).cast("long")).bitwiseOR(F.col("e").cast("long"))
    else:
        edge = F.struct("e", "s", "score")
    found = edges.select(*keys, edge.alias("edge"), "irregular").groupBy(*keys).agg(
        F.sort_array(F.collect_list("edge")).alias("edges"), F.bool_or("irregular").alias("irregular"))
    rows = found.withColumn("size", F.length(word))
    if model.kind == BPE:
        return rows.select(*keys, _merged(F.col("edges"), F.col("size"), F.col("irregular")).alias("cuts"))
    return rows.select(*keys, _viterbi(F.col("edges"), F.col("size"), model.missing).alias("cuts"))


# ---------------------------------------------------------------- texts and their words

def _give_back() -> None:
    """Free memory returns to the system: the worker lives on beside the next stage."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _frame(batch: pa.RecordBatch, packer) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return packer.compress(sink.getvalue())


def _per_block(batches: Iterator[pa.RecordBatch], block_at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    for b in batches:
        at = b.column(block_at).to_numpy(zero_copy_only=False)
        for block in np.unique(at):
            yield int(block), b.filter(pa.array(at == block)) if (at != block).any() else b


def _flat_units(model: Model, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts, one after the other, and their number in each text (NULL: none)."""
    cut = "\0"
    texts = pc.fill_null(texts, "")
    odd = [pc.match_substring(texts, x) for x in ("  ", SPACE, cut)] + [
        pc.starts_with(texts, " "), pc.ends_with(texts, " "), pc.equal(texts, "")]
    odd = np.logical_or.reduce([x.to_numpy(zero_copy_only=False) for x in odd])
    plain = pc.binary_join_element_wise(SPACE, texts.filter(pa.array(~odd)), "")
    plain = pc.replace_substring(plain, " ", cut + SPACE)
    for c in model.alone:
        plain = pc.replace_substring(plain, c, cut + c + cut)
    plain = pc.split_pattern(plain, cut)
    others = pa.array([model.split(t.as_py()) for t in texts.filter(pa.array(odd))], pa.list_(pa.string()))
    order = np.empty(len(texts), np.int64)
    order[~odd], order[odd] = np.arange(len(plain)), len(plain) + np.arange(len(others))
    lists = pa.concat_arrays([plain, others]).take(pa.array(order)) if odd.any() else plain
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def _buckets(units: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each unit, from all its bytes."""
    offsets = np.frombuffer(units.buffers()[1], np.int32, len(units) + 1, units.offset * 4)
    mixed = np.frombuffer(units.buffers()[2], np.uint8, offsets[-1] - offsets[0], offsets[0]).astype(np.uint32)
    at = np.arange(len(mixed), dtype=np.int32)
    at -= np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
    mixed += np.uint32(1)
    mixed *= np.uint32(2654435761) * (at.view(np.uint32) * np.uint32(2) + np.uint32(1))
    mixed ^= mixed >> np.uint32(13)
    mixed *= np.uint32(2246822519)
    return np.add.reduceat(mixed, (offsets[:-1] - offsets[0]).astype(np.int64)) % np.uint32(buckets)


def _dealt(found: list[pa.Array], buckets: int) -> tuple[np.ndarray, pa.ListArray]:
    """The buckets that the distinct units fall in, and the units of each, sorted. Both ends of the lattice rely on this order."""
    units = pc.unique(pa.concat_arrays([pa.array([], pa.string()), *found]))
    size = pc.utf8_length(units)
    units = units.filter(pc.and_(pc.greater_equal(size, 2), pc.less_equal(size, MAX_WORD)))
    units = units.take(pc.sort_indices(units))
    at = _buckets(units, buckets) if len(units) else np.zeros(0, np.uint32)
    held, counts = np.unique(at, return_counts=True)
    units = units.take(pa.array(np.argsort(at, kind="stable")))
    return held, pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), units)


def _frames(payloads: pa.ChunkedArray, rows: int = 512) -> Iterator[pa.Table]:
    """The texts of a block; scattered ones come in many small frames, which are joined."""
    import zstandard

    unpack, held = zstandard.ZstdDecompressor().decompress, []
    for payload in payloads:
        held.append(pa.ipc.open_stream(unpack(payload.as_py())).read_all())
        if sum(h.num_rows for h in held) >= rows:
            yield pa.concat_tables(held).combine_chunks()
            held = []
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _words_of(model: Model, buckets: int):
    """Distinct units of a block that the lattice takes, packed: (bucket, block, units joined by a line feed)."""
    def run(key: tuple, texts: pa.Table) -> pa.Table:
        found = [pc.unique(_flat_units(model, f.column(f.num_columns - 1).combine_chunks())[0]) for f in _frames(texts.column("payload"))]
        held, lists = _dealt(found, buckets)
        _give_back()
        return pa.table([pa.array(held.astype(np.int32)), pa.array(np.full(len(held), key[0].as_py(), np.int64)),
                         pc.binary_join(lists, "\n")], names=["bucket", "block", "words"])

    return run


class _Table:
    """Units and their ids, one after the other."""

    def __init__(self, model: Model, units: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.model, self.units, self.ids, self.sizes = model, units, ids, sizes

    def find(self, units: pa.Array, parts: Callable[[str], list[str]]) -> np.ndarray:
        """The place of each unit; a unit that is not here yet is cut by ``parts`` and added."""
        at = pc.index_in(units, value_set=self.units)
        if at.null_count:
            missing = units.filter(pc.is_null(at))
            new = pc.unique(missing)
            made = [self.model.unit_ids(parts(u)) if u else [] for u in new.to_pylist()]
            later = pc.add(pc.index_in(missing, value_set=new), len(self.units))
            at = pc.replace_with_mask(at, pc.is_null(at), later.cast(pa.int32()))
            self.units = pa.concat_arrays([self.units, new])
            self.ids = np.concatenate([self.ids, *(np.array(m, self.ids.dtype) for m in made)])
            self.sizes = np.concatenate([self.sizes, np.array([len(m) for m in made], np.int64)])
        return at.to_numpy()

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these places, one after the other, and their numbers."""
        starts = np.cumsum(self.sizes) - self.sizes
        sizes = self.sizes[at]
        shift = starts[at] - (np.cumsum(sizes) - sizes)
        where = np.repeat(shift.astype(np.int32), sizes)
        where += np.arange(len(where), dtype=np.int32)
        return self.ids[where], sizes


def _answers(model: Model, dtype: str):
    """For a bucket: the ids of each block's units and their numbers, in the order of the units, compressed.

    The units themselves do not travel back: the block knows them."""
    def run(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        ids: list[list[int]] = []
        for word, cuts in zip(known.column("word").to_pylist(), known.column("cuts").to_pylist()):
            at = [i for i in range(len(word) + 1) if cuts >> i & 1]
            ids.append(model.unit_ids([word[a:b] for a, b in zip(at, at[1:])]))
        sizes = np.array([len(x) for x in ids], np.int64)
        words = known.column("word").combine_chunks() if known.num_rows else pa.array([], pa.string())
        table = _Table(model, words, np.array([i for x in ids for i in x], dtype), sizes)
        out: list[tuple] = []
        for block, words in zip(asked.column("block").to_pylist(), asked.column("words").to_pylist()):
            units = pa.array(words.split("\n"), pa.string())
            got, counts = table.gather(table.find(units, list))      # no edge at all: every character stands alone
            out.append((block, key[0].as_py(), pack(got.tobytes()), pack(counts.astype("<u2").tobytes())))
        cols = list(zip(*out)) or [()] * 4
        _give_back()
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["block", "bucket", "ids", "counts"])

    return run


def _encode(model: Model, dtype: str, buckets: int, names: list[str]):
    """Texts of a block from its units' ids. A text is held only while its units are taken."""
    import xxhash

    def hash_of(text: pa.Scalar) -> tuple[int, bool]:
        """The hash of the text with U+2581 as a space, and whether it holds one."""
        raw = bytes(text.as_buffer()) if text.is_valid else b""
        plain = raw.replace(SPACE.encode(), b" ")
        return xxhash.xxh64_intdigest(plain, 42), plain != raw

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        rows: list[tuple] = []
        for batch in _frames(texts.column("payload")):
            body = batch.column(batch.num_columns - 1).combine_chunks()
            flat, in_text = _flat_units(model, body)
            hashes, marked = zip(*map(hash_of, body)) if len(body) else ((), ())
            hashes = np.array(hashes, np.uint64).view(np.int64)
            rows.append((batch.columns[:-1], flat.dictionary_encode(), in_text, hashes, np.array(marked, bool)))

        held, lists = _dealt([coded.dictionary for _, coded, *_ in rows], buckets)
        order = pc.sort_indices(answers.column("bucket").combine_chunks())
        answers = answers.take(order)
        counts = [np.frombuffer(unpack(x.as_py()), "<u2").astype(np.int64) for x in answers.column("counts")]
        if answers.column("bucket").to_pylist() != held.tolist() or [len(c) for c in counts] != pc.list_value_length(lists).to_pylist():
            raise RuntimeError("the answers do not match the units of their block")
        ids = np.frombuffer(b"".join(unpack(x.as_py()) for x in answers.column("ids")), dtype)
        table = _Table(model, lists.flatten(), ids, np.concatenate([np.zeros(0, np.int64), *counts]))

        outs = []
        for kept, coded, in_text, hashes, marked in rows:
            at = table.find(coded.dictionary, model.parts)[coded.indices.to_numpy()]
            got, in_unit = table.gather(at)
            ends = np.r_[0, np.cumsum(in_unit)][np.r_[0, np.cumsum(in_text)]]
            made = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(got.astype("<i4"), pa.int32()))
            outs.append(pa.table([*kept, made, pa.array(np.diff(ends).astype(np.int64)), pa.array(hashes), pa.array(marked)], names=names))
        _give_back()
        return pa.concat_tables(outs)

    return run


def encode(docs: DataFrame, model: Model, keep: list[str], doc_id: str = "doc_id", text: str = "text",
           block_chars: int = 8_000_000) -> DataFrame:
    """``keep`` columns, then ids (array<int>), n_tokens, text_hash (XXH64 of the text with U+2581 as a space) and has_mark (whether
    the text holds U+2581), one row per row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    body, name, row = F.make_valid_utf8(F.col(f"`{text}`")), F.col(f"`{doc_id}`"), F.monotonically_increasing_id()
    numbered = isinstance(docs.schema[doc_id].dataType, T.IntegralType)
    low, high, chars = docs.agg(F.min(name) if numbered else F.lit(None), F.max(name) if numbered else F.lit(None),
                                F.coalesce(F.sum(F.length(body)), F.lit(0))).first()
    want = max(1, -(-chars // block_chars))
    by_row = F.pmod(F.xxhash64(row), F.lit(want))                        # even whatever the ids and texts are
    if numbered:                                                         # neighbouring ids share a block
        width = 1 if low is None else max(1, -(-(high - low + 1) // want))
        wide = low is not None and high - low >= 2 ** 62                # differences that a long may not hold
        from_low = (name.cast("decimal(38,0)") if wide else name) - F.lit(low or 0).cast("decimal(38,0)" if wide else "long")
        ranged = F.coalesce(F.floor(from_low / F.lit(width).cast("decimal(38,0)" if wide else "long")).cast("long"), F.lit(-1).cast("long"))
        fullest = docs.groupBy(ranged.alias("r")).agg(F.sum(F.length(body)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        split = max(1, -(-fullest // (2 * block_chars)))                 # an uneven layout: every range in so many parts
        block = ranged if split == 1 else ranged * split + F.pmod(row, F.lit(split)) if split <= 4 else by_row
        split = split if split <= 4 else 1
    else:
        block, split = by_row, 1
    in_block, in_text = free("__block", keep), free("__text", keep)
    blocked = docs.select(block.alias(in_block), body.alias(in_text), *[F.col(f"`{c}`") for c in keep])
    buckets = int(max(8, want * split * 4))                             # linear in the text
    dtype = "<u2" if len(model.pieces) <= 65536 else "<u4"

    payload = [f for f in blocked.schema if f.name in keep] + [T.StructField(in_text, T.StringType())]
    order = [*keep, in_text]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=5)
        for key, b in _per_block(batches, 0):
            part = b.select(order)
            for at in range(0, part.num_rows, 512):
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([_frame(part.slice(at, 512), packer)], pa.binary())],
                                                 names=["block", "payload"])

    # one shuffle brings the texts of a block together, however they were laid out; its words are taken there
    packed = blocked.mapInArrow(pack, "block long, payload binary").repartition("block")
    asked = packed.groupBy("block").applyInArrow(_words_of(model, buckets), "bucket int, block long, words string").repartition("bucket")
    # the block is asked for only so that both readers of ``asked`` need the same columns and share its shuffle
    words = (asked.select("bucket", "block", F.explode(F.split("words", "\n")).alias("word"))
             .groupBy("bucket", "word").agg(F.min("block").alias("block")).where(F.col("block").isNotNull())
             .select(F.xxhash64("word").alias("h"), "bucket", "word"))          # h first: the grouping sorts by a number
    known = segment(words, model, ["h", "bucket", "word"]).select(F.col("bucket").alias("b"), "word", "cuts")
    answers = asked.groupBy("bucket").cogroup(known.groupBy("b")).applyInArrow(
        _answers(model, dtype), "block long, bucket int, ids binary, counts binary").withColumnRenamed("block", "in_block")

    out = T.StructType([f for c in keep for f in payload if f.name == c] + [
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("text_hash", T.LongType()),
        T.StructField("has_mark", T.BooleanType())])
    return packed.groupBy("block").cogroup(answers.groupBy("in_block")).applyInArrow(_encode(model, dtype, buckets, out.names), out)


def decode(ids: Column, model: Model) -> Column:
    """The text of an array of ids, in the JVM: pieces as hex, joined, read as UTF-8, spaces restored."""
    def raw(i: int) -> str:
        if model.types[i] == BYTE:
            return model.pieces[i][3:5]
        return "" if model.types[i] == CONTROL else model.pieces[i].replace(SPACE, " ").encode().hex()

    table = F.array(*[]) if not model.pieces else F.from_json(F.lit("[" + ",".join(f'"{raw(i)}"' for i in range(len(model.pieces))) + "]"), "array<string>")
    joined = F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")
    text = F.make_valid_utf8(F.unhex(joined).cast("string"))
    return F.when(F.startswith(text, F.lit(" ")), F.substring(text, 2, 2_147_483_647)).otherwise(text)


def round_trip(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip, exact): ``round_trip`` is whether decoding the ids gives the text with U+2581 as a
    space, which is how the model reads it; ``exact`` whether it gives the text as it is, so false for texts that hold U+2581."""
    rows = encode(docs, model, [doc_id], doc_id, text, **how)
    same = F.xxhash64(decode(F.col("ids"), model)) == F.col("text_hash")
    return (rows.select(F.col(f"`{doc_id}`"), "n_tokens", "ids", same.alias("round_trip"), "has_mark")
            .withColumn("exact", F.col("round_trip") & ~F.col("has_mark")).drop("has_mark"))
