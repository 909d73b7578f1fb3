"""Quality classifier: a weak-label model of overlapping heuristics trains a hashed linear scorer.

1. Heuristic labellers vote good, bad or abstain on every document (one pass over whole texts).
2. The votes of all documents are counted by vote pattern (at most 3 ** labellers rows) and
   expectation-maximisation over the patterns estimates each labeller's accuracy and the posterior
   of every pattern. No labels are used.
3. A logistic model over hashed features (character-class trigrams, binned measures) is fitted to
   the posteriors of a bounded sample of documents (about ``sample_rows``, by a hash of the id; where ids are
   missing or repeat so that this gives none or over twice as many, at random from a seed).
4. The scorer judges every document.

Null, empty or blank text: every labeller abstains, score 0, rejected. Null doc_id and repeated rows: each row
is judged alone. Very long texts: whole, one at a time with its list of words. Empty table: empty result. A score
equal to the threshold keeps the document. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.llm.common import field, filter_texts, per_text
from churnkit.session import materialize, ship_package

BAD, GOOD, ABSTAIN = 0, 1, 2
SYMBOLS = "#*$%&|<>=~^{}[]\\_@"
PUNCTUATION = SYMBOLS + "!?.,;:'\"()/+-`"
_MARKED = re.compile(f"[{re.escape(SYMBOLS)}]\\S*")


@dataclass(frozen=True)
class Measures:
    words: int
    symbols: float        # symbol characters a word
    marked: float         # words with a symbol character
    other: float          # characters that are neither letters, digits nor blanks
    upper: float          # capital share of the letters
    shout: float          # exclamation marks a word
    distinct: float       # distinct words, against what a text of this length usually has at least
    repeats: float        # words equal to the word before
    lines: float          # lines equal to an earlier line
    word_chars: float


def measure(text: str) -> Measures | None:
    words = text.split()
    n = len(words)
    if not n:
        return None
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = sum(map(text.count, "abcdefghijklmnopqrstuvwxyz"))
    lines = [x for x in text.split("\n") if x.strip()]
    chars = sum(map(len, words))
    other = sum(map(text.count, PUNCTUATION))
    return Measures(
        n, sum(map(text.count, SYMBOLS)) / n, len(_MARKED.findall(text)) / n, other / chars, upper / max(1, upper + lower), text.count("!") / n,
        len(set(words)) / min(n, 400 + 0.25 * n), sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(lines)) / len(lines), chars / n)


def _band(value: float, good: float, bad: float) -> int:
    """Good up to ``good``, bad from ``bad`` on (or the other way round), abstain between."""
    if good < bad:
        return GOOD if value <= good else BAD if value >= bad else ABSTAIN
    return GOOD if value >= good else BAD if value <= bad else ABSTAIN


# Each labeller sees one side of the text; they overlap, and EM weighs them.
LABELLERS = (
    lambda m: _band(m.symbols, 0.05, 0.30),
    lambda m: _band(m.marked, 0.05, 0.25),
    lambda m: _band(m.other, 0.07, 0.15) if m.words >= 5 else ABSTAIN,
    lambda m: _band(m.upper, 0.12, 0.40) if m.words >= 5 else ABSTAIN,
    lambda m: _band(m.shout, 0.05, 0.30),
    lambda m: _band(m.distinct, 0.45, 0.25) if m.words >= 20 else ABSTAIN,
    lambda m: _band(m.repeats, 0.05, 0.20) if m.words >= 8 else ABSTAIN,
    lambda m: _band(m.lines, 0.40, 0.75) if m.words >= 20 else ABSTAIN,
    lambda m: _band(abs(m.word_chars - 5.5), 2.5, 4.5) if m.words >= 10 else ABSTAIN,
)


def votes(m: Measures | None) -> int:
    """The votes as one number in base 3, the first labeller first."""
    code = 0
    for labeller in LABELLERS:
        code = 3 * code + (labeller(m) if m else ABSTAIN)
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    """(patterns, labellers) of BAD / GOOD / ABSTAIN."""
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return codes[:, None] // powers % 3


@dataclass(frozen=True)
class WeakModel:
    prior: float                   # share of good documents
    right: np.ndarray              # (labellers, 2): chance of the right vote, given bad / good and a vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of good for each row of votes; abstaining tells nothing."""
        score = np.full(len(patterns), np.log(self.prior) - np.log1p(-self.prior))
        for j, (bad, good) in enumerate(self.right):
            score += np.where(patterns[:, j] == GOOD, np.log(good) - np.log1p(-bad), 0.0)
            score += np.where(patterns[:, j] == BAD, np.log1p(-good) - np.log(bad), 0.0)
        return 1 / (1 + np.exp(-np.clip(score, -50, 50)))


def fit_weak_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, smooth: float = 1.0) -> WeakModel:
    """EM over vote patterns and their counts.

    It starts from what the labellers are made for: each sees one kind of defect, so a bad document trips a
    quarter of them, and a good one hardly any. ``smooth`` pseudo-counts keep every chance off 0 and 1; a labeller
    that never votes keeps its start."""
    k = patterns.shape[1]
    start = (0.25, 0.99)
    model = WeakModel(0.8, np.tile(start, (k, 1)))
    for _ in range(rounds):
        p = model.posterior(patterns) * counts
        q = counts - p
        right = np.empty((k, 2))
        for j in range(k):
            bad, good = patterns[:, j] == BAD, patterns[:, j] == GOOD
            right[j] = [(q[bad].sum() + start[0] * smooth) / (q[bad | good].sum() + smooth),
                        (p[good].sum() + start[1] * smooth) / (p[bad | good].sum() + smooth)]
        right = np.clip(right, 1e-4, 1 - 1e-4)
        right[:, 0] = np.maximum(right[:, 0], 1 - right[:, 1])      # a vote is never read backwards
        prior = float(np.clip((p.sum() + smooth) / (counts.sum() + 2 * smooth), 1e-3, 1 - 1e-3))
        settled = abs(prior - model.prior) < 1e-9 and np.abs(right - model.right).max() < 1e-9
        model = WeakModel(prior, right)
        if settled:
            break
    return model


def _byte_classes() -> np.ndarray:
    """Lower-case a, capitals A, digits 0, blanks one, non-ASCII one; every other byte itself."""
    kind = np.arange(256, dtype=np.uint32)
    for low, high, to in (("a", "z", "a"), ("A", "Z", "A"), ("0", "9", "0")):
        kind[ord(low):ord(high) + 1] = ord(to)
    kind[[9, 10, 11, 12, 13, 32]] = 32
    kind[128:] = ord("a")
    return kind


CLASSES = _byte_classes()


def features(text: str, m: Measures | None, dims: int) -> np.ndarray:
    """Hashed: square roots of the shares of class trigrams (runs shortened to one), and one feature for each binned measure."""
    out = np.zeros(dims)
    if m is None:
        return out
    raw = np.frombuffer(text.encode(), np.uint8)
    for at in range(0, len(raw), 1 << 20):                         # bounded memory for very long texts
        kind = CLASSES[raw[at:at + (1 << 20) + 2]]
        kind = kind[np.r_[True, kind[1:] != kind[:-1]]]
        if len(kind) >= 3:
            gram = (kind[:-2] * np.uint32(0x9E3779B1)) ^ (kind[1:-1] * np.uint32(0x85EBCA6B)) ^ (kind[2:] * np.uint32(0xC2B2AE35))
            gram ^= gram >> np.uint32(15)
            out += np.bincount((gram * np.uint32(0x2C1B3C6D) >> np.uint32(8)) % np.uint32(dims), minlength=dims)
    out = np.sqrt(out / max(1.0, out.sum()))
    for name in ("symbols", "marked", "other", "upper", "shout", "distinct", "repeats", "lines"):
        step = min(int(getattr(m, name) * 10), 12)
        out[zlib.crc32(f"{name}:{step}".encode()) % dims] += 1.0
    return out


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    intercept: float

    def __call__(self, text: str | None) -> float:
        m = measure(text or "")
        if m is None:
            return 0.0
        z = float(features(text, m, len(self.weights)) @ self.weights) + self.intercept
        return 1 / (1 + np.exp(-min(max(z, -50.0), 50.0)))


def count_patterns(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(doc_id, votes) of all documents, the distinct vote codes and their counts."""
    voted = materialize(per_text(docs, [doc_id], text, lambda: lambda t: (votes(measure(t or "")),),
                                 [field("votes", T.IntegerType())]), "quality-votes")
    rows = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()     # at most 3 ** labellers rows
    return voted, np.array([r["votes"] for r in rows], np.int64), np.array([r["n"] for r in rows], float)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = 8000, dims: int = 512,
        seed: int = 1) -> tuple[WeakModel | None, Scorer, DataFrame]:
    """The weak model (all documents), the scorer (about ``sample_rows`` documents) and the votes."""
    voted, codes, counts = count_patterns(docs, doc_id, text)
    if not len(codes):
        return None, Scorer(np.zeros(dims), 0.0), voted
    weak = fit_weak_model(unpack(codes), counts)
    chance = dict(zip(codes.tolist(), weak.posterior(unpack(codes)).tolist()))
    share = min(1.0, sample_rows / counts.sum())
    by_id = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000 + 1)
    n_drawn = voted.where(by_id).count()
    if not 0 < n_drawn <= 2 * sample_rows:             # ids are missing or repeat too much to draw by them
        by_id = F.rand(seed) < share
    drawn = docs.where(by_id)

    def make():
        def one(t: str | None) -> tuple:
            m = measure(t or "")
            return chance[votes(m)], m is not None, features(t or "", m, dims).tolist()
        return one

    rows = per_text(drawn, [], text, make, [field("p", T.DoubleType()), field("has_words", T.BooleanType()),
                                            field("x", T.ArrayType(T.DoubleType()))]).where("has_words")
    rows = materialize(rows.select("p", "x"), "quality-sample")
    return weak, fit_scorer(rows, dims), voted


def fit_scorer(rows: DataFrame, dims: int, ridge: float = 1.0, rounds: int = 12) -> Scorer:
    """Ridge logistic regression on soft labels (p, x) by Newton steps.

    Each step is one pass: every partition sums its gradient and curvature, ``dims`` squared numbers."""
    ship_package(rows.sparkSession)
    weights = np.zeros(dims + 1)                        # the intercept last, without a penalty
    penalty = np.r_[np.full(dims, ridge), 1e-6]
    rows = rows.coalesce(8)

    def sums(at: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gradient, curvature = np.zeros(dims + 1), np.zeros((dims + 1, dims + 1))
            for b in batches:
                x = np.c_[b.column(1).flatten().to_numpy().reshape(-1, dims), np.ones(b.num_rows)]
                q = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
                gradient += x.T @ (b.column(0).to_numpy() - q)
                curvature += (x * (q * (1 - q))[:, None]).T @ x
            yield pa.RecordBatch.from_arrays([pa.array([np.r_[gradient, curvature.ravel()].tobytes()], pa.binary())], names=["sums"])
        return run

    for _ in range(rounds):
        total = sum((np.frombuffer(r["sums"]) for r in rows.mapInArrow(sums(weights), "sums binary").collect()),
                    np.zeros((dims + 1) * (dims + 2)))
        gradient = total[:dims + 1] - penalty * weights
        step = np.linalg.solve(total[dims + 1:].reshape(dims + 1, -1) + np.diag(penalty), gradient)
        weights = weights + step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return Scorer(weights[:-1], float(weights[-1]))


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5, **how) -> DataFrame:
    """(doc_id, votes, weak_good, score, kept), one row per row of ``docs``."""
    weak, scorer, _ = fit(docs, doc_id, text, **how)

    def make():
        def one(t: str | None) -> tuple:
            code = votes(measure(t or ""))
            p = float(weak.posterior(unpack(np.array([code])))[0])
            score = float(scorer(t))
            return code, p, score, score >= threshold
        return one

    return per_text(docs, [doc_id], text, make, [
        field("votes", T.IntegerType()), field("weak_good", T.DoubleType()), field("score", T.DoubleType()),
        field("kept", T.BooleanType())])


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5, **how) -> DataFrame:
    """The documents the scorer does not reject, columns unchanged."""
    scorer = fit(docs, doc_id, text, **how)[1]
    return filter_texts(docs, text, lambda: lambda t: scorer(t) >= threshold)
