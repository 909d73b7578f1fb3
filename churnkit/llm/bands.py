"""Quality rules by compression bands (zstandard ratios of whole documents and fixed chunks).

Repetitive text compresses far better than prose, random or encoded text hardly at all. What is
normal depends on the length: the frame header and the cold dictionary weigh on short texts. So
each length class has its own band; a document is kept if its whole-text ratio and the ratio of
every fixed chunk lie inside their bands. The last chunk of a longer text is its last ``chunk`` bytes.

Null or empty text: no words, ratios NULL, base rule fails. Ties and repeated rows: every row is
judged alone. Very long texts: one pass, chunk by chunk. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnkit.llm.common import field, per_text

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Band:
    """Ratios (compressed bytes / bytes) from ``low`` to ``high`` pass, for texts of at least ``n_bytes``."""

    n_bytes: int
    low: float
    high: float


# Upper limits: the highest ratio of prose (two samples of about 1,500 random windows of just the class's least length,
# four languages, good labels of sf0.1) and a margin of about 0.08 from 768 bytes on; below, noise (base64 and random
# alphanumeric words) comes closer and the margin shrinks. Least length: highest prose, limit, lowest noise at the class's end.
#   128: 0.961 0.95 0.962   160: 0.900 0.92 0.942   192: 0.854 0.87 0.875   256: 0.801 0.83 0.843   384: 0.760 0.80 0.812
#   512: 0.719 0.76 0.777   768: 0.665 0.74 0.761   1024: 0.601 0.68 0.746   1536: 0.558 0.64 0.737   2048: 0.532 0.61 0.728
#   4096: 0.478 0.56 0.724   8192: 0.453 0.53 0.721   16384: 0.437 0.52 0.720
# (128: no margin; 99 % of the prose is under 0.892.) From 64 to 127 bytes zstandard may store prose uncompressed like
# noise (1.141 at 64 bytes both), so no upper limit parts them; the base rule's 50 words hardly fit there. Below 64 bytes
# the header decides and no ratio is judged.
DOCUMENT_BANDS = (Band(64, 0.40, 1.15), Band(128, 0.40, 0.95), Band(160, 0.40, 0.92), Band(192, 0.40, 0.87),
                  Band(256, 0.32, 0.83), Band(384, 0.32, 0.80), Band(512, 0.32, 0.76), Band(768, 0.32, 0.74),
                  Band(1024, 0.27, 0.68), Band(1536, 0.27, 0.64), Band(2048, 0.27, 0.61), Band(4096, 0.24, 0.56),
                  Band(8192, 0.24, 0.53), Band(16384, 0.22, 0.52))
# A chunk is judged without the rest of its text: as noise like a text of its length, as repetition less strictly.
CHUNK_BANDS = tuple(Band(b.n_bytes, min(b.low, 0.20), b.high) for b in DOCUMENT_BANDS)


def band_of(bands: tuple[Band, ...], n_bytes: int) -> Band | None:
    fit = [b for b in bands if n_bytes >= b.n_bytes]
    return fit[-1] if fit else None


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words lying in a window of ``width`` words that the text holds twice or more (first included)."""
    windows = list(zip(*(words[i:] for i in range(width))))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    marked = bytearray(len(words))
    for i, w in enumerate(windows):
        if times[w] > 1:
            marked[i:i + width] = b"\1" * width
    return sum(marked)


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


FIELDS = (
    field("n_words", T.LongType()), field("word_chars", T.LongType()), field("n_symbols", T.LongType()),
    field("n_dup_lines", T.LongType()), field("n_repeat_words", T.LongType()), field("base_failed", T.BooleanType()),
    field("kept", T.BooleanType()), field("ratio", T.DoubleType()), field("chunk_ratio_min", T.DoubleType()),
    field("chunk_ratio_max", T.DoubleType()),
)


def judge(level: int = 3, chunk: int = 4096, document_bands: tuple[Band, ...] = DOCUMENT_BANDS,
          chunk_bands: tuple[Band, ...] = CHUNK_BANDS, min_words: int = 50, max_repeat_pct: int = 50):
    """The per-text function; one compressor a task."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=level)

    def inside(bands: tuple[Band, ...], size: int, ratio: float) -> bool:
        band = band_of(bands, size)
        return band is None or band.low <= ratio <= band.high

    def one(text: str | None) -> tuple:
        text = text or ""
        raw = text.encode()
        words = raw.split()
        repeats = repeated_words(words)
        failed = len(words) < min_words or 100 * repeats > max_repeat_pct * len(words)
        ratio = len(packer.compress(raw)) / len(raw) if raw else None
        ok = ratio is not None and inside(document_bands, len(raw), ratio)
        low = high = None
        starts = list(range(0, len(raw), chunk))
        if len(starts) > 1:                  # the last chunk ends with the text and is whole too: it overlaps the one before
            starts[-1] = len(raw) - chunk
        for i in starts:
            part = raw[i:i + chunk]
            r = len(packer.compress(part)) / len(part)
            low, high = (r, r) if low is None else (min(low, r), max(high, r))
            ok = ok and inside(chunk_bands, len(part), r)
        return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
                duplicate_lines(text), repeats, failed, ok and not failed, ratio, low, high)

    return one


def quality_bands(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """(doc_id, measures, base_failed, kept, ratios), one row per row of ``docs``; see ``judge`` for the limits."""
    return per_text(docs, [doc_id], text, lambda: judge(**limits), FIELDS)
