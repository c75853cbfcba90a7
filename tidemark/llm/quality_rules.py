"""Quality rules: compression bands over whole documents and fixed chunks, beside
plain word, symbol, line and repeated-window counts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import filter_slices, map_slices

SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
SPACE = b" \t\n\r\x0b\x0c"
#: Odd multipliers that mix the places of a window.
MIX = np.random.default_rng(20).integers(1, 2**62, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Bands:
    """Limits on zstandard ratios (bytes before / bytes after).

    whole: (bytes below which the row holds, lowest ratio, highest ratio), by
    length, since a short text can't compress well. chunks: (bytes from which the row
    holds, bytes of a chunk, lowest, highest ratio of a chunk). Chunks cover the whole
    text; what is left after the last whole one is judged as a chunk that ends with the
    text. A document falls if more than chunk_share of its chunks lie outside. Texts
    shorter than the first row are one chunk, which `whole` judges.
    """

    whole: tuple[tuple[float, float, float], ...] = (
        (64, 0.40, 2.5),
        (128, 0.70, 3.0),
        (512, 0.95, 3.2),
        (1024, 1.20, 3.3),
        (4096, 1.40, 3.5),
        (32768, 1.50, 4.0),
        (float("inf"), 1.50, 4.5),
    )
    chunks: tuple[tuple[int, int, float, float], ...] = ((1024, 512, 1.20, 3.0), (4096, 1024, 1.35, 3.3), (16384, 4096, 1.50, 4.0))
    chunk_share: float = 0.25
    level: int = 3


def repeated_words(words: list[bytes], size: int = 8) -> int:
    """Words that lie in windows found twice or more, first included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        w = h[:n] * MIX[0]
        for k in range(1, size):
            w = (w ^ (w >> np.uint64(29))) * MIX[size] + h[k : n + k] * MIX[k]
    order = np.sort(w)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # Equal sums may still be of different words: the few windows that have them are compared.
    starts, seen = np.flatnonzero(np.isin(w, twice)), {}
    for i in starts.tolist():
        seen.setdefault(tuple(words[i : i + size]), []).append(i)
    starts = np.array([i for own in seen.values() if len(own) > 1 for i in own], dtype=np.int64)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def ratio_verdict(raw: bytes, bands: Bands, pack: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of chunks outside the chunk limits, verdict."""
    n = len(raw)
    if not n:
        return 0.0, 0.0, False
    ratio = n / len(pack.compress(raw))
    low, high = next((a, b) for most, a, b in bands.whole if n < most)
    outside, starts = 0, []
    for _, size, least, most in [row for row in bands.chunks if row[0] <= n][-1:]:
        starts = [*range(0, n - size + 1, size), *([n - size] if n % size else [])]
        outside = sum(not least <= size / len(pack.compress(raw[i : i + size])) <= most for i in starts)
    share = outside / len(starts) if starts else 0.0
    return ratio, share, low <= ratio <= high and share <= bands.chunk_share


def measure(text: str | None, bands: Bands, pack: zstandard.ZstdCompressor) -> dict:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    n_repeat = repeated_words(words)
    ratio, share, fine = ratio_verdict(raw, bands, pack)
    failed = len(words) < 20 or 100 * n_repeat > 30 * len(words)
    return {
        "n_words": len(words),
        "word_chars": len(text) - (len(raw) - len(raw.translate(None, SPACE))),
        "n_symbols": len(raw.translate(None, NOT_SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "kept": fine and not failed,
        "zstd_ratio": ratio,
        "bad_chunk_share": share,
    }


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, zstd_ratio double, bad_chunk_share double"
)


def quality_report(docs: DataFrame, bands: Bands | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its counts, ratios and verdict.

    Null and empty texts have no words and fail; repeated rows give repeated
    results; an empty table gives none; other columns are not read.
    """
    bands = bands or Bands()

    def make():
        pack = zstandard.ZstdCompressor(level=bands.level)

        def f(batch: pa.RecordBatch) -> dict[str, list]:
            rows = [measure(t, bands, pack) for t in batch.column(1).to_pylist()]
            return {key: batch.column(0)} | {k: [r[k] for r in rows] for k in (x.split()[0] for x in FIELDS.split(", "))}

        return f

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, {FIELDS}")


def keep_good(docs: DataFrame, bands: Bands | None = None, text: str = "text") -> DataFrame:
    """The rows whose text passes, with every column as it was; no shuffle. Null and empty
    texts have no words and go; repeated rows stay or go together; an empty table stays empty."""
    bands = bands or Bands()

    def make():
        pack = zstandard.ZstdCompressor(level=bands.level)
        return lambda texts: [measure(t, bands, pack)["kept"] for t in texts]

    return filter_slices(docs, make, text)
