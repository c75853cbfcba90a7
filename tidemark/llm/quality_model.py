"""Quality classifier: random Fourier features over document statistics.

The features approximate a Gaussian kernel; ridge weights solve normal equations that
partitions sum up; an isotonic fit turns raw scores into chances.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_ROWS, filter_slices, map_slices
from tidemark.llm.toxicity import labelled_sample

SPACE = b" \t\n\r\x0b\x0c"
UPPER, DIGIT = (bytes(range(*r)) for r in ((65, 91), (48, 58)))
STOPS, SYMBOLS, OTHER = b".,;:!?", b"#*$%&|<>=~^_", b"!|"
#: Bytes that the compression statistic is taken from at once.
CHUNK = 1 << 16


def only(kept: bytes) -> bytes:
    return bytes(set(range(256)) - set(kept))


NOT = [only(x) for x in (UPPER, DIGIT, STOPS, SYMBOLS, OTHER)]


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all zero without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * N_STATISTICS
    n, size = len(words), len(raw.translate(None, SPACE))
    lines = [x for x in raw.split(b"\n") if x]
    counts = [len(raw.translate(None, x)) / size for x in NOT]
    packed = sum(len(zlib.compress(raw[i : i + CHUNK], 1)) for i in range(0, len(raw), CHUNK))
    kinds = len(set(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    upper = sum(map(bytes.isupper, words)) / n
    return [
        np.log1p(n), size / n, float(lengths.std()), kinds / n, np.log(kinds) / np.log(n + 1.0), *np.sqrt(counts), upper,
        np.log1p(len(lines)), len(set(lines)) / len(lines), len(raw) / packed, np.log1p(len(raw) / len(lines)), float((lengths == 1).mean()),
        len(raw.translate(None, bytes(range(128)))) / size,
    ]


N_STATISTICS = 17


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores, ascending
    levels: np.ndarray  # chances at the knots

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.column_stack([np.cos(z @ self.freq + self.phase) * np.sqrt(2 / self.freq.shape[1]), z, np.ones(len(z))])

    def raw(self, texts: list[str | None]) -> np.ndarray:
        return self.expand(np.array([statistics(t) for t in texts], dtype=float).reshape(-1, N_STATISTICS)) @ self.weights

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.interp(self.raw(texts), self.knots, self.levels)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators of labels y sorted by x: one knot, the mean score, and one
    rising level for each pool. There are no more pools than labelled rows of the sample."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    pools: list[list[float]] = []  # sum of labels, rows, sum of scores
    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        pools.append([b, 1.0, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    levels = np.array([(s + 0.5) / (n + 1) for s, n, _ in pools])
    knots = np.array([t / n for _, n, t in pools])
    levels = np.maximum.accumulate(levels)
    # A small slope keeps the order of scores within a level and beyond the ends.
    wide = np.concatenate([[knots[0] - 1], knots, [knots[-1] + 1]])
    high = np.concatenate([[levels[0] * 0.5], levels, [1 - (1 - levels[-1]) * 0.5]])
    return wide, high


def train(docs: DataFrame, labels: DataFrame, fold: F.Column, label: str = "quality", width: int = 256, ridge: float = 1e-3, gamma: float = 0.06, seed: int = 6) -> Model:
    """Learn from at most toxicity.MOST_DOCS labelled documents of the fold.

    Each task sums the normal equations of its rows, in two parts by a hash of the
    text: one is weighed for the ridge fit, the other one calibrates it. With
    labels of one kind only, the score is their share.
    """
    sample = labelled_sample(docs, labels, label, fold)
    measured = sample.mapInArrow(_measure, "x array<double>, y int, part int").persist()
    moments = measured.select("y", F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.avg("y").alias("y")).orderBy("i").collect()
    rng = np.random.default_rng(seed)
    freq, phase = rng.normal(0, np.sqrt(2 * gamma), (N_STATISTICS, width)), rng.uniform(0, 2 * np.pi, width)
    none = np.zeros(width + N_STATISTICS + 1)
    if not moments:
        measured.unpersist()
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), freq, phase, none, np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    mean, scale, share = np.array([r["m"] for r in moments]), np.array([max(r["s"], 1e-6) for r in moments]), moments[0]["y"]
    model = Model(mean, scale, freq, phase, none, np.array([0.0, 1.0]), np.array([share, share]))
    if 0 < share < 1:
        weight = (0.5 / (1 - share), 0.5 / share)  # both kinds count alike in the fit

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(none)
            a, b = np.zeros((k, k)), np.zeros(k)
            for batch in batches:
                x, y, part = np.array(batch.column(0).to_pylist()).reshape(-1, N_STATISTICS), batch.column(1).to_numpy(), batch.column(2).to_numpy()
                x, y = model.expand(x[part > 0]), y[part > 0]
                w = np.where(y > 0, weight[1], weight[0])
                a += (x * w[:, None]).T @ x
                b += x.T @ (w * (2.0 * y - 1))
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([b.tobytes()])], names=["a", "b"])

        k = len(none)
        a, b = np.zeros((k, k)), np.zeros(k)
        for row in measured.mapInArrow(sums, "a binary, b binary").collect():  # one row for each partition of the sample
            a += np.frombuffer(row["a"]).reshape(k, k)
            b += np.frombuffer(row["b"])
        model.weights = np.linalg.solve(a + ridge * np.trace(a) / k * np.eye(k), b)
        held = measured.where("part = 0").toPandas()  # a fifth of the sample's rows, some numbers each
        if len(held) and held["y"].nunique() == 2:
            raw = model.expand(np.array(held["x"].tolist())) @ model.weights
            model.knots, model.levels = isotonic(raw, held["y"].to_numpy(dtype=float))
        else:
            model.knots, model.levels = np.array([-1.0, 1.0]), np.array([0.0, 1.0])
    measured.unpersist()
    return model


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE_ROWS):
            rows = batch.slice(i, SLICE_ROWS)
            texts = rows.column(0).to_pylist()
            part = [zlib.crc32((t or "").encode("utf-8", "surrogatepass")) % 5 for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array([statistics(t) for t in texts], pa.list_(pa.float64())), rows.column(1), pa.array(part, pa.int32())], names=["x", "y", "part"])


def score_quality(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, score. Null and empty texts have zero statistics and get
    their score; repeated rows give repeated results; an empty table gives none; other
    columns are not read."""

    def make():
        return lambda batch: {key: batch.column(0), "score": model.score(batch.column(1).to_pylist())}

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, score double")


def keep_fine(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose score is `least` or more, with every column; no shuffle. Null and empty
    texts have the score of zero statistics; repeated rows stay or go together."""
    return filter_slices(docs, lambda: lambda texts: (model.score(texts) >= least).tolist(), text)
