"""Importance resampling: documents drawn by how much likelier their features are in a target.

Features are runs of words, dealt to buckets by their CRC-32. The distinct words make an
Aho-Corasick dictionary: each stands between delimiters and carries its CRC and its
length as payload. One scan of a text emits the payloads of its words in order, and the
CRC of a run of words is put together from the payloads of neighbours, without reading
its bytes again. So counting and scoring work on payloads alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_slices, staged, unstage
from tidemark.llm.decontaminate import FOLD

BUCKETS = 10_000
#: Words that the dictionary holds, the most frequent ones; others are hashed where they
#: stand, with the same result. Of at most LONGEST bytes, so a dictionary is some 50 MB.
MOST_WORDS, LONGEST = 100_000, 64
#: Distinct words that a task counts before it sends them on.
MOST_COUNTED = 400_000
#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
SPACE = np.uint32(zlib.crc32(b" "))


# --- payloads


@lru_cache(maxsize=1)
def shifts() -> list[np.ndarray]:
    """Tables [k, b] of what 2^j bytes that follow make of byte k of a CRC, by its value b."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(POLYNOMIAL), one >> 1)
    units = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    tables = [units >> 8 ^ one[units & 255]]
    for _ in range(31):
        tables.append(_through(tables[-1], tables[-1]))
    return tables


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The part that these CRCs have in those of texts with so many bytes behind."""
    out = crc.copy()
    for j in range(int(size.max(initial=0)).bit_length()):
        has = (size >> j & 1).astype(bool)
        out[has] = _through(shifts()[j], out[has])
    return out


def run_crcs(crc: np.ndarray, size: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """CRCs of all runs of one, two ... words, joined by a space, from those of the words."""
    yield crc
    spaced = shifted(np.full(len(crc), SPACE), size) ^ crc if words > 1 else crc
    whole = crc
    for k in range(1, min(words, len(crc))):
        whole = shifted(whole[:-1], size[k:] + 1) ^ spaced[k:]
        yield whole


class Payloads:
    """The dictionary of words, as UTF-8, each with its CRC and length."""

    def __init__(self, words: list[bytes]):
        self.crc = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.automaton = ahocorasick.Automaton()
        for i, w in enumerate(words):  # a sign stands for a byte, so that places are places of bytes
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)
        self.empty = not words
        if words:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length of each word of a text."""
        raw = b" " + (text or "").encode("utf-8", "surrogatepass").translate(FOLD) + b" "
        gap = np.frombuffer(raw, dtype=np.uint8) == 32
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        found = [] if self.empty or not len(ends) else list(self.automaton.iter(raw.decode("latin-1")))
        word = np.fromiter(map(itemgetter(1), found), dtype=np.int64, count=len(found))
        if len(word) == len(ends):
            return self.crc[word], self.size[word]
        crc, known = np.zeros(len(ends), dtype=np.uint32), np.zeros(len(ends), dtype=bool)
        at = np.searchsorted(ends, np.fromiter(map(itemgetter(0), found), dtype=np.int64, count=len(found)))
        crc[at], known[at] = self.crc[word], True
        for i in np.flatnonzero(~known):
            crc[i] = zlib.crc32(raw[starts[i] : ends[i]])
        return crc, ends - starts


@dataclass(frozen=True)
class Words:
    """The dictionary's words, sent to all tasks, under a name of their own."""

    name: str
    sent: Broadcast


_built: dict[str, Payloads] = {}


def payloads(words: Words) -> Payloads:
    """The dictionary's automaton; a worker process builds it once."""
    if words.name not in _built:
        _built.clear()
        _built[words.name] = Payloads(words.sent.value)
    return _built[words.name]


def dictionary(texts: DataFrame, most: int = MOST_WORDS) -> Words:
    """The most frequent distinct words of all texts, `most` at most. Tasks count their own
    words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update((text.as_py() or "").encode("utf-8", "surrogatepass").translate(FOLD).split())
                if len(held) > MOST_COUNTED:
                    yield sent()
                    held.clear()
        yield sent()

    counted = texts.mapInArrow(run, "word binary, n long").where(F.octet_length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n"))
    counted = staged(counted.select("word", F.floor(F.log2("n")).alias("level")), "words")
    held, level = 0, 64  # frequencies by powers of two: as many levels from the top as fit
    for r in counted.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        held += r["n"]
        if held > most:
            break
        level = r["level"]
    kept = counted.where(F.col("level") >= level).select("word").collect()
    unstage(counted)
    return Words(counted.staged_at, texts.sparkSession.sparkContext.broadcast(sorted(bytes(r["word"]) for r in kept)))


# --- counting and scoring


def bucket_counts(texts: DataFrame, words: Words, run: int, buckets: int) -> DataFrame:
    """(bucket, n): features in each bucket over all texts; a task sends a row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = payloads(words), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                for crc in run_crcs(*known.scan(text.as_py()), run):
                    n += np.bincount(crc % buckets, minlength=buckets)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(n[has], pa.int64())], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """What a feature of each bucket adds to a weight: the logarithm, in thousandths, of how
    much likelier it is in the target, both counts smoothed by one a bucket."""
    both = source.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    found = {r["bucket"]: (r["s"] or 0, r["t"] or 0) for r in both.collect()}  # one row a bucket
    spark = source.sparkSession
    total = [float(sum(x[i] for x in found.values()) + buckets) for i in range(2)]
    rows = [(b, *map(float, found.get(b, (0, 0)))) for b in range(buckets)]
    ratio = (F.col("t") + 1) * F.lit(total[0]) / ((F.col("s") + 1) * F.lit(total[1]))
    named = spark.createDataFrame(rows, "bucket long, s double, t double").select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in named.collect():
        out[r["bucket"]] = r["gain"]
    return out


def weighed(docs: DataFrame, words: Words, gain: np.ndarray, run: int, key: str, text: str) -> DataFrame:
    """(key, n_words, n_features, weight) of every document."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL("n_words long, n_features long, weight long").fields])
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def make():
        known, own = payloads(words), sent.value

        def f(batch: pa.RecordBatch) -> dict[str, list]:
            out = {"key": batch.column(0), "n_words": [], "n_features": [], "weight": []}
            for t in batch.column(1).to_pylist():
                runs = [crc % len(own) for crc in run_crcs(*known.scan(t), run)]
                out["n_words"].append(len(runs[0]))
                out["n_features"].append(sum(map(len, runs)))
                out["weight"].append(int(sum(own[b].sum() for b in runs)))
            return out

        return f

    return map_slices(docs.select(key, text), make, schema)


def gumbel(key: Column, seed: int) -> Column:
    """A document's own draw, in thousandths, from the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, run: int = 1, buckets: int = BUCKETS, seed: int = 2024, key: str = "doc_id", text: str = "text", target_text: str = "text"
) -> DataFrame:
    """Every document's key, n_words, n_features, weight, score and rank; of those with at
    least so many words, the `percent` of the highest scores are drawn and have a rank.

    A score is the weight plus a Gumbel draw, so the draw is one without replacement in
    proportion to the weights. Null and empty texts have no features and a weight of 0;
    a null key counts as an empty one in its draw and comes last among ties; repeated rows
    are drawn one by one; an empty target or table is no error. Other columns are not read.
    """
    texts = docs.select(F.col(text).alias("text"))
    words = dictionary(texts.unionByName(target.select(F.col(target_text).alias("text"))))
    gain = gains(bucket_counts(texts, words, run, buckets), bucket_counts(target.select(target_text), words, run, buckets), buckets)
    found = staged(weighed(docs, words, gain, run, key, text).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed)), "weights")
    fits = F.col("n_words") >= least
    take = found.where(fits).count() * percent // 100
    # Sorted by ranges: rows of equal scores and keys are split by where they stand.
    order = [fits.desc(), F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]
    ranged = found.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(ranged.drop("row").withColumn("at", F.monotonically_increasing_id()), "ranks")
    part, at = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    held = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    base = held.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    numbered = placed.withColumn("part", part).join(base, "part").withColumn("rank", F.col("base") + at + 1)
    return numbered.select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", F.when(fits & (F.col("rank") <= take), F.col("rank")).alias("rank"))
