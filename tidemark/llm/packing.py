"""Mixture-controlled packing: deficit round-robin over source queues.

Every queue (a source) is a stream of its documents' ids. In every window of `length` ids
each queue is credited its share of the window and sends the whole ids that its credit
covers; what is left of the credit, less than an id, is its deficit and is carried on to
the next window. So what a queue has sent is within one id of its target after every window,
and each window holds its target to within two; the deficits carry over windows and
partitions alike. Credits are whole numbers, so how many ids a
queue has sent before any window follows from the window's number alone: no task needs
another one's state.

When queues end, the others share their part: the shares hold for a run of windows, then
for another one with fewer queues. What is left after the last full window goes into
sequences whose lengths are powers of two, so that no sequence holds padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SLICE_ROWS, staged, text_slices
from tidemark.llm.tokens import process_encoder, vocabulary_path

#: Rows of (task, source) offsets that may be broadcast.
MOST_BASES = 1_000_000
#: Sources of fewer ids a window than this share a queue, which is credited for all of them.
LEAST_IDS = 2
#: Parts of a window in which shares are counted.
UNIT = 1 << 30


@dataclass(frozen=True)
class Mixture:
    """What the queues have sent before any window. Runs of windows have shares of their
    own: starts[r] is the first window of run r, ends[r] the sums of the shares of the queues
    up to each one (ends[r][0] is 0, the last one stands for the whole window), and sent[r]
    the ids that each queue has sent before."""

    totals: np.ndarray
    length: int
    starts: np.ndarray
    ends: np.ndarray
    sent: np.ndarray

    @classmethod
    def of(cls, totals: list[int], shares: list[float], length: int) -> Mixture:
        """totals: ids of each queue; shares: its target share of a window."""
        left = np.array(totals, dtype=np.int64)
        # Every queue sends an id a window at least, so that none ever takes one back.
        least = -(-UNIT * 101 // (100 * length))
        wanted = np.maximum(np.round(UNIT * np.array(shares, dtype=float) / (sum(shares) or 1)).astype(np.int64), least)
        starts, ends, sent, window = [], [], [], 0
        while left.sum() >= length:
            own = np.where(left > 0, wanted, 0)
            run = np.concatenate([[0], np.cumsum(own)])
            fits = lambda n, run=run: bool((np.diff(through(np.int64(n), run, length)) <= left).all())
            low, high = 0, int(left.sum()) // length
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if fits(mid) else (low, mid - 1)
            if not low:  # one window in which the queues that end give all they have
                quota = np.minimum(np.diff(through(np.int64(1), run, length)), left)
                while more := length - int(quota.sum()):
                    open_ = np.flatnonzero(left > quota)
                    extra = np.zeros(len(left), dtype=np.int64)
                    extra[open_] = np.diff(through(np.int64(1), np.concatenate([[0], np.cumsum(own[open_])]), more))
                    quota = np.minimum(quota + extra, left)
                run, low = np.concatenate([[0], np.cumsum(quota)]), 1
            starts.append(window)
            ends.append(run)
            sent.append(np.array(totals) - left)
            left, window = left - np.diff(through(np.int64(low), run, length)), window + low
        starts.append(window)
        ends.append(np.arange(len(totals) + 1))
        sent.append(np.array(totals) - left)
        return cls(np.array(totals, dtype=np.int64), length, np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64).reshape(len(starts), -1), np.array(sent, dtype=np.int64).reshape(len(starts), -1))

    def before(self, queue: int, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the queue sent before these windows, ids of earlier queues in them)."""
        run = np.searchsorted(self.starts, window, side="right") - 1
        at, past = self.ends[run, queue], self.ends[run, queue + 1]
        whole, n = self.ends[run, -1], window - self.starts[run]
        low = part(n, at, whole, self.length)
        return self.sent[run, queue] + part(n, past, whole, self.length) - low, part(n + 1, at, whole, self.length) - low

    def window(self, queue: int, ids: np.ndarray) -> np.ndarray:
        """The windows that these ids of the queue lie in; past the last one, the number of windows."""
        run = np.searchsorted(self.sent[:, queue], ids, side="right") - 1
        last = len(self.starts) - 1
        own, whole = self.ends[run, queue + 1] - self.ends[run, queue], self.ends[run, -1]
        ideal = (ids - self.sent[run, queue]) / self.length * (whole / np.maximum(own, 1))
        slack = 2 + whole // np.maximum(own * self.length, 1) + (ideal * 1e-12).astype(np.int64)
        low = self.starts[run] + np.maximum(ideal.astype(np.int64) - slack, 0)
        high = np.minimum(self.starts[run] + ideal.astype(np.int64) + slack, self.starts[np.minimum(run + 1, last)] - 1)
        low, high = np.where(run < last, low, self.starts[last]), np.where(run < last, high, self.starts[last])
        low = np.minimum(low, high)
        while (low < high).any():
            mid = (low + high) // 2
            done = self.before(queue, mid + 1)[0] > ids
            low, high = np.where(done | (low == high), low, mid + 1), np.where(done, mid, high)
        return low

    def place(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, offset, ids up to the sequence's end) of places after the last full window."""
        full, rest = divmod(int(self.totals.sum()), self.length)
        sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        starts = np.cumsum([0, *sizes])
        k = np.searchsorted(starts, position, side="right") - 1
        return full + k, position - starts[k], starts[np.minimum(k + 1, len(starts) - 1)] - position


def part(n: np.ndarray, share: np.ndarray, whole: np.ndarray, length: int) -> np.ndarray:
    """Whole ids of n windows' ids that fall to a share of the whole; no product overflows."""
    a, b = np.divmod(n * length, np.maximum(whole, 1))
    return a * share + b * share // np.maximum(whole, 1)


def through(n: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    return part(n, ends, ends[-1], length)


ENCODED = "part int, queue string, at long, ids binary, n long"


def encoded(docs: DataFrame, end_id: int, path: str | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Staged ids of every document, with its place among those of its source in its partition."""
    queue = F.coalesce(F.col(source).cast("string"), F.lit(""))
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL(ENCODED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at, part = process_encoder(path), {}, TaskContext.get().partitionId()
        ending = np.array([end_id], dtype=encoder.dtype).tobytes()
        for batch in batches:
            for rows in text_slices(batch, 1):
                ids = [x + ending for x in encoder.encode(rows.column(1).to_pylist())]
                n = [len(x) // encoder.dtype.itemsize for x in ids]
                queues, starts = rows.column(2).to_pylist(), []
                for q, k in zip(queues, n, strict=True):
                    starts.append(at.get(q, 0))
                    at[q] = starts[-1] + k
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([part] * len(n), pa.int32()), pa.array(queues, pa.string()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary()), pa.array(n, pa.int64())],
                    names=schema.names,
                )

    return staged(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), queue.alias("queue")).mapInArrow(run, schema), "ids", "snappy")


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string, ids binary"


def queues(shares: DataFrame, weights: dict[str, float] | None, length: int) -> tuple[dict[str, int], list[float]]:
    """(numbers of the sources that have a queue of their own, target shares by number). The
    queue of number 0 is that of all sources with less than LEAST_IDS ids a window."""
    by_source = shares.groupBy("queue").agg(F.sum("n").alias("n"))
    total = shares.agg(F.sum("n")).first()[0] or 1
    given = {k: max(float(v), 0.0) for k, v in (weights or {}).items()}
    held = {r["queue"]: r["n"] for r in by_source.where(F.col("queue").isin(list(given))).collect()} if given else {}
    given = {k: v for k, v in given.items() if k in held}
    # Sources without a weight share what the weights leave of a window, by their sizes; where
    # the weights leave nothing, all are brought down together.
    weight, rest = sum(given.values()), max(1 - sum(held.values()) / total, 0.0)
    scale = (1 - weight) / rest if weight < 1 and rest > 0 else 1.0
    whole = weight + rest * scale or 1.0
    least = LEAST_IDS / length
    others = by_source.where(~F.col("queue").isin(list(given))) if given else by_source
    share = F.col("n") / total * scale / whole
    large = {r["queue"]: r["share"] for r in others.withColumn("share", share).where(F.col("share") >= least).collect()}  # length / LEAST_IDS rows at most
    large |= {k: v / whole for k, v in given.items() if v / whole >= least}
    names = sorted(large)
    return {n: i for i, n in enumerate(names, 1)}, [max(1 - sum(large.values()), 0.0), *(large[n] for n in names)]


def pack(
    docs: DataFrame,
    length: int = 1024,
    end_id: int = 0,
    weights: dict[str, float] | None = None,
    path: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in packed sequences: one row a piece.

    weights: target shares of a window by source; sources without one share the rest by
    their sizes. Where the weights make up one or more, all shares are brought down to one
    together. While the queues last, a window holds each queue's share to within two ids,
    and what it lacks comes later. Sources of less than LEAST_IDS ids a window share a
    queue, credited with their shares together.

    A document is its ids and the end id; null and empty texts are the end id alone.
    A null source is ''. Repeated rows are packed as often as they stand; an empty table
    gives no pieces; other columns are not read. The staged ids are read once, and no ids
    are shuffled.
    """
    path = path or vocabulary_path()
    rows = encoded(docs, end_id, path, key, text, source)
    # A row for each partition and source, at most one for each document.
    shares = staged(rows.groupBy("part", "queue").agg(F.sum("n").alias("n")), "shares")
    number, target = queues(shares, weights, length)
    known = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])[F.col("queue")] if number else F.lit(None)
    numbered = shares.withColumn("number", F.coalesce(known.cast("int"), F.lit(0)))
    # Where a source's ids of a partition begin in its queue: after those of earlier partitions, and of sources before it.
    by_part = numbered.groupBy("part", "number").agg(F.sum("n").alias("all"))
    earlier = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    beside = Window.partitionBy("part", "number").orderBy("queue").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    based = by_part.withColumn("past", F.coalesce(F.sum("all").over(earlier), zero))
    bases = numbered.withColumn("own", F.coalesce(F.sum("n").over(beside), zero)).join(based, ["part", "number"]).select("part", "queue", "number", (F.col("past") + F.col("own")).alias("base"))
    bases = staged(bases, "bases")
    found = {r["number"]: r["n"] for r in numbered.groupBy("number").agg(F.sum("n").alias("n")).collect()}  # one row a queue
    mixture = Mixture.of([found.get(i, 0) for i in range(len(target))], target, length)
    # Some 40 bytes a row: sent to every task while that is little, else joined by a shuffle.
    bases = F.broadcast(bases) if bases.count() <= MOST_BASES else bases
    dealt = rows.join(bases, ["part", "queue"]).select("key", "queue", "number", (F.col("at") + F.col("base")).alias("at"), "ids", "n")
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *[f for f in T.StructType.fromDDL(PIECES).fields if with_ids or f.name != "ids"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                out = _cut(batch.slice(i, SLICE_ROWS), mixture, with_ids)
                for j in range(0, len(out[0]), 20_000):
                    yield pa.RecordBatch.from_arrays([x.slice(j, 20_000) for x in out], names=schema.names)

    return dealt.mapInArrow(run, schema)


def _cut(rows: pa.RecordBatch, mixture: Mixture, with_ids: bool) -> list[pa.Array]:
    """Pieces of some documents, cut at what their queues send to each window."""
    keys, names, numbers, at, raws, sizes = (rows.column(i) for i in range(6))
    numbers, at, n = numbers.to_numpy(), at.to_numpy(), sizes.to_numpy()
    windows = int(mixture.starts[-1])
    rest = mixture.totals - mixture.sent[-1]
    parts: list[tuple[np.ndarray, ...]] = []
    for q in np.unique(numbers).tolist():
        own = np.flatnonzero(numbers == q)
        first, last = mixture.window(q, at[own]), mixture.window(q, at[own] + n[own] - 1)
        count = last - first + 1
        d = np.repeat(own, count)
        g = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        inside = g < windows
        begun, ahead = mixture.before(q, g)
        ended = np.where(inside, mixture.before(q, np.minimum(g + 1, windows))[0], mixture.totals[q])
        from_, past = np.maximum(begun, at[d]), np.minimum(ended, at[d] + n[d])
        full = inside & (past > from_)
        parts.append((d[full], (from_ - at[d])[full], (past - from_)[full], g[full], (ahead + from_ - begun)[full]))
        # After the last full window: places of the rest, cut where sequences end.
        d, s, size, p = d[~inside], (from_ - at[d])[~inside], (past - from_)[~inside], (from_ - begun)[~inside] + int(rest[:q].sum())
        while len(d):
            sequence, offset, left = mixture.place(p)
            now = np.minimum(size, left)
            parts.append((d, s, now, sequence, offset))
            more = size > left
            d, s, p, size = d[more], s[more] + left[more], p[more] + left[more], size[more] - left[more]
    d, s, now, sequence, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((s, d))
    d, s, now, sequence, offset = d[order], s[order], now[order], sequence[order], offset[order]
    texts = raws.to_pylist()
    width = [len(x) // k for x, k in zip(texts, n.tolist(), strict=True)]
    wide = [memoryview(np.frombuffer(x, dtype="<u2" if w == 2 else "<u4").astype("<u4")).cast("B") for x, w in zip(texts, width, strict=True)]
    crc32, spans = zlib.crc32, list(zip(d.tolist(), (4 * s).tolist(), (4 * (s + now)).tolist(), strict=True))
    crc = [crc32(wide[i][a:b]) for i, a, b in spans]
    out = [
        keys.take(pa.array(d)), pa.array(s), pa.array(now), pa.array(crc, pa.int64()), pa.array(n[d]),
        pa.array(sequence), pa.array(offset), names.take(pa.array(d)),
    ]
    return [*out, pa.array([bytes(wide[i][a:b]) for i, a, b in spans], pa.binary())] if with_ids else out


def sequences(pieces: DataFrame, length: int = 1024) -> DataFrame:
    """Whole sequences from the pieces of pack(): sequence_id, ids (array of int, at
    most `length`) and n_pieces. A group never holds more than one window."""
    return (
        pieces.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
        .select("sequence_id", "n_tokens", F.size("p").alias("n_pieces"), F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "").alias("h"))
        .select("sequence_id", "n_tokens", "n_pieces", F.unhex("h").alias("ids"))
    )
