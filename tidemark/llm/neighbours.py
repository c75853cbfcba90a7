"""Approximate nearest neighbours by collision counting.

Vectors of length one are projected on PROJECTIONS random directions. A block of vectors
keeps its projections as sorted arrays, one a direction. A query opens a window around its own
projection in each array; vectors that lie in at least THRESHOLD windows are
verified by their exact cosine. The windows then grow (virtual rehashing: only what is new at
their flanks is counted), until they are as wide as the distance of the k-th best vector
found so far: nearer ones would have collided by then.

Two projections of vectors at a distance d differ by a normal variable of deviation d. A
window of half-width R so holds a vector at distance R with probability P_IN; over all
directions the count of a vector as near as that falls below the threshold once in some
twenty times, of a nearer one less often. No bucket or window is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged

PROJECTIONS, SEED = 112, 7
#: Chance that a vector as far away as a window is half-wide lies in it.
P_IN = math.erf(1 / math.sqrt(2))
#: Collisions at which a vector is verified: 1.7 deviations below what is expected at that distance.
THRESHOLD = int(PROJECTIONS * P_IN - 1.7 * math.sqrt(PROJECTIONS * P_IN * (1 - P_IN)))
#: Windows as parts of the widest one that can be needed.
LEVELS = (0.35, 0.7, 1.0)
#: Vectors from which every query has a first bound; it decides how wide windows start.
SAMPLE_ROWS = 4096
#: Components of a block of vectors, its rows at most, and rows of a block of queries.
BLOCK_VALUES, BLOCK_ROWS, QUERY_ROWS = 1 << 22, 1 << 14, 1 << 16


def directions(dims: int) -> np.ndarray:
    """Random directions; any process draws the same."""
    return np.random.default_rng(SEED).standard_normal((PROJECTIONS, dims))


def as_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Arrow lists of one length as rows in double precision, each scaled by a power of two,
    which changes no cosine and lets no square overflow."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.ldexp(flat, -np.frexp(np.abs(flat).max(axis=1, initial=0.0))[1][:, None])


def dots(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Scalar products; equal rows give equal results wherever they stand."""
    return (rows * one).sum(axis=1)


def cosines(rows: np.ndarray, norms: np.ndarray, one: np.ndarray, norm: float) -> np.ndarray:
    return dots(rows, one) / (norms * norm)


def norms_of(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


class Block:
    """Vectors with a sorted array of their projections on each direction."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, axes: np.ndarray):
        self.ids, self.rows, self.norms, self.axes = ids, rows, norms_of(rows), axes
        at = (rows / self.norms[:, None]) @ axes.T
        self.order = [np.argsort(at[:, i], kind="stable") for i in range(len(axes))]
        self.values = [at[o, i] for i, o in enumerate(self.order)]

    def windows(self, at: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past place of each query's window in each array: [query, direction]."""
        low, high = np.empty(at.shape, dtype=np.int64), np.empty(at.shape, dtype=np.int64)
        for i, own in enumerate(self.values):
            low[:, i] = np.searchsorted(own, at[:, i] - reach, side="left")
            high[:, i] = np.searchsorted(own, at[:, i] + reach, side="right")
        return low, high

    def search(self, ids: np.ndarray, rows: np.ndarray, bound: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, places of vectors, cosines): of each query at most k vectors that
        are as near as its bound, the cosine of its k-th best one elsewhere."""
        norms = norms_of(rows)
        at = (rows / norms[:, None]) @ self.axes.T
        # Without a bound all vectors are verified.
        widest = np.where(np.isfinite(bound), np.sqrt(np.maximum(2 - 2 * bound, 0)) + 1e-9, np.inf)
        levels = [self.windows(at, widest * x) for x in LEVELS]
        for q in range(len(ids)):
            count, seen = np.zeros(len(self.ids), dtype=np.int64), np.zeros(len(self.ids), dtype=bool)
            places, near, limit = np.zeros(0, dtype=np.int64), np.zeros(0), bound[q]
            low = high = None
            for part, (lows, highs) in zip(LEVELS, levels, strict=True):
                if part > LEVELS[0] and np.isfinite(limit) and 2 - 2 * limit <= (widest[q] * last) ** 2:
                    break  # nothing nearer than the k-th best can be outside
                new = [o[a:b] for o, a, b in zip(self.order, lows[q], low if low is not None else highs[q], strict=True)]
                if high is not None:
                    new += [o[a:b] for o, a, b in zip(self.order, high, highs[q], strict=True)]
                count += np.bincount(np.concatenate(new), minlength=len(count))
                low, high, last = lows[q], highs[q], part
                more = np.flatnonzero((count >= THRESHOLD) & ~seen & (self.ids != ids[q]))
                seen[more] = True
                score = cosines(self.rows[more], self.norms[more], rows[q], norms[q])
                fits = score >= limit if np.isfinite(limit) else np.ones(len(score), dtype=bool)
                places, near = np.concatenate([places, more[fits]]), np.concatenate([near, score[fits]])
                if len(places) > k:
                    best = np.lexsort((self.ids[places], -near))[:k]
                    places, near = places[best], near[best]
                if len(places) == k:
                    limit = max(limit, near.min()) if np.isfinite(limit) else near.min()
            if len(places):
                yield q, places, near


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(id, v) of the vectors that can be compared, and their length: that of most; of two
    as frequent the larger. Null ones, those with components that are null or no finite numbers,
    zero ones and those of another length take no part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = vectors.select(F.col(key).alias("id"), v.alias("v")).where(v.isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False)))
    sizes = whole.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    dims = sizes["n"] if sizes else 0
    return whole.where(F.size("v") == dims), dims


def asked(rows: DataFrame, dims: int, every: int, k: int) -> DataFrame:
    """(id, v, bound): the queries, with the cosine of the k-th best vector of a sample of
    at most SAMPLE_ROWS; null where the sample holds fewer others."""
    drawn = rows.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE_ROWS).toArrow()
    held = as_matrix(drawn.column("v").combine_chunks(), dims)
    sent = rows.sparkSession.sparkContext.broadcast((drawn.column("id").to_pylist(), held, norms_of(held)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, matrix, norms = sent.value
        place = {}
        for i, x in enumerate(own):
            place.setdefault(x, []).append(i)
        for batch in batches:
            mine, bounds = as_matrix(batch.column(1), dims), []
            lengths = norms_of(mine)
            for q, x in enumerate(batch.column(0).to_pylist()):
                near = cosines(matrix, norms, mine[q], lengths[q])
                near[place.get(x, [])] = -np.inf
                best = np.partition(near, -k)[-k] if len(near) >= k else -np.inf
                bounds.append(float(best) if np.isfinite(best) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bounds, pa.float64())], names=["id", "v", "bound"])

    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    return queries.mapInArrow(run, T.StructType([*queries.schema.fields, T.StructField("bound", T.DoubleType())]))


def candidates(rows: DataFrame, dims: int, queries: Broadcast, k: int) -> DataFrame:
    """(query_id, vec_id, score) of what each block of vectors has for a block of queries."""
    block_rows = max(256, min(BLOCK_ROWS, BLOCK_VALUES // dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked_ids, asked_rows, bounds = queries.value
        axes, held, n = directions(dims), [], 0

        def searched() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids = whole.column("id").chunk(0)
            # Null ids are no query's own and come last among ties.
            block = Block(ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), as_matrix(whole.column("v").chunk(0), dims), axes)
            for i in range(0, len(asked_ids), 512):
                part = slice(i, i + 512)
                who, found, near = [], [], []
                for q, places, score in block.search(asked_ids[part], asked_rows[part], bounds[part], k):
                    who += [int(asked_ids[i + q])] * len(places)
                    found.append(places)
                    near.append(score)
                if who:
                    yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(near))], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(0, batch.num_rows, block_rows):
                held.append(batch.slice(i, block_rows))
                n += held[-1].num_rows
                if n >= block_rows:
                    yield from searched()
                    held, n = [], 0
        if n:
            yield from searched()

    return rows.select(F.col("id").cast("long").alias("id"), "v").mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors by cosine of every query, the
    rows whose whole-number key `every` divides, among all rows but its own.

    Fewer than k others: all of them. Vectors that are null, zero, of another length than
    most or hold components that are null or not finite take no part. Rows with the key of a query are its
    own; repeated queries are asked once, with the smallest of their vectors. Rows with a null key can be
    found, last among ties. An empty table gives none. Other columns are not read.

    Queries go to the tasks in blocks of QUERY_ROWS, each against all vectors.
    """
    spark = vectors.sparkSession
    rows, dims = usable(vectors, key, vector)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not dims:
        return none
    size = max(1, min(QUERY_ROWS, (QUERY_ROWS * 64) // dims))
    queries = staged(asked(rows, dims, every, k), "queries")
    blocks = -(-queries.count() // size)
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(blocks, 1))))
    found = None
    for i in range(blocks):
        own = dealt.where(F.col("block") == i).select("id", "v", "bound").toArrow()  # about `size` rows
        if not own.num_rows:
            continue
        bounds = own.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
        sent = spark.sparkContext.broadcast((own.column("id").to_numpy(), as_matrix(own.column("v").combine_chunks(), dims), np.where(np.isnan(bounds), -np.inf, bounds)))
        part = candidates(rows, dims, sent, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return none
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
