"""SimHash near-duplicates: fingerprints, and bit-sliced comparison inside blocks.

Two fingerprints of 64 bits that differ in r bits or fewer agree on at least
(blocks - r) of `blocks` blocks of bits. Rows are dealt by the value of each choice
of so many blocks, and compared only within a value. There, each bit plane of the
next 64 fingerprints lies in one machine word; a counter of bit-sliced planes adds up
64 distances at once, and a word is abandoned once all its lanes exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_slices, staged
from tidemark.llm.components import smallest_labels
from tidemark.operators.change import free_name

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Rows of one blocking value that a task compares at once.
CELL_ROWS = 8192
#: Bytes of shingles of one blocking value that a task compares at once.
CELL_BYTES = 64 << 20
#: Rows from which a fingerprint's rows are no longer dealt to one task, and how many such
#: fingerprints may be sent to every task.
HOT_ROWS, MOST_HOT = 100_000, 1_000_000
#: Planes after which finished words are taken out.
LOOKS = (10, 13, 16, 20, 26, 34, 48)


def fingerprint(text: str | None, size: int = 4, seed: int = 42) -> int:
    """SimHash over word shingles, repeats included; no words: 0."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER)
    words = raw.split()
    if not words:
        return 0
    line = b" ".join(words)
    n = len(words) - size + 1
    h64 = xxhash.xxh64_intdigest
    if n <= 1:
        h = [h64(line, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = np.concatenate([[0], ends[: n - 1]]).tolist()
        h = [h64(line[a:b], seed) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]
    bits = np.unpackbits(np.array(h, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


UPPER_TO_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def fingerprints(docs: DataFrame, size: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp long): the fingerprint's bits as a signed number."""

    def make():
        def f(batch: pa.RecordBatch) -> dict[str, list]:
            found = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            return {key: batch.column(0), "fp": found.view(np.int64)}

        return f

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, fp long")


def scheme(n: int, radius: int, per_cell: int = 64) -> tuple[int, int]:
    """(blocks, blocks that must agree): the fewest tables whose values hold about
    per_cell of n even fingerprints or fewer."""
    for blocks in range(radius + 1, radius + 5):
        agree = blocks - radius
        if n / 2 ** (64 * agree // blocks) <= per_cell:
            break
    return blocks, agree


def block_masks(blocks: int, agree: int) -> list[int]:
    """One mask of bits for each choice of blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    one = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(x) for x in combinations(one, agree)]


def _words_at(packed: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64 bits of a packed plane, from any bit on."""
    wide = np.lib.stride_tricks.as_strided(packed, (len(packed) - 8, 8), (1, 1))
    at, shift = start >> 3, (start & 7).astype(np.uint64)
    low = np.ascontiguousarray(wide[at]).view("<u8").ravel() >> shift
    high = packed[at + 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1)))
    return np.where(shift == 0, low, low | high)


def near_pairs(fp: np.ndarray, end: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j < end[i] whose fingerprints differ in radius bits or fewer.

    Row i is compared with the words of rows i+1.., i+65.., up to end[i]."""
    n = len(fp)
    planes = np.zeros((64, n // 8 + 24), dtype=np.uint8)
    for p in range(64):
        b = np.packbits((fp >> np.uint64(p)).astype(np.uint8) & 1, bitorder="little")
        planes[p, : len(b)] = b
    width = max(1, int(radius).bit_length())
    over = np.uint64((1 << width) - 1 - radius)  # the counter starts here, so that one more than the radius overflows it
    rows, start = np.arange(n), np.arange(n) + 1
    rows, start = rows[start < end], start[start < end]
    while len(rows):
        here, at, left = rows, start, np.minimum(end[rows] - start, 64).astype(np.uint64)
        valid = ALL >> (np.uint64(64) - left)
        own = fp[here]
        count = [np.full(len(here), ALL if over >> np.uint64(k) & np.uint64(1) else 0, dtype=np.uint64) for k in range(width)]
        dead = ~valid
        for p in range(64):
            carry = _words_at(planes[p], at) ^ (np.uint64(0) - (own >> np.uint64(p) & np.uint64(1)))
            for k in range(width):
                count[k], carry = count[k] ^ carry, count[k] & carry
            dead |= carry
            if p in LOOKS:
                alive = np.flatnonzero(dead != ALL)
                if not len(alive):
                    here = alive
                    break
                if 2 * len(alive) < len(here):
                    here, at, own, dead = here[alive], at[alive], own[alive], dead[alive]
                    count = [c[alive] for c in count]
        if len(here):
            hit = np.flatnonzero(dead != ALL)
            if len(hit):
                bits = np.unpackbits((~dead[hit]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                i, lane = np.nonzero(bits)
                yield here[hit[i]], at[hit[i]] + lane
        start = start + 64
        rows, start = rows[start < end[rows]], start[start < end[rows]]


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the groups of i and j; root holds every row's smallest member."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up


def forest(fp: np.ndarray, cell: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, within each run of equal cells, what is linked there: each
    fingerprint with the smallest of its group, never all pairs."""
    change = np.flatnonzero(cell[1:] != cell[:-1]) + 1
    ends = np.append(change, len(cell))
    end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    root = np.arange(len(fp))
    for i, j in near_pairs(fp, end, radius):
        root = unite(root, i, j)
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked], fp[root[linked]]


def near_links(distinct: DataFrame, radius: int, n: int) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) whose closure is that
    of all pairs within the radius."""
    masks = block_masks(*scheme(n, radius))
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("k")) for t, m in enumerate(masks)]))
    dealt = distinct.select("fp", tables.alias("x")).select("fp", "x.t", "x.k")
    # Values with many rows are compared in cells of two parts each, so that no task gets a whole one.
    hot = dealt.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS).withColumn("parts", F.ceil(F.col("n") * 2 / CELL_ROWS).cast("int"))
    cold = dealt.join(hot, ["t", "k"], "left_anti").select("fp", "t", "k", F.lit(0).alias("a"), F.lit(0).alias("b"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    split = (
        dealt.join(hot, ["t", "k"])
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .where("part <> other")
        .select("fp", "t", "k", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"))
    )
    cells = cold.unionByName(split).select("fp", F.xxhash64("t", "k", "a", "b").alias("cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

        def links(fp: np.ndarray, cell: np.ndarray) -> pa.RecordBatch:
            u, v = forest(fp.view(np.uint64), cell, radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            fp, cell = (np.concatenate([k, batch.column(i).to_numpy()]) for i, k in enumerate(kept))
            if not len(cell):
                continue
            whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            if whole:
                yield links(fp[:whole], cell[:whole])
            kept = [fp[whole:], cell[whole:]]
        if len(kept[0]):
            yield links(*kept)

    return cells.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(run, "u long, v long")


def _signed(mask: int) -> F.Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def grouped(docs: DataFrame, size: int, radius: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(key, fp) of every row, and per fingerprint its component_id."""
    marked = staged(fingerprints(docs, size, key, text), "fp")
    groups = staged(marked.groupBy("fp").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("n")), "groups")
    labels = smallest_labels(near_links(groups.select("fp"), radius, groups.count()))
    reached = groups.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left").select("fp", "least", "n", F.coalesce("label", "fp").alias("label"))
    least = reached.groupBy("label").agg(F.min("least").alias("component_id"))
    return marked, reached.select("fp", "least", "n", "label").join(least, "label").select("fp", "least", "n", "component_id")


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fp, component_id (the smallest key it reaches).

    Null and empty texts have fingerprint 0 and link like any other; repeated rows
    give repeated results; an empty table gives none; other columns are not read.
    A null key counts only where a component has no other.
    """
    marked, components = grouped(docs, size, radius, key, text)
    found = staged(components.select("fp", "n", "component_id"), "components")
    # Of fingerprints with HOT_ROWS rows or more there is one in HOT_ROWS rows at most; these go to
    # all tasks, so that no task gets all rows of one.
    hot = found.where(F.col("n") >= HOT_ROWS).select("fp", "component_id")
    hot = F.broadcast(hot) if hot.count() <= MOST_HOT else hot
    many = marked.join(hot, "fp").select(key, "fp", "component_id")
    few = marked.join(hot, "fp", "left_anti").join(found.where(F.col("n") < HOT_ROWS).select("fp", "component_id"), "fp")
    return many.unionByName(few.select(key, "fp", "component_id"))


def keep_first(docs: DataFrame, size: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of the smallest key of each component, with every column as it was.
    Of rows with an equal key, all of them or none stay; null keys go."""
    _, components = grouped(docs, size, radius, key, text)
    first = components.where(F.col("least") == F.col("component_id")).select(F.col("least").alias(key)).distinct()
    return docs.join(first, key, "left_semi").select(*docs.columns)


# --- texts by the share of shingles they have in common

#: A band joins equal texts of ROWS minima; BANDS of them miss a pair of similarity 0.8 3 times in 100,000.
BANDS, ROWS = 20, 4
#: Bits that fingerprints of distinct shingles may differ in to be compared exactly; at 0.8 they differ in 10 +- 3.
WIDE = 24
_MIX = np.uint64(0xD6E8FEB86659FD93)
_ODD, _FLIP = (np.random.default_rng(9).integers(0, 1 << 64, (2, BANDS * ROWS), dtype=np.uint64)) | np.array([[1], [0]], dtype=np.uint64)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, no words are none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).split()
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(len(words) - size + 1, min(len(words), 1))
    found = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(size, len(words))):
            found = (found ^ (found >> np.uint64(31))) * _MIX + codes[k : n + k]
        found = (found ^ (found >> np.uint64(32))) * _MIX
    return np.unique(found)


def set_fingerprint(found: np.ndarray) -> int:
    """SimHash of distinct shingles, each once."""
    bits = np.unpackbits(found.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(found), bitorder="little").view("<u8")[0])


def band_values(found: np.ndarray) -> np.ndarray:
    """One value for each band of minima; texts of equal shingles have equal ones, no shingles have none."""
    if not len(found):
        return np.zeros(0, dtype=np.int64)
    least = np.full(BANDS * ROWS, ALL)
    with np.errstate(over="ignore"):
        for i in range(0, len(found), 2048):
            least = np.minimum(least, ((found[i : i + 2048, None] ^ _FLIP) * _ODD).min(axis=0))
        value = np.arange(1, BANDS + 1, dtype=np.uint64)
        for column in least.reshape(BANDS, ROWS).T:
            value = (value ^ (value >> np.uint64(31))) * _MIX + column
    return value.view(np.int64)


def similar_forest(fp: np.ndarray, cell: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of pairs that join, within each run of equal cells, all texts that pairs of at
    least the similarity link there; each pair given has it, and no cycle is given."""
    size = np.array([len(x) for x in sets], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    marked = np.zeros(int(codes.max()) + 1, dtype=bool)
    ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell))
    end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    root, u, v = np.arange(len(fp)), [], []
    for i, j in near_pairs(fp, end, WIDE):
        most = np.minimum(size[i], size[j])
        open_ = (root[i] != root[j]) & (most * (1 + similarity) >= similarity * (size[i] + size[j]) - 1e-9)
        i, j = i[open_], j[open_]
        if not len(i):
            continue
        order = np.lexsort((j, i))
        i, j = i[order], j[order]
        for a, b in zip(starts := np.flatnonzero(np.diff(i, prepend=-1)), np.append(starts[1:], len(i)), strict=True):
            one, others = i[a], j[a:b]
            others = others[root[others] != root[one]]
            if not len(others):
                continue
            own = codes[at[one] : at[one + 1]]
            marked[own] = True
            first, last = others[0], others[-1] + 1  # a run of at most 64 rows
            common = np.add.reduceat(marked[codes[at[first] : at[last]]], at[first:last] - at[first], dtype=np.int64)[others - first]
            marked[own] = False
            for x in others[common * (1 + similarity) >= similarity * (size[one] + size[others]) - 1e-9]:
                p, q = root[one], root[x]
                if p != q:
                    root[root == max(p, q)] = min(p, q)
                    u.append(one)
                    v.append(x)
    return np.array(u, dtype=np.int64), np.array(v, dtype=np.int64)


def similar_links(groups: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """(u, v): digests of texts of at least the similarity, whose closure is that of all such
    pairs with a band in common. groups: digest, row, words (distinct shingles), bands; texts: row, text."""
    cells = groups.select("digest", "words", F.explode("bands").alias("cell"))
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("words") * 8).alias("bytes"), F.bit_xor(F.xxhash64("digest")).alias("members")).where("n > 1")
    # Cells of the same members are compared once. A task holds as many rows or bytes as half a cell may have, twice.
    share = F.greatest(F.col("n") / CELL_ROWS, F.col("bytes") / CELL_BYTES)
    counts = staged(counts.groupBy("members", "n", "bytes").agg(F.min("cell").alias("cell")).select("cell", F.least(F.ceil(share * 2), F.col("n")).cast("int").alias("parts"), share.alias("share")), "cells")
    dealt = cells.join(counts, "cell")
    cold = dealt.where("share <= 1").select("digest", "cell")
    split = (
        dealt.where("share > 1")
        .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .where("part <> other")
        .select("digest", F.xxhash64("cell", F.least("part", "other"), F.greatest("part", "other")).alias("cell"))
    )
    places = staged(cold.unionByName(split), "places")

    def make():
        def f(batch: pa.RecordBatch) -> dict[str, list]:
            sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
            marks = np.array([set_fingerprint(x) for x in sets], dtype=np.uint64).view(np.int64)
            return {"digest": batch.column(0), "fp": marks, "words": [x.tobytes() for x in sets]}

        return f

    wanted = groups.join(places.select("digest").distinct(), "digest", "left_semi").select("digest", "row")
    sets = staged(map_slices(texts.join(wanted, "row").select("digest", "text"), make, "digest long, fp long, words binary"), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def links(part: pa.Table) -> pa.RecordBatch:
            digest, fp, cell = (part.column(c).to_numpy() for c in ("digest", "fp", "cell"))
            found = [np.frombuffer(x, dtype=np.uint64) for x in part.column("words").to_pylist()]
            u, v = similar_forest(fp.view(np.uint64), cell, found, similarity)
            return pa.RecordBatch.from_arrays([pa.array(digest[u]), pa.array(digest[v])], names=["u", "v"])

        for batch in batches:
            now = pa.Table.from_batches([batch])
            kept = now if kept is None else pa.concat_tables([kept, now])
            if not len(kept):
                continue
            cell = kept.column("cell").to_numpy()
            whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            if whole:
                yield links(kept.slice(0, whole))
                kept = kept.slice(whole)
        if kept is not None and len(kept):
            yield links(kept)

    met = places.join(sets, "digest").select("cell", "digest", "fp", "words")
    return met.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(run, "u long, v long")


def keep_distinct(docs: DataFrame, size: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of texts that a chain of pairs links whose distinct word
    shingles have a Jaccard similarity of at least the given one: that of the smallest
    key, nulls last, and of the first such row. Every column, whatever its name, stays as it was."""
    own = free_name(docs.columns, "row")
    rows = staged(docs.withColumn(own, F.monotonically_increasing_id()), "rows")
    texts = rows.select(F.col(own).alias("row"), F.col(text).alias("text"))

    def make():
        def f(batch: pa.RecordBatch) -> dict[str, list]:
            sets = [shingles(t, size) for t in batch.column(2).to_pylist()]
            digest = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], dtype=np.uint64).view(np.int64)
            return {"row": batch.column(0), "key": batch.column(1), "digest": digest, "words": [len(x) for x in sets], "bands": [band_values(x) for x in sets]}

        return f

    given = rows.select(F.col(own).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    marks = map_slices(given, make, f"row long, key {docs.schema[key].dataType.simpleString()}, digest long, words long, bands array<long>")
    first = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    groups = staged(marks.groupBy("digest").agg(F.min(first).alias("first"), F.min_by("bands", "row").alias("bands"), F.max("words").alias("words")), "groups")
    labels = smallest_labels(similar_links(groups.select("digest", "first.row", "words", "bands"), texts, size, similarity))
    reached = groups.join(labels.select(F.col("node").alias("digest"), "label"), "digest", "left").select("first", F.coalesce("label", "digest").alias("label"))
    kept = reached.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias(own))
    return rows.join(kept, own, "left_semi").select(*docs.columns)
