"""Ranked lexical search: the best documents for every item of a set of queries.

A document is a bag: how often it holds each term of the items' vocabulary, and nothing
else. Documents with the same bag and the same length factor m have the same score for
every item, so they make a class: classes are found by a hash, verified by the bag itself,
and scored once. The members of the classes that reach an item's best ones are expanded at
the end, by ascending key.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_slices, staged
from tidemark.llm.decontaminate import FOLD

#: Pairs of item and term, and items, that one broadcast holds; more items make further blocks.
MOST_PAIRS, MOST_ITEMS = 1_000_000, 2_000
#: Best classes that a task holds before it sorts them out; classes scored at once.
MOST_HELD, SCORED = 400_000, 128


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


# --- items


class Postings:
    """The terms of a block of items, and the items that hold each."""

    def __init__(self, ids: pa.Array, texts: list[str | None]):
        place: dict = {}
        own: dict[bytes, set[int]] = {}
        for i, text in zip(ids.to_pylist(), texts, strict=True):
            row = place.setdefault(i, len(place))
            for term in terms_of(text):
                own.setdefault(term, set()).add(row)
        self.ids = pa.array(list(place), ids.type)
        self.terms = {t: i for i, t in enumerate(own)}
        self.items = np.array([i for who in own.values() for i in sorted(who)], dtype=np.int64)
        self.starts = np.cumsum([0, *map(len, own.values())])
        held = np.bincount(self.items, minlength=1)
        #: Sums of so few parts are exact in doubles.
        self.exact = int(held.max()) < 200_000


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Postings]:
    """The items in blocks of bounded size; rows of one key stay together."""
    words = F.ceil(F.char_length(F.coalesce(F.col(text), F.lit(""))) / 2)  # at most so many
    sized = items.select(F.col(key).alias("id"), F.col(text).alias("text"), words.alias("n"))
    total = sized.agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("rows")).first()
    n = max(-(-(total["pairs"] or 0) // MOST_PAIRS), -(-total["rows"] // MOST_ITEMS))
    for i in range(n):
        own = sized.where(F.pmod(F.xxhash64("id"), F.lit(n)) == i).select("id", "text").orderBy("id", "text").toArrow()
        yield Postings(own.column("id").combine_chunks(), own.column("text").to_pylist())


# --- documents


def bags(docs: DataFrame, block: Broadcast, key: str, text: str) -> DataFrame:
    """(key, n: terms in all, bag): the bag is the numbers of the block's terms, rising, and
    then how often each stands; documents without a term at all are left out."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL("n long, bag binary").fields])

    def make():
        known = block.value.terms

        def f(batch: pa.RecordBatch) -> dict[str, list]:
            at, sizes, packed = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if own := terms_of(t):
                    held = sorted((known[w], n) for w, n in Counter(own).items() if w in known)
                    at.append(i)
                    sizes.append(len(own))
                    packed.append(np.array(held, dtype="<u4").reshape(-1, 2).T.tobytes())
            return {"key": batch.column(0).take(pa.array(at, pa.int64())), "n": sizes, "bag": packed}

        return f

    return map_slices(docs.select(key, text), make, schema)


def classes(held: DataFrame, n_docs: int, n_terms: int, slope: int) -> DataFrame:
    """held with m and the class: the hash of bag and m."""
    m = (F.lit(100 - slope) + F.expr(f"({slope} * n * {n_docs}L) div {max(n_terms, 1)}L")).cast("long")
    return held.withColumn("m", m).withColumn("class", F.xxhash64("bag", "m"))


def document_counts(grouped: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term stands, from the classes and their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            for bag, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n[np.frombuffer(bag, dtype="<u4")[: len(bag) // 8]] += members
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(n[has], pa.int64())], names=["term", "n"])

    out = np.zeros(n_terms, dtype=np.int64)
    for r in grouped.select("bag", "members").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # the block's terms at most
        out[r["term"]] = r["n"]
    return out


class Best:
    """The best classes of each item that a task has seen: by score, then by the first key."""

    def __init__(self, n_items: int, most: int, held: int):
        self.most, self.held, self.least = most, held, np.zeros(n_items, dtype=np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, score: np.ndarray, first: np.ndarray, place: np.ndarray) -> None:
        """Scores [class, item] of classes, their first keys and their numbers."""
        row, item = np.nonzero((score > 0) & (score >= self.least))
        self.parts.append((item, score[row, item], first[row], place[row]))
        self.n += len(row)
        if self.n > self.held:
            self.sorted_out()

    def sorted_out(self) -> tuple[np.ndarray, ...]:
        item, score, first, place = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, dtype=np.int64),) * 4
        order = np.lexsort((place, first, -score, item))
        by_item = item[order]
        rank = np.arange(len(order)) - np.searchsorted(by_item, by_item, side="left")
        kept, last = order[rank < self.most], order[rank == self.most - 1]
        self.least[item[last]] = score[last]
        self.parts, self.n = [(item[kept], score[kept], first[kept], place[kept])], len(kept)
        return self.parts[0]


def scored(grouped: DataFrame, block: Broadcast, weight: np.ndarray, most: int, slope: int) -> DataFrame:
    """(item, score, first, class, bag, m): of each item the best classes of every task."""
    sent = grouped.sparkSession.sparkContext.broadcast(weight)
    item_type = T.StructField("item", _spark_type(block.value.ids.type))
    most_held = MOST_HELD
    schema = T.StructType([item_type, *T.StructType.fromDDL("score long, first long, class long, bag binary, m long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = block.value, sent.value
        n_items, size = len(own.ids), np.diff(own.starts)
        best, kept, base = Best(n_items, most, most_held), {}, 0
        for batch in batches:
            for i in range(0, batch.num_rows, SCORED):
                part = batch.slice(i, SCORED)
                raw, m = part.column(1).to_pylist(), part.column(2).to_numpy()
                pairs = [np.frombuffer(b, dtype="<u4").reshape(2, -1).astype(np.int64) for b in raw]
                term, tf = np.concatenate(pairs, axis=1)
                of = np.repeat(np.arange(len(raw)), [p.shape[1] for p in pairs])
                value = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[of]))
                n = size[term]
                at = np.repeat(own.starts[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                cell = np.repeat(of, n) * n_items + own.items[at]
                if own.exact:
                    score = np.bincount(cell, weights=np.repeat(value, n), minlength=len(raw) * n_items).astype(np.int64)
                else:
                    score = np.zeros(len(raw) * n_items, dtype=np.int64)
                    np.add.at(score, cell, np.repeat(value, n))
                first = part.column(3).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                place = np.arange(base, base + len(raw))
                best.add(score.reshape(len(raw), n_items), first, place)
                named = np.unique(np.concatenate([p[3][p[3] >= base] for p in best.parts[-1:]]))
                kept.update((int(p), (part.column(0)[p - base].as_py(), raw[p - base], int(m[p - base]))) for p in named)
                base += len(raw)
                if len(kept) > most_held // 10 + n_items * most:
                    still = set(best.sorted_out()[3].tolist())
                    kept = {p: x for p, x in kept.items() if p in still}
        item, score, first, place = best.sorted_out()
        for i in range(0, len(item), 1024):
            rows = [kept[int(p)] for p in place[i : i + 1024]]
            columns = [own.ids.take(pa.array(item[i : i + 1024])), pa.array(score[i : i + 1024]), pa.array(first[i : i + 1024])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())], names=schema.names)

    return grouped.select("class", "bag", "m", F.col("first").cast("long").alias("first")).mapInArrow(run, schema)


def _spark_type(kind: pa.DataType) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind)


def top(df: DataFrame, by: list, order: list, most: int, name: str = "rank") -> DataFrame:
    """The first rows of each group; tasks sort out what they can before rows are shuffled."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= most)


def search(docs: DataFrame, items: DataFrame, most: int = 50, slope: int = 50, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, key, score): for each item the `most` documents of the highest scores above 0.

    A term weighs floor(1000 ln((2N+2) / (2df+1))) and counts 10^9 tf div (1000 tf + 20 m), m
    being 100 - slope + slope n N div L; N counts documents with a term, L all their terms.
    Equal scores are ranked by ascending key (whole numbers; null ones last), repeated documents
    one by one. Items without terms have no rows, rows of one item key are one item; null and
    empty documents have no terms. Empty tables give no rows. Other columns are not read.

    Items go to the tasks in blocks of MOST_PAIRS pairs with terms, each against all documents.
    """
    out = None
    for block in item_blocks(items, item_key, item_text):
        if not block.terms:
            continue
        found = _search_block(docs, docs.sparkSession.sparkContext.broadcast(block), most, slope, key, text)
        out = found if out is None else out.unionByName(found)
    if out is None:
        kinds = [T.StructField("item", items.schema[item_key].dataType), T.StructField("rank", T.IntegerType()), T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.LongType())]
        out = docs.sparkSession.createDataFrame([], T.StructType(kinds))
    return out.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")


def _search_block(docs: DataFrame, block: Broadcast, most: int, slope: int, key: str, text: str) -> DataFrame:
    held = staged(bags(docs, block, key, text), "bags")
    n_docs, n_terms = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    members = classes(held.where(F.octet_length("bag") > 0), n_docs, n_terms, slope).select("key", "bag", "m", "class")
    # Grouped by the bag itself beside its hash: equal hashes of different bags stay apart.
    grouped = staged(members.groupBy("class", "bag", "m").agg(F.count(F.lit(1)).alias("members"), F.min("key").alias("first")), "classes")
    df = document_counts(grouped, len(block.value.terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    best = top(scored(grouped, block, weight, most, slope), ["item"], [F.desc("score"), F.asc("first"), F.asc("class")], most)
    best = staged(best.select("item", "score", "class", "bag", "m"), "best")
    # At most MOST_ITEMS * most hashes go to every task; rows that pass are verified by the join below.
    near = members.join(F.broadcast(best.select("class").distinct()), "class", "left_semi")
    first = top(near, ["class", "bag", "m"], [F.asc_nulls_last("key")], most, "place").select("key", "class", "bag", "m")
    expanded = best.join(first, ["class", "bag", "m"]).select("item", "score", "key")
    return top(expanded, ["item"], [F.desc("score"), F.asc_nulls_last("key")], most).select("item", "rank", "key", "score")
