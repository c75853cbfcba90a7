"""Benchmark decontamination: Aho-Corasick over normalised item windows.

Texts and items are lower-cased (A-Z only) and cut into words. The windows of all
items go into one automaton, each document is scanned once, and hits are mapped to
word numbers and to code points of the original text.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from typing import Any

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SLICE_ROWS, filter_slices, map_slices, staged
from tidemark.operators.change import free_name

#: Signs of distinct windows that one automaton holds about; further windows go to further
#: ones. A sign takes some 45 bytes of a worker's memory (measured), so this is 180 MB.
BLOCK_SIGNS = 4_000_000
#: Signs that an item's id beside a window counts for.
ID_SIGNS = 2
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: ASCII to lower case letters and digits, all else below 128 to a space.
FOLD = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def normal_words(text: str | None) -> list[str]:
    """Words of a text, lower-cased."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(FOLD)
    return [w for w in raw.decode("utf-8", "surrogatepass").split(" ") if w]


def windows(words: list[str], size: int) -> list[str]:
    """Consecutive windows of an item's words; a shorter item is one window."""
    if not words:
        return []
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class Scanner:
    """An automaton over (window, ids of the items that hold it)."""

    def __init__(self, owners: list[tuple[str, tuple]]):
        self.automaton = ahocorasick.Automaton()
        for w, who in owners:
            self.automaton.add_word(f" {w} ", (w.count(" ") + 1, who))
        self.empty = not owners
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, word spans [first, past) that are hit, merged, and items."""
        words = normal_words(text)
        if not words or self.empty:
            return len(words), [], set()
        line = f" {' '.join(words)} "
        found = list(self.automaton.iter(line))
        if not found:
            return len(words), [], set()
        ends = np.cumsum([len(w) + 1 for w in words])
        last = np.searchsorted(ends, [end for end, _ in found])
        spans: list[list[int]] = []
        for a, b in sorted((int(i) + 1 - size, int(i) + 1) for i, (_, (size, _)) in zip(last, found, strict=True)):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        return len(words), [(a, b) for a, b in spans], {i for _, (_, who) in found for i in who}


def char_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as spans of code points of the original text."""
    if not spans:
        return []
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


_built: dict[str, Scanner] = {}


class Block:
    """Windows of one automaton, packed and sent to tasks as Spark broadcasts are: in pieces,
    from executor to executor, to disk where memory is short. Nothing stays in the driver."""

    def __init__(self, name: str, held: Broadcast | None):
        self.name, self.held = name, held

    def owners(self) -> list[tuple[str, tuple]]:
        return pickle.loads(zlib.decompress(self.held.value)) if self.held else []


def scanner_of(block: Block) -> Scanner:
    """The block's scanner; a worker process holds one at a time."""
    if block.name not in _built:
        _built.clear()
        _built[block.name] = Scanner(block.owners())
    return _built[block.name]


def blocks_of(items: DataFrame, size: int, key: str, text: str, most: int | None = None) -> list[Block]:
    """The items' distinct windows in blocks of about BLOCK_SIGNS signs. Windows are dealt by
    their hash, so blocks are even however long single items are. The driver holds one
    block at a time, on its way to the executors."""
    kind = T.StructType([T.StructField("item", items.schema[key].dataType), T.StructField("window", T.StringType())])
    most, spark = most or BLOCK_SIGNS, items.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(i, SLICE_ROWS)
                found = [(n, w) for n, t in enumerate(rows.column(1).to_pylist()) for w in dict.fromkeys(windows(normal_words(t), size))]
                for j in range(0, len(found), 20_000):
                    part = found[j : j + 20_000]
                    yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array([n for n, _ in part], pa.int64())), pa.array([w for _, w in part], pa.string())], names=kind.names)

    held = items.select(key, text).mapInArrow(cut, kind).groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    held = staged(held, "windows")
    # An id beside a window counts as ID_SIGNS signs, so a window of very many items fills a block.
    signs = held.agg(F.sum(F.char_length("window") + 2 + ID_SIGNS * F.size("items"))).first()[0]
    if not signs:
        return [Block("none", None)]
    n = -(-signs // most)
    dealt = held.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(n)))
    if n > 1:
        dealt = staged(dealt.repartition(min(n, 200), "block").sortWithinPartitions("block"), "blocks")
    found, name = [], dealt.inputFiles()[0] if n > 1 else held.inputFiles()[0]
    for i in range(n):
        rows = [(r["window"], tuple(r["items"])) for r in dealt.where(F.col("block") == i).select("window", "items").collect()]
        found.append(Block(f"{name}#{i}", spark.sparkContext.broadcast(zlib.compress(pickle.dumps(rows, protocol=5), 1))))
        del rows
    return found


def hits_schema(docs: DataFrame, items: DataFrame, key: str, item_key: str) -> T.StructType:
    spans = T.StructType.fromDDL("n_words long, spans array<struct<first: long, past: long>>, chars array<struct<start: long, end: long>>").fields
    item = T.StructField("items", T.ArrayType(items.schema[item_key].dataType))
    return T.StructType([T.StructField(key, docs.schema[key].dataType), spans[0], spans[1], item, spans[2]])


def find_overlap(docs: DataFrame, items: DataFrame, size: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: key, n_words, merged word spans, item ids, code-point spans.

    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing; repeated document rows give repeated results, repeated items count
    once by id, and items without an id count for hits but not as items. Windows
    beyond one automaton's size are scanned in blocks, whose results are merged by
    document. Other columns are not read.
    """
    blocks = blocks_of(items, size, item_key, item_text)
    schema = hits_schema(docs, items, key, item_key)

    def over(df: DataFrame, block: Block, schema: T.StructType) -> DataFrame:
        def make():
            scan = scanner_of(block).scan

            def f(batch: pa.RecordBatch) -> dict[str, list]:
                out: dict[str, Any] = {schema.names[0]: batch.column(0), "n_words": [], "spans": [], "items": [], "chars": []}
                for t in batch.column(1).to_pylist():
                    n, spans, who = scan(t)
                    out["n_words"].append(n)
                    out["spans"].append([{"first": a, "past": b} for a, b in spans])
                    out["items"].append(sorted(who))
                    out["chars"].append([{"start": a, "end": b} for a, b in char_spans(t, spans)] if spans else [])
                return out

            return f

        return map_slices(df, make, schema)

    base = docs.select(key, text)
    if len(blocks) == 1:
        return over(base, blocks[0], schema)
    # Each row gets a number of its own, so that repeated rows stay apart when blocks are merged.
    own = free_name([key, text, *schema.names], "row")
    numbered = staged(base.withColumn(own, F.monotonically_increasing_id()), "numbered")
    by_row = T.StructType([T.StructField(own, T.LongType()), *schema.fields[1:]])
    parts = [over(numbered.select(own, text), block, by_row) for block in blocks]
    first, rest = parts[0], parts[1].where("size(spans) > 0")
    for part in parts[2:]:
        rest = rest.unionByName(part.where("size(spans) > 0"))
    # Only rows with hits go on to the merge; the first block's scan has every row.
    merged = first.unionByName(rest).groupBy(own).agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("chars"))).alias("chars"),
    )
    return numbered.select(own, key).join(merged, own).drop(own)


def word_total(spans: str) -> F.Column:
    """Words in spans that may overlap, sorted by their start."""
    none = F.struct(F.lit(0).cast("long").alias("past"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, x: F.struct(
        F.greatest(acc["past"], x["past"]).alias("past"),
        (acc["n"] + F.greatest(F.lit(0).cast("long"), x["past"] - F.greatest(acc["past"], x["first"]))).alias("n"),
    )
    return F.aggregate(F.col(spans), none, step, lambda acc: acc["n"])


def keep_clean(docs: DataFrame, items: DataFrame, size: int = 10, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows without a hit, with every column as it was; no shuffle while the windows fit
    one automaton. Null and empty texts stay; repeated rows stay or go together; an empty
    benchmark takes nothing away."""
    blocks = blocks_of(items, size, item_key, item_text)

    def hit(block: Block, wanted: bool):
        def make():
            scan = scanner_of(block).scan
            return lambda texts: [bool(scan(t)[1]) == wanted for t in texts]

        return make

    if len(blocks) == 1:
        return filter_slices(docs, hit(blocks[0], False), text)
    own = free_name(docs.columns, "row")
    rows = staged(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    found = [filter_slices(rows.select(own, text), hit(block, True), text).select(own) for block in blocks]
    gone = found[0]
    for part in found[1:]:
        gone = gone.unionByName(part)
    return rows.join(gone.distinct(), own, "left_anti").select(*docs.columns)
