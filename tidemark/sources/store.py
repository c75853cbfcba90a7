"""A versioned Parquet table.

Every write goes to a new directory. A version is one small file that names the directories of
its partitions, with what is known of each: rows, schema, smallest and largest key, deleted
rows. It is written last, and of several writers one gets its number. So nothing that
is being read is overwritten, a run that dies before leaves the table as it was, an upsert
writes the touched partitions once, and dropping partitions writes no data at all.

A writer that finds its number taken looks at what the others did: if they touched other
partitions, its own work goes on top of theirs; else it gets a Conflict and has to be done
again. Directories keep the schema that they were written with; where the table's columns
have become wider since, they are cast on reading.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import wider
from tidemark.sources.scratch import create_text, local_rows, n_files, names, read_text, remove

#: Values of the partition columns, as texts; None for null.
Values = tuple[str | None, ...]
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Keys in a block of a directory's filter: 256 bits, of which a key sets eight.
BLOCK_KEYS = 16
#: Files whose rows are counted by one task; no column of them is read.
FEW_FILES = 64
#: Pairs of keys and directories that are looked up in filters, as a part of the table's
#: rows; beyond, reading its keys is less work.
MOST_PROBES = 0.5


class Conflict(RuntimeError):
    """Another writer changed what this one had read."""


@dataclass(frozen=True)
class Version:
    """dirs: what is known of each directory: n (rows), dead (rows deleted since), schema (its
    place in `schemas`), at (its name in URLs), and of an indexed table low, high and blocks.
    touched: the partitions that made the version, None for all; transactions: the last number
    of each writer that counts its own."""

    number: int
    schema: T.StructType
    parts: list[str]
    dirs: dict[str, dict[str, Any]]
    schemas: list[dict] = field(default_factory=list)
    touched: list[Values] | None = None
    transactions: dict[str, int] = field(default_factory=dict)

    @staticmethod
    def values(directory: str) -> Values:
        own = [unquote(x.split("=", 1)[1]) for x in directory.split("/")[1:]]
        return tuple(None if v == NULL_PARTITION else v for v in own)

    @property
    def rows(self) -> int:
        return sum(d["n"] - d.get("dead", 0) for d in self.dirs.values())

    def text(self) -> str:
        return json.dumps({
            "schema": json.loads(self.schema.json()), "parts": self.parts, "dirs": self.dirs, "schemas": self.schemas,
            "touched": self.touched, "transactions": self.transactions,
        })

    @classmethod
    def read(cls, number: int, text: str) -> Version:
        held = json.loads(text)
        touched = None if held["touched"] is None else [tuple(v) for v in held["touched"]]
        return cls(number, T.StructType.fromJson(held["schema"]), held["parts"], held["dirs"], held["schemas"], touched, held["transactions"])


class Table:
    """index: a column whose smallest and largest value, and a filter of its values, are kept for
    every directory, so that few directories have to be opened to find keys."""

    def __init__(self, spark: SparkSession, path: str, parts: Sequence[str] = (), index: str | None = None):
        self.spark, self.path, self.wanted, self.index = spark, path.rstrip("/"), list(parts), index
        self._last: Version | None = None

    # --- versions

    def _numbers(self) -> list[int]:
        found = [n.removesuffix(".json")[1:] for n in names(self.spark, f"{self.path}/_log") if n.startswith("v")]
        return sorted(int(n) for n in found if n.isdigit())

    def version(self) -> int:
        """The current version, 0 if the table isn't there."""
        return max(self._numbers(), default=0)

    def state(self, number: int | None = None) -> Version | None:
        """The current version, or an earlier one."""
        number = number or self.version()
        if not number:
            return None
        if self._last is not None and self._last.number == number:  # a version never changes
            return self._last
        found = Version.read(number, read_text(self.spark, f"{self.path}/_log/v{number}.json"))
        if self._last is None or self._last.number < number:
            self._last = found
        return found

    def exists(self) -> bool:
        return self.version() > 0

    @property
    def parts(self) -> list[str]:
        """Partition columns: those of the table, or, before there is one, those asked for."""
        held = self.state()
        return held.parts if held else self.wanted

    def _commit(self, before: Version | None, made: Callable[[Version | None], Version], touched: Iterable[Values] | None, transaction: tuple[str, int] | None = None, adds: bool = False) -> None:
        """A new version out of the current one. `before` is the one that the writer has read:
        if others came since, what they touched must not meet what this one touched (None: all),
        unless it only adds rows, which hang on nothing that was there."""
        touched = None if touched is None else set(touched)
        while True:
            now = self.state()
            for number in range(before.number + 1 if before else 1, now.number + 1 if now else 1):
                other = self.state(number)
                if transaction and other.transactions.get(transaction[0], -1) >= transaction[1]:
                    return
                same = before is not None and other.parts == before.parts
                if not adds and (not same or other.touched is None or touched is None or touched & set(other.touched)):
                    raise Conflict(f"version {number} of {self.path} touched the same partitions")
            new = made(now)
            ids = {**(now.transactions if now else {}), **({transaction[0]: transaction[1]} if transaction else {})}
            new = Version(now.number + 1 if now else 1, new.schema, new.parts, new.dirs, new.schemas, None if touched is None else sorted(touched, key=str), ids)
            if create_text(self.spark, f"{self.path}/_log/v{new.number}.json", new.text()):
                self._last = new
                return

    def done(self, transaction: tuple[str, int] | None) -> bool:
        """Whether a writer's numbered transaction, or a later one, is in the table."""
        held = self.state()
        return bool(transaction and held and held.transactions.get(transaction[0], -1) >= transaction[1])

    # --- reading

    def read(self, only: Iterable[Values] | None = None, version: int | None = None) -> DataFrame | None:
        """The current rows, or those of an earlier version; with `only`, those of some
        partitions. The schema is known, so no file is opened for it."""
        held = self.state(version)
        if held is None:
            return None
        wanted = None if only is None else set(only)
        return self._frame(held, [d for d in held.dirs if wanted is None or held.values(d) in wanted])

    def read_dirs(self, dirs: Iterable[str], places: bool = False, version: Version | None = None) -> DataFrame:
        """The rows of some directories of a version, by default the current one; with places,
        where each stands (_file, _row)."""
        return self._frame(version or self.state(), list(dirs), places)

    def _frame(self, held: Version, dirs: Sequence[str], places: bool = False) -> DataFrame:
        extra = [T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())] if places else []
        if not dirs:
            return self.spark.createDataFrame([], T.StructType([*held.schema.fields, *extra]))
        groups: dict[tuple[int, bool], list[str]] = {}
        for d in dirs:
            groups.setdefault((held.dirs[d]["schema"], bool(held.dirs[d].get("dead"))), []).append(d)
        return reduce(DataFrame.unionByName, [self._group(held, k, marked, own, places) for (k, marked), own in sorted(groups.items())])

    def _group(self, held: Version, schema: int, marked: bool, dirs: list[str], places: bool) -> DataFrame:
        """Rows of directories of one schema, without deleted ones, as the table's columns are now."""
        base, own = f"{self.path}/data", T.StructType.fromJson(held.schemas[schema])
        rows = self.spark.read.schema(own).option("basePath", base).parquet(*[f"{base}/{d}" for d in dirs])
        if places or marked:
            rows = rows.select(*[F.col(f"`{f.name}`") for f in own.fields], file_place().alias("_file"), F.col("_metadata.row_index").alias("_row"))
        if marked:
            vectors = sorted({v for d in dirs for v in held.dirs[d]["vectors"]})
            bits = self.spark.read.schema(VECTOR).parquet(*[f"{self.path}/vectors/{v}" for v in vectors])
            bits = bits.groupBy("_file", "_part").agg(F.bitmap_or_agg("bits").alias("_bits"))
            at = F.col("_row") % (1 << 15)
            byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            dead = F.coalesce(F.call_function("getbit", byte, (at % 8).cast("int")) == 1, F.lit(False))
            rows = rows.withColumn("_part", F.shiftright("_row", 15)).join(bits, ["_file", "_part"], "left").where(~dead)
        shown = [(F.col(f"`{f.name}`") if f.name in own.fieldNames() else F.lit(None)).cast(f.dataType).alias(f.name) for f in held.schema.fields]
        return rows.select(*shown, *(["_file", "_row"] if places else []))

    def values_of(self, df: DataFrame) -> set[Values]:
        """The partitions that rows lie in: as many values as there are partitions at most."""
        found = df.select(*[F.col(f"`{p}`").cast("string") for p in self.parts]).distinct().collect()
        return {tuple(v or None for v in row) for row in found}

    def may_hold(self, keys: DataFrame, known: tuple[int, Any, Any] | None = None, version: Version | None = None) -> list[str]:
        """The directories that may hold a row with one of these keys (of the indexed column's
        values, whatever their name): by the smallest and largest key of each, and by its filter.
        known: how many keys there are at most, the smallest and the largest as texts, where
        they are known. Without an index all directories of the version."""
        held = version or self.state()
        marked = {d: x for d, x in held.dirs.items() if "low" in x}
        if not marked or self.index is None or self.index not in held.schema.names:
            return list(held.dirs)
        rest = [d for d in held.dirs if d not in marked]
        kind = held.schema[self.index].dataType
        keys = keys.select(F.col(f"`{keys.columns[0]}`").cast(kind).alias("_key")).where("_key is not null")
        n, low, high = known or keys.agg(F.count(F.lit(1)), F.min("_key").cast("string"), F.max("_key").cast("string")).first()
        if not n or low is None:
            return rest
        # Bounds are compared by Spark, as values of the column's type; a local relation needs no job.
        rows = [(d, x["at"], x["low"], x["high"], x["blocks"]) for d, x in marked.items()]
        ranges = local_rows(self.spark, rows, "_dir string, _at string, low string, high string, _blocks long")
        ranges = ranges.select("_dir", "_at", F.col("low").cast(kind).alias("_low"), F.col("high").cast(kind).alias("_high"), "_blocks")
        near = ranges.where((F.col("_high") >= F.lit(low).cast(kind)) & (F.col("_low") <= F.lit(high).cast(kind)))
        found = [r["_dir"] for r in near.select("_dir").collect()]
        if not found or n * len(found) > MOST_PROBES * max(held.rows, 1):
            return [*rest, *found]
        pairs = keys.join(F.broadcast(near), F.col("_key").between(F.col("_low"), F.col("_high")))  # a row a directory at most, counted above
        paths = [f"{self.path}/index/{w}" for w in sorted({d.split("/")[0] for d in found})]
        bits = self.spark.read.schema(FILTER).parquet(*paths)
        masks = [F.col(f"m{i}").bitwiseAND(F.col(f"w{i}")) == F.col(f"m{i}") for i in range(4)]
        hit = pairs.select("_dir", "_at", *block_and_masks("_key", F.col("_blocks"))).join(bits, ["_at", "block"]).where(reduce(Column.__and__, masks))
        return [*rest, *[r["_dir"] for r in hit.select("_dir").distinct().collect()]]

    # --- writing

    def _write(self, df: DataFrame, parts: list[str], number: int) -> dict[str, dict[str, Any]]:
        """Rows in a directory of their own; what is known of its partitions."""
        own = f"_write={number:08d}-{uuid.uuid4().hex[:8]}"
        # Rebalanced, not repartitioned by the partition columns: a day that holds most rows is split.
        out = df.hint("rebalance", *parts) if parts else df
        writer = out.write.option("compression", "snappy")
        base = f"{self.path}/data"
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{base}/{own}")
        back = self.spark.read.schema(df.schema).option("basePath", base).parquet(f"{base}/{own}")
        indexed = self.index is not None and self.index in df.columns
        key = F.col(f"`{self.index}`") if indexed else F.lit(None)
        placed = back.select(F.col("_metadata.file_path").alias("_path"), key.alias("_key"))
        few = not indexed and n_files(self.spark, f"{base}/{own}") <= FEW_FILES
        # Counted by file, then by directory: a file's path is taken apart once, not for each of its rows.
        files = (placed.coalesce(1) if few else placed).groupBy("_path").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high"))
        known = files.groupBy(directory(file_place("_path"), len(parts)).alias("_at")).agg(F.sum("n").alias("n"), F.min("low").cast("string").alias("low"), F.max("high").cast("string").alias("high"))
        out = {}
        for r in known.collect():  # one row a directory
            entry = out[unquote(r["_at"])] = {"n": r["n"], "at": r["_at"]}
            if indexed and r["low"] is not None:
                entry |= {"low": r["low"], "high": r["high"], "blocks": -(-r["n"] // BLOCK_KEYS)}
        if indexed:
            sizes = local_rows(self.spark, [(x["at"], x["blocks"]) for x in out.values() if "low" in x], "_at string, _blocks long")
            keyed = placed.where("_key is not null").select(directory(file_place("_path"), len(parts)).alias("_at"), "_key")
            keyed = keyed.join(F.broadcast(sizes), "_at").select("_at", *block_and_masks("_key", F.col("_blocks")))
            keyed.groupBy("_at", "block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(4)]).write.parquet(f"{self.path}/index/{own}")
        return out

    def _added(self, now: Version | None, kept: Mapping[str, dict], fresh: Mapping[str, dict], schema: T.StructType, written: T.StructType, parts: list[str]) -> Version:
        """The version of the kept and the fresh directories, the latter written with a schema of their own."""
        schemas = [*(now.schemas if now else [])]
        own = json.loads(written.json())
        if own not in schemas:
            schemas.append(own)
        at = schemas.index(own)
        return Version(0, schema, parts, {**kept, **{d: {**x, "schema": at} for d, x in fresh.items()}}, schemas)

    def replace(self, df: DataFrame, parts: Sequence[str] | None = None, before: Version | None = None) -> None:
        """A new version of the whole table. The ones before stay until vacuum()."""
        before = before or self.state()
        parts = list(parts) if parts is not None else self.wanted or (before.parts if before else [])
        fresh = self._write(df, parts, before.number + 1 if before else 1)
        self._commit(before, lambda now: self._added(None, {}, fresh, nullable(df.schema), df.schema, parts), None)

    def append(self, df: DataFrame, transaction: tuple[str, int] | None = None) -> None:
        """More rows, possibly with more or wider columns; rows before hold null in new ones. Appends
        of several writers don't meet. A numbered transaction that the table holds isn't done again."""
        before = self.state()
        if self.done(transaction):
            return
        parts = before.parts if before else self.wanted
        fresh = self._write(df, parts, before.number + 1 if before else 1)

        def made(now: Version | None) -> Version:
            if now is not None and now.parts != parts:
                raise ValueError(f"{self.path} has other partition columns now")
            return self._added(now, now.dirs if now else {}, fresh, widened(now.schema, df.schema) if now else nullable(df.schema), df.schema, parts)

        self._commit(before, made, {Version.values(d) for d in fresh}, transaction, adds=True)

    def replace_partitions(self, df: DataFrame, touched: Iterable[Values] | None = None, before: Version | None = None) -> None:
        """Instead of the touched partitions (by default those that df has rows in) the rows
        of df; a touched partition without rows is empty afterwards. Others stay as they
        are, on disk as well. df may come from this table: `before` is the version it was read from, by
        default the current one."""
        before = before or self.state()
        if before is None or not before.parts:
            raise ValueError("the table has no partitions")
        fresh = self._write(df, before.parts, before.number + 1)
        own = {before.values(d) for d in fresh}
        gone = set(touched) if touched is not None else own

        def made(now: Version) -> Version:
            return self._added(now, {d: x for d, x in now.dirs.items() if now.values(d) not in gone}, fresh, widened(now.schema, df.schema), df.schema, now.parts)

        self._commit(before, made, gone | own)

    def delete_and_append(self, places: DataFrame, df: DataFrame, before: Version | None = None) -> None:
        """Rows at (_file, _row) out of the table and the rows of df into it, in one version, without
        writing others again: places go into bitmaps by file, which are applied on reading. Versions
        before read as they did."""
        before = before or self.state()
        own = f"{before.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        bits = places.distinct().withColumn("_part", F.shiftright("_row", 15))
        bits = bits.groupBy("_file", "_part").agg(F.bitmap_construct_agg(F.col("_row") % (1 << 15)).alias("bits"), F.count(F.lit(1)).alias("n"))
        bits.write.parquet(f"{self.path}/vectors/{own}")
        back = self.spark.read.schema(VECTOR + ", n long").parquet(f"{self.path}/vectors/{own}")
        dead = {r["_at"]: r["n"] for r in back.groupBy(directory(F.col("_file"), len(before.parts)).alias("_at")).agg(F.sum("n").alias("n")).collect()}
        fresh = self._write(df, before.parts, before.number + 1)
        hit = {d for d, x in before.dirs.items() if x["at"] in dead}

        def made(now: Version) -> Version:
            kept = {d: {**x, "dead": x.get("dead", 0) + dead[x["at"]], "vectors": [*x.get("vectors", []), own]} if d in hit else x for d, x in now.dirs.items()}
            return self._added(now, {d: x for d, x in kept.items() if x["n"] > x.get("dead", 0)}, fresh, widened(now.schema, df.schema), df.schema, now.parts)

        self._commit(before, made, {before.values(d) for d in [*hit, *fresh]})

    def drop_partitions(self, gone: Iterable[Values]) -> None:
        """Partitions out of the current version; no data is read or written."""
        before, gone = self.state(), set(gone)
        if before and any(before.values(d) in gone for d in before.dirs):
            self._commit(before, lambda now: Version(0, now.schema, now.parts, {d: x for d, x in now.dirs.items() if now.values(d) not in gone}, now.schemas), gone)

    def compact(self, most: int = 1, order: Sequence[str] = ()) -> int:
        """Partitions that lie in more than `most` directories, or hold deleted rows, in one
        directory each, the rows of a file in the order of some columns; how many
        partitions were written. Versions before stay readable until vacuum()."""
        before = self.state()
        if before is None:
            return 0
        held: dict[Values, list[dict]] = {}
        for d, x in before.dirs.items():
            held.setdefault(before.values(d), []).append(x)
        shape = lambda fields: [(f["name"], f["type"]) for f in fields]
        now = shape(json.loads(before.schema.json())["fields"])
        old = {i for i, x in enumerate(before.schemas) if shape(x["fields"]) != now}
        many = {v for v, own in held.items() if len(own) > most or any(x.get("dead") or x["schema"] in old for x in own)}
        if not many:
            return 0
        rows = self.read(many, before.number)
        if order:  # ranges first, so that files hold neighbours; then within each
            rows = rows.repartitionByRange(*[F.col(f"`{c}`") for c in [*before.parts, *order]]).sortWithinPartitions(*[F.col(f"`{c}`") for c in [*before.parts, *order]])
        if before.parts:
            self.replace_partitions(rows, many, before)
        else:
            self.replace(rows, before=before)
        return len(many)

    def partitions(self) -> set[Values]:
        held = self.state()
        return {held.values(d) for d in held.dirs} if held else set()

    def n_rows(self) -> int:
        """Rows of the table by what its versions know; nothing is read."""
        held = self.state()
        return held.rows if held else 0

    def drop(self) -> None:
        """The table and all its versions."""
        remove(self.spark, self.path)
        self._last = None

    def vacuum(self, keep: int = 2) -> None:
        """Remove what none of the last `keep` versions names. Readers of older ones fail, and so do
        writers that began before them."""
        numbers = self._numbers()[::-1]
        kept = [self.state(n) for n in numbers[:keep]]
        writes = {d.split("/")[0] for v in kept for d in v.dirs}
        vectors = {x for v in kept for d in v.dirs.values() for x in d.get("vectors", [])}
        for folder, used in (("data", writes), ("index", writes), ("vectors", vectors)):
            for own in names(self.spark, f"{self.path}/{folder}"):
                if own not in used:
                    remove(self.spark, f"{self.path}/{folder}/{own}")
        for number in numbers[keep:]:
            remove(self.spark, f"{self.path}/_log/v{number}.json")


#: Rows of a directory's filter, and of the bitmaps of deleted rows.
FILTER = "_at string, block long, w0 long, w1 long, w2 long, w3 long"
VECTOR = "_file string, _part long, bits binary"


def file_place(path: str = "_metadata.file_path") -> Column:
    """The file of a row, from the table's own folder on, as URLs have it. No pattern is
    matched, since this may be asked of every row."""
    return F.concat(F.lit("_write="), F.substring_index(F.col(path), "/data/_write=", -1))


def directory(place: Column, parts: int) -> Column:
    """The directory of a file's place in a table of so many partition columns."""
    return F.substring_index(place, "/", 1 + parts)


def block_and_masks(key: str, blocks: Column) -> list[Column]:
    """The block of a key in a directory's filter, and the eight bits that it sets there, two
    in each of four words."""
    bit = "shiftleft(1L, cast(shiftright(xxhash64({0}, 'bits'), {1}) & 63 as int))"
    masks = [F.expr(f"{bit.format(key, 12 * i)} | {bit.format(key, 12 * i + 6)}").alias(f"m{i}") for i in range(4)]
    return [F.pmod(F.xxhash64(key), blocks).alias("block"), *masks]


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, as wide as either schema has them, and those that only the new one has."""
    known, fresh = {f.name: f.dataType for f in old.fields}, {f.name: f.dataType for f in new.fields}
    out = {}
    for name, kind in {**known, **{n: k for n, k in fresh.items() if n not in known}}.items():
        out[name] = wider(kind, fresh.get(name, kind))
        if out[name] is None:
            raise ValueError(f"{name} is {kind.simpleString()} in the table, {fresh[name].simpleString()} in the rows")
    return T.StructType([T.StructField(n, k) for n, k in out.items()])
