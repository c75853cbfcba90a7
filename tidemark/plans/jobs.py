"""The four sync modes as set-based plans over versioned tables.

dump: a stamped copy of the source a run; log: new keys only; sync: new keys and
changed rows, by a bookmark or else by row hashes; mirror: sync, and deletes.

What a run moves is one scan of the source with one predicate, staged with its counts;
all later steps read the staged rows. A table with partitions gets new files for the
partitions that change, and for no others.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.objectid import before
from tidemark.functions.project import RECORD_KEY, SNAPSHOT, masked, partition_columns, veil, with_snapshot
from tidemark.functions.types import cleaned as cleaned_key
from tidemark.functions.types import to_utc, typed
from tidemark.operators import change, metrics, select
from tidemark.sources.scratch import megabytes, remove, scratch_path
from tidemark.sources.state import HashState, JobLog, StateLog
from tidemark.sources.store import Conflict, Table

#: How often a run that met another writer's work is merged again.
TRIES = 5


@dataclass(frozen=True)
class SyncSpec:
    """What a job needs to know of a table. moves: whether a row's partition can change, so
    that its old copy has to be looked for; drift: what a changed schema does ('apply': add or
    widen columns or load anew, as change.drift() says, or 'ignore'); write: whether a sync writes
    touched partitions again ('rewrite') or marks old copies as deleted and writes what it
    moves alone ('delta', which Table.compact() tidies up)."""

    name: str
    key: str
    fields: Mapping[str, str] = field(default_factory=dict)
    bookmark: str | None = None
    improper_bookmark: bool = False
    null_bookmark: str = "drop"
    masks: Sequence[tuple[str, int]] = ()
    names: Mapping[str, str] = field(default_factory=dict)
    parts: Mapping[str, str] = field(default_factory=dict)
    strict: bool = False
    zone: str = "UTC"
    grace: int = 0
    lag: int = 0
    moves: bool = True
    drift: str = "apply"
    write: str = "rewrite"


@dataclass(frozen=True)
class Moved:
    """Rows to move, one a key, staged at a path, with a struct column `found` of their kind and hash;
    their counts, the largest key moved so far, and the smallest and largest key among them as
    the destination holds it, as texts."""

    rows: DataFrame
    found: str
    path: str
    insertions: int
    updations: int
    high: Any
    bounds: tuple[str | None, str | None]

    def plain(self) -> DataFrame:
        return self.rows.drop(self.found)


def record_key(df: DataFrame, spec: SyncSpec) -> Column:
    """The key of the rows as text, masked, but as it is before typing: a null one stays null."""
    col, kind = F.col(f"`{spec.key}`"), df.schema[spec.key].dataType
    shown = reduce(lambda c, m: veil(c, kind, m[1]), [m for m in spec.masks if m[0] == spec.key], col)
    shown = to_utc(shown, kind, spec.zone) if isinstance(kind, T.TimestampType) else shown
    return F.when(col.isNotNull(), shown.cast("string"))


def typed_key(df: DataFrame, spec: SyncSpec) -> Column:
    """The key of the rows as the destination holds it, masked and typed."""
    kind = df.schema[spec.key].dataType
    col = reduce(lambda c, m: veil(c, kind, m[1]), [m for m in spec.masks if m[0] == spec.key], F.col(f"`{spec.key}`"))
    return cleaned_key(col, kind, spec.fields.get(spec.key, kind.simpleString()), spec.strict, spec.zone)


def cleaned(df: DataFrame, spec: SyncSpec) -> tuple[DataFrame, list[str]]:
    """Source rows as the destination holds them: masked, with partition columns and a
    record key, typed, columns sorted, renamed."""
    fields = dict(spec.fields) or {f.name: f.dataType.simpleString() for f in df.schema.fields}
    own = change.free_name(df.columns, "record_key")
    veiled = masked(df.withColumn(own, record_key(df, spec)), spec.masks)
    out = typed(veiled, fields, spec.strict, spec.zone, keep=[own])
    out, made = partition_columns(out, spec.parts)
    out = out.withColumn(RECORD_KEY, F.col(own)).drop(own)
    return out.select(*sorted(out.columns)).withColumnsRenamed(dict(spec.names)), made


def bookmark_of(df: DataFrame, spec: SyncSpec) -> Column:
    col = F.col(f"`{spec.bookmark}`")
    return to_utc(col, df.schema[spec.bookmark].dataType, spec.zone)


def select_changes(source: DataFrame, spec: SyncSpec, mark: select.Watermark, run_at: Any, found: str = "found") -> DataFrame:
    """New keys and changed rows by bookmark, with their kind: one predicate for one scan.
    What is read is what there is, so that no upper bound is needed."""
    key = F.col(f"`{spec.key}`")
    fresh = select.new_rows(key, mark.last_key)
    told = lambda kind: F.struct(kind.alias("kind"), F.lit(None).cast("string").alias("sha")).alias(found)
    if spec.bookmark is None:
        return source.where(fresh).select("*", told(F.lit("I")))
    stale = select.update_set(key, bookmark_of(source, spec), mark, run_at, spec.grace, spec.lag, key, spec.null_bookmark)
    return source.where(fresh | stale).select("*", told(F.when(fresh, "I").otherwise("U")))


def hash_changes(source: DataFrame, spec: SyncSpec, known: DataFrame | None, found: str = "found") -> DataFrame:
    """New and changed rows by their hashes, with their kind and hash."""
    whole = source.where(F.col(f"`{spec.key}`").isNotNull())
    if known is None:
        return whole.select("*", F.struct(F.lit("I").alias("kind"), change.row_hash(source.columns).alias("sha")).alias(found))
    return change.changed(whole, known, spec.key, "both", found=found)


def staged(changes: DataFrame, spec: SyncSpec, mark: select.Watermark, found: str) -> Moved:
    """The changes written down, one row of each key, counted as they are written."""
    path = scratch_path(changes.sparkSession, spec.name)
    kinds = [F.count_if(F.col(f"`{found}`.kind") == k).alias(k) for k in ("I", "U")]
    own = typed_key(changes, spec)
    most = [F.max(f"`{spec.key}`").alias("high"), F.min(own).cast("string").alias("low_own"), F.max(own).cast("string").alias("high_own")]
    seen, counts = metrics.observed(last_copies(changes, spec, found), f"moved-{path.rsplit('-', 1)[-1]}", *kinds, *most)
    seen.write.parquet(path)
    got = counts.get
    marks = [x for x in (mark.last_key, got["high"]) if x is not None]
    bounds = (got["low_own"], got["high_own"])
    return Moved(changes.sparkSession.read.schema(changes.schema).parquet(path), found, path, got["I"], got["U"], max(marks, default=None), bounds)


def last_copies(changes: DataFrame, spec: SyncSpec, found: str) -> DataFrame:
    """One row of each key that moves: the one of the latest bookmark; ties go by the
    columns' hash, so that a rerun gives the same."""
    order = [bookmark_of(changes, spec)] if spec.bookmark else []
    return change.latest(changes, [spec.key], [*order, F.xxhash64(*[F.col(f"`{c}`") for c in changes.columns if c != found])])


def dump(source: DataFrame, spec: SyncSpec, table: Table, run_at: Any, expiry: Mapping[str, int] | None = None, log: JobLog | None = None, made_by: str | None = None) -> None:
    """One more stamped snapshot, a partition of its own, with all rows, those of a null key
    among them; a run that is done again replaces it. With an expiry (days, hours), partitions
    of old ones go, without reading any. made_by: a column of object ids; documents made
    while the run goes on are left to the next one."""
    began, spark = time.time(), source.sparkSession
    rows, made = cleaned(source if made_by is None else source.where(before(F.col(f"`{made_by}`"), select.moment(run_at))), spec)
    stamped = with_snapshot(rows, select.moment(run_at))
    if table.exists():
        stamp = spark.range(1).select(select.moment(run_at).cast("string").alias("s")).first()["s"]
        at = table.parts.index(SNAPSHOT)
        own = {v for v in table.partitions() if v[at] == stamp}
        table.replace_partitions(stamped, own)
        if expiry:
            held = [v for v in table.partitions() if v[at] is not None]
            shown = spark.createDataFrame([(v[at], i) for i, v in enumerate(held)], "s string, i int").withColumn(SNAPSHOT, F.col("s").cast("timestamp_ntz"))
            kept = {r["i"] for r in change.unexpired(shown, select.moment(run_at), **expiry).collect()}  # one row a snapshot
            table.drop_partitions(v for i, v in enumerate(held) if i not in kept)
    else:
        stamp, at = None, 0
        table.replace(stamped, [SNAPSHOT, *made])
    if log is not None:
        held = table.state()
        n = sum(x["n"] for d, x in held.dirs.items() if stamp is None or held.values(d)[at] == stamp)
        record(log, spec, n, 0, table, began, run_at, 0.0)


def log(source: DataFrame, spec: SyncSpec, table: Table, state: StateLog, run_at: Any) -> None:
    """Append keys beyond the last one. A rerun after a crash adds nothing twice: rows that
    the table holds by key are left out. Rows with a null key are never moved."""
    mark, plain = state.get(spec.name), replace(spec, bookmark=None)
    found = change.free_name(source.columns, "found")
    moved = staged(select_changes(source, plain, mark, run_at, found), plain, mark, found)
    rows, _ = cleaned(moved.plain(), spec)
    held = table.read()
    if held is not None:
        key = spec.names.get(spec.key, spec.key)
        beyond = held if mark.last_key is None else held.where(F.col(f"`{key}`") > F.lit(mark.last_key))  # what a lost run may have added
        rows = rows.join(beyond.select(RECORD_KEY), RECORD_KEY, "left_anti").select(*rows.columns)
    table.append(rows)
    remove(source.sparkSession, moved.path)
    state.commit(spec.name, run_at, moved.high)


def sync(source: DataFrame, spec: SyncSpec, table: Table, state: StateLog, run_at: Any, hashes: HashState | None = None, delete: bool = False, log: JobLog | None = None) -> None:
    """Upsert what is new or changed; with delete, rows gone from the source go too. Without
    a bookmark, `hashes` holds the row hashes by which changes are found. A source whose
    columns don't fit the table any more is loaded anew, as a new version: a run that fails
    leaves the table and its earlier versions as they were. State is written last: a run that
    dies before is done again with the same result, and so is one whose partitions
    another writer changed meanwhile.

    Rows with a null key are never moved, in no mode but dump: nothing could find them again.
    A null key that lenient typing shows as 0 or '' is no key of that value. Columns of the
    source may have any name but those of the record key and the partition columns."""
    began, spark = time.time(), source.sparkSession
    by_hash = spec.bookmark is None and hashes is not None
    anew = drifted(source, spec, table) == "reload"
    mark = select.Watermark() if anew else state.get(spec.name)
    found = change.free_name(source.columns, "found")
    known = hashes.read() if by_hash and not anew else None
    moved = staged(hash_changes(source, spec, known, found) if by_hash else select_changes(source, spec, mark, run_at, found), spec, mark, found)
    keys = Keys.of(source, spec) if delete else None
    if moved.high is not None:
        state.mark_recovery(spec.name, moved.high, run_at)
    rows, _ = cleaned(moved.plain(), spec)
    for left in reversed(range(TRIES)):
        try:
            gone = merge_into(table, rows, spec, keys, anew, (moved.insertions + moved.updations, *moved.bounds))
            break
        except Conflict:
            if not left:
                raise
    if by_hash:
        prints = moved.rows.select(F.col(f"`{spec.key}`").cast("string").alias("map_id"), F.col(f"`{found}`.sha").alias("sha"))
        if anew or known is None:
            hashes.replace(prints)
        else:
            if delete:
                out = change.keys_gone(known.select("map_id"), keys.rows.select(F.col("raw").alias("map_id")), "map_id", keys.n)
                prints = prints.unionByName(out.select("map_id", F.lit(None).cast("string").alias("sha")))
            hashes.put(prints)
    state.commit(spec.name, run_at, moved.high)
    if log is not None:
        record(log, spec, moved.insertions, moved.updations, table, began, run_at, megabytes(spark, moved.path))
    for path in (moved.path, *([keys.path] if keys else []), *([gone] if gone else [])):
        remove(spark, path)


@dataclass(frozen=True)
class Keys:
    """The source's keys, staged once for all that a mirror asks of them: as the record key
    (key), as they stand (raw) and typed (own); how many, and the largest typed one."""

    rows: DataFrame
    path: str
    n: int
    top: Any

    @classmethod
    def of(cls, source: DataFrame, spec: SyncSpec) -> Keys:
        spark, path = source.sparkSession, scratch_path(source.sparkSession, f"{spec.name}-keys")
        whole = source.where(F.col(f"`{spec.key}`").isNotNull())
        raw = F.col(f"`{spec.key}`").cast("string").alias("raw")
        keys = whole.select(record_key(whole, spec).alias("key"), raw, typed_key(whole, spec).alias("own"))
        seen, counts = metrics.observed(keys, f"keys-{path.rsplit('-', 1)[-1]}", F.max("own").alias("top"))
        seen.write.parquet(path)
        if not counts.get["n"]:
            remove(spark, path)
            raise ValueError("the source has no keys: nothing is deleted")
        return cls(spark.read.schema(keys.schema).parquet(path), path, counts.get["n"], counts.get["top"])


def merge_into(table: Table, rows: DataFrame, spec: SyncSpec, keys: Keys | None, anew: bool = False, known: tuple[int, str | None, str | None] | None = None) -> str | None:
    """Merge rows that hold a key once into the table, and take out what `keys` lacks, up to its
    largest key; the path of what was staged on the way. Only directories that may hold
    one of the keys are looked through for old copies. known: as Table.may_hold() takes it."""
    held, key, spark = table.state(), spec.names.get(spec.key, spec.key), rows.sparkSession
    if held is None or anew:
        table.replace(rows, table.wanted, held)
        return None
    gone, path = None, None
    if keys is not None:
        top = select.moment(keys.top) if isinstance(keys.top, dt.datetime) else F.lit(keys.top)
        bound = table.read(version=held.number).where(F.col(f"`{key}`") <= top)
        lost = change.keys_gone(bound.select(RECORD_KEY, f"`{key}`"), keys.rows.select(F.col("key").alias(RECORD_KEY)), RECORD_KEY, keys.n)
        path = scratch_path(spark, f"{spec.name}-gone")
        lost.distinct().write.parquet(path)
        gone = spark.read.schema(lost.schema).parquet(path)
    delta = spec.write == "delta"
    out_of = rows.select(F.col(f"`{key}`"), RECORD_KEY)
    dirs = table.may_hold(out_of.select(f"`{key}`"), known, held) if spec.moves or delta or not held.parts else []
    old = table.read_dirs(dirs, delta, held).join(out_of.select(RECORD_KEY), RECORD_KEY, "left_semi")
    if gone is not None:
        more = table.read_dirs(table.may_hold(gone.select(f"`{key}`"), version=held), delta, held).join(gone, RECORD_KEY, "left_semi")
        old = old.unionByName(more)
    if delta:
        table.delete_and_append(old.select("_file", "_row"), rows, held)
        return path
    now = table.read(version=held.number)
    if not held.parts:
        out = change.merge(now, rows, [RECORD_KEY])
        table.replace(out if gone is None else out.join(gone.select(RECORD_KEY), RECORD_KEY, "left_anti").select(*out.columns), before=held)
        return path
    touched = table.values_of(old.select(*held.parts).unionByName(rows.select(*held.parts)))
    if touched:
        out = change.merge(table.read(touched, held.number), rows, [RECORD_KEY])
        table.replace_partitions(out if gone is None else out.join(gone.select(RECORD_KEY), RECORD_KEY, "left_anti").select(*out.columns), touched, held)
    return path


def drifted(source: DataFrame, spec: SyncSpec, table: Table) -> str:
    """What the source's schema asks for: 'same', 'evolve' or 'reload'."""
    held = table.state()
    if held is None or spec.drift == "ignore":
        return "same"
    rows, _ = cleaned(source.limit(0), spec)
    return change.drift(held.schema, rows.schema, held.parts, table.wanted or held.parts)


def record(log: JobLog, spec: SyncSpec, insertions: int, updations: int, table: Table, began: float, run_at: Any, moved_mb: float) -> None:
    """The run's row in the job log. The whole table's megabytes are estimated from those
    moved; if none were, they are as before. Its rows are counted in its versions."""
    last, total, changed = log.last(spec.name), table.n_rows(), insertions + updations
    log.put({
        "job_id": spec.name, "table_name": spec.name, "insertions": insertions, "updations": updations, "total_records": total, "start_time": str(run_at),
        "total_time": time.time() - began, "curr_megabytes_processed": moved_mb,
        "total_megabytes": moved_mb / changed * total if changed else last["total_megabytes"] if last else 0.0, "status": True,
    })


def mirror(source: DataFrame, spec: SyncSpec, table: Table, state: StateLog, run_at: Any, hashes: HashState | None = None, log: JobLog | None = None) -> None:
    """A sync, and rows whose key left the source go. The source's keys are read once, besides
    what moves; an empty source is refused. Keys beyond the source's largest stay."""
    sync(source, spec, table, state, run_at, hashes, delete=True, log=log)


def fan_out(df: DataFrame, writes: Sequence[Callable[[DataFrame], None]]) -> None:
    """One source to several destinations, read once: it is staged, so all get the same rows
    whatever is lost or changes meanwhile."""
    path = scratch_path(df.sparkSession, "fan")
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    for write in writes:
        write(back)
    remove(df.sparkSession, path)


__all__ = ["SNAPSHOT", "Keys", "Moved", "SyncSpec", "cleaned", "drifted", "dump", "fan_out", "log", "merge_into", "mirror", "select_changes", "sync"]
