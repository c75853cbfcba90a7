"""Change detection, merges and deletes: frames in, frames out."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import wider
from tidemark.sources.scratch import local_rows


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 of a row's columns, sorted by name, as canonical JSON with nulls."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def fingerprints(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(map_id, sha): what the hash state keeps of a row."""
    return df.select(F.col(key).cast("string").alias("map_id"), row_hash(columns or df.columns).alias("sha"))


def free_name(columns: Iterable[str], base: str) -> str:
    """A column name that is none of the given ones, whatever their case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def classify(df: DataFrame, state: DataFrame, key: str, columns: Sequence[str] | None = None, found: str = "found") -> DataFrame:
    """Rows with one more column, a struct of their kind, I (new), U (changed) or S (same), and
    their hash (sha). Its name must be none of theirs: free_name() makes one. Only keys and
    hashes of the state are joined. Rows with a null key are new: the state never holds them."""
    if found != free_name(df.columns, found):
        raise ValueError(f"the rows have a column {found}")
    own = free_name([*df.columns, found], "map_id")
    known = state.select(F.col("map_id").alias(own), F.struct(F.col("sha")).alias(found))
    hashed = df.select("*", F.col(f"`{key}`").cast("string").alias(own))
    before, now = F.col(f"`{found}`.sha"), row_hash(columns or df.columns)
    kind = F.when(before.isNull(), "I").when(before != now, "U").otherwise("S")
    return hashed.join(known, own, "left").select(*[F.col(f"`{c}`") for c in df.columns], F.struct(kind.alias("kind"), now.alias("sha")).alias(found))


def changed(df: DataFrame, state: DataFrame, key: str, mode: str = "both", unknown: str = "skip", found: str = "found") -> DataFrame:
    """Rows to move, as classify() gives them. mode: 'insert', 'update' or 'both'; unknown: whether an
    update pass leaves keys that the state doesn't hold ('skip') or takes them ('update')."""
    takes = {"insert": ["I"], "update": ["U"] if unknown == "skip" else ["U", "I"], "both": ["I", "U"]}[mode]
    return classify(df, state, key, found=found).where(F.col(f"`{found}`.kind").isin(*takes))


def next_state(state: DataFrame, moved: DataFrame) -> DataFrame:
    """The hash state after rows (map_id, sha) were moved: changed ones replaced, new ones
    added. Null keys leave no trace in it."""
    return upsert(state, moved.where("map_id is not null"), ["map_id"], [F.col("sha")])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key by the order given; arrival has none in Spark. Rows with a
    null in their key match no other, so each of them stays."""
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    own = free_name(df.columns, "alone")
    rank = free_name([*df.columns, own], "rank")
    alone = df.withColumn(own, F.when(~whole, F.monotonically_increasing_id()))  # no two rows with nulls meet
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], F.col(own)).orderBy(*[o.desc() for o in order])
    return alone.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank, own)


def merge(dest: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The destination with whole rows replaced by key, and rows without a match added.
    fresh holds a key once; rows with a null in their key are added as they are."""
    return dest.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)


def upsert(dest: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """merge() of the last row of each key. Updates with null keys are added as they are."""
    return merge(dest, latest(updates, keys, order), keys)


def touched_rows(dest: DataFrame, fresh: DataFrame, keys: Sequence[str], parts: Sequence[str], moved: bool = True) -> DataFrame:
    """Partition values that an upsert changes. With moved, those that hold an old copy of an
    updated key are among them, so that a row that changes its partition leaves the old one."""
    own = fresh.select(*parts)
    return own.unionByName(dest.select(*dict.fromkeys([*keys, *parts])).join(fresh.select(*keys), list(keys), "left_semi").select(*parts)) if moved else own


def upsert_touched(dest: DataFrame, updates: DataFrame, keys: Sequence[str], parts: Sequence[str], order: Sequence[Column], moved: bool = True) -> DataFrame:
    """Rows of the partitions that an upsert changes, whole. A partition that loses its last
    row has none here: tell the writer of touched_rows() as well."""
    fresh = latest(updates, keys, order)
    same = reduce(lambda a, b: a & b, [F.col(f"d.{p}").eqNullSafe(F.col(f"t.{p}")) for p in parts])
    read = dest.alias("d").join(touched_rows(dest, fresh, keys, parts, moved).distinct().alias("t"), same, "left_semi")
    return merge(read, fresh, keys)


def insert_ignore(dest: DataFrame, rows: DataFrame, null_safe: bool = False) -> DataFrame:
    """The rows that aren't in the destination as they are, once each. Nulls differ from
    each other unless null_safe."""
    fresh = rows.dropDuplicates() if null_safe else _distinct_known(rows)
    same = [fresh[c].eqNullSafe(dest[c]) if null_safe else fresh[c] == dest[c] for c in rows.columns]
    return fresh.join(dest, reduce(lambda a, b: a & b, same), "left_anti")


def _distinct_known(rows: DataFrame) -> DataFrame:
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rows.columns])
    return rows.where(whole).dropDuplicates().unionByName(rows.where(~whole))


def mirror(dest: DataFrame, source: DataFrame, key: str, full: bool = False, force: bool = False) -> DataFrame:
    """The destination without rows whose key left the source. Keys beyond the source's
    largest, and null ones, stay unless full. An empty source is refused unless forced."""
    top = source.agg(F.max(key)).first()[0]
    if top is None:
        if not force:
            raise ValueError("the source has no keys: nothing is deleted unless forced")
        return dest.limit(0) if full else dest
    kept = dest.join(source.select(key).distinct(), key, "left_semi")
    return kept if full else kept.unionByName(dest.where((F.col(key) > top) | F.col(key).isNull()))


def mirror_deleted(dest: DataFrame, source: DataFrame, key: str, full: bool = False, force: bool = False) -> DataFrame:
    """The destination rows that mirror() takes away, with the same guard."""
    top = source.agg(F.max(key)).first()[0]
    if top is None:
        if not force:
            raise ValueError("the source has no keys: nothing is deleted unless forced")
        return dest if full else dest.limit(0)
    bound = dest if full else dest.where(F.col(key) <= F.lit(top))
    return bound.join(source.select(key).distinct(), key, "left_anti")


def key_range(key: str, ranges: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string"), F.lit("range")), F.lit(ranges))


def ranges_apart(a: DataFrame, b: DataFrame) -> list[int]:
    """The ranges in which two sides don't hold the same rows, of (range, h), h a hash of 64 bits:
    their number, the exclusive or and the sum of their hashes differ. One aggregation of
    both sides; a null hash sets its range apart. At most as many as there are ranges."""
    both = a.select("range", "h", F.lit(1).alias("side")).unionByName(b.select("range", "h", F.lit(-1).alias("side")))
    total = F.sum(F.col("h").cast("decimal(38,0)") * F.col("side"))
    summed = both.groupBy("range").agg(F.sum("side").alias("n"), F.bit_xor("h").alias("x"), total.alias("s"), F.count_if(F.col("h").isNull()).alias("alone"))
    return [r["range"] for r in summed.where("n <> 0 or x <> 0 or s <> 0 or alone > 0").select("range").collect()]


#: Ranges that key sets are compared by: as many keys in each as this, in so many ranges at most.
RANGE_KEYS, MOST_RANGES = 2_000, 1 << 18


def keys_gone(dest: DataFrame, source: DataFrame, key: str, n: int) -> DataFrame:
    """The rows of dest whose key is none of the source's. Both key columns are digested by ranges;
    only keys of ranges that differ are joined, so nothing is shuffled where the sides agree. n: about how many keys there are. Null keys stay."""
    ranges = min(MOST_RANGES, max(16, n // RANGE_KEYS))
    dest = dest.where(F.col(f"`{key}`").isNotNull())
    side = lambda df: df.select(key_range(key, ranges).alias("range"), F.xxhash64(f"`{key}`").alias("h"))
    apart = ranges_apart(side(dest), side(source))
    if not apart:
        return dest.limit(0)
    if len(apart) > ranges // 2:
        return dest.join(source.select(key).distinct(), key, "left_anti")
    own = F.broadcast(local_rows(dest.sparkSession, [(r,) for r in apart], "range long"))
    at = free_name(dest.columns, "range")
    near = lambda df: df.withColumn(at, key_range(key, ranges)).join(own.withColumnRenamed("range", at), at, "left_semi").drop(at)
    return near(dest).join(near(source.select(key)), key, "left_anti")


def unexpired(df: DataFrame, now: Column, days: int = 0, hours: int = 0, stamp: str = "migration_snapshot_date") -> DataFrame:
    """Snapshots younger than the expiry; at the very moment they go. Rows without a stamp stay."""
    cutoff = F.timestamp_add("HOUR", F.lit(-(24 * days + hours)), now.cast("timestamp_ntz"))
    return df.where(F.coalesce(F.col(stamp) > cutoff, F.lit(True)))


def reload_slices(dest: DataFrame, rows: DataFrame, slices: Sequence[str], cleared: DataFrame | None = None) -> DataFrame:
    """The destination with slices replaced by the given rows: their own ones, and those of
    `cleared`, which go whether or not rows come back for them."""
    touched = rows.select(*slices)
    if cleared is not None:
        touched = touched.unionByName(cleared.select(*slices))
    touched = touched.distinct()
    same = reduce(lambda a, b: a & b, [dest[c].eqNullSafe(touched[c]) for c in slices])
    return dest.join(touched, same, "left_anti").unionByName(rows, allowMissingColumns=True)


def drift(dest: T.StructType, source: T.StructType, dest_parts: Sequence[str] = (), source_parts: Sequence[str] = ()) -> str:
    """'same', 'evolve' (columns were added, or hold more than before) or 'reload' (a column
    went, or changed to a type that doesn't hold the old one's values, or the partitions did)."""
    old, new = ({f.name: f.dataType for f in s.fields} for s in (dest, source))
    if list(dest_parts) != list(source_parts) or any(k not in new or wider(v, new[k]) is None for k, v in old.items()):
        return "reload"
    return "same" if len(old) == len(new) and all(wider(v, new[k]) == v for k, v in old.items()) else "evolve"
