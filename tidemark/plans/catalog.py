"""Registered queries and their SQL oracles.

The history is simulated from the given tables: the source is orders without the keys
that 17 divides, the destination holds the keys up to half the largest, at nine tenths
of the price where 5 divides the key. Run times are fixed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import objectid, project
from tidemark.functions import types as typing
from tidemark.operators import change, flatten, metrics, reconcile, select
from tidemark.plans import jobs
from tidemark.sources import jdbc, readers
from tidemark.sources.scratch import scratch_path
from tidemark.sources.state import HashState, JobLog, StateLog
from tidemark.sources.store import Table
from tidemark.streaming import router

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LAST_RUN, RUN_AT, DAY = "1998-06-01 00:00:00", "2001-01-01 00:00:00", 86_400


def query(sql: str | None):
    """Register a query under its function's name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 17 <> 0")


def half(spark: SparkSession, sf_dir: str) -> int:
    return select.high_water(table(spark, sf_dir, "orders"), "o_orderkey") // 2


def dest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") * 0.9).otherwise(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").where(F.col("o_orderkey") <= half(spark, sf_dir)).withColumn("o_totalprice", price)


SRC = "src as (select * from orders where o_orderkey % 17 <> 0), h as (select max(o_orderkey) // 2 as half from orders)"
DST = "dst as (select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 5 = 0 then o_totalprice * 0.9 else o_totalprice end as o_totalprice, o_orderdate, o_orderpriority from orders, h where o_orderkey <= half)"


def okey() -> Column:
    return F.col("o_orderkey")


def odate() -> Column:
    return F.col("o_orderdate")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


# --- sources, snapshots ----------------------------------------------------------


@query("select o_orderkey, o_totalprice, s as migration_snapshot_date from orders, (select unnest([timestamp '2001-01-01', timestamp '2001-01-02', timestamp '2001-01-03']) as s)")
def snapshot_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three full snapshots in one table; a run that is done again replaces its own."""
    held = Table(spark, scratch_path(spark, "dump"))
    for day in ("2001-01-01", "2001-01-02", "2001-01-02", "2001-01-03"):
        jobs.dump(readers.read_snapshot(spark, f"{sf_dir}/orders.parquet"), jobs.SyncSpec("orders", "o_orderkey"), held, day)
    return held.read().select("o_orderkey", "o_totalprice", "migration_snapshot_date")


@query("select o_orderkey, s as migration_snapshot_date from orders, (select unnest([timestamp '2001-01-02 12:00:00', timestamp '2001-01-03 00:00:00']) as s)")
def dump_with_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dump job keeps snapshots younger than a day; partitions of the others leave the table unread."""
    held, spec = Table(spark, scratch_path(spark, "expiring")), jobs.SyncSpec("orders", "o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    for at in ("2001-01-01 00:00:00", "2001-01-02 00:00:00", "2001-01-02 12:00:00", "2001-01-03 00:00:00"):
        jobs.dump(orders, spec, held, at, {"days": 1})
    return held.read().select("o_orderkey", "migration_snapshot_date")


@query("select o_orderkey, s as migration_snapshot_date from orders, (select unnest([timestamp '2001-01-01 00:00:00', timestamp '2001-01-02 00:00:00', timestamp '2001-01-02 12:00:00', timestamp '2001-01-03 00:00:00', null]) as s) where s is null or s > timestamp '2001-01-02 00:00:00'")
def expire_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of a day or younger; the one at the cut-off goes, rows without a stamp stay."""
    stamps = F.explode(F.array(*[select.moment(x) for x in ("2001-01-01 00:00:00", "2001-01-02 00:00:00", "2001-01-02 12:00:00", "2001-01-03 00:00:00")], F.lit(None).cast("timestamp_ntz")))
    copies = table(spark, sf_dir, "orders").select("o_orderkey", stamps.alias(project.SNAPSHOT))
    return change.unexpired(copies, select.moment("2001-01-03 00:00:00"), days=1)


@query(
    "select c_custkey, c_name, n_name as nation, c_acctbal as balance, c_acctbal > 0 as in_credit, left(c_name, length(c_name) - 4) || 'XXXX' as veiled, c_custkey // 100 * 100 as century, "
    "coalesce(cast(trunc(try_cast(case when c_custkey % 3 = 0 then 'none' else cast(c_acctbal as varchar) end as double)) as bigint), 0) as whole "
    "from customer join nation on c_nationkey = n_nationkey where c_mktsegment <> 'BUILDING'"
)
def custom_query_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's join as the source of a snapshot, with masks and a lenient cast called by name."""
    sql = (
        "SELECT c_custkey, c_name, n_name AS nation, c_acctbal AS balance, c_acctbal > 0 AS in_credit, mask_text(c_name, 4) AS veiled, mask_digits(c_custkey, 2) AS century, "
        "lenient_int(CASE WHEN c_custkey % 3 = 0 THEN 'none' ELSE CAST(c_acctbal AS STRING) END) AS whole "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING'"
    )
    fields = {"c_custkey": "bigint", "c_name": "str", "nation": "str", "balance": "float", "in_credit": "bool", "veiled": "str", "century": "bigint", "whole": "bigint"}
    return readers.read_query(spark, sql, {n: table(spark, sf_dir, n) for n in ("customer", "nation")}, fields)


# --- incremental selection ---------------------------------------------------------


@query("select max(o_orderkey) as high_int, max(md5(cast(o_orderkey as varchar))) as high_text, max(o_orderdate) as high_time from orders")
def high_water_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest key, whole number, text or time."""
    orders = table(spark, sf_dir, "orders").withColumn("uuid", F.md5(okey().cast("string").cast("binary")))
    return orders.agg(F.max("o_orderkey").alias("high_int"), F.max("uuid").alias("high_text"), F.max("o_orderdate").alias("high_time"))


@query(f"with {SRC} select o_orderkey, o_totalprice from src, h where o_orderkey > half")
def log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys, appended by the log job to a table that held the others."""
    held, state = Table(spark, scratch_path(spark, "log")), StateLog(spark, scratch_path(spark, "state"))
    spec, last = jobs.SyncSpec("orders", "o_orderkey"), half(spark, sf_dir)
    state.commit("orders", LAST_RUN, last)
    jobs.log(source_orders(spark, sf_dir), spec, held, state, RUN_AT)
    return held.read().select("o_orderkey", "o_totalprice")


@query(f"with {SRC} select o_orderkey, o_orderdate from src, h where o_orderkey > half and o_orderkey <= (select max(o_orderkey) from src)")
def sync_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New whole-number keys."""
    source = source_orders(spark, sf_dir)
    return source.where(select.new_rows(okey(), half(spark, sf_dir), select.high_water(source, "o_orderkey"))).select("o_orderkey", "o_orderdate")


@query("select o_orderkey, md5(cast(o_orderkey as varchar)) as uuid from orders where md5(cast(o_orderkey as varchar)) > '8' union all select o_orderkey, null from orders where o_orderdate > timestamp '2000-01-01'")
def sync_inserts_other_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New text keys, and new time keys."""
    orders = table(spark, sf_dir, "orders").withColumn("uuid", F.md5(okey().cast("string").cast("binary")))
    by_text = orders.where(select.new_rows(F.col("uuid"), "8", select.high_water(orders, "uuid"))).select("o_orderkey", "uuid")
    by_time = orders.where(select.new_rows(odate(), select.moment("2000-01-01"), F.lit(select.high_water(orders, "o_orderdate")).cast("timestamp_ntz")))
    return by_text.unionByName(by_time.select("o_orderkey", F.lit(None).cast("string").alias("uuid")))


@query(f"with {SRC} select o_orderkey, o_orderdate from src, h where o_orderkey <= half and o_orderdate > timestamp '1998-05-31 00:00:00'")
def sync_updates_grace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moved rows changed since the last run, a day of grace."""
    mark = select.Watermark(LAST_RUN, half(spark, sf_dir))
    return source_orders(spark, sf_dir).where(select.updated_rows(okey(), odate(), mark, DAY)).select("o_orderkey", "o_orderdate")


@query("select o_orderkey, o_orderdate from orders where o_orderdate > timestamp '2000-12-02' and o_orderdate <= timestamp '2001-01-01'")
def sync_updates_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose bookmark lies in the month before the run."""
    orders = table(spark, sf_dir, "orders")
    return orders.where(select.buffered_rows(okey(), odate(), RUN_AT, 30 * DAY, select.high_water(orders, "o_orderkey"))).select("o_orderkey", "o_orderdate")


@query(f"with {SRC} select o_orderkey, o_orderdate from src, h where o_orderkey > half and o_orderkey <= half + half // 4 and o_orderdate > timestamp '1999-01-01'")
def sync_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a failed run had inserted and that changed since."""
    last = half(spark, sf_dir)
    mark = select.Watermark(LAST_RUN, last, last + last // 4, "1999-01-01")
    return source_orders(spark, sf_dir).where(select.recovered_rows(okey(), odate(), mark)).select("o_orderkey", "o_orderdate")


@query(
    f"with {SRC} select o_orderkey, o_orderdate from src, h where o_orderkey <= half and o_orderdate > timestamp '1998-05-31' "
    "or o_orderkey > half and o_orderkey <= half + half // 4 and o_orderdate > timestamp '1999-01-01' "
    "or o_orderkey <= half + half // 2 and o_orderdate > timestamp '2000-12-02' and o_orderdate <= timestamp '2001-01-01'"
)
def sync_update_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three kinds of updates in one scan."""
    last = half(spark, sf_dir)
    mark = select.Watermark(LAST_RUN, last, last + last // 4, "1999-01-01")
    return source_orders(spark, sf_dir).where(select.update_set(okey(), odate(), mark, RUN_AT, DAY, 30 * DAY, last + last // 2)).select("o_orderkey", "o_orderdate")


@query(
    "with b as (select o_orderkey, o_orderdate as d from orders) select o_orderkey, 'text' as kind from b where o_orderkey % 11 = 0 or d > timestamp '1998-06-01' "
    "union all select o_orderkey, 'epoch' from b where d > timestamp '1998-06-01' and o_orderkey % 11 <> 0"
)
def improper_bookmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookmarks as text (nulls kept) and as epoch seconds (nulls dropped)."""
    orders, mark = table(spark, sf_dir, "orders"), select.Watermark(LAST_RUN, 1 << 60)
    known = F.col("o_orderkey") % 11 != 0
    text = orders.withColumn("b", F.when(known, F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss")))
    epoch = orders.withColumn("b", F.when(known, objectid.epoch_seconds(odate())))
    a = text.where(select.updated_rows(okey(), typing.to_utc(F.col("b"), T.StringType()), mark, null_bookmark="keep"))
    b = epoch.where(select.updated_rows(okey(), typing.to_utc(F.col("b"), T.LongType()), mark))
    return a.select("o_orderkey", F.lit("text").alias("kind")).unionByName(b.select("o_orderkey", F.lit("epoch").alias("kind")))


@query("select 'first' as step, '1999-01-01 00:00:00' as last_run, null::bigint as last_key, null::varchar as recovery_time union all select 'failed', '1999-01-01 00:00:00', null, '1998-06-01 00:00:00' union all select 'committed', '2001-01-01 00:00:00', (select max(o_orderkey) from orders), null union all select 'reset', '1999-01-01 00:00:00', null, null")
def state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job's watermark over its life: the earliest recovery time stays until a commit."""
    state, high = StateLog(spark, scratch_path(spark, "state")), select.high_water(table(spark, sf_dir, "orders"), "o_orderkey")
    steps = [("first", state.get("orders"))]
    state.mark_recovery("orders", 10, "1998-06-01 00:00:00")
    state.mark_recovery("orders", 20, "1999-06-01 00:00:00")
    steps.append(("failed", state.get("orders")))
    state.commit("orders", RUN_AT, high)
    steps.append(("committed", state.get("orders")))
    state.reset("orders")
    steps.append(("reset", state.get("orders")))
    rows = [(n, str(m.last_run), m.last_key, m.recovery_time) for n, m in steps]
    return spark.createDataFrame(rows, "step string, last_run string, last_key long, recovery_time string")


# --- change detection by hash ---------------------------------------------------------


CUSTOMER_STATE = "case when c_custkey % 10 = 1 then 'I' when c_custkey % 10 in (2, 3) then 'U' else 'S' end"


def customer_hashes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    old = customer.where("c_custkey % 10 <> 1").withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 2, F.col("c_acctbal") - 1).otherwise(F.col("c_acctbal")))
    old = old.withColumn("c_name", F.when(F.col("c_custkey") % 10 == 3, F.lit(None)).otherwise(F.col("c_name")))
    return customer, change.fingerprints(old, "c_custkey", customer.columns)


@query(f"select c_custkey, {CUSTOMER_STATE} as change from customer")
def hash_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, changed and unchanged customers by row hash; a null differs from a value."""
    customer, state = customer_hashes(spark, sf_dir)
    return change.classify(customer, state, "c_custkey").select("c_custkey", F.col("found.kind").alias("change"))


@query(f"with c as (select c_custkey, {CUSTOMER_STATE} as s from customer) select c_custkey, 'insert' as mode from c where s = 'I' union all select c_custkey, 'skip' from c where s = 'U' union all select c_custkey, 'update' from c where s <> 'S'")
def hash_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the passes move: inserts; updates without and with unknown keys."""
    customer, state = customer_hashes(spark, sf_dir)
    passes = [("insert", "insert", "skip"), ("skip", "update", "skip"), ("update", "update", "update")]
    out = [change.changed(customer, state, "c_custkey", mode, unknown).select("c_custkey", F.lit(name).alias("mode")) for name, mode, unknown in passes]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("select cast(c_custkey as varchar) as map_id, 'S' as change from customer")
def hash_state_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After its changes are taken over, the state holds every customer as it is."""
    customer, state = customer_hashes(spark, sf_dir)
    moved = change.fingerprints(change.changed(customer, state, "c_custkey").drop("found"), "c_custkey", customer.columns)
    after = change.next_state(state, moved)
    found = change.classify(customer, after, "c_custkey")
    return found.select(F.col("c_custkey").cast("string").alias("map_id"), F.col("found.kind").alias("change"))


# --- typing ---------------------------------------------------------------------------


DIRTY = """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case l_partkey % 6 when 0 then null when 1 then 'junk' when 2 then cast(l_quantity as varchar) else cast(l_partkey as varchar) end as whole,
  case l_suppkey % 5 when 0 then null when 1 then 'n/a' else cast(l_suppkey as varchar) || '.5' end as part,
  case l_linenumber % 4 when 0 then 'Yes' when 1 then 'no' when 2 then null else 'T' end as flag,
  case when l_partkey % 3 = 0 then null else l_returnflag end as note from lineitem"""


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s, n = F.col("l_partkey") % 6, F.col("l_suppkey") % 5, F.col("l_linenumber") % 4
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(p == 0, None).when(p == 1, "junk").when(p == 2, F.col("l_quantity").cast("string")).otherwise(F.col("l_partkey").cast("string")).alias("whole"),
        F.when(s == 0, None).when(s == 1, "n/a").otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(".5"))).alias("part"),
        F.when(n == 0, "Yes").when(n == 1, "no").when(n == 2, None).otherwise("T").alias("flag"),
        F.when(F.col("l_partkey") % 3 == 0, None).otherwise(F.col("l_returnflag")).alias("note"),
    )


LINE_FIELDS = {"l_orderkey": "bigint", "l_linenumber": "integer", "l_partkey": "bigint", "l_suppkey": "int8", "whole": "integer", "part": "numeric(10,2)", "flag": "boolean", "note": "varchar"}


@query(f"with d as ({DIRTY}) select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, coalesce(cast(trunc(try_cast(whole as double)) as bigint), 0) as whole, try_cast(part as double) as part, coalesce(lower(flag) in ('true','1','t','y','yes'), false) as flag, coalesce(note, '') as note from d")
def cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typing.typed(dirty_lines(spark, sf_dir), LINE_FIELDS)


@query(f"with d as ({DIRTY}) select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, cast(trunc(try_cast(whole as double)) as bigint) as whole, try_cast(part as double) as part, lower(flag) in ('true','1','t','y','yes') as flag, note from d")
def cast_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typing.typed(dirty_lines(spark, sf_dir), LINE_FIELDS, strict=True)


@query("select event_id, lower(w) in ('true','1','t','y','yes') as truth from (select event_id, case event_id % 8 when 0 then 'TRUE' when 1 then '1' when 2 then 'y' when 3 then 'off' when 4 then '' when 5 then '2' when 6 then 'Yes' else null end as w from events)")
def bool_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 8
    word = F.when(e == 0, "TRUE").when(e == 1, "1").when(e == 2, "y").when(e == 3, "off").when(e == 4, "").when(e == 5, "2").when(e == 6, "Yes")
    return table(spark, sf_dir, "events").select("event_id", typing.to_bool(word).alias("truth"))


@query("select cast(event_id as varchar) as event_id, strftime(ts, '%Y/%m/%dT%H:%M:%S') as ts, cast(props as varchar) as props, 0::bigint as priority, false as spam, null::double as score, null::timestamp as closed_at, null::varchar as subject from events")
def missing_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared fields that documents lack; undeclared times as text."""
    docs = table(spark, sf_dir, "events").select("event_id", "ts", "props")
    return typing.conform_documents(docs, {"priority": "int", "spam": "bool", "score": "float", "closed_at": "datetime", "subject": "str"})


@query("select cast(event_id as varchar) as _id, case when event_id % 5 = 0 then 0 else user_id end as user_id, value, ts as created_at, (event_id % 2 = 0) as private, event_type, '{\"k\":' || json_extract_string(props, '$.k') || '}' as payload, 0::bigint as __v from events")
def documents_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON documents, written, read back and typed by declared fields."""
    path = scratch_path(spark, "documents")
    user = F.when(F.col("event_id") % 5 == 0, "none").otherwise(F.col("user_id").cast("string"))
    private = F.when(F.col("event_id") % 2 == 0, "yes").otherwise("no")
    table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"), user.alias("user_id"), "value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        private.alias("private"), "event_type", F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k")).alias("payload"),
    ).write.json(path)
    docs = readers.read_documents(spark, path, "_id string, user_id string, value double, created_at string, private string, event_type string, payload struct<k: long>")
    return typing.conform_documents(docs, {"user_id": "int", "value": "float", "created_at": "datetime", "private": "bool", "__v": "int"})


@query(
    "select 'event' as kind, event_id as id, event_type as name, cast(json_extract_string(props, '$.k') as bigint) as k, case when event_id % 2 = 0 then value end as score, "
    "case when event_id % 3 = 0 then '[' || user_id || ']' end as members, case when event_id % 4 = 0 then case when event_id % 8 = 0 then cast(user_id as varchar) else event_type end end as mixed from events "
    "union all select 'turn', conv_id, role, turn, null, null, null from conversations"
)
def documents_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of two kinds whose fields nobody declared: found, typed and read as columns."""
    path, e = scratch_path(spark, "loose"), F.col("event_id")
    own = [e.alias("id"), F.col("event_type").alias("name"), F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.when(e % 2 == 0, F.col("value")).alias("score"), F.when(e % 3 == 0, F.array("user_id")).alias("members")]
    events = table(spark, sf_dir, "events").select(
        F.when(e % 8 == 0, F.to_json(F.struct(*own, F.col("user_id").alias("mixed")))).when(e % 4 == 0, F.to_json(F.struct(*own, F.col("event_type").alias("mixed")))).otherwise(F.to_json(F.struct(*own))).alias("value")
    )
    turns = table(spark, sf_dir, "conversations").select(F.to_json(F.struct(F.col("conv_id").alias("id"), F.col("role").alias("name"), F.col("turn").alias("k"))).alias("value"))
    for name, rows in (("event", events), ("turn", turns)):
        rows.write.text(f"{path}/{name}")
    docs = reduce(DataFrame.unionByName, [readers.read_loose_documents(spark, f"{path}/{n}").withColumn("kind", F.lit(n)) for n in ("event", "turn")])
    return readers.typed_documents(docs).withColumn("members", F.to_json("members"))


@query("select event_id, ts - interval 330 minute as local_in, date_trunc('second', ts) as from_epoch, date_trunc('second', ts) as from_short, date_trunc('second', ts) as from_text, date_trunc('second', ts) - interval 2 hour as from_offset, null::timestamp as junk from events")
def datetime_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local times, epoch seconds, texts with and without an offset, junk."""
    ts, text = F.col("ts"), T.StringType()
    second = F.date_trunc("second", ts).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id",
        typing.to_utc(ts, T.TimestampNTZType(), "Asia/Kolkata").alias("local_in"),
        typing.to_utc(objectid.epoch_seconds(ts), T.LongType()).alias("from_epoch"),
        typing.to_utc(objectid.epoch_seconds(ts).cast("int"), T.IntegerType()).alias("from_short"),
        typing.to_utc(F.date_format(second, "yyyy/MM/dd HH:mm:ss"), text).alias("from_text"),
        typing.to_utc(F.concat(F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")), text).alias("from_offset"),
        typing.to_utc(F.concat(F.lit("on "), F.col("event_type")), text).alias("junk"),
    )


@query("select event_id, date_trunc('second', ts) as stamp, cast(strftime(ts, '%Y%m%d') as integer) as day from events")
def compact_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.date_format("ts", "yyyyMMddHHmmss").cast("bigint")
    return table(spark, sf_dir, "events").select("event_id", typing.compact_timestamp(number).alias("stamp"), typing.date_number(F.col("ts")).alias("day"))


@query(
    "select o_orderkey, case when o_orderkey % 7 = 0 then null when o_orderkey % 7 = 1 then '' else "
    "case when o_orderkey % 7 <> 2 and o_orderkey % 2 = 0 then '[' else '(' end || case when o_orderkey % 7 = 2 then 'None' else cast(o_custkey as varchar) end || ', ' || "
    "case when o_orderkey % 7 = 3 then 'None' else cast(o_custkey + 10 as varchar) end || case when o_orderkey % 7 <> 3 and o_orderkey % 3 = 0 then ']' else ')' end end as r from orders"
)
def range_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = okey() % 7
    r = F.struct(
        F.when(m != 2, F.col("o_custkey")).alias("lower"), F.when(m != 3, F.col("o_custkey") + 10).alias("upper"),
        (okey() % 2 == 0).alias("lower_inc"), (okey() % 3 == 0).alias("upper_inc"), (m == 1).alias("is_empty"),
    )
    made = table(spark, sf_dir, "orders").select("o_orderkey", F.when(m != 0, r).alias("r"))
    return made.select("o_orderkey", typing.range_text(F.col("r")).alias("r"))


@query("select event_id, '{\"k\":' || json_extract_string(props, '$.k') || ',\"t\":\"' || event_type || '\"}' as obj, '[' || user_id || ',' || event_id || ']' as arr from events")
def json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("event_type").alias("t")).alias("obj"), F.array("user_id", "event_id").alias("arr")
    )
    return e.select("event_id", *[typing.json_text(F.col(c), e.schema[c].dataType).alias(c) for c in ("obj", "arr")])


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, event_type as spaced, null::varchar as missing from events")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at paths, one with a space in a step, one that isn't there."""
    doc = F.to_json(F.struct(F.struct(F.col("event_type").alias("b c")).alias("a")))
    return table(spark, sf_dir, "events").select("event_id", typing.at_path(F.col("props"), "k").cast("bigint").alias("k"), typing.at_path(doc, "a.b c").alias("spaced"), typing.at_path(doc, "a.x.y").alias("missing"))


HEX_ID = "lower(lpad(to_hex(cast(epoch(date_trunc('second', ts)) as bigint)), 8, '0') || lpad(to_hex(event_id), 16, '0'))"


def with_object_id(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    seconds = F.lpad(F.lower(F.hex(objectid.epoch_seconds(F.col("ts")))), 8, "0")
    return table(spark, sf_dir, "events").select("event_id", F.concat(seconds, F.lpad(F.lower(F.hex("event_id")), 16, "0")).alias("_id"), *more)


@query("select event_id, date_trunc('second', ts) as created, year(ts) as y, month(ts) as m, day(ts) as d from events")
def objectid_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation times out of object ids, and the partition that they give."""
    out, made = project.partition_columns(with_object_id(spark, sf_dir), {"_id": "objectid"})
    return out.select("event_id", objectid.created_at(F.col("_id")).alias("created"), *[F.col(c).alias(n) for c, n in zip(made, "ymd", strict=True)])


@query("select event_id from events where date_trunc('second', ts) < date_trunc('second', (select min(ts) + (max(ts) - min(ts)) / 2 from events))")
def objectid_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents made before half the time had passed."""
    low, high = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    return with_object_id(spark, sf_dir).where(objectid.before(F.col("_id"), select.moment(low + (high - low) / 2))).select("event_id")


@query(f"select {HEX_ID} as _id, event_type, s as migration_snapshot_date from events, (select unnest([(select min(ts) + (max(ts) - min(ts)) / 2 from events), (select max(ts) + interval 1 day from events)]) as s) where date_trunc('second', ts) < date_trunc('second', s)")
def dump_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of documents at two moments: each holds those made before, by their ids."""
    held, docs = Table(spark, scratch_path(spark, "documents")), with_object_id(spark, sf_dir, "event_type").drop("event_id")
    low, high = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    for at in (low + (high - low) / 2, high + dt.timedelta(days=1)):
        jobs.dump(docs, jobs.SyncSpec("events", "_id"), held, at, made_by="_id")
    return held.read().select("_id", "event_type", "migration_snapshot_date")


# --- projections ------------------------------------------------------------------------


@query("select c_custkey, left(c_name, greatest(length(c_name) - 4, 0)) || 'XXXX' as c_name, c_mktsegment, repeat('X', 60) as hidden from customer")
def mask_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_name").alias("hidden"))
    return project.masked(c, [("c_name", 4), ("c_mktsegment", 0), ("hidden", 60)])


@query("select c_custkey, (c_custkey // 100) * 100 as masked_key, b - ((b % 1000) + 1000) % 1000 as balance, 0::bigint as nothing from (select c_custkey, cast(trunc(c_acctbal) as bigint) as b from customer)")
def mask_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("masked_key"), F.col("c_acctbal").cast("bigint").alias("balance"), F.lit(None).cast("bigint").alias("nothing"))
    return project.masked(c, [("masked_key", 2), ("balance", 3), ("nothing", 2)])


@query("select cast(o_orderkey as varchar) as unique_migration_record_id, o_custkey as customer, o_orderstatus as status_ from orders")
def record_key_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = project.with_record_key(table(spark, sf_dir, "orders"), "o_orderkey").select(project.RECORD_KEY, "o_custkey", "o_orderstatus")
    return project.renamed(keyed, {"o_custkey": "customer", "o_orderstatus": "status_"})[0]


#: Source type names and where they go.
TYPE_NAMES = (
    ("text", "string"), ("varchar(10)", "string"), ("uuid", "string"), ("inet", "string"), ("jsonb", "string"), ("ARRAY", "string"), ("int4range", "string"),
    ("daterange", "string"), ("interval", "string"), ("bigint", "bigint"), ("int", "bigint"), ("smallserial", "bigint"), ("numeric(10,2)", "double"), ("money", "double"),
    ("double precision", "double"), ("real", "double"), ("boolean", "boolean"), ("timestamp without time zone", "timestamp_ntz"), ("date", "timestamp_ntz"), ("datetime", "timestamp_ntz"),
)


@query("select c_mktsegment, t as source_type, d as destination, count(*) as n_rows from customer, (values " + ", ".join(f"('{a}', '{b}')" for a, b in TYPE_NAMES) + ") v(t, d) group by all")
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination types of a table of every source type, over the customers."""
    schema = typing.destination_schema({a: a for a, _ in TYPE_NAMES})
    wide = table(spark, sf_dir, "customer").select("c_mktsegment", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    names = F.explode(F.array(*[F.struct(F.lit(f.name).alias("source_type"), F.typeof(F.col(f"`{f.name}`")).alias("destination")) for f in schema]))
    return wide.select("c_mktsegment", names.alias("x")).groupBy("c_mktsegment", "x.source_type", "x.destination").agg(F.count(F.lit(1)).alias("n_rows"))


@query("select o_orderkey, year(o_orderdate) as parquet_format_o_orderdate_year, month(o_orderdate) as parquet_format_o_orderdate_month, day(o_orderdate) as parquet_format_o_orderdate_day, o_orderstatus as parquet_format_o_orderstatus, case when o_custkey % 9 = 0 then 0 else o_custkey end as parquet_format_cust, o_totalprice as parquet_format_o_totalprice from orders")
def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("cust", F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey")))
    out, made = project.partition_columns(orders, {"o_orderdate": "datetime", "o_orderstatus": "str", "cust": "int", "o_totalprice": "float"})
    return out.select("o_orderkey", *made)


@query("select date_trunc('month', o_orderdate)::timestamp as month, count(*) as n from orders group by 1")
def month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table kept by months, with no last month."""
    held = Table(spark, scratch_path(spark, "months"), ["month"])
    held.replace(table(spark, sf_dir, "orders").select("o_orderkey", project.month_of(odate()).alias("month")))
    return held.read().groupBy(F.col("month").cast("timestamp_ntz").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("select 'c_name' as column_name, count(*) filter (where length(c_name) > 17) as n_rows, max(length(c_name)) as longest from customer having count(*) filter (where length(c_name) > 17) > 0 union all select 'c_mktsegment', count(*) filter (where length(c_mktsegment) > 8), max(length(c_mktsegment)) from customer having count(*) filter (where length(c_mktsegment) > 8) > 0")
def length_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns that hold more than their limits."""
    return project.overlong(table(spark, sf_dir, "customer"), {"c_name": 17, "c_mktsegment": 8})


@query("select c_custkey, left(c_name, 5) as c_name from customer")
def length_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.fitted(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), {"c_name": 5})


@query("select p_brand as brand, p_partkey as partkey, p_size as size from part")
def lowercase_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("PartKey"), F.col("p_brand").alias("BRAND"), F.col("p_size").alias("Size"))
    return project.lower_names(part)


@query("select o_orderkey, o_orderstatus || '_' || o_custkey || '_' || strftime(o_orderdate, '%Y-%m-%d') as composite from orders")
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", project.joined_key(F.col("o_orderstatus"), F.col("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("composite"))


# --- merges and deletes --------------------------------------------------------------


LINE_ORDER = "l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc"


LAST_LINES = f"select *, row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER}) as r from lineitem"


@query(
    f"with u as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from ({LAST_LINES}) where r = 1 and l_orderkey % 3 <> 0), "
    "d as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, 0.0 as l_extendedprice from lineitem where l_linenumber <= 3) "
    "select * from u union all select * from d where (l_orderkey, l_linenumber) not in (select (l_orderkey, l_linenumber) from u)"
)
def upsert_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by (order, number), the last of each, over a destination: of its lines those of
    every third order stay, others of the same order but another number come in."""
    lines = table(spark, sf_dir, "lineitem")
    order = [F.col(c.split()[0]) for c in LINE_ORDER.split(", ")]
    old = lines.where("l_linenumber <= 3").withColumn("l_extendedprice", F.lit(0.0))
    return change.upsert(old, lines.where("l_orderkey % 3 <> 0"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(f"with {SRC}, {DST}, u as (select * from src, h where o_orderkey > half - 3000) select o_orderkey, o_totalprice from u union all select o_orderkey, o_totalprice from dst where o_orderkey not in (select o_orderkey from u)")
def upsert_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates given twice, once with an older price: the last one counts; those without a
    match become inserts."""
    new = source_orders(spark, sf_dir).where(okey() > half(spark, sf_dir) - 3000).withColumn("seq", F.lit(2))
    old = new.withColumn("o_totalprice", F.lit(-1.0)).withColumn("seq", F.lit(1))
    updates = new.unionByName(old)
    dest = dest_orders(spark, sf_dir).withColumn("seq", F.lit(0))
    return change.upsert(dest, updates, ["o_orderkey"], [F.col("seq")]).select("o_orderkey", "o_totalprice")


@query("with old as (select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 3 = 0) select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 3 <> 0 or o_custkey % 4 = 0")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that aren't there as they are; a null is no match."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    dest = rows.where("o_orderkey % 3 = 0").withColumn("o_custkey", F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")))
    return change.insert_ignore(dest, rows.unionByName(rows))


def monthly(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))


FIRST_MONTH = "strftime(o_orderdate, '%Y-%m') = (select min(strftime(o_orderdate, '%Y-%m')) from orders)"


@query(
    f"with {SRC}, {DST}, u as (select src.o_orderkey, o_totalprice + 1 as o_totalprice, case when src.o_orderkey % 2 = 0 or {FIRST_MONTH} then o_orderdate + interval 31 day else o_orderdate end as o_orderdate "
    f"from orders src, h where (o_orderkey % 50 = 1 or {FIRST_MONTH}) and o_orderkey <= half) "
    "select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') as month from u union all select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') from dst where o_orderkey not in (select o_orderkey from u)"
)
def upsert_partition_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a table by months: only the months that updates leave or reach are
    written again; rows that moved leave their old month, and the first month gets empty."""
    held = Table(spark, scratch_path(spark, "scoped"), ["month"])
    held.replace(monthly(dest_orders(spark, sf_dir)))
    orders = monthly(table(spark, sf_dir, "orders").where(okey() <= half(spark, sf_dir)))
    first = F.col("month") == table(spark, sf_dir, "orders").agg(F.min(F.date_format("o_orderdate", "yyyy-MM"))).first()[0]
    shifted = F.when((okey() % 2 == 0) | first, odate() + F.expr("interval 31 day")).otherwise(odate())
    updates = monthly(orders.where((okey() % 50 == 1) | first).withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("o_orderdate", shifted))
    touched = held.values_of(change.touched_rows(held.read(), updates, ["o_orderkey"], ["month"]))
    held.replace_partitions(change.upsert(held.read(touched), updates, ["o_orderkey"], [odate()]), touched)
    return held.read().select("o_orderkey", "o_totalprice", "month")


SYNCED = "case when o_orderkey > half or o_orderdate > timestamp '1998-05-31' then o_totalprice when o_orderkey % 5 = 0 then o_totalprice * 0.9 else o_totalprice end"
SYNC_ORDERS = f"with h as (select max(o_orderkey) // 2 as half from orders) select cast(o_orderkey as varchar) as unique_migration_record_id, o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 17 = 0 then case when o_orderkey % 5 = 0 then o_totalprice * 0.9 else o_totalprice end else {SYNCED} end as o_totalprice, o_orderdate, o_orderpriority, year(o_orderdate) as year from orders, h where o_orderkey % 17 <> 0 or o_orderkey <= half"
MIRROR_ORDERS = f"with {SRC} select cast(o_orderkey as varchar) as unique_migration_record_id, o_orderkey, o_custkey, o_orderstatus, {SYNCED} as o_totalprice, o_orderdate, o_orderpriority, year(o_orderdate) as year from src, h"


def synced_table(spark: SparkSession, sf_dir: str, delete: bool, log: JobLog | None = None, write: str = "rewrite") -> Table:
    path = scratch_path(spark, "sync")
    held, state = Table(spark, f"{path}/table", ["parquet_format_o_orderdate_year"]), StateLog(spark, f"{path}/state")
    spec = jobs.SyncSpec("orders", "o_orderkey", bookmark="o_orderdate", grace=DAY, parts={"o_orderdate": "datetime"}, write=write)
    held.replace(jobs.cleaned(dest_orders(spark, sf_dir), spec)[0])
    state.commit("orders", LAST_RUN, half(spark, sf_dir))
    (jobs.mirror if delete else jobs.sync)(source_orders(spark, sf_dir), spec, held, state, RUN_AT, log=log)
    return held


def synced(spark: SparkSession, sf_dir: str, delete: bool, log: JobLog | None = None, write: str = "rewrite") -> DataFrame:
    held = synced_table(spark, sf_dir, delete, log, write)
    return held.read().select(project.RECORD_KEY, *ORDER_COLUMNS, F.col("parquet_format_o_orderdate_year").alias("year"))


@query(SYNC_ORDERS)
def sync_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sync job: new keys and changed rows merged into an older copy."""
    return synced(spark, sf_dir, False)


@query(MIRROR_ORDERS)
def mirror_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror job: a sync, and rows gone from the source go."""
    return synced(spark, sf_dir, True)


@query(SYNC_ORDERS)
def sync_orders_by_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sync job into a table that isn't written again: old copies are marked as deleted."""
    return synced(spark, sf_dir, False, write="delta")


@query(MIRROR_ORDERS)
def mirror_orders_by_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synced(spark, sf_dir, True, write="delta")


@query(f"with {SRC}, {DST} select 'now' as version, count(*) as n, sum(o_orderkey)::bigint as keys from src union all select 'before', count(*), sum(o_orderkey)::bigint from dst union all select 'compacted', count(*), sum(o_orderkey)::bigint from src")
def versions_after_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror by marks, then compaction: the current rows, those of the version before, and
    those of the compacted table, which has a directory a year."""
    held = synced_table(spark, sf_dir, True, write="delta")
    shown = lambda name, df: df.agg(F.lit(name).alias("version"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    now, before = shown("now", held.read()), shown("before", held.read(version=1))
    held.compact(order=["o_orderkey"])
    if len(held.state().dirs) != len(held.partitions()):
        raise AssertionError("a partition lies in several directories after compaction")
    return now.unionByName(before).unionByName(shown("compacted", held.read()))


@query("select o_orderkey, case when o_orderkey % 3 = 0 then o_totalprice + 2 when o_orderkey % 3 = 1 then o_totalprice + 1 else o_totalprice end as o_totalprice from orders where o_orderkey % 2 = 0 or o_orderkey % 3 <> 2")
def key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upserts of few keys into many directories without an order: those that can't hold a
    key, by smallest and largest key and by their filters, aren't opened."""
    held, state = Table(spark, scratch_path(spark, "indexed"), ["parquet_format_o_orderstatus"], index="o_orderkey"), StateLog(spark, scratch_path(spark, "state"))
    spec = jobs.SyncSpec("orders", "o_orderkey", bookmark="o_orderdate", grace=40 * 366 * DAY, parts={"o_orderstatus": "str"})
    orders = table(spark, sf_dir, "orders")
    jobs.sync(orders.where("o_orderkey % 2 = 0"), spec, held, state, LAST_RUN)
    for rest, more in ((1, 1), (0, 2)):
        jobs.sync(orders.where(okey() % 3 == rest).withColumn("o_totalprice", F.col("o_totalprice") + more), spec, held, state, RUN_AT)
    return held.read().select("o_orderkey", "o_totalprice")


@query("select o_orderkey, o_totalprice from orders")
def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs at once on one table, with orders of even and of odd keys, which meet in all
    partitions: each version goes on top of the other one's, and none is lost."""
    path, orders = scratch_path(spark, "shared"), table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    spec = [jobs.SyncSpec(n, "o_orderkey", bookmark="o_orderdate", parts={"o_orderstatus": "str"}) for n in ("even", "odd")]
    made = lambda: Table(spark, f"{path}/table", ["parquet_format_o_orderstatus"])
    made().replace(jobs.cleaned(orders.limit(0), spec[0])[0])
    run = lambda i: jobs.sync(orders.where(okey() % 2 == i), spec[i], made(), StateLog(spark, f"{path}/state"), RUN_AT)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(run, (0, 1)))
    return made().read().select("o_orderkey", "o_totalprice")


RESERVED = "o_orderstatus as sha, o_orderpriority as change, o_custkey as found, o_totalprice as _kind, o_orderkey % 9 as rank, o_orderkey % 5 as _row"


@query(f"select 'hash' as mode, o_orderkey, {RESERVED} from orders union all select 'bookmark', o_orderkey, {RESERVED} from orders")
def sync_reserved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a source may have the names that a job works with: two runs by hashes and
    two by a bookmark keep them as they are."""
    path = scratch_path(spark, "names")
    now = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("sha"), F.col("o_orderpriority").alias("change"), F.col("o_custkey").alias("found"),
        F.col("o_totalprice").alias("_kind"), (okey() % 9).alias("rank"), (okey() % 5).alias("_row"),
    )
    old = now.where("o_orderkey % 4 <> 0").withColumn("change", F.when(okey() % 3 == 0, "old").otherwise(F.col("change")))
    out = []
    for mode, spec in (("hash", jobs.SyncSpec("o", "o_orderkey")), ("bookmark", jobs.SyncSpec("o", "o_orderkey", bookmark="o_orderdate", grace=40 * 366 * DAY))):
        held, state, hashes = Table(spark, f"{path}/{mode}"), StateLog(spark, f"{path}/{mode}-state"), HashState(spark, f"{path}/{mode}-hashes", 8)
        jobs.sync(old, spec, held, state, LAST_RUN, hashes)
        jobs.sync(now, spec, held, state, RUN_AT, hashes)
        out.append(held.read().select(F.lit(mode).alias("mode"), "o_orderkey", "sha", "change", "found", "_kind", "rank", "_row"))
    return out[0].unionByName(out[1])


@query(
    "with k as (select case when o_orderkey % 7 = 0 then null else o_orderkey - (select min(o_orderkey) from orders where o_orderkey % 7 <> 0) end as k, o_totalprice, o_orderkey from orders) "
    "select m as mode, k, o_totalprice, (select count(*) from k where k is not null and m = 'hash') as n_hashes from k, (select unnest(['hash', 'bookmark', 'mirror']) as m) where k is not null"
)
def sync_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over orders of which some have no key and one has the key 0: rows without a key
    are never moved, the key 0 is a key like others, and the hash state holds each key once."""
    path, orders = scratch_path(spark, "nulls"), table(spark, sf_dir, "orders")
    least = orders.where("o_orderkey % 7 <> 0").agg(F.min("o_orderkey")).first()[0]
    now = orders.select(F.when(okey() % 7 != 0, okey() - least).alias("k"), "o_totalprice", "o_orderdate")
    old = now.where("k is null or k % 5 <> 3").withColumn("o_totalprice", F.when(F.col("k") % 2 == 0, 0.0).otherwise(F.col("o_totalprice")))
    out = []
    for mode in ("hash", "bookmark", "mirror"):
        held, state, hashes = Table(spark, f"{path}/{mode}"), StateLog(spark, f"{path}/{mode}-state"), HashState(spark, f"{path}/{mode}-hashes", 8)
        spec = jobs.SyncSpec("o", "k", bookmark=None if mode != "bookmark" else "o_orderdate", grace=40 * 366 * DAY, fields={"k": "bigint", "o_totalprice": "float", "o_orderdate": "datetime"})
        for source, at in ((old, LAST_RUN), (now, "1999-01-01 00:00:00"), (now, RUN_AT)):
            jobs.sync(source, spec, held, state, at, hashes, delete=mode == "mirror")
        n = hashes.read().count() if mode == "hash" else 0
        out.append(held.read().select(F.lit(mode).alias("mode"), "k", "o_totalprice", F.lit(n).cast("long").alias("n_hashes")))
    return reduce(DataFrame.unionByName, out)


@query(
    "select 1 as run, count(*) filter (where c_custkey % 10 <> 1) as n_written, count(*) filter (where c_custkey % 10 <> 1) as n_state from customer union all "
    "select 2, count(*) filter (where c_custkey % 10 in (1, 2)), count(*) from customer union all select 3, count(*) filter (where c_custkey % 10 = 4), count(*) filter (where c_custkey % 10 <> 4) from customer"
)
def hash_state_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs write into a bucketed hash state: all, then what is new or changed, then what
    is gone, and how many keys it holds after each."""
    customer, hashes, out = table(spark, sf_dir, "customer"), HashState(spark, scratch_path(spark, "hashes"), 8), []
    old = customer.where("c_custkey % 10 <> 1").withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 2, F.col("c_acctbal") - 1).otherwise(F.col("c_acctbal")))
    before = {}
    for run in (1, 2, 3):
        if run == 1:
            hashes.put(change.fingerprints(old, "c_custkey", customer.columns))
        elif run == 2:
            moved = change.changed(customer, hashes.read(), "c_custkey")
            hashes.put(moved.select(F.col("c_custkey").cast("string").alias("map_id"), "found.sha"))
        else:
            left = customer.where("c_custkey % 10 <> 4").select(F.col("c_custkey").cast("string").alias("map_id"))
            gone = change.keys_gone(hashes.read().select("map_id"), left, "map_id", customer.count())
            hashes.put(gone.select("map_id", F.lit(None).cast("string").alias("sha")))
        now = {r["seq"]: r["n"] for r in hashes.written().collect()}
        out.append((run, sum(n for s, n in now.items() if s not in before), hashes.read().count()))
        before = now
    return spark.createDataFrame(out, "run int, n_written long, n_state long")


@query(f"with {SRC}, {DST} select o_orderkey from dst where o_orderkey not in (select o_orderkey from src)")
def mirror_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys gone from the source, found by digests of ranges: only ranges that differ are joined."""
    dest, source = dest_orders(spark, sf_dir).select("o_orderkey"), source_orders(spark, sf_dir).select("o_orderkey")
    most = source.union(dest.where(F.col("o_orderkey") % 17 == 0)).distinct()
    same = change.keys_gone(dest, most, "o_orderkey", dest.count())  # nothing is gone yet
    return change.keys_gone(dest, source, "o_orderkey", 40 * dest.count()).unionByName(same)


@query(
    "with l as (select l_orderkey, l_shipdate, l_extendedprice, l_partkey, row_number() over (partition by l_orderkey order by l_shipdate desc) as r, count(*) over (partition by l_orderkey, l_shipdate) as ties from lineitem) "
    "select l_orderkey, l_shipdate from l where r = 1"
)
def sync_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that holds a key many times: the row of the latest bookmark counts, in the
    first run and in one that updates all keys."""
    path = scratch_path(spark, "doubled")
    held, state = Table(spark, f"{path}/table"), StateLog(spark, f"{path}/state")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    spec = jobs.SyncSpec("lines", "l_orderkey", bookmark="l_shipdate", grace=40 * 366 * DAY)
    jobs.sync(lines.where("l_extendedprice < 30000"), spec, held, state, LAST_RUN)
    jobs.sync(lines, spec, held, state, RUN_AT)
    return held.read().select("l_orderkey", "l_shipdate")


@query(
    f"with {SRC} select 'evolve' as run, o_orderkey, case when o_orderkey % 17 <> 0 and (o_orderkey > half or o_orderdate > timestamp '1998-05-31') then o_orderpriority end as o_orderpriority, o_custkey::double as customer from orders, h where o_orderkey % 17 <> 0 or o_orderkey <= half "
    "union all select 'reload', o_orderkey, o_orderpriority, null from src "
    "union all select 'widen', o_orderkey, null, case when o_orderkey > half or o_orderdate > timestamp '1998-05-31' then o_custkey + 0.5 else o_custkey end from src, h"
)
def sync_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column more: rows that don't move hold null in it. A column less: the table is loaded anew,
    as a new version. A column that holds fractions now: rows that don't move stay as they
    were written and are read as fractions."""
    path, status, source = scratch_path(spark, "drift"), ["parquet_format_o_orderstatus"], source_orders(spark, sf_dir)
    spec = jobs.SyncSpec("orders", "o_orderkey", bookmark="o_orderdate", grace=DAY, parts={"o_orderstatus": "str"})
    more, less, wide = (Table(spark, f"{path}/{n}", status) for n in ("more", "less", "wide"))
    state = {t: StateLog(spark, f"{t.path}-state") for t in (more, less, wide)}
    more.replace(jobs.cleaned(dest_orders(spark, sf_dir).drop("o_orderpriority"), spec)[0])
    state[more].commit("orders", LAST_RUN, half(spark, sf_dir))
    jobs.sync(source, spec, more, state[more], RUN_AT)
    jobs.sync(source.where("o_orderkey % 2 = 0"), spec, less, state[less], LAST_RUN)
    jobs.sync(source.drop("o_custkey"), spec, less, state[less], RUN_AT)
    marked = replace(spec, write="delta")
    wide.replace(jobs.cleaned(source.where(okey() <= half(spark, sf_dir)).drop("o_orderpriority"), spec)[0])
    state[wide].commit("orders", LAST_RUN, half(spark, sf_dir))
    jobs.sync(source.drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey") + F.lit(0.5).cast("double")), marked, wide, state[wide], RUN_AT)
    if less.version() != 2 or wide.state(1).dirs.keys() - wide.state().dirs.keys():
        raise AssertionError("a reload is a version more, and rows that don't move aren't written again")
    shown = lambda t, run: t.read().select(F.lit(run).alias("run"), "o_orderkey", *[(F.col(c) if c in t.state().schema.names else F.lit(None)).cast(k).alias(n) for c, k, n in (("o_orderpriority", "string", "o_orderpriority"), ("o_custkey", "double", "customer"))])
    return shown(more, "evolve").unionByName(shown(less, "reload")).unionByName(shown(wide, "widen"))


@query(f"with {SRC}, {DST} select o_orderkey from dst where o_orderkey <= (select max(o_orderkey) from src) and o_orderkey not in (select o_orderkey from src)")
def mirror_deleted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.mirror_deleted(dest_orders(spark, sf_dir), source_orders(spark, sf_dir), "o_orderkey").select("o_orderkey")


@query("select c_custkey, c_name, c_acctbal from customer")
def sync_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a sync without a bookmark: an older copy, then the customers as they are."""
    path = scratch_path(spark, "hashed")
    held, hashes, state = (Table(spark, f"{path}/table"), HashState(spark, f"{path}/hashes", 8), StateLog(spark, f"{path}/state"))
    customer = table(spark, sf_dir, "customer")
    spec = jobs.SyncSpec("customer", "c_custkey")
    old = customer.where("c_custkey % 4 <> 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")))
    jobs.sync(old, spec, held, state, LAST_RUN, hashes)
    jobs.sync(customer, spec, held, state, RUN_AT, hashes)
    return held.read().select("c_custkey", "c_name", "c_acctbal")


@query(
    "select 1 as run, count(*) filter (where c_custkey % 4 <> 0) as insertions, 0::bigint as updations, count(*) filter (where c_custkey % 4 <> 0) as total_records from customer union all "
    "select 2, count(*) filter (where c_custkey % 4 = 0), count(*) filter (where c_custkey % 4 <> 0 and c_custkey % 3 = 0 and c_acctbal <> 0), count(*) from customer"
)
def sync_by_hash_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the runs of a sync by hashes move, from the job log: new and changed rows, no others."""
    path = scratch_path(spark, "moves")
    held, hashes, state, log = (Table(spark, f"{path}/table"), HashState(spark, f"{path}/hashes", 8), StateLog(spark, f"{path}/state"), JobLog(spark, f"{path}/log"))
    customer, spec = table(spark, sf_dir, "customer"), jobs.SyncSpec("customer", "c_custkey")
    old = customer.where("c_custkey % 4 <> 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")))
    jobs.sync(old, spec, held, state, LAST_RUN, hashes, log=log)
    jobs.sync(customer, spec, held, state, RUN_AT, hashes, log=log)
    return log.read().select(F.when(F.col("start_time") == LAST_RUN, 1).otherwise(2).alias("run"), "insertions", "updations", "total_records")


@query("select o_orderkey, o_totalprice, null::varchar as channel from orders where o_orderkey % 2 = 0 union all select o_orderkey, o_totalprice, 'web' from orders where o_orderkey % 2 = 1")
def append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a partitioned table, the second with one more column."""
    orders, _ = project.partition_columns(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), {"o_orderstatus": "str"})
    held = Table(spark, scratch_path(spark, "append"), ["parquet_format_o_orderstatus"])
    held.append(orders.where("o_orderkey % 2 = 0"))
    held.append(orders.where("o_orderkey % 2 = 1").withColumn("channel", F.lit("web")))
    return held.read().select("o_orderkey", "o_totalprice", "channel")


@query("select event_id, event_type, ts::date::timestamp as day, case when day(ts) % 3 = 0 and event_type in ('click', 'view') then value + 1 else value end as value from events where not (day(ts) % 3 = 0 and event_type in ('click', 'view') and event_id % 7 = 0)")
def slice_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and types loaded again: what the slices held before is gone."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "value")
    again = events.where((F.dayofmonth("day") % 3 == 0) & F.col("event_type").isin("click", "view"))
    rows = again.where("event_id % 7 <> 0").withColumn("value", F.col("value") + 1)
    # All slices asked for are cleared, also those that come back empty.
    return change.reload_slices(events, rows, ["day", "event_type"], again)


@query("select p_partkey, case p_partkey % 4 when 0 then 'same' when 1 then 'evolve' else 'reload' end as plan, case when p_partkey % 4 = 1 then p_size + 1 end as p_extra from part")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters of the parts by what their columns ask for: as they are, a column more, a
    column less, another type."""
    part = table(spark, sf_dir, "part")
    now = [part, part.withColumn("p_extra", F.col("p_size") + 1), part.drop("p_size"), part.withColumn("p_size", F.col("p_size").cast("string"))]
    quarter = lambda df, i: df.where(F.col("p_partkey") % 4 == i).select("p_partkey", F.lit(change.drift(part.schema, df.schema)).alias("plan"), (F.col("p_extra") if "p_extra" in df.columns else F.lit(None).cast("int")).alias("p_extra"))
    return reduce(DataFrame.unionByName, [quarter(df, i) for i, df in enumerate(now)])


# --- nested API records -----------------------------------------------------------------


@query("select c_name as name, '' as phone, coalesce(event_type, '') as screen_name, cast(json_extract_string(props, '$.k') as bigint) as ct_k, cast(c_nationkey as varchar) as city, event_type as event_name, date_trunc('second', ts) as timestamp from events join customer on user_id % (select count(*) from customer) = c_custkey")
def event_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events as flat rows by a map of paths."""
    customers = table(spark, sf_dir, "customer")
    n = customers.count()
    joined = table(spark, sf_dir, "events").join(customers, F.col("user_id") % n == F.col("c_custkey"))
    profile = F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("cx city")).alias("profileData"))
    record = F.struct(F.date_format("ts", "yyyyMMddHHmmss").cast("bigint").alias("ts"), profile.alias("profile"), F.struct(F.get_json_object("props", "$.k").alias("CT k"), F.col("event_type").alias("screen")).alias("event_props"))
    landed = joined.select(F.to_json(record).alias("record"), "event_type")
    paths = {"name": "profile.name", "phone": "profile.phone", "screen_name": "event_props.screen", "ct_k": "event_props.CT k", "city": "profile.profileData.cx city"}
    return flatten.flatten_event(landed, "record", paths, {"ct_k": "int"}, F.col("event_type"))


ACTION = "max_by(value, event_id) filter (where event_type = '{}')"


@query(
    "select cast(user_id as varchar) as user_id, " + ", ".join(f"{ACTION.format(t)} as actions_{t}, {ACTION.format(t).replace('max_by(value', 'max_by(value * 2')} as actions_{t}_7d_click" for t in ("click", "view", "purchase"))
    + ", null::double as actions_link_click, null::double as actions_link_click_7d_click, cast(user_id as varchar) || '_' || strftime(ts::date, '%Y-%m-%d') as id from events group by user_id, ts::date"
)
def actions_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of actions as declared columns; the last action of a type counts."""
    day = F.date_format("ts", "yyyy-MM-dd")
    action = F.struct("event_id", F.col("event_type").alias("action_type"), F.col("value").cast("string").alias("value"), (F.col("value") * 2).cast("string").alias("7d_click"))
    grouped = table(spark, sf_dir, "events").groupBy("user_id", day.alias("day")).agg(F.array_sort(F.collect_list(action)).alias("actions"))
    flat = flatten.flatten_actions(grouped, {"actions": ["click", "view", "purchase", "link.click"]})
    keyed = flat.withColumn("id", project.joined_key(F.col("user_id"), F.col("day")))
    numbers = [c for c in flat.columns if c.startswith("actions_")]
    return flatten.conform(keyed, {"user_id": "str", **dict.fromkeys(numbers, "float"), "id": "str"}, strict=True)


# --- streams ---------------------------------------------------------------------------


@query(
    "select event_type as type, case event_type when 'purchase' then 'audit_logs' when 'error' then 'error_logs' when 'signup' then null else 'product_audit_logs' end as routed, user_id, "
    "case when event_type <> 'signup' then value end as value, case when event_type <> 'signup' then ts end as created_at, case when event_type <> 'signup' then cast(json_extract_string(props, '$.k') as varchar) end as k from events"
)
def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of JSON lines, routed by type to tables by day. One route is in no
    list; records without a route are set aside with what they hold."""
    path = scratch_path(spark, "stream")
    events = table(spark, sf_dir, "events")
    lines = F.to_json(F.struct(F.col("event_type").alias("type"), "user_id", "value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"), F.col("props").alias("payload"), "event_id"))
    events.select(lines.alias("value")).write.text(f"{path}/in")
    by_type = F.when(F.col("type") == "purchase", "audit_logs").when(F.col("type") == "error", "error_logs").when(F.col("type") != "signup", "product_audit_logs")
    sink = router.Router(
        spark, f"{path}/out", lambda _: by_type, ["audit_logs", "product_audit_logs"], router.lift_payload(["k"]),
        {"user_id": "int", "value": "float", "date": "datetime", "event_id": "int"}, {"date": "datetime"}, {"date": "created_at"},
    )
    schema = "type string, user_id string, value string, date string, payload string, event_id long"
    router.run_router(router.read_lines(spark, f"{path}/in"), schema, sink, f"{path}/checkpoint").awaitTermination()
    read = [sink.read(name).select("type", F.lit(name).alias("routed"), "user_id", "value", "created_at", "k") for name in ("audit_logs", "error_logs", "product_audit_logs")]
    lost = sink.set_aside("routes").select(F.from_json("value", "type string, user_id string").alias("r"), "route")
    null = [F.lit(None).cast(t).alias(n) for n, t in (("value", "double"), ("created_at", "timestamp_ntz"), ("k", "string"))]
    return reduce(DataFrame.unionByName, read).unionByName(lost.select("r.type", F.col("route").alias("routed"), F.col("r.user_id").cast("long").alias("user_id"), *null))


# --- reconciliation, statistics ------------------------------------------------------------


def damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders, and a copy of them that lacks rows, differs in some and has more."""
    source = table(spark, sf_dir, "orders")
    dest = source.where("o_orderkey % 10 <> 1").withColumn("o_totalprice", F.when(okey() % 10 == 2, F.col("o_totalprice") + 5).otherwise(F.col("o_totalprice") + 0.0))
    dest = dest.withColumn("o_orderstatus", F.when(okey() % 10 == 3, "?").otherwise(F.col("o_orderstatus"))).withColumn("o_orderdate", F.when(okey() % 10 == 4, odate() + F.expr("interval 1 day")).otherwise(odate()))
    top = select.high_water(source, "o_orderkey")
    extra = source.where("o_orderkey % 10 = 0").withColumn("o_orderkey", okey() + top + 1)
    return source, dest.unionByName(extra)


STATUS = "case o_orderkey % 10 when 1 then 'missing' when 2 then 'mismatch' when 3 then 'mismatch' when 4 then 'mismatch' else 'ok' end"
WRONG = "case o_orderkey % 10 when 2 then 'o_totalprice' when 3 then 'o_orderstatus' when 4 then 'o_orderdate' else '' end"
COMPARED = f"select o_orderkey, {STATUS} as status, {WRONG} as wrong from orders union all select o_orderkey + (select max(o_orderkey) from orders) + 1, 'extra', '' from orders where o_orderkey % 10 = 0"


@query(COMPARED)
def reconcile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, dest = damaged(spark, sf_dir)
    return reconcile.compare(source, dest, "o_orderkey").withColumn("wrong", F.array_join("wrong", ","))


@query(f"select 'damaged' as pair, * from ({COMPARED}) union all select 'equal', o_orderkey, 'ok', '' from orders union all select 'few', o_orderkey, case when o_orderkey % 997 = 0 then 'mismatch' else 'ok' end, case when o_orderkey % 997 = 0 then 'o_orderpriority' else '' end from orders")
def reconcile_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of key ranges first: the rows of reconcile_columns, a pair of equal tables, which
    isn't joined at all, and one with few differences, of which few ranges are."""
    source, dest = damaged(spark, sf_dir)
    few = source.withColumn("o_orderpriority", F.when(okey() % 997 == 0, "?").otherwise(F.col("o_orderpriority")))
    found = [reconcile.compare_tree(source, d, "o_orderkey", leaves=4096).withColumn("pair", F.lit(n)) for n, d in (("damaged", dest), ("equal", source), ("few", few))]
    return reduce(DataFrame.unionByName, found).select("pair", "o_orderkey", "status", F.array_join("wrong", ",").alias("wrong"))


@query(
    "with a as (select o_orderkey % 10 as m from orders) select count(*) + count(*) filter (where m = 0) as n_rows, count(*) filter (where m in (1, 2, 3, 4)) as n_mismatches, count(*) filter (where m = 1) as n_missing, "
    "count(*) filter (where m = 0) as n_extra, count(*) filter (where m = 2) as wrong_o_totalprice, count(*) filter (where m = 3) as wrong_o_orderstatus, count(*) filter (where m = 4) as wrong_o_orderdate from a"
)
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, dest = damaged(spark, sf_dir)
    return reconcile.summary(reconcile.compare(source, dest, "o_orderkey"), ["o_totalprice", "o_orderstatus", "o_orderdate"])


@query("with h as (select max(o_orderkey) // 2 as half from orders) select o_orderkey from orders, h where o_orderkey <= half and (o_orderkey % 11 = 0 or o_orderdate < timestamp '1998-05-31')")
def reconcile_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a run must have moved; a null bookmark stays."""
    orders = table(spark, sf_dir, "orders").withColumn("b", F.when(okey() % 11 != 0, odate()))
    return orders.where(reconcile.due(okey(), F.col("b"), half(spark, sf_dir), LAST_RUN, DAY)).select("o_orderkey")


@query(f"select * from ({COMPARED}) where md5(cast(o_orderkey as varchar)) < '19999999'")
def reconcile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeatable sample of a tenth, the same keys on either side."""
    source, dest = (reconcile.sampled(x, "o_orderkey", 10) for x in damaged(spark, sf_dir))
    return reconcile.compare(source, dest, "o_orderkey").withColumn("wrong", F.array_join("wrong", ","))


@query(
    f"with {SRC} select 'orders' as table_name, count(*) filter (where o_orderkey > half) as insertions, count(*) filter (where o_orderkey <= half and o_orderdate > timestamp '1998-05-31') as updations, "
    "count(*) filter (where o_orderkey > half) + (select count(*) from orders, h where o_orderkey <= half) as total_records, true as status, true as timed, true as sized from src, h"
)
def job_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics that a sync job leaves: counted as its changes are staged."""
    path = scratch_path(spark, "stats")
    log = JobLog(spark, f"{path}/log")
    synced(spark, sf_dir, False, log)
    sized = (F.col("curr_megabytes_processed") > 0) & (F.col("total_megabytes") >= F.col("curr_megabytes_processed"))
    return log.read().select("table_name", "insertions", "updations", "total_records", "status", (F.col("total_time") > 0).alias("timed"), sized.alias("sized"))


@query("with s as (select event_type as job_id, max(ts) as start_time from events group by 1) select s.job_id, s.start_time, max(e.event_id) as insertions from s join events e on e.event_type = s.job_id and e.ts = s.start_time group by all")
def latest_job_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each job; events stand for runs."""
    runs = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("job_id"), F.col("ts").alias("start_time")).agg(F.max("event_id").alias("insertions"))
    return metrics.latest_statistics(runs)


@query("select o_orderkey, case when o_custkey % 3 = 0 then 7.5 else o_totalprice / (o_custkey % 3) * 100 end as total_megabytes from orders")
def estimated_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated megabytes from those of the rows moved, or as before if none were."""
    moved = F.col("o_custkey") % 3
    return table(spark, sf_dir, "orders").select("o_orderkey", metrics.estimated_megabytes(F.col("o_totalprice"), moved, F.lit(100), F.lit(7.5)).alias("total_megabytes"))


@query("select strftime(o_orderdate, '%Y-%m') as month, count(*) as n_updates from orders where o_orderdate > timestamp '1998-06-01' group by 1")
def updates_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.per_partition(monthly(table(spark, sf_dir, "orders").where(odate() > select.moment(LAST_RUN))), ["month"])


@query("select count(*) as n_records, 0::bigint as n_absent from orders")
def count_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a destination, and of one that isn't there."""
    held = Table(spark, scratch_path(spark, "absent"))
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n_records"), F.lit(metrics.n_records(held.read())).cast("bigint").alias("n_absent"))


# --- databases, several destinations ----------------------------------------------------


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def database(path: str) -> str:
    return "jdbc:derby:memory:" + path.rsplit("-", 1)[-1] + ";create=true"


@query("select c_custkey, c_name, c_acctbal from customer")
def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers staged, loaded into the embedded database, read back over key ranges."""
    path = scratch_path(spark, "jdbc")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    jdbc.load_through_stage(rows, f"{path}/stage", database(path), "customers", mode="overwrite", limits={"c_name": 64}, options=DERBY)
    return readers.read_jdbc(spark, database(path), "customers", "c_custkey", 4, DERBY).select("c_custkey", "c_name", "c_acctbal")


@query("with k as (select o_orderkey, md5(cast(o_orderkey as varchar)) as uuid, case when o_orderkey % 9 > 0 then o_orderdate end as o_orderdate from orders) select 'text' as by_key, o_orderkey, uuid, o_orderdate from k union all select 'time', o_orderkey, uuid, o_orderdate from k union all select 'number', o_orderkey, uuid, o_orderdate from k")
def jdbc_key_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read back over ranges of a text key, of a time (some null) and of a number: each row once."""
    path = scratch_path(spark, "kinds")
    time = F.when(okey() % 9 > 0, odate().cast("timestamp"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.md5(okey().cast("string").cast("binary")).alias("uuid"), time.alias("o_orderdate"))
    jdbc.write_jdbc(rows, database(path), "keyed", mode="overwrite", limits={"uuid": 32}, options=DERBY)
    read = lambda name, key: readers.read_jdbc(spark, database(path), "keyed", key, 5, DERBY).select(F.lit(name).alias("by_key"), "o_orderkey", "uuid", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    return reduce(DataFrame.unionByName, [read("text", "uuid"), read("time", "o_orderdate"), read("number", "o_orderkey")])


@query("with k as (select case when o_orderkey % 10 = 0 then o_orderkey * 1000 else o_orderkey end as k from orders) select k, 1 as n from k union all select null, 1 where (select count(*) from k) = 0")
def jdbc_skewed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tenths of the keys lie in a thousandth of their range: by cut points that the database
    answers, no range holds twice its share of the rows."""
    path = scratch_path(spark, "skew")
    key = F.when(okey() % 10 == 0, okey() * 1000).otherwise(okey())
    jdbc.write_jdbc(table(spark, sf_dir, "orders").select(key.alias("k")), database(path), "skewed", mode="overwrite", options=DERBY)
    back = readers.read_jdbc(spark, database(path), "skewed", "k", 8, DERBY, quantiles=readers.NUMBERED)
    sizes = [r["n"] for r in back.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    if max(sizes) * 8 > 2 * sum(sizes):
        raise AssertionError(f"rows of the ranges: {sizes}")
    return back.select("k", F.lit(1).alias("n"))


@query("select c_custkey, c_name, case when c_custkey % 3 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal from customer")
def jdbc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed and new customers merged inside the database; of two rows of a key the last one counts."""
    path = scratch_path(spark, "merge")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    how = {"limits": {"c_name": 64}, "options": DERBY}
    jdbc.write_jdbc(rows.where("c_custkey % 5 <> 0"), database(path), "customers", mode="overwrite", **how)
    new = rows.where("c_custkey % 3 = 0 or c_custkey % 5 = 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    jdbc.merge_jdbc(new.unionByName(new.withColumn("c_acctbal", F.lit(-1e9))), ["c_custkey"], database(path), "customers", [F.col("c_acctbal")], **how)
    return readers.read_jdbc(spark, database(path), "customers", "c_custkey", 4, DERBY).select("c_custkey", "c_name", "c_acctbal")


@query(
    "with k as (select c_custkey from customer where c_custkey % 5 <> 0) select c_custkey, c_acctbal from customer where c_custkey % 5 <> 0 or c_custkey > (select max(c_custkey) from k)"
)
def jdbc_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers gone from the source go in the database as well; keys beyond the source's largest stay."""
    path, rows = scratch_path(spark, "mirror"), table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    jdbc.write_jdbc(rows, database(path), "customers", mode="overwrite", options=DERBY)
    jdbc.mirror_jdbc(rows.where("c_custkey % 5 <> 0"), "c_custkey", database(path), "customers", options=DERBY)
    return readers.read_jdbc(spark, database(path), "customers", "c_custkey", 4, DERBY).select("c_custkey", "c_acctbal")


@query("select o_orderkey, s as migration_snapshot_date from orders, (select unnest([timestamp '2001-01-02 12:00:00', timestamp '2001-01-03 00:00:00', null]) as s)")
def jdbc_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots in a database that are older than a day, or just that old, go; rows without a stamp stay."""
    path = scratch_path(spark, "expire")
    stamps = F.explode(F.array(*[select.moment(x) for x in ("2001-01-01 00:00:00", "2001-01-02 00:00:00", "2001-01-02 12:00:00", "2001-01-03 00:00:00")], F.lit(None).cast("timestamp_ntz")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", stamps.alias("s")).select("o_orderkey", F.col("s").cast("timestamp").alias(project.SNAPSHOT))
    jdbc.write_jdbc(rows, database(path), "snapshots", mode="overwrite", options=DERBY)
    jdbc.expire_jdbc(spark, database(path), "snapshots", "2001-01-03 00:00:00", days=1, options=DERBY)
    return readers.read_jdbc(spark, database(path), "snapshots", "o_orderkey", 4, DERBY).select("o_orderkey", F.col(project.SNAPSHOT).cast("timestamp_ntz").alias(project.SNAPSHOT))


@query("select 'all' as dest, count(*) as n, sum(c_custkey)::bigint as keys from customer union all select 'rich', count(*), coalesce(sum(c_custkey), 0)::bigint from customer where c_acctbal > 5000")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source written to two tables, read once."""
    path = scratch_path(spark, "fan")
    every, rich = Table(spark, f"{path}/all"), Table(spark, f"{path}/rich")
    jobs.fan_out(table(spark, sf_dir, "customer"), [every.replace, lambda df: rich.replace(df.where("c_acctbal > 5000"))])
    count = lambda t, n: t.read().agg(F.lit(n).alias("dest"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("c_custkey"), F.lit(0)).alias("keys"))
    return count(every, "all").unionByName(count(rich, "rich"))
