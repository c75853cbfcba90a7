"""Versions, writers, indexes, deletion marks, hash states and checksums."""

import json
import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import project, sql, types
from tidemark.operators import change, reconcile
from tidemark.plans import jobs
from tidemark.sources import readers
from tidemark.sources.scratch import create_text, names, read_text
from tidemark.sources.state import HashState, JobLog, StateLog
from tidemark.sources.store import Conflict, Table

KV = "k long, p string, v long"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# --- files and writers


def test_one_of_many_gets_a_file(spark, tmp_path):
    got, path = [], f"{tmp_path}/log dir/v1.json"
    (tmp_path / "log dir").mkdir()
    threads = [threading.Thread(target=lambda i=i: got.append((create_text(spark, path, f"é{i}"), i))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    first = [i for ok, i in got if ok]
    assert len(first) == 1 and read_text(spark, path) == f"é{first[0]}" and [n for n in names(spark, f"{tmp_path}/log dir") if not n.startswith(".")] == ["v1.json"]


def test_writers_of_other_partitions_dont_meet(spark, tmp_path):
    one, two = (Table(spark, f"{tmp_path}/t", ["p"]) for _ in range(2))
    one.replace(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], KV))
    before = two.state()
    one.replace_partitions(spark.createDataFrame([(1, "a", 1)], KV))
    two.replace_partitions(spark.createDataFrame([(2, "b", 2)], KV), before=before)  # it had read the first version
    assert rows(Table(spark, f"{tmp_path}/t").read(), "k", "v") == [(1, 1), (2, 2)] and two.version() == 3
    before = two.state()
    one.replace_partitions(spark.createDataFrame([(1, "a", 3)], KV))
    with pytest.raises(Conflict):
        two.replace_partitions(spark.createDataFrame([(1, "a", 4)], KV), before=before)
    two.append(spark.createDataFrame([(9, "a", 9)], KV))
    assert rows(two.read(), "k", "v") == [(1, 3), (2, 2), (9, 9)]
    before = two.state()
    one.append(spark.createDataFrame([(8, "b", 8)], KV))
    with pytest.raises(Conflict):  # it would lose the row that came in
        two.replace_partitions(spark.createDataFrame([(2, "b", 5)], KV), before=before)
    one.replace_partitions(spark.createDataFrame([(2, "b", 6)], KV))
    fresh = [Table(spark, f"{tmp_path}/fresh") for _ in range(2)]
    threads = [threading.Thread(target=t.append, args=(spark.createDataFrame([(i, "x", i)], KV),)) for i, t in enumerate(fresh)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert rows(fresh[0].read(), "k") == [(0,), (1,)] and fresh[0].version() == 2


def test_a_sync_that_meets_another_is_merged_again(spark, tmp_path, monkeypatch):
    """Both touch the same partition: the second one reads the first one's rows, and loses none."""
    spec = jobs.SyncSpec("t", "k", bookmark="v", improper_bookmark=True, fields={"k": "bigint", "p": "str", "v": "bigint"}, parts={"p": "str"})
    table, state = Table(spark, f"{tmp_path}/t", ["parquet_format_p"]), StateLog(spark, f"{tmp_path}/s")
    jobs.sync(spark.createDataFrame([(1, "a", 1)], KV), spec, table, state, "2020-01-01 00:00:00")
    plain, met = Table.replace_partitions, []

    def meets(self, df, touched=None, before=None):
        if not met:
            met.append(1)
            other = Table(spark, f"{tmp_path}/t", ["parquet_format_p"])
            plain(other, other.read().unionByName(other.read().withColumn("k", F.lit(7).cast("long")).withColumn(project.RECORD_KEY, F.lit("7"))))
        return plain(self, df, touched, before)

    monkeypatch.setattr(Table, "replace_partitions", meets)
    jobs.sync(spark.createDataFrame([(2, "a", 10**10)], KV), spec, table, state, "2020-01-02 00:00:00")
    assert rows(table.read(), "k") == [(1,), (2,), (7,)] and table.version() == 3


@pytest.mark.parametrize("hashed", [False, True])
def test_a_reload_that_fails_leaves_all_as_it_was(spark, tmp_path, hashed):
    spec = jobs.SyncSpec("t", "k", bookmark=None if hashed else "v", fields={"k": "bigint", "p": "str", "v": "bigint"})
    table, state, hashes = Table(spark, f"{tmp_path}/t"), StateLog(spark, f"{tmp_path}/s"), HashState(spark, f"{tmp_path}/h", 2)
    jobs.sync(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], KV), spec, table, state, "2020-01-01 00:00:00", hashes)
    broken = spark.createDataFrame([(1, 1), (3, 0)], "k long, v long").withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        jobs.sync(broken, spec, table, state, "2020-01-02 00:00:00", hashes)
    assert rows(table.read(), "k", "p") == [(1, "a"), (2, "b")] and state.get("t").last_key == 2
    assert not hashed or hashes.read().count() == 2
    jobs.sync(spark.createDataFrame([(1, 1), (3, 0)], "k long, v long"), spec, table, state, "2020-01-02 00:00:00", hashes)
    assert rows(table.read(), "k") == [(1,), (3,)] and "p" not in table.read().columns and rows(table.read(version=1), "k") == [(1,), (2,)]


def test_versions_and_vacuum(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["p"], index="k")
    table.replace(spark.range(50).selectExpr("id as k", "cast(id % 5 as string) as p", "id as v"))
    for i in range(3):
        table.append(spark.createDataFrame([(100 + i, "1", i)], KV))
    assert len(table.state().dirs) == 8 and table.n_rows() == 53
    assert table.compact(order=["k"]) == 1 and len(table.state().dirs) == 5 and table.read().count() == 53
    assert table.read(version=2).count() == 51  # until vacuum
    table.vacuum(1)
    assert table.read().count() == 53 == table.n_rows() and len(names(spark, f"{tmp_path}/t/data")) == 2 == len(names(spark, f"{tmp_path}/t/index"))
    assert [d.split("p=")[1] for d in table.may_hold(spark.createDataFrame([(101,)], "k long"))] == ["1"]
    assert table.compact() == 0


# --- where keys lie


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(0, 3)), min_size=1, max_size=60), st.lists(st.integers(-60, 60), max_size=8), st.booleans())
def test_no_directory_that_holds_a_key_is_passed_over(spark, tmp_path, held, asked, as_text):
    table = Table(spark, f"{tmp_path}/{abs(hash(str((held, asked, as_text))))}", ["p"], index="k")
    kind = "string" if as_text else "bigint"
    table.replace(spark.createDataFrame([(k, str(p), 0) for k, p in held], KV).withColumn("k", F.col("k").cast(kind)))
    keys = spark.createDataFrame([(k,) for k in asked], "x long").withColumn("x", F.col("x").cast(kind))
    found = {d.rsplit("=", 1)[1] for d in table.may_hold(keys)}
    assert {str(p) for k, p in held if k in asked} <= found
    assert {d.rsplit("=", 1)[1] for d in table.state().dirs} == {str(p) for _, p in held}


def test_a_sync_of_few_keys_opens_few_directories(spark, tmp_path, monkeypatch):
    """Keys without any order over 40 directories: only those that hold one of five are read."""
    table = Table(spark, f"{tmp_path}/t", ["parquet_format_p"], index="k")
    spec = jobs.SyncSpec("t", "k", bookmark="v", fields={"k": "str", "p": "str", "v": "bigint"}, parts={"p": "str"}, grace=10**9)
    made = lambda n, v: spark.range(n).selectExpr("md5(cast(id as string)) as k", "cast(id % 40 as string) as p", f"id + {v} as v")
    state = StateLog(spark, f"{tmp_path}/s")
    jobs.sync(made(20_000, 0), spec, table, state, "2020-01-01 00:00:00")
    opened, plain = [], Table.read_dirs
    monkeypatch.setattr(Table, "read_dirs", lambda self, dirs, *more: (opened.append(list(dirs)), plain(self, dirs, *more))[1])
    few = made(20_000, 10**9).where("v % 4000 = 7").withColumn("p", F.lit("moved"))
    held = {str(r[0] % 40) for r in spark.range(20_000).selectExpr("id").where(f"(id + {10**9}) % 4000 = 7").collect()}
    jobs.sync(few, spec, table, state, "2020-01-02 00:00:00")
    assert len(opened) == 1 and held <= {d.rsplit("=", 1)[1] for d in opened[0]} and len(opened[0]) <= len(held) + 2
    assert table.read().count() == 20_000 and table.read().where("p = 'moved'").count() == 5


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 3)), max_size=6), min_size=1, max_size=4), st.booleans())
def test_marks_give_what_rewriting_gives(spark, tmp_path, batches, delete):
    path = f"{tmp_path}/{abs(hash(str((batches, delete))))}"
    tables = {w: Table(spark, f"{path}/{w}", ["parquet_format_p"], index="k") for w in ("rewrite", "delta")}
    now = {}
    for day, batch in enumerate(batches, 1):
        now = {**({} if delete else now), **{k: (f"p{p}", day) for k, p in batch}}
        source = spark.createDataFrame([(k, p, f"2020-01-{d:02d} 00:00:00") for k, (p, d) in now.items()], "k long, p string, t string").select("k", "p", F.col("t").cast("timestamp_ntz").alias("at"))
        for w, table in tables.items():
            spec = jobs.SyncSpec("t", "k", bookmark="at", grace=10**7, fields={"k": "bigint", "p": "str", "at": "datetime"}, parts={"p": "str"}, write=w)
            if delete and not now:
                with pytest.raises(ValueError):
                    jobs.mirror(source, spec, table, StateLog(spark, f"{path}/{w}-s"), f"2020-01-{day:02d} 12:00:00")
            else:
                (jobs.mirror if delete else jobs.sync)(source, spec, table, StateLog(spark, f"{path}/{w}-s"), f"2020-01-{day:02d} 12:00:00")
    one, two = (t.read() for t in tables.values())
    assert one is None or rows(one, "k", "p", "parquet_format_p") == rows(two, "k", "p", "parquet_format_p")
    assert one is None or tables["delta"].n_rows() == two.count()


def test_marks_write_few_rows(spark, tmp_path):
    spec = jobs.SyncSpec("t", "k", bookmark="v", grace=10**9, fields={"k": "bigint", "p": "str", "v": "bigint"}, write="delta")
    table, state = Table(spark, f"{tmp_path}/t"), StateLog(spark, f"{tmp_path}/s")
    jobs.sync(spark.range(5000).selectExpr("id as k", "'a' as p", "id as v"), spec, table, state, "2020-01-01 00:00:00")
    first = set(table.state().dirs)
    jobs.sync(spark.createDataFrame([(5, "b", 10**10), (6000, "b", 10**10)], KV), spec, table, state, "2020-01-02 00:00:00")
    fresh = [x for d, x in table.state().dirs.items() if d not in first]
    assert first < set(table.state().dirs) and [x["n"] for x in fresh] == [2]
    assert table.read().count() == 5001 and rows(table.read().where("p = 'b'"), "k") == [(5,), (6000,)]
    assert table.read(version=1).count() == 5000 and table.read(version=1).where("p = 'b'").count() == 0


# --- hashes, keys, names


def test_a_join_with_the_hash_state_shuffles_the_rows_alone(spark, tmp_path):
    hashes = HashState(spark, f"{tmp_path}/h", 8)
    df = spark.range(500).selectExpr("id as k", "cast(id as string) as v")
    hashes.put(change.fingerprints(df, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = change.classify(df, hashes.read(), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_hash_state_after_lost_runs_and_compaction(spark, tmp_path):
    hashes = HashState(spark, f"{tmp_path}/h", 2)
    put = lambda pairs: hashes.put(spark.createDataFrame(pairs, "map_id string, sha string"))
    put([("1", "a"), ("2", "b"), (None, "x")])
    hashes._add(spark.createDataFrame([("1", "lost"), ("9", "lost")], "map_id string, sha string"), hashes._held(), 10**18)  # and no entry in the log
    assert rows(hashes.read(), "map_id", "sha") == [("1", "a"), ("2", "b")]
    put([("2", "c"), ("3", "d")])
    put([("1", None)])
    assert rows(hashes.read(), "map_id", "sha") == [("2", "c"), ("3", "d")]
    other = HashState(spark, f"{tmp_path}/h")
    assert rows(other.read(), "map_id", "sha") == [("2", "c"), ("3", "d")]
    assert len([n for n in names(spark, f"{tmp_path}/h") if n.startswith("hashes-")]) == 1  # what was compacted is gone


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 40)), st.lists(st.integers(0, 40), max_size=50), st.sampled_from([1, 40_000, 10**7]))
def test_keys_gone(spark, dest, source, n):
    a, b = spark.createDataFrame([(k,) for k in [*dest, None]], "k long"), spark.createDataFrame([(k,) for k in [*source, None]], "k long")
    assert rows(change.keys_gone(a, b, "k", n), "k") == sorted((k,) for k in dest - set(source))


def test_names_that_jobs_use_themselves(spark, tmp_path):
    taken = ["sha", "Change", "FOUND", "record_key", "alone", "rank", "map_id", "_kind", "raw", "key", "own", "_file", "range"]
    df = spark.createDataFrame([(1, *["x"] * len(taken))], "k long, " + ", ".join(f"`{c}` string" for c in taken))
    for name, bookmark in (("h", None), ("b", "sha")):
        table, state, hashes = Table(spark, f"{tmp_path}/{name}"), StateLog(spark, f"{tmp_path}/{name}s"), HashState(spark, f"{tmp_path}/{name}h", 2)
        for day in (1, 2):
            jobs.mirror(df, jobs.SyncSpec("t", "k", bookmark=bookmark), table, state, f"2020-01-0{day}", hashes)
        assert {c.lower() for c in table.read().columns} == {c.lower() for c in [*taken, "k", project.RECORD_KEY]}
        assert set(table.read().first()) == {1, "1", "x"}


def test_a_masked_key_stays_masked(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t")
    df = spark.createDataFrame([("abcdef", 1), (None, 2)], "k string, v long")
    spec = jobs.SyncSpec("t", "k", bookmark="v", masks=[("k", 3)])
    jobs.mirror(df, spec, table, StateLog(spark, f"{tmp_path}/s"), "2020-01-01")
    assert rows(table.read(), "k", project.RECORD_KEY) == [("abcXXX", "abcXXX")]


def test_a_dump_keeps_rows_without_a_key(spark, tmp_path):
    table, log = Table(spark, f"{tmp_path}/t"), JobLog(spark, f"{tmp_path}/l")
    jobs.dump(spark.createDataFrame([(None, 1), (0, 2)], "k long, v long"), jobs.SyncSpec("t", "k"), table, "2020-01-01", log=log)
    assert {(r["k"], r[project.RECORD_KEY]) for r in table.read().collect()} == {(0, "0"), (0, None)}
    assert log.read().first()["total_records"] == 2 and log.last("t")["insertions"] == 2


# --- checksums


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data(), st.sampled_from([0, 1]), st.sampled_from([1, 16, 4096]))
def test_checksums_give_what_comparing_gives(spark, data, seconds, leaves):
    value = st.sampled_from([None, 0.0, 0.4, 1.2, 1.9, float("nan"), 1e300])
    row = lambda: st.tuples(value, st.sampled_from([None, "", "a", "b"]), st.sampled_from([None, "2020-01-01 00:00:00.2", "2020-01-01 00:00:00.9", "2020-01-01 00:00:01"]), st.sampled_from([None, 0, 5]))
    sides = [data.draw(st.dictionaries(st.integers(0, 8), row(), max_size=8)) for _ in range(2)]
    a, b = (spark.createDataFrame([(k, *r) for k, r in s.items()] + [(None, 1.0, "a", None, 5)], "k long, x double, y string, t string, n long").withColumn("t", F.col("t").cast("timestamp_ntz")) for s in sides)
    shown = lambda df: sorted((str(r["k"]), r["status"], ",".join(r["wrong"])) for r in df.collect())
    assert shown(reconcile.compare_tree(a, b, "k", seconds=seconds, leaves=leaves)) == shown(reconcile.compare(a, b, "k", seconds=seconds))


def test_equal_tables_are_not_joined(spark):
    df = spark.range(1000).selectExpr("id as k", "cast(id as string) as v")
    plan = reconcile.compare_tree(df, df.repartition(3), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    plan = reconcile.compare_tree(df, df.withColumn("v", F.when(F.col("k") == 5, "?").otherwise(F.col("v"))), "k", leaves=256)
    assert plan.where("status <> 'ok'").collect()[0]["k"] == 5 and plan.count() == 1000


# --- types, functions, documents


def test_wider_types(spark, tmp_path):
    kind = lambda ddl: spark.createDataFrame([], f"x {ddl}").schema[0].dataType
    for a, b, c in (("int", "bigint", "bigint"), ("bigint", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("float", "int", "double"), ("string", "int", None), ("string", "string", "string")):
        assert types.wider(kind(a), kind(b)) == types.wider(kind(b), kind(a)) == (kind(c) if c else None)
    table = Table(spark, f"{tmp_path}/t")
    table.append(spark.createDataFrame([(1,)], "x int"))
    table.append(spark.createDataFrame([(2**40,)], "x long"))
    table.append(spark.createDataFrame([(0.5,)], "x double"))
    table.append(spark.createDataFrame([(7,)], "x int"))
    assert rows(table.read(), "x") == [(0.5,), (1.0,), (7.0,), (float(2**40),)] and table.read(version=1).dtypes == [("x", "int")]
    assert table.compact() == 1 and rows(table.read(), "x") == [(0.5,), (1.0,), (7.0,), (float(2**40),)] and table.compact() == 0


def test_functions_by_name_are_their_expressions(spark):
    sql.register(spark)
    text = spark.createDataFrame([(x,) for x in ("12", " 12.7 ", "1e3", "junk", "", None, "9007199254740993", "Yes", "t", "nan")], "x string")
    for name, f in (("strict_int", types.to_int), ("lenient_float", types.to_float), ("strict_bool", types.to_bool)):
        got = text.select(F.expr(f"{name}(x)").cast("string").alias("a"), f(F.col("x")).cast("string").alias("b"))
        assert got.where("not a <=> b").count() == 0
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    for n in (0, 2, 9):
        got = text.select(F.expr(f"mask_text(x, {n})").alias("a"), project.mask_text(F.col("x"), n).alias("b"))
        assert got.where("not a <=> b").count() == 0
        got = spark.range(-500, 500, 7).select(F.expr(f"mask_digits(id, {n})").alias("a"), project.mask_digits(F.col("id"), n).alias("b"))
        assert got.where("not a <=> b").count() == 0
    kind = "r struct<lower: string, upper: string, lower_inc: boolean, upper_inc: boolean, is_empty: boolean>"
    spans = spark.createDataFrame([(("1", None, True, True, False),), ((None, "2", True, True, False),), (("1", "2", False, True, True),), (None,)], kind)
    assert spans.select(F.expr("range_text(r)").alias("a"), types.range_text(F.col("r")).alias("b")).where("not a <=> b").count() == 0


def test_documents_show_new_fields(spark, tmp_path):
    (tmp_path / "d.json").write_text("\n".join(json.dumps(x) for x in [{"a": 1, "b c": {"x": "y"}}, {"a": 2.5, "it's": [1, None]}, {"a": None, "OBJECT<": True}, [1], "text"]) + "\nno json")
    found = readers.typed_documents(readers.read_loose_documents(spark, str(tmp_path / "d.json")))
    assert dict(found.dtypes) == {"a": "double", "b c": "struct<x:string>", "it's": "array<bigint>", "OBJECT<": "boolean"}
    got = [r.asDict(recursive=True) for r in found.collect()]
    assert len(got) == 6 and [r["a"] for r in got] == [1.0, 2.5, None, None, None, None] and got[1]["it's"] == [1, None] and got[0]["b c"] == {"x": "y"} and got[2]["OBJECT<"] is True
    assert readers.typed_documents(readers.read_loose_documents(spark, str(tmp_path / "d.json")).limit(0)).columns == []
