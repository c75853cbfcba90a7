import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import change, reconcile, select
from tidemark.plans import jobs
from tidemark.sources.state import HashState, JobLog, StateLog
from tidemark.sources.store import Table

ROWS = "k long, v string, at timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, t) for k, v, t in rows], "k long, v string, t string").select("k", "v", F.col("t").cast("timestamp_ntz").alias("at"))


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 9), st.text("ab", max_size=2), max_size=6), st.lists(st.tuples(st.integers(0, 9), st.text("ab", max_size=2)), max_size=6))
def test_upsert_is_a_dict_update(spark, old, new):
    dest = spark.createDataFrame([(k, v, -1) for k, v in old.items()], "k long, v string, seq int")
    updates = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(new)], "k long, v string, seq int")
    once = change.upsert(dest, updates, ["k"], [F.col("seq")])
    assert rows(once, "k", "v") == sorted({**old, **dict(new)}.items())
    assert rows(change.upsert(once, updates, ["k"], [F.col("seq")]), "k", "v") == rows(once, "k", "v")


def test_upsert_touched_moves_rows(spark):
    dest = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "k long, p string")
    updates = spark.createDataFrame([(1, "b"), (9, "b")], "k long, p string")
    assert rows(change.upsert_touched(dest, updates, ["k"], ["p"], [F.col("p")]), "k", "p") == [(1, "b"), (2, "a"), (3, "b"), (9, "b")]
    assert rows(change.upsert_touched(dest, updates, ["k"], ["p"], [F.col("p")], moved=False), "k", "p") == [(1, "b"), (3, "b"), (9, "b")]


def test_a_partition_that_gets_empty(spark, tmp_path):
    held = Table(spark, str(tmp_path / "t"), ["p"])
    held.replace(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, p int"))
    updates = spark.createDataFrame([(1, "new", 2)], "k long, v string, p int")
    touched = held.values_of(change.touched_rows(held.read(), updates, ["k"], ["p"]))
    held.replace_partitions(change.upsert_touched(held.read(), updates, ["k"], ["p"], [F.col("v")]), touched)
    assert rows(held.read(), "k", "v", "p") == [(1, "new", 2), (2, "b", 2)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 20), st.integers(0, 2)), max_size=5), min_size=1, max_size=3))
def test_syncs_of_a_moving_source(spark, tmp_path, batches):
    """Rows change their partition, keys come many times: the table is the source's latest rows."""
    path = tmp_path / str(abs(hash(str(batches))))
    held, state = Table(spark, str(path / "t"), ["parquet_format_p"]), StateLog(spark, str(path / "s"))
    spec = jobs.SyncSpec("t", "k", bookmark="at", fields={"k": "bigint", "p": "str", "at": "datetime"}, parts={"p": "str"})
    want = {}
    for day, batch in enumerate(batches, 1):
        df = spark.createDataFrame([(k, f"2020-01-0{day} 00:00:{s:02d}", f"p{p}") for k, s, p in batch], "k long, t string, p string").select("k", "p", F.col("t").cast("timestamp_ntz").alias("at"))
        jobs.sync(df, spec, held, state, f"2020-01-0{day} 00:00:00" if day == 1 else f"2020-01-0{day} 00:00:00")
        for k, s, p in sorted(batch, key=lambda x: x[1]):
            want[k] = max((day, s), want.get(k, ((0, 0), ""))[0]), p
    got = held.read()
    assert got.count() == len(want) and {r["k"]: (r["at"].day, r["at"].second) for r in got.collect()} == {k: v[0] for k, v in want.items()}
    assert got.where("p <> parquet_format_p").count() == 0


def test_null_keys_stay_apart(spark):
    dest = spark.createDataFrame([(None, "old"), (1, "a")], "k long, v string")
    updates = spark.createDataFrame([(None, "x"), (None, "x"), (1, "b"), (1, "c")], "k long, v string")
    assert rows(change.upsert(dest, updates, ["k"], [F.col("v")]).fillna(-1, ["k"]), "k", "v") == [(-1, "old"), (-1, "x"), (-1, "x"), (1, "c")]


def test_the_latest_bookmark_counts(spark, tmp_path):
    spec = jobs.SyncSpec("t", "k", bookmark="at", fields={"k": "bigint", "v": "str", "at": "datetime"})
    for i in range(4):
        held, state = Table(spark, str(tmp_path / f"t{i}")), StateLog(spark, str(tmp_path / f"s{i}"))
        jobs.sync(frame(spark, [(1, f"new{i}", "2020-01-03 00:00:00"), (1, f"old{i}", "2020-01-02 00:00:00"), (1, "none", None)]), spec, held, state, "2020-01-04 00:00:00")
        assert rows(held.read(), "k", "v") == [(1, f"new{i}")]


def test_state_gives_keys_back_as_they_were(spark, tmp_path):
    state = StateLog(spark, str(tmp_path / "s"))
    for key in (7, 2.5, "a-1", dt.datetime(2020, 1, 2, 3, 4, 5, 6)):
        state.commit("j", "2020-01-01 00:00:00", key)
        assert state.get("j").last_key == key


def test_hash_tells_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None)], "x string, y string").withColumn("h", change.row_hash(["x", "y"]))
    assert df.select("h").distinct().count() == 3
    assert df.select(change.row_hash(["y", "x"]).alias("g"), "h").where("g <> h").count() == 0


def test_unknown_keys_in_the_update_pass(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    state = change.fingerprints(df.where("k = 1").withColumn("v", F.lit("z")), "k", ["k", "v"])
    assert rows(change.changed(df, state, "k", "update", "skip"), "k") == [(1,)]
    assert rows(change.changed(df, state, "k", "update", "update"), "k") == [(1,), (2,)]
    assert rows(change.changed(df, state, "k", "insert"), "k") == [(2,)]


def test_mirror_bounds_and_guard(spark):
    dest = spark.createDataFrame([(1,), (2,), (3,), (9,), (None,)], "k long")
    source = spark.createDataFrame([(1,), (3,), (None,)], "k long")
    assert change.mirror(dest, source, "k").count() == 4  # 2 goes; 9 and the null key stay
    assert rows(change.mirror(dest, source, "k", full=True), "k") == [(1,), (3,)]
    assert rows(change.mirror_deleted(dest, source, "k"), "k") == [(2,)]
    for full in (False, True):
        with pytest.raises(ValueError):
            change.mirror_deleted(dest, source.limit(0), "k", full=full)
    assert change.mirror_deleted(dest, source.limit(0), "k", full=True, force=True).count() == 5
    with pytest.raises(ValueError):
        change.mirror(dest, source.limit(0), "k")
    assert change.mirror(dest, source.limit(0), "k", force=True).count() == 5
    assert change.mirror(dest, source.limit(0), "k", full=True, force=True).count() == 0


def test_insert_ignore_nulls(spark):
    dest = spark.createDataFrame([(1, None), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c"), (3, "c")], "k long, v string")
    assert change.insert_ignore(dest, new).count() == 3
    assert rows(change.insert_ignore(dest, new, null_safe=True), "k") == [(3,)]


def test_drift(spark):
    a = spark.createDataFrame([], "k long, v string").schema
    more = spark.createDataFrame([], "v string, k long, w int").schema
    other = spark.createDataFrame([], "k long, v int").schema
    assert [change.drift(a, x) for x in (a, more, other)] == ["same", "evolve", "reload"]
    assert change.drift(a, a, ["p"], []) == "reload"


def test_first_run_has_no_lower_bound(spark):
    df = spark.createDataFrame([(-(2**40),), (5,)], "k long")
    assert df.where(select.new_rows(F.col("k"), None, 5)).count() == 2


def source(spark, version):
    base = [(k, f"v{k}", "2020-01-01 00:00:00") for k in range(1, 8)]
    if version > 1:
        base = [(k, v if k != 3 else "changed", t if k != 3 else "2020-02-02 00:00:00") for k, v, t in base if k != 5] + [(8, "v8", "2020-02-02 00:00:00")]
    return frame(spark, base)


@pytest.mark.parametrize("hashed", [False, True])
def test_two_runs_and_a_crash(spark, tmp_path, hashed):
    spec = jobs.SyncSpec("t", "k", bookmark=None if hashed else "at", fields={"k": "bigint", "v": "str", "at": "datetime"})
    held, state = Table(spark, str(tmp_path / "t")), StateLog(spark, str(tmp_path / "s"))
    hashes = HashState(spark, str(tmp_path / "h"), 4) if hashed else None
    jobs.sync(source(spark, 1), spec, held, state, "2020-01-15 00:00:00", hashes)
    assert rows(held.read(), "k", "v") == rows(source(spark, 1), "k", "v")
    jobs.sync(source(spark, 1), spec, held, state, "2020-01-16 00:00:00", hashes)  # nothing new: nothing changes
    assert rows(held.read(), "k", "v") == rows(source(spark, 1), "k", "v")

    class Dies(StateLog):
        def commit(self, *a):
            raise RuntimeError("lost between the data and the state")

    with pytest.raises(RuntimeError):
        jobs.mirror(source(spark, 2), spec, held, Dies(spark, str(tmp_path / "s")), "2020-02-15 00:00:00", hashes)
    jobs.mirror(source(spark, 2), spec, held, state, "2020-02-15 00:00:00", hashes)
    assert rows(held.read(), "k", "v") == rows(source(spark, 2), "k", "v")


def test_log_after_a_crash_adds_nothing_twice(spark, tmp_path):
    spec = jobs.SyncSpec("t", "k", fields={"k": "bigint", "v": "str", "at": "datetime"})
    held, state = Table(spark, str(tmp_path / "t")), StateLog(spark, str(tmp_path / "s"))
    jobs.log(source(spark, 1), spec, held, state, "2020-01-15 00:00:00")
    state.reset("t")  # as if the state had not been written
    jobs.log(source(spark, 2), spec, held, state, "2020-02-15 00:00:00")
    assert rows(held.read(), "k") == [(k,) for k in range(1, 9)]


def test_dump_with_expiry(spark, tmp_path):
    spec, held = jobs.SyncSpec("t", "k", fields={"k": "bigint", "v": "str", "at": "datetime"}), Table(spark, str(tmp_path / "t"))
    for day in (1, 2, 5):
        jobs.dump(source(spark, 1), spec, held, f"2020-01-0{day}", {"days": 3})
    assert [r[0].day for r in held.read().select("migration_snapshot_date").distinct().orderBy(F.col("migration_snapshot_date")).collect()] == [5]


def test_a_dump_done_again_and_rows_without_a_stamp(spark, tmp_path):
    spec, held = jobs.SyncSpec("t", "k", fields={"k": "bigint", "v": "str", "at": "datetime"}), Table(spark, str(tmp_path / "t"))
    for day in (1, 2, 2):
        jobs.dump(source(spark, 1), spec, held, f"2020-01-0{day}", {"days": 9})
    assert held.read().groupBy("migration_snapshot_date").count().where("count <> 7").count() == 0 and held.read().count() == 14
    held.append(held.read().limit(1).withColumn("migration_snapshot_date", F.lit(None).cast("timestamp_ntz")))
    jobs.dump(source(spark, 1), spec, held, "2021-01-01", {"days": 9})
    assert held.read().count() == 8 and held.read().where("migration_snapshot_date is null").count() == 1


def test_only_touched_partitions_are_written(spark, tmp_path):
    spec = jobs.SyncSpec("t", "k", bookmark="at", fields={"k": "bigint", "v": "str", "at": "datetime"}, parts={"v": "str"})
    held, state, log = Table(spark, str(tmp_path / "t"), ["parquet_format_v"]), StateLog(spark, str(tmp_path / "s")), JobLog(spark, str(tmp_path / "l"))
    jobs.sync(source(spark, 1), spec, held, state, "2020-01-15 00:00:00", log=log)
    before = held.state().dirs
    jobs.mirror(source(spark, 2), spec, held, state, "2020-02-15 00:00:00", log=log)
    gone = {d.rsplit("=", 1)[1] for d in set(before) - set(held.state().dirs)}
    assert gone == {"v3", "v5"} and rows(held.read(), "k", "v") == rows(source(spark, 2), "k", "v")
    stats = log.read().orderBy("start_time").collect()
    assert [(r["insertions"], r["updations"], r["total_records"], r["status"]) for r in stats] == [(7, 0, 7, True), (1, 1, 7, True)] and all(r["curr_megabytes_processed"] > 0 for r in stats)
    jobs.sync(source(spark, 2), spec, held, state, "2020-02-16 00:00:00", log=log)  # nothing moves: as large as before
    last = log.read().orderBy(F.desc("start_time")).first()
    assert (last["insertions"], last["updations"]) == (0, 0) and last["total_megabytes"] == stats[1]["total_megabytes"]


def test_replace_partitions_keeps_others(spark, tmp_path):
    held = Table(spark, str(tmp_path / "t"), ["p"])
    held.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string"))
    held.replace_partitions(held.read().where("p = 'a'").withColumn("k", F.col("k") + 10))
    assert rows(held.read(), "k", "p") == [(2, "b"), (11, "a")]


def test_reconcile_rules(spark):
    a = frame(spark, [(1, "x", "2020-01-01 00:00:00.2"), (2, "", "2020-01-01 00:00:00"), (3, "y", None), (4, "z", "2020-01-01 00:00:00")])
    b = frame(spark, [(1, "x", "2020-01-01 00:00:00.9"), (2, "filled", "2020-01-01 00:00:01"), (3, None, "2020-01-01 00:00:00")])
    assert rows(reconcile.compare(a, b, "k").withColumn("w", F.array_join("wrong", ",")), "k", "status", "w") == [(1, "ok", ""), (2, "mismatch", "at"), (3, "mismatch", "v"), (4, "missing", "")]
    assert rows(reconcile.compare(a, b, "k", seconds=1).where("k = 2"), "k", "status") == [(2, "ok")]
