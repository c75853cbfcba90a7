import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import flatten, metrics
from tidemark.sources import jdbc, readers
from tidemark.sources.scratch import names
from tidemark.sources.store import Table

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def url(tmp_path):
    return f"jdbc:derby:memory:{tmp_path.name};create=true"


def test_wall_clock_times(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12), 1)], "t timestamp_ntz, k int")
    assert jdbc.wall_clock(df, "Asia/Kolkata").first()["t"] == dt.datetime(2024, 7, 1, 17, 30)


def test_merge_inside_the_database(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    jdbc.write_jdbc(old, url(tmp_path), "t", mode="overwrite", limits={"v": 8}, options=DERBY)
    new = spark.createDataFrame([(2, "A"), (2, "B"), (3, "c")], "k long, v string")
    for _ in range(2):  # done again, it leaves the same
        jdbc.merge_jdbc(new, ["k"], url(tmp_path), "t", [F.col("v")], limits={"v": 8}, options=DERBY)
    back = readers.read_jdbc(spark, url(tmp_path), "t", "k", 2, DERBY)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "B"), (3, "c")] and back.rdd.getNumPartitions() == 2
    with pytest.raises(Exception, match="NOWHERE|nowhere"):
        jdbc.statements(spark, url(tmp_path), ['DELETE FROM t WHERE "k" = 1', "DELETE FROM nowhere"], DERBY)
    assert readers.read_jdbc(spark, url(tmp_path), "t", options=DERBY).count() == 3  # nothing of a failed transaction stays


def test_mirror_and_expiry_inside_the_database(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (9, "z"), (None, "n")], "k long, v string")
    jdbc.write_jdbc(rows, url(tmp_path), "t", mode="overwrite", limits={"v": 8}, options=DERBY)
    keys = lambda: sorted(r["v"] for r in readers.read_jdbc(spark, url(tmp_path), "t", options=DERBY).collect())
    source = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k long")
    for full, force in ((False, False), (True, False)):
        with pytest.raises(ValueError):
            jdbc.mirror_jdbc(source.limit(0), "k", url(tmp_path), "t", full, force, options=DERBY)
    jdbc.mirror_jdbc(source.limit(0), "k", url(tmp_path), "t", force=True, options=DERBY)
    assert keys() == ["a", "b", "c", "n", "z"]
    jdbc.mirror_jdbc(source, "k", url(tmp_path), "t", options=DERBY)
    assert keys() == ["a", "c", "n", "z"]
    jdbc.mirror_jdbc(source, "k", url(tmp_path), "t", full=True, options=DERBY)
    assert keys() == ["a", "c"]
    with pytest.raises(Exception, match="t_|T_|nowhere|NOWHERE"):
        jdbc.mirror_jdbc(source, "k", url(tmp_path), "nowhere", options=DERBY)  # the stage goes all the same
    left = spark.read.format("jdbc").option("url", url(tmp_path)).options(**DERBY).option("query", "SELECT COUNT(*) AS n FROM SYS.SYSTABLES WHERE TABLETYPE = 'T' AND TABLENAME <> 'T'").load()
    assert left.first()[0] == 0


def test_bounds_of_keys():
    for low, high, kind in [(0, 100, T.LongType()), ("00ab", "ffee", T.StringType()), ("Zed", "abc", T.StringType()), (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 9), T.TimestampNTZType()), (dt.date(2020, 1, 1), dt.date(2020, 1, 9), T.DateType()), (5, 5, T.LongType())]:
        found = readers.cuts(low, high, kind, 4)
        assert found == sorted(found) and len(found) == 3
    assert readers.ranges("k", ["1", "1", "5"]) == ["(k < 1 OR k IS NULL)", "(k >= 1 AND k < 5)", "k >= 5"]
    assert readers.shown("it's", T.StringType()) == "'it''s'" and readers.shown(dt.date(2020, 1, 1), T.DateType()) == "{d '2020-01-01'}"


def test_lengths_of_text_columns(spark):
    df = spark.createDataFrame([], "a string, b string, n int")
    assert jdbc.column_types(df, {"a": 5}) == "a VARCHAR(5)" and jdbc.column_types(df, {"a": 5}, 512) == "a VARCHAR(5), b VARCHAR(512)"


def test_count_without_a_second_pass(spark, tmp_path):
    df, seen = metrics.observed(spark.range(7), "moved")
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get["n"] == 7


def test_loose_documents(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"a": {"b c": 1}}\nno json\n{"x": [1, 2]}')
    docs = readers.read_loose_documents(spark, str(tmp_path / "d.json"))
    assert docs.where("document is null").count() == 1
    assert docs.select(F.try_variant_get("document", "$.x[1]", "int").alias("v")).where("v = 2").count() == 1


def test_queries_are_only_for_snapshots(spark):
    with pytest.raises(ValueError):
        readers.read_query(spark, "SELECT 1 AS a", {}, {"a": "int"}, mode="syncing")
    assert readers.read_query(spark, "SELECT '7' AS a", {}, {"a": "int"}).first()["a"] == 7


def test_store_reads_columns_of_all_appends(spark, tmp_path):
    held = Table(spark, str(tmp_path / "t"))
    assert held.read() is None and metrics.n_records(held.read()) == 0
    held.append(spark.createDataFrame([(1,)], "k long"))
    held.append(spark.createDataFrame([(2, "x")], "k long, v string"))
    assert sorted((r["k"], r["v"]) for r in held.read().collect()) == [(1, None), (2, "x")] and held.version() == 2
    held.replace(held.read().where("k = 2"))  # from itself
    assert held.version() == 3 and held.read().count() == 1
    with pytest.raises(ValueError):
        held.append(spark.createDataFrame([("x",)], "k string"))
    held.vacuum(1)
    assert held.version() == 3 and held.read().count() == 1 and len(names(spark, f"{held.path}/data")) == 1
    held.drop()
    assert held.read() is None


def test_partitions_of_a_table(spark, tmp_path):
    held = Table(spark, str(tmp_path / "t"), ["p", "q"])
    held.replace(spark.createDataFrame([(1, "a b", 1.5), (2, "x/y=%", 2.0), (3, None, None)], "k long, p string, q double"))
    assert held.partitions() == {("a b", "1.5"), ("x/y=%", "2.0"), (None, None)} == held.values_of(held.read())
    assert [r["k"] for r in held.read({("x/y=%", "2.0")}).collect()] == [2] and held.read(set()).count() == 0
    before = held.state().dirs
    held.replace_partitions(spark.createDataFrame([(5, "new", 0.0)], "k long, p string, q double"), {("a b", "1.5")})
    assert sorted((r["k"], r["p"], r["q"]) for r in held.read().where("k <> 3").collect()) == [(2, "x/y=%", 2.0), (5, "new", 0.0)]
    assert set(before) & set(held.state().dirs) == {d for d in before if "p=a" not in d}  # others are not written again
    held.drop_partitions(held.partitions())
    assert held.read().count() == 0 and held.read().dtypes == [("k", "bigint"), ("p", "string"), ("q", "double")]
    assert Table(spark, str(tmp_path / "t")).parts == ["p", "q"]


def test_actions_take_the_last_of_a_type(spark):
    kind = "id long, actions array<struct<action_type: string, value: string, `7d_click`: string>>"
    df = spark.createDataFrame([(1, [("a.b", "1", "5"), ("a.b", "2", None), ("c", "junk", "3")]), (2, []), (3, None)], kind)
    rows = {r["id"]: r.asDict() for r in flatten.flatten_actions(df, {"actions": ["a.b", "c", "none"]}).collect()}
    assert (rows[1]["actions_a_b"], rows[1]["actions_a_b_7d_click"], rows[1]["actions_c"], rows[1]["actions_c_7d_click"], rows[1]["actions_none"]) == (2.0, None, None, 3.0, None)
    assert set(rows[2].values()) == {2, None} and set(rows[3].values()) == {3, None} and "actions" not in rows[1]


def test_flat_events(spark):
    text = json.dumps({"ts": 20240102030405, "profile": {"name": "n", "p q": {"x": 5}}})
    df = spark.createDataFrame([(text,), ("{}",)], "record string")
    out = flatten.flatten_event(df, "record", {"name": "profile.name", "x": "profile.p q.x", "gone": "a.b"}, {"x": "int"}, F.lit("e")).collect()
    assert tuple(out[0]) == ("n", 5, "", "e", dt.datetime(2024, 1, 2, 3, 4, 5)) and tuple(out[1]) == ("", 0, "", "e", None)


def test_conform_adds_and_drops(spark):
    df = spark.createDataFrame([("1", "x")], "a string, extra string")
    out = flatten.conform(df, {"b": "float", "a": "int", "c": "str", "d": "int"})
    assert out.columns == ["b", "a", "c", "d"] and tuple(out.first()) == (None, 1, "", 0)
