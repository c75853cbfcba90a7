import json

from pyspark.sql import functions as F

from tidemark.streaming import router

SCHEMA = "type string, user_id string, date string, payload string"


def put(path, name, records):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def record(i, kind="a"):
    return {"type": kind, "user_id": str(i), "date": f"2024-01-0{i % 3 + 1}T00:00:00", "payload": json.dumps({"name": f"n{i}"})}


def sink(spark, tmp_path, transform=None):
    return router.Router(spark, str(tmp_path / "out"), router.route_by("type", {"a": "first"}, "rest"), ["first", "rest"], transform or router.lift_payload(["name"]), {"user_id": "int", "date": "datetime"}, {"date": "datetime"}, {"date": "created_at"})


def run(spark, tmp_path, to):
    router.run_router(router.read_lines(spark, str(tmp_path / "in")), SCHEMA, to, str(tmp_path / "check")).awaitTermination()


def test_restart_takes_only_new_files(spark, tmp_path):
    put(tmp_path / "in", "1.json", [record(1), record(2, "b"), "no json {"])
    run(spark, tmp_path, sink(spark, tmp_path))
    put(tmp_path / "in", "2.json", [record(3), record(4, "c")])
    run(spark, tmp_path, sink(spark, tmp_path))
    first, rest = (sink(spark, tmp_path).read(n) for n in ("first", "rest"))
    assert sorted(r["user_id"] for r in first.collect()) == [1, 3]
    assert sorted(r["name"] for r in rest.collect()) == ["n2", "n4"]
    assert "created_at" in first.columns and first.select(router.RECORD_KEY).distinct().count() == 2
    assert sink(spark, tmp_path).set_aside("lines").select("value").first()[0] == "no json {"


def test_a_batch_run_again_leaves_the_same_rows(spark, tmp_path):
    lines = spark.createDataFrame([(json.dumps(record(i)), "t", 0, i) for i in range(6)], "value string, topic string, partition int, offset long")
    good, bad = router.parsed(lines, SCHEMA)
    to = sink(spark, tmp_path)
    for _ in range(2):
        to(good, 0)
    out = to.read("first")
    assert to.records.version() == 1
    assert out.count() == 6 and bad.count() == 0 and out.select(router.RECORD_KEY).distinct().count() == 6


def test_plain_python_transform(spark, tmp_path):
    shape = "dms_pkey string, type string, user_id string, date string, payload string, _route string"
    lines = spark.createDataFrame([(json.dumps(record(1)), "t", 0, 1)], "value string, topic string, partition int, offset long")
    upper = router.per_record(lambda r: {**r, "payload": r["payload"].upper()}, shape.replace(", _route string", ""))
    to = sink(spark, tmp_path, upper)
    to(router.parsed(lines, SCHEMA)[0], 0)
    assert to.read("first").select(F.col("payload")).first()[0] == '{"NAME": "N1"}'


def test_no_record_is_lost(spark, tmp_path):
    """Routes in no list get a table; those without a name for one are set aside with their route."""
    put(tmp_path / "in", "1.json", [record(1), record(2, "b"), record(3, "c"), record(4, "../up"), record(5, None), record(6, "_odd")])
    to = router.Router(spark, str(tmp_path / "out"), lambda df: F.col("type"), ["a", "idle"], router.lift_payload(["name"]), {"user_id": "int", "date": "datetime"})
    run(spark, tmp_path, to)
    read = lambda n: sorted(r["user_id"] for r in to.read(n).collect())
    assert (read("a"), read("b"), read("c"), read("idle")) == ([1], [2], [3], [])
    lost = to.set_aside("routes").collect()
    assert sorted((r["route"] or "", json.loads(r["value"])["user_id"]) for r in lost) == [("", "5"), ("../up", "4"), ("_odd", "6")]


def test_another_checkpoint_keeps_what_is_there(spark, tmp_path):
    put(tmp_path / "in", "1.json", [record(i) for i in range(3)])
    run(spark, tmp_path, sink(spark, tmp_path))
    (tmp_path / "in" / "1.json").rename(tmp_path / "old.json")
    put(tmp_path / "in", "2.json", [record(9)])
    router.run_router(router.read_lines(spark, str(tmp_path / "in")), SCHEMA, sink(spark, tmp_path), str(tmp_path / "new-check")).awaitTermination()
    assert sorted(r["user_id"] for r in sink(spark, tmp_path).read("first").collect()) == [0, 1, 2, 9]


def test_equal_lines_have_keys_of_their_own(spark, tmp_path):
    put(tmp_path / "in", "1.json", [record(1)] * 3 + [record(2)])
    run(spark, tmp_path, sink(spark, tmp_path))
    out = sink(spark, tmp_path).read("first")
    assert out.count() == 4 and out.select(router.RECORD_KEY).distinct().count() == 4


def test_a_reader_never_sees_half_a_batch(spark, tmp_path, monkeypatch):
    """Read while a batch is written: all of its routes or none; a batch that died is one version when it
    runs again, with what was set aside once."""
    batch = lambda n: router.parsed(spark.createDataFrame([(json.dumps(record(i, k)), "t", 0, 10 * n + i) for i, k in enumerate("abcb")], "value string, topic string, partition int, offset long"), SCHEMA)[0]
    to = router.Router(spark, str(tmp_path / "out"), lambda df: F.when(F.col("type") != "c", F.col("type")), ["a", "b"], None, {"user_id": "int"})
    counts = lambda: (to.read("a").count(), to.read("b").count(), to.set_aside("routes").count())
    to(batch(0), 0)
    assert counts() == (1, 2, 1)
    plain, seen = type(to.records)._commit, []

    def dies(self, *a, **how):
        seen.append(counts())
        if self is to.records and len(seen) == 2:
            raise RuntimeError("lost before the version")
        return plain(self, *a, **how)

    monkeypatch.setattr(type(to.records), "_commit", dies)
    try:
        to(batch(1), 1)
    except RuntimeError:
        pass
    assert seen[:2] == [(1, 2, 1), (1, 2, 2)] and to.read("b").count() == 2
    to(batch(1), 1)
    assert counts() == (2, 4, 2) and to.records.version() == 2 and to.read("a", 1).count() == 1


def test_fields_may_have_any_name(spark, tmp_path):
    put(tmp_path / "in", "1.json", [{"type": "a", "route": "r", "_route": "s", "_corrupt": "t", "_CORRUPT_": "u"}, "no json"])
    to = router.Router(spark, str(tmp_path / "out"), lambda df: F.col("type"), [], None, {})
    router.run_router(router.read_lines(spark, str(tmp_path / "in")), "type string, route string, _route string, _corrupt string, _CORRUPT_ string", to, str(tmp_path / "check")).awaitTermination()
    assert {k: v for k, v in to.read("a").first().asDict().items() if k != router.RECORD_KEY} == {"type": "a", "route": "r", "_route": "s", "_corrupt": "t", "_CORRUPT_": "u"}
    assert to.set_aside("lines").count() == 1
