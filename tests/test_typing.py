import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import project, types


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], T.StructType([T.StructField("v", kind)])).select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("12", 12), ("12.7", 12), ("-12.7", -12), ("1e3", 1000), ("9007199254740993", 9007199254740993), ("", None), ("nan", None), ("inf", None), ("junk", None), (None, None), (" 5 ", 5)],
)
def test_to_int(spark, text, want):
    got = one(spark, text, T.StringType(), types.to_int)
    assert got == want or (want is None and got in (None,)), got


@pytest.mark.parametrize(("text", "want"), [("1.5", 1.5), ("1e3", 1000.0), ("junk", None), ("", None), (None, None)])
def test_to_float(spark, text, want):
    assert one(spark, text, T.StringType(), types.to_float) == want


@pytest.mark.parametrize(("text", "want"), [("TRUE", True), ("y", True), ("1", True), ("2", False), ("", False), (None, None)])
def test_to_bool(spark, text, want):
    assert one(spark, text, T.StringType(), types.to_bool) is want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-01-02", dt.datetime(2024, 1, 2)),
        ("2024/01/02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("20240102030405", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("20240102", dt.datetime(2024, 1, 2)),
        ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05+05:30", dt.datetime(2024, 1, 1, 21, 34, 5)),
        ("2024-01-02T03:04:05.25-0030", dt.datetime(2024, 1, 2, 3, 34, 5, 250000)),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_text_times(spark, text, want):
    assert one(spark, text, T.StringType(), lambda c: types.to_utc(c, T.StringType())) == want


def test_local_times_over_a_clock_change(spark):
    zone = lambda c: types.to_utc(c, T.TimestampNTZType(), "Europe/Berlin")
    assert one(spark, dt.datetime(2024, 3, 30, 12), T.TimestampNTZType(), zone) == dt.datetime(2024, 3, 30, 11)
    assert one(spark, dt.datetime(2024, 3, 31, 12), T.TimestampNTZType(), zone) == dt.datetime(2024, 3, 31, 10)


def test_epoch_seconds(spark):
    assert one(spark, 86400.5, T.DoubleType(), lambda c: types.to_utc(c, T.DoubleType())) == dt.datetime(1970, 1, 2, 0, 0, 0, 500000)


def test_families():
    assert [types.family(x) for x in ("int4range", "interval", "int8", "ARRAY", "jsonb", "daterange", "timestamptz", "decimal(3)", "money", "cidr")] == [
        "range", "interval", "int", "json", "json", "range", "timestamp", "float", "float", "string",
    ]


def test_lenient_and_strict_nulls(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i string, f string, b string")
    fields = {"s": "text", "i": "int", "f": "float", "b": "boolean"}
    assert types.typed(df, fields).first().asDict() == {"b": False, "f": None, "i": 0, "s": ""}
    assert types.typed(df, fields, strict=True).first().asDict() == {"b": None, "f": None, "i": None, "s": None}


def test_ranges(spark):
    kind = T.StructType.fromDDL("lower long, upper long, lower_inc boolean, upper_inc boolean, is_empty boolean")
    for value, want in [((1, 5, True, False, False), "[1, 5)"), ((None, 5, True, True, False), "(None, 5]"), ((1, 5, True, True, True), ""), (None, None)]:
        assert one(spark, value, kind, types.range_text) == want


@pytest.mark.parametrize(("text", "n", "want"), [("abcdef", 2, "abcdXX"), ("ab", 5, "XXXXX"), ("ab", 0, "ab"), (None, 2, "XX"), ("", 0, "")])
def test_mask_text(spark, text, n, want):
    assert one(spark, text, T.StringType(), lambda c: project.mask_text(c, n)) == want


@pytest.mark.parametrize(("x", "n", "want"), [(1234, 2, 1200), (-1234, 2, -1300), (5, 3, 0), (None, 2, 0), (77, 0, 77)])
def test_mask_digits(spark, x, n, want):
    assert one(spark, x, T.LongType(), lambda c: project.mask_digits(c, n)) == want


def test_masks_refuse_other_types(spark):
    with pytest.raises(TypeError):
        project.masked(spark.range(1).select(F.lit(1.5).alias("x")), [("x", 1)])


def test_lower_names_refuse_collisions(spark):
    df = spark.range(1).select(F.lit(1).alias("A"), F.lit(2).alias("b"))
    assert project.lower_names(df).columns == ["a", "b"]
    with pytest.raises(ValueError):
        project.lower_names(spark.range(1).toDF("a").withColumnRenamed("a", "A").join(spark.range(1).toDF("a"), F.lit(True)))


def test_table_path():
    assert project.table_path("/w/", "pgsql", "my.db-1", "a.b", "_logs") == "/w/pgsql/my_db_1/a_b_logs"


def test_json_path(spark):
    text = '{"a": {"b c": {"d": 1}}, "x": null}'
    assert one(spark, text, T.StringType(), lambda c: types.at_path(c, "a.b c.d")) == "1"
    assert one(spark, text, T.StringType(), lambda c: types.at_path(c, "a.q.d")) is None
