"""Typing and cleaning: one column expression for each declared field.

Timestamps come out as TIMESTAMP_NTZ holding UTC, so results don't hang on the
session's time zone. The lenient rules fill nulls (text '', int 0, bool false); the
strict ones keep them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type names by family; other names that begin so are taken the same way.
INTS = frozenset("int integer bigint smallint bigserial smallserial serial".split())
FLOATS = frozenset(("float", "double", "double precision", "real", "money"))
TRUE_WORDS = ("true", "1", "t", "y", "yes")
DESTINATION = {
    "string": T.StringType(), "json": T.StringType(), "range": T.StringType(), "interval": T.StringType(),
    "int": T.LongType(), "float": T.DoubleType(), "bool": T.BooleanType(), "timestamp": T.TimestampNTZType(),
}


def family(name: str) -> str:
    """The family of a source type name: string, int, float, bool, timestamp, json,
    range or interval. Ranges and intervals go before names that begin with int."""
    n = name.lower().strip()
    if "range" in n:
        return "range"
    if n.startswith("interval"):
        return "interval"
    if n in ("json", "jsonb") or n.startswith("arr"):
        return "json"
    if n == "datetime" or n.startswith(("timestamp", "date")):
        return "timestamp"
    if n in ("bool", "boolean"):
        return "bool"
    if n in INTS or n.startswith(("int", "serial")):
        return "int"
    if n in FLOATS or n.startswith(("numeric", "decimal", "float")):
        return "float"
    return "string"


def destination_schema(fields: Mapping[str, str]) -> T.StructType:
    """Declared source types as a destination schema."""
    return T.StructType([T.StructField(k, DESTINATION[family(v)]) for k, v in fields.items()])


def to_bool(c: Column) -> Column:
    """True for the words that mean it, false for any other; null stays null."""
    return F.lower(F.trim(c.cast("string"))).isin(*TRUE_WORDS)


def to_int(c: Column) -> Column:
    """Exact where the text is a whole number, else cut through double; junk is null."""
    text = F.trim(c.cast("string"))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def to_float(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def to_utc(c: Column, kind: T.DataType, zone: str = "UTC", text_zone: str = "UTC") -> Column:
    """Any time as UTC: naive times are local to `zone`, numbers are epoch seconds,
    texts are ISO, yyyy/MM/dd[ HH:mm:ss] or yyyyMMdd[HHmmss], with their own offset or
    in `text_zone`; junk is null."""
    if isinstance(kind, T.TimestampNTZType):
        return c if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), c)
    if isinstance(kind, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    if isinstance(kind, T.DateType):
        return to_utc(c.cast("timestamp_ntz"), T.TimestampNTZType(), zone)
    if isinstance(kind, T.NumericType):
        million = F.lit(1_000_000).cast("bigint")  # 32 bits can't hold the microseconds of a time
        micros = F.try_multiply(c.cast("bigint"), million) if isinstance(kind, T.IntegralType) else (c.cast("double") * 1e6 if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else F.try_multiply(c, million)).try_cast("bigint")
        return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
    text = F.trim(c.cast("string"))
    text = F.regexp_replace(text, r"^(\d{4})/(\d\d)/(\d\d)", "$1-$2-$3")
    text = F.regexp_replace(text, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    text = F.regexp_replace(text, r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3")
    offset = F.regexp_extract(text, r"\d\d:\d\d.*?([+-]\d\d):?(\d\d)$", 0)
    zoned = offset != ""
    hours, minutes = (F.regexp_extract(text, r"([+-]\d\d):?(\d\d)$", i).try_cast("int") for i in (1, 2))
    sign = F.when(F.regexp_extract(text, r"([+-])\d\d:?\d\d$", 1) == "-", -1).otherwise(1)
    bare = F.regexp_replace(text, r"(?<=\d\d:\d\d.{0,12})(Z|[+-]\d\d:?\d\d)$", "").try_cast("timestamp_ntz")
    moved = F.timestamp_add("MINUTE", -(hours * 60 + sign * minutes), bare)
    naive = bare if text_zone == "UTC" else F.when(text.endswith("Z"), bare).otherwise(F.convert_timezone(F.lit(text_zone), F.lit("UTC"), bare))
    return F.when(zoned, moved).otherwise(naive)


def range_text(c: Column) -> Column:
    """A struct (lower, upper, lower_inc, upper_inc, is_empty) as '[lo, hi)'; an open side
    is None, an empty range ''."""
    side = lambda x: F.coalesce(x.cast("string"), F.lit("None"))
    opens = F.when(c["lower"].isNotNull() & c["lower_inc"], "[").otherwise("(")
    closes = F.when(c["upper"].isNotNull() & c["upper_inc"], "]").otherwise(")")
    shown = F.concat(opens, side(c["lower"]), F.lit(", "), side(c["upper"]), closes)
    return F.when(c.isNotNull(), F.when(c["is_empty"], "").otherwise(shown))


def json_text(c: Column, kind: T.DataType) -> Column:
    """Nested values as JSON text; other values as they are."""
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(c, {"ignoreNullFields": "false"}) if nested else c.cast("string")


def cleaned(c: Column, kind: T.DataType, name: str, strict: bool = False, zone: str = "UTC") -> Column:
    """One field by the name of its source type."""
    of = family(name)
    if of == "int":  # a column that has the type already is not printed and read again
        whole = c.try_cast("bigint") if isinstance(kind, T.NumericType) else to_int(c)
        return whole if strict else F.coalesce(whole, F.lit(0).cast("bigint"))
    if of == "float":
        return c.cast("double") if isinstance(kind, T.NumericType) else to_float(c)
    if of == "bool":
        true = c if isinstance(kind, T.BooleanType) else to_bool(c)
        return true if strict else F.coalesce(true, F.lit(False))
    if of == "timestamp":
        return to_utc(c, kind, zone)
    text = range_text(c) if of == "range" and isinstance(kind, T.StructType) else json_text(c, kind)
    return text if strict else F.coalesce(text, F.lit(""))


def typed(df: DataFrame, fields: Mapping[str, str], strict: bool = False, zone: str = "UTC", keep: Sequence[str] = ()) -> DataFrame:
    """All columns typed in one projection and sorted by name; columns that aren't
    declared become text. Those to keep stay as they are."""
    own = lambda c: F.col(f"`{c}`") if c in keep else cleaned(F.col(f"`{c}`"), df.schema[c].dataType, fields.get(c, "string"), strict, zone)
    return df.select(*[own(c).alias(c) for c in sorted(df.columns)])


def conform_documents(df: DataFrame, fields: Mapping[str, str], zone: str = "UTC", stamp: str = "yyyy/MM/dd'T'HH:mm:ss") -> DataFrame:
    """Documents by declared fields: lists and objects are JSON text, undeclared times
    are texts in one format, other undeclared values are texts; declared fields that are
    missing are added (int 0, bool false, else null)."""
    out = {}
    for c in df.columns:
        kind, col = df.schema[c].dataType, F.col(f"`{c}`")
        of = family(fields[c]) if c in fields else None
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            out[c] = F.to_json(col)
        elif of in ("int", "bool"):
            out[c] = cleaned(col, kind, fields[c])
        elif of in ("float", "timestamp"):
            out[c] = cleaned(col, kind, fields[c], True, zone)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            out[c] = F.date_format(to_utc(col, kind, zone), stamp)
        else:
            out[c] = col.cast("string")
    for c, name in fields.items():
        if c not in out:
            of = family(name)
            default = F.lit(0) if of == "int" else F.lit(False) if of == "bool" else F.lit(None)
            out[c] = default.cast(DESTINATION[of])
    return df.select(*[out[c].alias(c) for c in sorted(out)])


def compact_timestamp(c: Column) -> Column:
    """A number or text yyyyMMddHHmmss as a time."""
    return to_utc(c.cast("string"), T.StringType())


def date_number(c: Column) -> Column:
    """A time as the whole number yyyyMMdd."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def at_path(c: Column, path: str, text: bool = True) -> Column:
    """The value at a dotted path, null where any step is missing; steps may hold spaces.
    JSON text is searched; of a struct, fields are taken."""
    steps = path.split(".")
    if text:
        return F.get_json_object(c, "$" + "".join(f"['{s}']" for s in steps))
    for s in steps:
        c = c.getField(s)
    return c


#: Types by how much they hold; a type goes into a later one of its own row.
WIDER = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds values of both; None if there is none."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        for row in WIDER:
            if x in row and y in row and row.index(x) < row.index(y):
                return y
    return T.DoubleType() if {a, b} <= {*WIDER[0], *WIDER[1]} else None
