"""Nested API records as flat rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import DESTINATION, at_path, cleaned, compact_timestamp, family


def flatten_event(df: DataFrame, record: str, paths: Mapping[str, str], fields: Mapping[str, str], event_name: Column, stamp_path: str = "ts") -> DataFrame:
    """Rows of JSON texts as one column a path; what is missing or empty is '' or 0.
    event_name and timestamp (from yyyyMMddHHmmss at stamp_path) are added."""
    out = []
    for name, path in paths.items():
        value = at_path(F.col(record), path)
        kind = fields.get(name, "str")
        out.append(cleaned(value, DESTINATION["string"], kind, strict=family(kind) not in ("int", "string")).alias(name))
    return df.select(*out, event_name.alias("event_name"), compact_timestamp(at_path(F.col(record), stamp_path)).alias("timestamp"))


def action_value(actions: Column, kind: str, field: str = "value") -> Column:
    """A field of the last action of a type, as a number; null if there is none."""
    last = F.try_element_at(F.filter(actions, lambda a: a["action_type"] == kind), F.lit(-1))
    return last[field].cast("string").try_cast("double")


def flatten_actions(df: DataFrame, columns: Mapping[str, Sequence[str]], windows: Sequence[str] = ("7d_click", "1d_view")) -> DataFrame:
    """Arrays of actions as declared columns <field>_<type with _ for .>, and the same with
    _<window> for each window that the actions hold. No pivot: the columns are declared.
    The arrays go."""
    out = {}
    for field, kinds in columns.items():
        held = df.schema[field].dataType.elementType.fieldNames()
        for kind in kinds:
            name = f"{field}_{kind.replace('.', '_')}"
            out[name] = action_value(F.col(field), kind)
            out |= {f"{name}_{w}": action_value(F.col(field), kind, w) for w in windows if w in held}
    return df.withColumns(out).drop(*columns)


def conform(df: DataFrame, fields: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Exactly the declared fields, in order: missing ones are null (or the lenient
    default), others are dropped, all are typed."""
    out = []
    for name, kind in fields.items():
        if name in df.columns:
            out.append(cleaned(F.col(f"`{name}`"), df.schema[name].dataType, kind, strict).alias(name))
        else:
            out.append(cleaned(F.lit(None).cast("string"), DESTINATION["string"], kind, strict).alias(name))
    return df.select(*out)
