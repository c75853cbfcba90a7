"""The typing rules and masks as SQL functions, for users' own queries.

Each has a SQL body, so the optimiser inlines it: a query that calls one has the plan of the
expressions that it stands for, and no row goes to Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.types import TRUE_WORDS

WORDS = ", ".join(f"'{w}'" for w in TRUE_WORDS)
RANGE = "STRUCT<lower: STRING, upper: STRING, lower_inc: BOOLEAN, upper_inc: BOOLEAN, is_empty: BOOLEAN>"
INT = "coalesce(try_cast(trim(x) AS BIGINT), try_cast(try_cast(trim(x) AS DOUBLE) AS BIGINT))"

#: (name, parameters, result, body); x is the value.
FUNCTIONS = (
    ("strict_int", "x STRING", "BIGINT", INT),
    ("lenient_int", "x STRING", "BIGINT", f"coalesce({INT}, 0L)"),
    ("lenient_float", "x STRING", "DOUBLE", "try_cast(trim(x) AS DOUBLE)"),
    ("strict_bool", "x STRING", "BOOLEAN", f"lower(trim(x)) IN ({WORDS})"),
    ("lenient_bool", "x STRING", "BOOLEAN", f"coalesce(lower(trim(x)) IN ({WORDS}), false)"),
    ("lenient_text", "x STRING", "STRING", "coalesce(x, '')"),
    ("mask_text", "x STRING, n INT", "STRING", "concat(left(coalesce(x, ''), greatest(char_length(coalesce(x, '')) - n, 0)), repeat('X', n))"),
    ("mask_digits", "x BIGINT, n INT", "BIGINT", "coalesce(x, 0L) - pmod(coalesce(x, 0L), cast(power(10, n) AS BIGINT))"),
    (
        "range_text", f"x {RANGE}", "STRING",
        "CASE WHEN x IS NULL THEN NULL WHEN x.is_empty THEN '' ELSE concat(CASE WHEN x.lower IS NOT NULL AND x.lower_inc THEN '[' ELSE '(' END, coalesce(x.lower, 'None'), ', ', "
        "coalesce(x.upper, 'None'), CASE WHEN x.upper IS NOT NULL AND x.upper_inc THEN ']' ELSE ')' END) END",
    ),
)


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; their names. A function of such a name that is
    known already, also a user's own, stays."""
    for name, parameters, result, body in FUNCTIONS:
        if not spark.catalog.functionExists(name):
            spark.sql(f"CREATE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [f[0] for f in FUNCTIONS]
