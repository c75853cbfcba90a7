"""Streams of JSON records, routed to tables by what they hold."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.project import partition_columns, surrogate_key
from tidemark.functions.types import typed
from tidemark.operators.change import free_name
from tidemark.sources.store import Table

RECORD_KEY = "dms_pkey"


def read_kafka(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A topic as (value, topic, partition, offset); maxOffsetsPerTrigger bounds a batch."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).options(**(options or {})).load()
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_lines(spark: SparkSession, path: str, files_a_batch: int = 100) -> DataFrame:
    """Files of JSON lines as the same four columns. A file has no offsets, so a line has its
    digest there; records() tells equal lines apart by their place in the batch."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", files_a_batch).load(path)
    return raw.select("value", F.col("_metadata.file_name").alias("topic"), F.lit(0).alias("partition"), F.sha2("value", 256).alias("offset"))


def records(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """(key, value, r: the record, broken: whether the line is no JSON). Lines without an
    offset are numbered as they stand in the batch: a batch that is run again numbers
    them alike, and its files replace those of the first try."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    corrupt = free_name(kind.names, "_corrupt")
    wide = T.StructType([*kind.fields, T.StructField(corrupt, T.StringType())])
    place = [F.monotonically_increasing_id()] if isinstance(lines.schema["offset"].dataType, T.StringType) else []
    key = surrogate_key(F.col("topic"), F.col("partition"), F.col("offset"), *place).alias(RECORD_KEY)
    read = lines.select(key, "value", F.from_json("value", wide, {"columnNameOfCorruptRecord": corrupt}).alias("r"))
    return read.withColumn("broken", F.col("r").isNull() | F.col(f"r.`{corrupt}`").isNotNull())


def split(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with their key, lines that are no JSON)."""
    names = read.schema["r"].dataType.names[:-1]  # the last one holds lines that are no JSON
    return read.where(~F.col("broken")).select(RECORD_KEY, *[F.col(f"r.`{f}`").alias(f) for f in names]), read.where("broken").select(RECORD_KEY, "value")


def parsed(lines: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(records with their key, lines that are no JSON)."""
    return split(records(lines, schema))


def route_by(column: str, routes: Mapping[str, str], otherwise: str) -> Callable[[DataFrame], Column]:
    """A route by the values of one column."""
    return lambda df: reduce(lambda c, kv: c.when(F.col(column) == kv[0], kv[1]), routes.items(), F.when(F.lit(False), "")).otherwise(otherwise)


def lift_payload(names: Sequence[str], payload: str = "payload") -> Callable[[DataFrame], DataFrame]:
    """Take fields out of a JSON payload; the payload stays as text."""
    return lambda df: df.withColumns({n: F.get_json_object(payload, f"$['{n}']") for n in names})


def per_record(process: Callable[[dict], dict], schema: T.StructType | str) -> Callable[[DataFrame], DataFrame]:
    """A plain Python function of one record as a transform. It runs in Python workers over
    Arrow batches: prefer column expressions."""

    names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([process(dict(r)) for r in batch.to_dict("records")], columns=names)

    return lambda df: df.mapInPandas(run, schema)


def finished(df: DataFrame, fields: Mapping[str, str], parts: Mapping[str, str] | None, names: Mapping[str, str] | None, strict: bool = False) -> tuple[DataFrame, list[str]]:
    """Typed records with partition columns and new names, as in batch jobs."""
    out = typed(df, {**fields, RECORD_KEY: "str"}, strict)
    out, made = partition_columns(out, parts or {})
    return out.withColumnsRenamed(dict(names or {})), made


#: What may be the name of a route.
ROUTE = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"


class Router:
    """foreachBatch sink. All records go to one versioned table, `records`, with the route as its
    first partition column: a batch is one write and one version, so a reader sees all of
    its routes or none. The version holds the query's id and the batch's number: a batch that is run again
    after a failure adds nothing, and a query from another checkpoint, which counts from 0 again,
    is told apart. Records whose route is null or no name go to the table `quarantine`,
    with lines that are no JSON; its version comes first.

    Routes in `routes` are there without a record as well."""

    def __init__(self, spark: SparkSession, path: str, route: Callable[[DataFrame], Column], routes: Sequence[str], transform: Callable[[DataFrame], DataFrame] | None, fields: Mapping[str, str], parts: Mapping[str, str] | None = None, names: Mapping[str, str] | None = None):
        self.path, self.route, self.routes, self.transform = path.rstrip("/"), route, list(routes), transform
        self.fields, self.parts, self.names = fields, parts, names
        self.records, self.quarantine = Table(spark, f"{self.path}/records"), Table(spark, f"{self.path}/quarantine", ["kind"])

    def transaction(self, spark: SparkSession, number: int) -> tuple[str, int]:
        return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch", number

    def __call__(self, batch: DataFrame, number: int, bad: DataFrame | None = None) -> None:
        """Records with their key, and lines that are no JSON (key, value)."""
        once = self.transaction(batch.sparkSession, number)
        if self.records.done(once):
            return
        own = free_name([*batch.columns, *self.fields], "route")
        routed = batch.withColumn(own, self.route(batch))
        fits = F.coalesce(F.col(own).rlike(ROUTE), F.lit(False))
        text = F.to_json(F.struct(*[f"`{c}`" for c in batch.columns if c != RECORD_KEY]))
        lost = routed.where(~fits).select(RECORD_KEY, text.alias("value"), F.col(own).alias("route"), F.lit("routes").alias("kind"))
        if bad is not None:
            lost = lost.unionByName(bad.select(RECORD_KEY, "value", F.lit(None).cast("string").alias("route"), F.lit("lines").alias("kind")))
        self.quarantine.append(lost, once)
        out, made = finished(self.transformed(routed.where(fits), own), {**self.fields, own: "str"}, self.parts, self.names)
        if not self.records.exists():
            self.records.wanted = [own, *made]
        self.records.append(out, once)

    def transformed(self, routed: DataFrame, own: str) -> DataFrame:
        """The records through the transform, with their route. A transform that hands on columns it
        doesn't know works on all routes at once; one with a fixed result on one after another."""
        if self.transform is None:
            return routed
        out = self.transform(routed)
        if own in out.columns:
            return out
        named = sorted(r[0] for r in routed.select(own).distinct().collect())  # one row a route
        each = lambda r: self.transform(routed.where(F.col(own) == r).drop(own)).withColumn(own, F.lit(r))
        return reduce(DataFrame.unionByName, [each(r) for r in named]) if named else self.transform(routed.drop(own)).withColumn(own, F.lit(None).cast("string"))

    def read(self, route: str, version: int | None = None) -> DataFrame:
        """The records of a route, without the column that names it."""
        held = self.records.state(version)
        if held is None:
            raise ValueError("no batch was written yet")
        own = {held.values(d) for d in held.dirs if held.values(d)[0] == route}
        if not own and route not in self.routes:
            raise ValueError(f"no route {route}")
        return self.records.read(own, held.number).drop(held.parts[0])

    def set_aside(self, kind: str) -> DataFrame:
        """What no route has: 'routes' or 'lines'."""
        return self.quarantine.read({(kind,)}).drop("kind")


def run_router(lines: DataFrame, schema: T.StructType | str, sink: Router, checkpoint: str, trigger: Mapping[str, object] | None = None):
    """Start the stream; with no trigger it takes what is there and ends. A batch is parsed once."""

    def both(batch: DataFrame, number: int) -> None:
        read = records(batch, schema).persist()
        try:
            good, bad = split(read)
            sink(good, number, bad)
        finally:
            read.unpersist()

    return lines.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
