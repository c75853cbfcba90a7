"""What runs leave for the next one: times, keys, recovery points, and their statistics.

Each is a small file, written by the file system without a job, and the last one counts.
States are written after the data, so a run that dies between the two is done again.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import observed
from tidemark.operators.select import EPOCH, Watermark
from tidemark.sources.scratch import create_text, names, read_text, remove

#: The fields of a run's statistics, by their names in the job log.
STATISTICS = (
    "job_id string, table_name string, insertions long, updations long, total_records long, start_time string, "
    "total_time double, curr_megabytes_processed double, total_megabytes double, status boolean"
)
#: States of a job that are kept, and runs after which a hash state is compacted.
KEPT, MOST_RUNS = 20, 200


def packed(key: Any) -> str | None:
    """A key as JSON; a time is told from a text."""
    if key is None or isinstance(key, (int, float, str)):
        return None if key is None else json.dumps(key)
    return json.dumps({"time": key.isoformat(sep=" ")}) if isinstance(key, dt.datetime) else json.dumps(str(key))


def unpacked(text: str | None) -> Any:
    key = None if text is None else json.loads(text)
    return dt.datetime.fromisoformat(key["time"]) if isinstance(key, dict) else key


class Files:
    """Numbered small files, a folder of them for each job."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def folder(self, job: str) -> str:
        return f"{self.path}/" + re.sub(r"[^A-Za-z0-9-]", lambda m: f"_{ord(m[0]):x}_", job)

    def numbers(self, job: str) -> list[int]:
        found = [n.removesuffix(".json") for n in names(self.spark, self.folder(job))]
        return sorted(int(n) for n in found if n.isdigit())

    def last(self, job: str) -> dict | None:
        found = self.numbers(job)
        return json.loads(read_text(self.spark, f"{self.folder(job)}/{found[-1]:08d}.json")) if found else None

    def add(self, job: str, values: Mapping[str, Any], keep: int | None = None) -> None:
        text = json.dumps(dict(values))
        while True:
            found = self.numbers(job)
            if create_text(self.spark, f"{self.folder(job)}/{(found[-1] if found else 0) + 1:08d}.json", text):
                break
        for old in found[:-keep] if keep else ():
            remove(self.spark, f"{self.folder(job)}/{old:08d}.json")


class StateLog:
    def __init__(self, spark: SparkSession, path: str):
        self.files = Files(spark, path)

    def get(self, job: str) -> Watermark:
        """The job's watermark; keys come back as they were put. A job without one starts
        from EPOCH and no key."""
        held = self.files.last(job)
        if held is None:
            return Watermark()
        return Watermark(held["last_run"] or EPOCH, unpacked(held["last_key"]), unpacked(held["recovery_key"]), held["recovery_time"])

    def _put(self, job: str, mark: Watermark) -> None:
        time = lambda x: None if x is None else str(x)
        values = {"job": job, "last_run": time(mark.last_run), "last_key": packed(mark.last_key), "recovery_key": packed(mark.recovery_key), "recovery_time": time(mark.recovery_time)}
        self.files.add(job, values, KEPT)

    def commit(self, job: str, run_at: object, last_key: object) -> None:
        """After the data: the new watermark; the recovery point is gone."""
        self._put(job, Watermark(str(run_at), self.get(job).last_key if last_key is None else last_key))

    def mark_recovery(self, job: str, key: object, at: object) -> None:
        """Before an insert: from when and up to where rows may be half moved. The earliest
        time is kept until a run commits."""
        before = self.get(job)
        first = min(str(at), str(before.recovery_time)) if before.recovery_time else str(at)
        self._put(job, Watermark(before.last_run, before.last_key, key, first))

    def reset(self, job: str) -> None:
        self._put(job, Watermark())


class JobLog:
    """One row of statistics for each run."""

    def __init__(self, spark: SparkSession, path: str):
        self.files = Files(spark, path)

    def put(self, stats: Mapping[str, Any]) -> None:
        self.files.add(stats["job_id"], {f.split()[0]: stats[f.split()[0]] for f in STATISTICS.split(", ")})

    def last(self, job: str) -> dict | None:
        """The job's last row, without a job of Spark's."""
        return self.files.last(job)

    def read(self) -> DataFrame:
        """All rows of all jobs."""
        spark = self.files.spark
        if not names(spark, self.files.path):
            return spark.createDataFrame([], STATISTICS)
        return spark.read.schema(STATISTICS).option("recursiveFileLookup", "true").json(self.files.path)


class HashState:
    """The row hashes by which a sync without a bookmark finds changes: (map_id, sha).

    They lie in buckets of the key's hash, as Spark's bucketed tables do, so a join with them
    shuffles the other side alone. A run writes the hashes of what it moved, and nothing else: the last
    one of a key counts, and one without a hash says that the key is gone. When what was
    written so has grown beyond the state itself, the state is written anew (compacted).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.files = Files(spark, path)

    def _held(self) -> dict | None:
        return self.files.last("log")

    def exists(self) -> bool:
        return self._held() is not None

    def _table(self, held: Mapping[str, Any]) -> str:
        """The bucketed table of the state's folder, known to the session's catalogue."""
        place = f"{self.path}/{held['folder']}"
        name = f"tidemark_hashes_{held['folder'].rsplit('-', 1)[-1]}"
        if not self.spark.catalog.tableExists(name):
            own = place.replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {name} (map_id STRING, sha STRING, seq BIGINT) USING parquet CLUSTERED BY (map_id) INTO {held['buckets']} BUCKETS LOCATION '{own}'")
        return name

    def read(self) -> DataFrame | None:
        """The current hashes, a row a key."""
        held = self._held()
        if held is None:
            return None
        self.spark.catalog.refreshTable(self._table(held))
        rows = self.spark.table(self._table(held)).where(F.col("seq").isin(held["seqs"]))  # what a lost run left counts for nothing
        last = rows.groupBy("map_id").agg(F.max_by("sha", F.struct("seq", F.coalesce("sha", F.lit("")))).alias("sha"))
        return last.where("sha is not null")

    def written(self) -> DataFrame:
        """(seq, n): how many hashes each run wrote that the state still holds."""
        held = self._held()
        self.spark.catalog.refreshTable(self._table(held))
        return self.spark.table(self._table(held)).where(F.col("seq").isin(held["seqs"])).groupBy("seq").agg(F.count(F.lit(1)).alias("n"))

    def put(self, rows: DataFrame) -> None:
        """Take over (map_id, sha) of what was moved; a null sha takes a key out. Null keys leave no trace."""
        held = self._held()
        if held is None:
            return self.replace(rows)
        seq = max(held["seqs"][-1] + 1, time.time_ns() // 1000)
        n = self._add(rows, held, seq)
        if n:
            self.files.add("log", {**held, "seqs": [*held["seqs"], seq], "later": held["later"] + n}, KEPT)
        if held["later"] + n > held["n"] or len(held["seqs"]) > MOST_RUNS:
            self.compact()

    def _add(self, rows: DataFrame, held: Mapping[str, Any], seq: int) -> int:
        own = rows.where("map_id is not null").select("map_id", "sha", F.lit(seq).cast("long").alias("seq"))
        seen, counts = observed(own.repartition(held["buckets"], "map_id"), f"hashes-{held['folder']}-{seq}")
        seen.write.mode("append").insertInto(self._table(held))
        return counts.get["n"]

    def replace(self, rows: DataFrame) -> None:
        """These hashes instead of all; those before stay where they are until the new ones are whole."""
        before, seq = self._held(), time.time_ns() // 1000
        fresh = {"folder": f"hashes-{uuid.uuid4().hex}", "buckets": self.buckets, "seqs": [seq], "later": 0}
        fresh["n"] = self._add(rows, fresh, seq)
        self.files.add("log", fresh, KEPT)
        if before:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(before)}")
            remove(self.spark, f"{self.path}/{before['folder']}")

    def compact(self) -> None:
        """One hash a key, in new buckets."""
        self.replace(self.read())
