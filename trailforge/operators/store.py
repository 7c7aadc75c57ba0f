"""A write-once, content-addressed table of results, an event log, run manifests, resume and verification."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import IdempotencyError, StoreError
from ..functions.text import canonical
from ..schemas import STAGES

KEY = "^[0-9a-f]{64}$"
OBJECTS = "key string, stage string, payload string"


def conflicts(rows: DataFrame) -> DataFrame:
    """key, versions: keys with more than one content."""
    per = rows.groupBy("key", F.sha2("payload", 256).alias("content")).agg(F.lit(1).alias("x"))
    return per.groupBy("key").agg(F.count("*").alias("versions")).where("versions > 1")


def pending(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests whose key has no stored result: what a resumed run has yet to compute."""
    return requests.join(stored.select("key"), "key", "left_anti")


def reused(requests: DataFrame, stored: DataFrame) -> DataFrame:
    return requests.join(stored.select("key", "payload"), "key")


def stage_stats(events: DataFrame) -> DataFrame:
    """stage, n: completed events per stage; the known stages are always there, others are added."""
    counted = events.where("event = 'completed'").groupBy("stage").agg(F.count("*").alias("n"))
    known = events.sparkSession.createDataFrame([(s,) for s in STAGES], "stage string")
    return F.broadcast(known).join(counted, "stage", "full").select("stage", F.coalesce("n", F.lit(0)).alias("n"))


def completed_keys(events: DataFrame, stage: str | None = None) -> DataFrame:
    rows = events.where("event = 'completed'")
    return (rows.where(F.col("stage") == stage) if stage else rows).select("key").distinct()


def verify(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """key, problem: recomputed results that are missing in the store or differ. Both: key, payload."""
    met = recomputed.select("key", F.col("payload").alias("new")).join(stored.select("key", F.col("payload").alias("old")), "key", "left")
    return met.where(~F.col("new").eqNullSafe(F.col("old"))).select("key", F.when(F.col("old").isNull(), "missing").otherwise("different").alias("problem"))


class ResultStore:
    """Results as Parquet below root/objects, events as JSON lines below root/events, manifests below root/runs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def objects(self) -> DataFrame:
        """All results stored by now. The batches are named one by one: Spark takes two scans of one folder for the same,
        even where files came in between, and would then reuse the older one inside a plan."""
        fs, path = self._fs(f"{self.root}/objects")
        batches = sorted(x.getPath().toString() for x in fs.listStatus(path)) if fs.exists(path) else []
        return self.spark.read.schema(OBJECTS).parquet(*batches) if batches else self.spark.createDataFrame([], OBJECTS)

    def put(self, rows: DataFrame, strict: bool = False) -> int:
        """One driver at a time writes a store: the check and the append are two steps.

        Store new rows (key, stage, payload); an equal one is left alone (or refused, if strict), a different one is an
        error, and then nothing is stored. Returns the number stored. The rows are computed once, into a staging
        folder; one anti-join and one append follow."""
        fs, staging = self._fs(f"{self.root}/staging/{uuid.uuid4().hex}")
        rows.select("key", "stage", "payload").write.parquet(staging.toString())
        try:
            rows = self.spark.read.schema(OBJECTS).parquet(staging.toString())
            if not rows.where(~F.col("key").rlike(KEY) | F.col("key").isNull()).isEmpty():
                raise StoreError("a key is 64 lower-case hexadecimal digits")
            old = self.objects()
            same = rows.join(old.select("key", F.col("payload").alias("old")), "key")
            if not conflicts(rows).isEmpty() or not same.where("not (payload <=> old)").isEmpty():
                raise IdempotencyError("a key is stored with other content")
            if strict and not same.isEmpty():
                raise IdempotencyError("a key is stored already")
            new = pending(rows, old).dropDuplicates(["key"])
            if new.isEmpty():
                return 0
            batch = f"{self.root}/objects/batch-{uuid.uuid4().hex}"
            new.write.parquet(batch)
            return self.spark.read.schema(OBJECTS).parquet(batch).count()
        finally:
            fs.delete(staging, True)

    def step(self, rows: DataFrame) -> DataFrame:
        """rows, written below root/steps and read back: what a run has come to, so that a later step doesn't begin before it.
        Steps go with the application; the results proper are objects."""
        fs, path = self._fs(f"{self.root}/steps/{uuid.uuid4().hex}")
        rows.write.parquet(path.toString())
        fs.deleteOnExit(path)
        return self.spark.read.schema(rows.schema).parquet(path.toString())

    def get(self, key: str) -> dict | None:
        if not re.match(KEY, key):
            raise StoreError("a key is 64 lower-case hexadecimal digits")
        found = self.objects().where(F.col("key") == key).head()
        if found is None:
            return None
        try:
            return json.loads(found.payload)
        except ValueError as e:
            raise StoreError(f"the object {key[:16]} is corrupt") from e

    def has(self, key: str) -> bool:
        return self.get(key) is not None

    # events

    def append_events(self, run_id: str, events: DataFrame) -> None:
        """events: event, stage, key, turn; committed whole by Spark's writer, so that no line is torn."""
        events.write.mode("append").json(f"{self.root}/events/{_run(run_id)}")

    def events(self, run_id: str) -> DataFrame:
        fs, path = self._fs(f"{self.root}/events/{_run(run_id)}")
        schema = "event string, stage string, key string, turn int"
        if not fs.exists(path):
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path.toString())
        torn = F.raise_error(F.concat(F.lit("torn event: "), F.substring("_corrupt", 1, 60))).cast("string")
        return read.select(F.when(F.col("_corrupt").isNotNull(), torn).otherwise(F.col("event")).alias("event"), "stage", "key", "turn")

    # manifests

    def start(self, run_id: str, manifest: dict) -> dict:
        """Write a run's manifest once; a stored one must be equal but that a judge may be named where none was."""
        old = self.manifest(run_id)
        if old is not None:
            changed = manifest_changes(old, manifest)
            if changed - {"judge"} or "judge" in changed and old.get("judge"):
                raise StoreError(f"run {run_id}: the manifest differs in {sorted(changed)}")
            if not changed:
                return old
        fs, path = self._fs(f"{self.root}/runs/{_run(run_id)}.json")
        temporary = self._fs(f"{self.root}/runs/.{run_id}.{uuid.uuid4().hex}")[1]
        out = fs.create(temporary, True)
        out.write(bytearray(canonical(manifest).encode()))
        out.hsync()
        out.close()
        self._replace(temporary, path)
        return manifest

    def _replace(self, source, target) -> None:
        """Rename in one step, over what may be there: a reader sees the old file or the new one."""
        sc = self.spark.sparkContext
        hadoop = sc._jvm.org.apache.hadoop.fs
        kind = getattr(hadoop, "Options$Rename")
        options = sc._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, options)

    def manifest(self, run_id: str) -> dict | None:
        fs, path = self._fs(f"{self.root}/runs/{_run(run_id)}.json")
        if not fs.exists(path):
            return None
        return json.loads(self.spark.read.text(path.toString(), wholetext=True).head().value)


def _run(run_id: str) -> str:
    if not run_id or "/" in run_id:
        raise StoreError("a run id is not empty and has no slash")
    return run_id


def manifest_changes(a: dict, b: dict) -> set[str]:
    return {k for k in a.keys() | b.keys() if k != "store_version" and a.get(k) != b.get(k)}


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}-{uuid.uuid4().hex[:12]}"
