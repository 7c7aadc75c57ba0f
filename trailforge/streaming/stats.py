"""Structured Streaming over the append-only event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event string, stage string, key string, turn int"


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The log as a stream of files."""
    return spark.readStream.schema(SCHEMA).json(path)


def completed_once(events: DataFrame, time: str | None = None, late: str = "1 day") -> DataFrame:
    """Each completed key once, whatever is logged again after a restart. Without a time column the state holds every key for
    ever; with one, keys of the last `late` only, so that a restart may repeat events that long."""
    done = events.where("event = 'completed'")
    return done.dropDuplicates(["key"]) if time is None else done.withWatermark(time, late).dropDuplicatesWithinWatermark(["key"])


def stage_counts(events: DataFrame, time: str | None = None, late: str = "1 day") -> DataFrame:
    return completed_once(events, time, late).groupBy("stage").agg(F.count("*").alias("n"))


def run_once(stream: DataFrame, target: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Take all that is there, write the result table, and read it back."""
    spark = stream.sparkSession

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(target)

    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target)


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "1 hour", width: str = "10 minutes") -> DataFrame:
    """Counts per window and event type with a watermark: later rows than `late` are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), "event_type").agg(F.count("*").alias("n")).select("w.start", "w.end", "event_type", "n")
