"""Training records from judged trajectories: ordered refusal rules, first match wins; every refusal is named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .trajectory import SAMPLE


def refusal_reason(min_score: float = 1.0, judged: bool = True) -> Column:
    """Over the columns of summarised() and score; null when none applies."""
    rules = F.when(F.col("n_harness") > 0, "harness_error").when(F.col("state") == "truncated", "truncated").when(F.col("n_turns") == 0, "empty")
    rules = rules.when(F.col("n_calls") == 0, "no_tool_calls").when(F.col("n_calls") != F.col("n_executed"), "dangling_call")
    return rules.when(F.col("score").isNull(), "unjudged").when(F.col("score") < min_score, "below_threshold") if judged else rules


def screened(trajectories: DataFrame, verdicts: DataFrame | None, min_score: float = 1.0, tasks: DataFrame | None = None, n_samples: int = 1) -> DataFrame:
    """task_id, sample_index, reason (null: admitted), score. With tasks, every sample of every task has a row."""
    rows = trajectories
    if tasks is not None:
        spine = tasks.select("task_id").withColumn("sample_index", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
        rows = spine.join(trajectories, list(SAMPLE), "left")
    judged = verdicts is not None
    rows = rows.join(verdicts.select(*SAMPLE, "score"), list(SAMPLE), "left") if judged else rows.withColumn("score", F.lit(None).cast("double"))
    nameless = F.coalesce(F.col("task_id").cast("string"), F.lit("")) == ""
    unfinished = F.coalesce(F.col("state") == "unfinished", F.lit(True))
    reason = F.when(nameless, "missing_task_id").when(unfinished, "unfinished").otherwise(refusal_reason(min_score, judged))
    return rows.select(*SAMPLE, reason.alias("reason"), "score")


def histogram(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count("*").alias("n")).orderBy("reason")


def records(admitted: DataFrame, tasks: DataFrame) -> DataFrame:
    """task_id, sample_index, metadata of admitted rows; the score is 0.0 where nothing was judged."""
    met = admitted.where("reason is null").join(tasks.select("task_id", "repository", "package"), "task_id", "left")
    metadata = F.struct("task_id", "sample_index", F.coalesce("repository", F.lit("")).alias("repository"), F.coalesce("package", F.lit("")).alias("package"), F.coalesce("score", F.lit(0.0)).alias("score"), F.lit("eval").alias("source"))
    return met.select(*SAMPLE, metadata.alias("metadata"))
