"""Scores of runs: status classes, summaries per task, judge queue, integrity of verdicts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pass_at_k
from ..functions.text import blank
from .trajectory import SAMPLE, all_ok


def status_of(exit_code: Column, model_fault: Column | None = None, lost: Column | None = None) -> Column:
    """Lost environment, then bad arguments, then the exit code."""
    model_fault, lost = (F.lit(False) if c is None else c for c in (model_fault, lost))
    return F.when(lost, "harness_error").when(model_fault, "model_error").when(exit_code == 0, "ok").otherwise("tool_error")


def shown_output(stdout: Column, stderr: Column) -> Column:
    return F.when(blank(stdout), stderr).otherwise(stdout)


def execution_summary(results: DataFrame, k: int = 1) -> DataFrame:
    """results: task_id, status. A row per task, in order: samples, passed, three error counts, pass_at_1, pass_at_n."""
    n = lambda s: F.count_if(F.col("status") == s).cast("long")
    found = results.groupBy("task_id").agg(F.count("*").alias("samples"), n("ok").alias("passed"), n("tool_error").alias("tool_errors"), n("model_error").alias("model_errors"), n("harness_error").alias("harness_errors"))
    return found.withColumn("pass_at_1", F.col("passed") / F.col("samples")).withColumn("pass_at_n", pass_at_k(F.col("samples"), F.col("passed"), k)).orderBy("task_id")


def run_summary(tasks: DataFrame, n_samples: int, trajectories: DataFrame, verdicts: DataFrame | None, k: int = 1) -> DataFrame:
    """A row per task of the task list: every sample counts once, whatever is missing.

    trajectories: summarised(); verdicts: task_id, sample_index, score, or None for scoring by execution: the mode is
    said, never guessed from the data. In judged mode a sample without a verdict is 0."""
    spine = tasks.select("task_id").withColumn("sample_index", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    met = spine.join(trajectories, list(SAMPLE), "left")
    if verdicts is None:
        value = F.when(all_ok() & (F.col("state") != "unfinished"), 1.0).otherwise(0.0)
        judged = F.lit(0)
    else:
        met = met.join(verdicts.select(*SAMPLE, "score"), list(SAMPLE), "left")
        value = F.coalesce("score", F.lit(0.0))
        judged = F.when(F.col("score").isNotNull(), 1).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    found = met.groupBy("task_id").agg(
        F.count("*").alias("samples"), F.count_if(value >= 1.0).cast("long").alias("passed"), total("n_tool_error").alias("tool_errors"),
        total("n_model_error").alias("model_errors"), total("n_harness").alias("harness_errors"), total(judged).alias("judged"),
    )
    return found.withColumn("pass_at_1", F.col("passed") / F.col("samples")).withColumn("pass_at_n", pass_at_k(F.col("samples"), F.col("passed"), k)).orderBy("task_id")


def run_report(summary: DataFrame, trajectories: DataFrame | None = None) -> DataFrame:
    """Means over tasks, and the tasks without any verdict; with trajectories also how many are truncated."""
    found = summary.agg(F.count("*").alias("tasks"), F.avg("pass_at_1").alias("mean_pass_at_1"), F.avg("pass_at_n").alias("mean_pass_at_n"), F.count_if(F.col("judged") == 0).cast("long").alias("unjudged_tasks"))
    return found if trajectories is None else found.join(F.broadcast(trajectories.agg(F.count_if(F.col("state") == "truncated").cast("long").alias("truncated"))))


def judge_queue(trajectories: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Whole trajectories without a harness error that no verdict exists for, in order."""
    open_ = trajectories.where("state <> 'unfinished' and n_harness = 0").join(verdicts, list(SAMPLE), "left_anti")
    return open_.select(*SAMPLE, "state", "n_turns").orderBy(*SAMPLE)


def verdict_problems(verdicts: DataFrame, queue: DataFrame, key="key") -> DataFrame:
    """problem, key: verdicts of unknown keys, keys with several verdicts, queued keys without one.

    Keys have the same types on both sides; a null fits no key. One aggregate over both sides: joins would put the sorts
    and maps of all three problems into one task."""
    keys = [key] if isinstance(key, str) else list(key)
    own = [f"k{i}" for i in range(len(keys))]
    side = lambda df, n: df.select(*[F.col(c).alias(k) for c, k in zip(keys, own, strict=True)], F.lit(n).alias("judged"), F.lit(1 - n).alias("queued"))
    met = side(verdicts, 1).unionByName(side(queue, 0)).groupBy(*own).agg(F.sum("judged").alias("judged"), F.max("queued").alias("queued"))
    judged, queued, whole = F.col("judged") > 0, F.col("queued") > 0, reduce(and_, [F.col(k).isNotNull() for k in own])
    problems = (judged & ~(queued & whole), "unknown_key"), (F.col("judged") > 1, "duplicate_key"), (queued & ~(judged & whole), "missing_key")
    found = F.array_compact(F.array(*[F.when(c, name) for c, name in problems]))
    return met.select(F.explode(found).alias("problem"), F.concat_ws("#", *[F.col(k).cast("string") for k in own]).alias("key"))


def checked_verdicts(verdicts: DataFrame, queue: DataFrame) -> DataFrame:
    """The verdicts, once all their keys fit the queue; else an error that counts the problems."""
    from ..errors import HarnessError

    wrong = {r.problem: r.n for r in verdict_problems(verdicts, queue).groupBy("problem").agg(F.count("*").alias("n")).collect()}
    if wrong:
        raise HarnessError(f"verdicts don't fit the queue: {wrong}")
    return verdicts
