"""Rewards from execution, and best/worst preference pairs. A reward of null is no evidence, never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .trajectory import SAMPLE


def result_score(status: Column) -> Column:
    return F.when(status == "ok", 1.0).when(status.isin("tool_error", "model_error"), 0.0)


def rewards(executions: DataFrame, trajectories: DataFrame, verification) -> DataFrame:
    """task_id, sample_index, reward, complete: the last execution of a declared verification that the harness did not
    lose decides. executions: task_id, sample_index, turn_index, call_index, tool_name, status."""
    declared = executions.where(F.col("tool_name").isin(*verification) & F.col("status").isNotNull() & (F.col("status") != "harness_error"))
    last = declared.groupBy(*SAMPLE).agg(F.max_by("status", F.struct("turn_index", "call_index")).alias("last"))
    whole = trajectories.where("state <> 'unfinished'").select(*SAMPLE, (F.col("state") == "finished").alias("complete"))
    return whole.join(last, list(SAMPLE), "left").select(*SAMPLE, result_score(F.col("last")).alias("reward"), "complete")


def preference_outcomes(scored: DataFrame, min_margin: float = 0.0) -> DataFrame:
    """A row per task: reason (null: a pair), chosen, rejected (sample_index), chosen_reward, rejected_reward, margin.

    Of equal rewards the first sample counts, for the best as for the worst."""
    gradable = F.col("reward").isNotNull() & F.col("complete")
    sample, reward = F.col("sample_index"), F.col("reward")
    found = scored.groupBy("task_id").agg(
        F.count_if(gradable).cast("long").alias("gradable"), F.count_if(reward.isNotNull()).cast("long").alias("graded"),
        F.max(F.when(gradable, F.struct(reward.alias("r"), (-sample).alias("s")))).alias("best"), F.min(F.when(gradable, F.struct(reward.alias("r"), sample.alias("s")))).alias("worst"),
    )
    margin = F.col("best.r") - F.col("worst.r")
    reason = F.when(F.coalesce(F.col("task_id").cast("string"), F.lit("")) == "", "missing_task_id").when(F.col("graded") == 0, "nothing_gradable").when(F.col("gradable") < 2, "too_few_gradable_samples")
    reason = reason.when((margin <= min_margin) | (-F.col("best.s") == F.col("worst.s")), "no_contrast")
    return found.select("task_id", reason.alias("reason"), (-F.col("best.s")).alias("chosen"), F.col("worst.s").alias("rejected"), F.col("best.r").alias("chosen_reward"), F.col("worst.r").alias("rejected_reward"), margin.alias("margin"))


def pairs(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("reason is null and task_id is not null").drop("reason")


def reward_lists(scored: DataFrame) -> DataFrame:
    """task_id, rewards: all rewards there are, in sample order."""
    kept = scored.where("reward is not null").groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("sample_index", "reward"))).alias("x"))
    return kept.select("task_id", F.transform("x", lambda x: x["reward"]).alias("rewards"))
