"""Multi-turn trajectories from long tables of turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MAX_TURNS

SAMPLE = ("task_id", "sample_index")


def summarised(turns: DataFrame, max_turns: int = MAX_TURNS) -> DataFrame:
    """A row per task and sample with turns: state, and n_turns, n_calls, n_executed, n_harness, n_tool_error, n_model_error, n_ok
    of the turns up to the end.

    turns: task_id, sample_index, turn_index, has_call, tool_name, status (null: not executed). state is `finished` (a
    turn without a call ends it and all before are there), `truncated` (max_turns turns, all with calls), or
    `unfinished`, which a gap makes it too."""
    inside = turns.where(F.col("turn_index") < max_turns)
    own = Window.partitionBy(*SAMPLE)
    end = F.min(F.when(~F.col("has_call"), F.col("turn_index"))).over(own)
    upto = inside.withColumn("end", end).where(F.col("end").isNull() | (F.col("turn_index") <= F.col("end")))
    call = F.col("has_call")
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    status = lambda s: count(call & (F.col("status") == s))
    found = upto.groupBy(*SAMPLE).agg(
        F.max("end").alias("end"), F.count("*").alias("n_turns"), count(call).alias("n_calls"), count(call & F.col("status").isNotNull()).alias("n_executed"),
        status("harness_error").alias("n_harness"), status("tool_error").alias("n_tool_error"), status("model_error").alias("n_model_error"), status("ok").alias("n_ok"),
    )
    all_there = F.col("n_calls") == F.col("n_executed")
    dense = F.col("n_turns") == F.col("end") + 1
    state = F.when(F.col("end").isNotNull() & dense & all_there, "finished").when(F.col("end").isNull() & (F.col("n_turns") == max_turns) & all_there, "truncated").otherwise("unfinished")
    return found.withColumn("state", state).drop("end")


def all_ok() -> Column:
    """Something ran and every result is ok."""
    return (F.col("n_executed") > 0) & (F.col("n_ok") == F.col("n_executed"))


def is_complete() -> Column:
    """Not truncated, and the last turn has no call."""
    return F.col("state") == "finished"


def assistant_message(text: Column, calls: Column) -> Column:
    """role, content and tool_calls, null (so absent in JSON) when there are none."""
    return F.struct(F.lit("assistant").alias("role"), F.coalesce(text, F.lit("")).alias("content"), F.when(F.size(calls) > 0, calls).alias("tool_calls"))


def observation(result: Column, call: Column, turn: Column) -> Column:
    """A result as the model sees it: lost infrastructure is named, never shown as empty output; is_error is set from the
    status. A missing call id takes the turn, tool and position, so that it is unique."""
    default = F.concat_ws("-", F.concat(F.lit("t"), turn.cast("string")), result["tool_name"], result["call_index"].cast("string"))
    lost = result["status"] == "harness_error"
    fault = F.concat(F.lit("[infrastructure error] "), F.coalesce(F.nullif(result["harness_error"], F.lit("")), F.lit("execution failed")))
    return F.struct(
        F.lit("tool").alias("role"), F.coalesce(F.nullif(call["id"], F.lit("")), default).alias("tool_call_id"), result["tool_name"].alias("name"),
        result["status"].alias("status"), F.when(lost, fault).otherwise(F.coalesce(result["stdout"], F.lit(""))).alias("content"), (result["status"] != "ok").alias("is_error"),
    )


def _first() -> Column:
    return F.array(F.to_json(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))))


def _own_messages() -> Column:
    """A turn's messages as JSON texts: what the assistant said, then its results; calls and results pair by position, cut to the shorter."""
    pairs = F.slice(F.arrays_zip("calls", "results"), 1, F.least(F.size("calls"), F.size("results")))
    shown = F.transform(pairs, lambda p: F.to_json(observation(p["results"], p["calls"], F.col("turn_index"))))
    return F.concat(F.array(F.to_json(assistant_message(F.col("text"), F.col("calls")))), shown)


def history(turns: DataFrame) -> DataFrame:
    """turns (schemas.TURN) with `history`: the JSON of all messages that the model saw before each turn, prompt first.

    turns needs a column prompt."""
    before = Window.partitionBy(*SAMPLE).orderBy("turn_index").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.flatten(F.collect_list(_own_messages()).over(before))
    return turns.withColumn("history", F.concat(_first(), F.coalesce(earlier, F.array().cast("array<string>"))))


def conversations(turns: DataFrame) -> DataFrame:
    """task_id, sample_index, messages: the whole conversation of each sample up to its first turn without a call, as JSON texts, prompt first.

    turns: as for history(), bounded per sample by its turns."""
    found = turns.groupBy(*SAMPLE).agg(F.array_sort(F.collect_list(F.struct("turn_index", (F.size("calls") > 0).alias("goes_on"), _own_messages().alias("own")))).alias("x"), F.first("prompt").alias("prompt"))
    ends = F.array_position(F.transform("x", lambda t: t["goes_on"]), False)
    upto = F.when(ends > 0, F.slice("x", 1, ends.cast("int"))).otherwise(F.col("x"))
    return found.select(*SAMPLE, F.concat(_first(), F.flatten(F.transform(upto, lambda t: t["own"]))).alias("messages"))
