"""Runs of an agent over tasks: turn by turn as DataFrame steps, each stored under its content key, so that a run that is
started again computes only what is missing.

Generators, executors and judges are factories of objects with one method; the object is made once per partition, on the
executors, so nothing of them is pickled but the factory."""

from __future__ import annotations

import json
import os
import re
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ConfigError, HarnessError
from ..functions.keys import json_text, key_column
from ..functions.text import canonical, parse_reply, parse_verdict, spaced
from ..schemas import MAX_TURNS
from . import judging, mining, render, reward, scoring, tools, trajectory, workspace
from .conversation import normalize_records
from .store import ResultStore, pending
from .trajectory import SAMPLE

RESULT = "tool_name string, status string, exit_code int, stdout string, duration_ms bigint, harness_error string"


def _hook(rows: DataFrame, make: Callable[[], Callable[[dict], dict]], columns: list[str]) -> DataFrame:
    """key, stage, payload: what make()(row) returns for each row, as canonical JSON."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "stage": batch["stage"], "payload": [canonical(call(dict(zip(columns, r, strict=True)))) for r in batch[columns].itertuples(index=False)]}, columns=["key", "stage", "payload"])

    return rows.select("key", "stage", *columns).mapInPandas(run, "key string, stage string, payload string")


def _computed(store: ResultStore, run_id: str, rows: DataFrame, make, columns: list[str], turn: int) -> DataFrame:
    """rows (key, stage, ...) with the payload: stored results are used, the others are computed and stored first, or, if
    make is None, left out."""
    missing = pending(rows, store.objects()) if make else None
    if missing is not None and not missing.isEmpty():
        store.put(_hook(missing.dropDuplicates(["key"]), make, columns))
        store.append_events(run_id, missing.select(F.lit("completed").alias("event"), "stage", "key", F.lit(turn).alias("turn")).distinct())
    return rows.join(store.objects().select("key", "payload"), "key")


def _calls(payload: Column, turn: int) -> Column:
    """The calls of a reply as JSON objects; what is no object is left out before positions are counted. A call without an id
    gets one of turn, tool and position, which its result names too."""
    found = F.filter(F.coalesce(F.from_json(payload, "tool_calls array<string>")["tool_calls"], F.array().cast("array<string>")), lambda c: c.startswith("{"))

    def named(call: Column, i: Column) -> Column:
        ident = F.concat(F.lit(f"t{turn}-"), F.coalesce(F.get_json_object(call, "$.name"), F.lit("")), F.lit("-"), i.cast("string"))
        body = F.regexp_replace(call, r"\}\s*$", "")
        return F.concat(body, F.when(F.trim(body) == "{", "").otherwise(","), F.lit('"id":'), json_text(ident), F.lit("}"))

    return F.transform(found, lambda c, i: F.when(F.coalesce(F.get_json_object(c, "$.id"), F.lit("")) == "", named(c, i)).otherwise(c))


def _message(text: Column, calls: Column) -> Column:
    shown = F.when(F.size(calls) > 0, F.concat(F.lit(',"tool_calls":['), F.array_join(calls, ","), F.lit("]"))).otherwise(F.lit(""))
    return F.concat(F.lit('{"role":"assistant","content":'), json_text(F.coalesce(text, F.lit(""))), shown, F.lit("}"))


@dataclass(frozen=True)
class Played:
    """What a run has come to, as written tables.

    calls: task_id, sample_index, turn_index, has_call, call_index, tool_name, status; conversations: task_id, sample_index,
    messages (JSON texts, as the model saw them), of finished and truncated samples; turns: task_id, sample_index, turn,
    generated (JSON), executions (JSON texts in order of calls)."""

    calls: DataFrame
    conversations: DataFrame
    turns: DataFrame


def _united(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def played(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, run_id: str, generate, execute, max_turns: int = MAX_TURNS) -> Played:
    """All turns of all samples. generate() makes a function of {task_id, prompt, sample_index, turn, history_json} that returns
    {text, tool_calls}; execute() one of {task_id, sample_index, turn, call_index, tool_name, arguments} that returns a result.

    Each turn is one step over all samples that go on, and is written, so that work grows with the turns and no step
    recomputes an earlier one. Without hooks nothing is computed, and a sample whose next result isn't stored ends there."""
    ids = tasks.select(F.coalesce(F.col("id"), F.lit("")).alias("id"))
    if ids.isEmpty() or not ids.where("id = ''").isEmpty():
        raise ConfigError("a run needs tasks, each with an id")
    prompt = F.concat(F.lit('{"role":"user","content":'), json_text(F.coalesce("prompt", F.lit(""))), F.lit("}"))
    active = tasks.select(F.col("id").alias("task_id"), F.coalesce("prompt", F.lit("")).alias("prompt"), F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("sample_index"), F.array(prompt).alias("history"))
    calls, talks, turns = [], [], []
    none = F.array().cast("array<string>")
    for turn in range(max_turns):
        key = key_column(config, F.col("task_id"), F.col("sample_index"), F.lit("generate"), F.lit(turn))
        asked = active.withColumn("key", key).withColumn("stage", F.lit("generate")).withColumn("turn", F.lit(turn)).withColumn("history_json", F.to_json("history"))
        told = _computed(store, run_id, asked, generate, ["task_id", "prompt", "sample_index", "turn", "history_json"], turn)
        told = store.step(told.select(*SAMPLE, "prompt", "history", "payload", F.from_json("payload", "text string")["text"].alias("text"), _calls(F.col("payload"), turn).alias("calls")))
        ended, going = told.where(F.size("calls") == 0), told.where(F.size("calls") > 0)
        calls.append(ended.select(*SAMPLE, F.lit(turn).alias("turn_index"), F.lit(False).alias("has_call"), F.lit(0).alias("call_index"), F.lit(None).cast("string").alias("tool_name"), F.lit(None).cast("string").alias("status")))
        talks.append(ended.select(*SAMPLE, F.concat("history", F.array(_message(F.col("text"), F.col("calls")))).alias("messages")))
        turns.append(ended.select(*SAMPLE, F.lit(turn).alias("turn"), F.col("payload").alias("generated"), none.alias("executions")))
        if going.isEmpty():
            break
        each = going.select(*SAMPLE, F.posexplode("calls").alias("call_index", "call")).select(*SAMPLE, "call_index", F.coalesce(F.get_json_object("call", "$.name"), F.lit("")).alias("tool_name"), F.coalesce(F.get_json_object("call", "$.arguments"), F.lit("{}")).alias("arguments"), F.get_json_object("call", "$.id").alias("id"))
        key = key_column(config, F.col("task_id"), F.col("sample_index"), F.lit("execute"), F.lit(turn), F.col("call_index"), F.col("tool_name"))
        ran = _computed(store, run_id, each.withColumn("key", key).withColumn("stage", F.lit("execute")).withColumn("turn", F.lit(turn)), execute, [*SAMPLE, "turn", "call_index", "tool_name", "arguments"], turn)
        ran = store.step(ran.select(*SAMPLE, "call_index", "tool_name", "id", "payload", F.from_json("payload", RESULT).alias("r"))).withColumn("status", F.coalesce("r.status", F.lit("ok")))
        calls.append(ran.select(*SAMPLE, F.lit(turn).alias("turn_index"), F.lit(True).alias("has_call"), "call_index", "tool_name", "status"))
        result = F.struct(F.col("tool_name"), F.col("status"), F.col("r.stdout").alias("stdout"), F.col("r.harness_error").alias("harness_error"), F.col("call_index"))
        shown = F.to_json(trajectory.observation(result, F.struct(F.coalesce("id", F.lit("")).alias("id")), F.lit(turn)))
        seen = ran.groupBy(*SAMPLE).agg(F.array_sort(F.collect_list(F.struct("call_index", shown.alias("m"), "payload"))).alias("x"))
        met = store.step(going.join(seen, list(SAMPLE)).where(F.size("x") == F.size("calls")))
        turns.append(met.select(*SAMPLE, F.lit(turn).alias("turn"), F.col("payload").alias("generated"), F.transform("x", lambda x: x["payload"]).alias("executions")))
        active = met.select("task_id", "prompt", "sample_index", F.concat("history", F.array(_message(F.col("text"), F.col("calls"))), F.transform("x", lambda x: x["m"])).alias("history"))
    else:
        talks.append(active.select(*SAMPLE, F.col("history").alias("messages")))
    return Played(*map(_united, (calls, talks, turns)))


def run_turns(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, run_id: str, generate, execute, max_turns: int = MAX_TURNS) -> DataFrame:
    """The calls of played()."""
    return played(config, tasks, n_samples, store, run_id, generate, execute, max_turns).calls


def rebuilt(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, max_turns: int = MAX_TURNS) -> Played:
    """played() of what is stored: nothing is computed."""
    return played(config, tasks, n_samples, store, "", None, None, max_turns)


def rebuild_from_store(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, max_turns: int = MAX_TURNS) -> DataFrame:
    return rebuilt(config, tasks, n_samples, store, max_turns).calls


def stored_verdicts(config: dict, samples: DataFrame, store: ResultStore) -> DataFrame:
    """task_id, sample_index, score of the samples with a stored verdict."""
    keyed = samples.select(*SAMPLE).withColumn("key", key_column(config, F.col("task_id"), F.col("sample_index"), F.lit("judge"), F.lit(0)))
    return keyed.join(store.objects().select("key", "payload"), "key").select(*SAMPLE, F.get_json_object("payload", "$.score").cast("double").alias("score"))


def mine(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, *, judged: bool = True, min_score: float = 1.0, max_turns: int = MAX_TURNS) -> DataFrame:
    """mining.screened() of a stored run: every sample of every task with its reason, or none if it is admitted."""
    return _screened(rebuilt(config, tasks, n_samples, store, max_turns), config, tasks, n_samples, store, judged, min_score, max_turns)


def _screened(play: Played, config, tasks, n_samples, store, judged, min_score, max_turns) -> DataFrame:
    whole = trajectory.summarised(per_turn(play.calls), max_turns)
    return mining.screened(whole, stored_verdicts(config, whole, store) if judged else None, min_score, tasks.select(F.col("id").alias("task_id")), n_samples)


def mined(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, *, judged: bool = True, min_score: float = 1.0, max_turns: int = MAX_TURNS, tokenizer=render.byte_tokenizer) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training records (task_id, sample_index, value: JSON of messages, tools, metadata), the same as measured trajectories
    (schemas.MEASURED), and the outcome of every sample (reason, score).

    A record is normalised as training will, which may refuse it (reason `invalid:...`), and its tokens are those of its rendering."""
    play = rebuilt(config, tasks, n_samples, store, max_turns)
    outcomes = _screened(play, config, tasks, n_samples, store, judged, min_score, max_turns)
    about = [F.col(c) if c in tasks.columns else F.lit("").alias(c) for c in ("repository", "package")]
    rows = mining.records(outcomes, tasks.select(F.col("id").alias("task_id"), *about)).join(play.conversations, list(SAMPLE))
    body = F.concat(F.lit('{"messages":['), F.array_join("messages", ","), F.lit('],"tools":' + spaced(tools.function_specs())))
    rows = store.step(normalize_records(rows.withColumn("body", body).withColumn("value", F.concat("body", F.lit("}")))).drop("messages", "value"))
    kept = rows.where("reason is null")
    records = kept.select(*SAMPLE, F.concat("body", F.lit(',"metadata":'), F.to_json("metadata"), F.lit("}")).alias("value"))
    used = play.calls.where("has_call").groupBy(*SAMPLE).agg(F.array_sort(F.collect_list(F.struct("turn_index", "call_index", "tool_name"))).alias("x"))
    name = F.concat_ws("#", "task_id", "sample_index")
    tokens = render.measured_rows(kept.select(name.alias("conv_id"), "conversation"), tokenizer).withColumnRenamed("conv_id", "id")
    said = F.from_json("conversation", "messages array<struct<reasoning_content:string,images:array<string>>>")["messages"]
    unknown = lambda c: F.coalesce(F.nullif(F.col(f"metadata.{c}"), F.lit("")), F.lit("unknown")).alias(c)
    measured = kept.join(used, list(SAMPLE)).withColumn("id", name).join(tokens, "id").select(
        "id", unknown("repository"), unknown("package"), F.transform("x", lambda x: x["tool_name"]).alias("tools"), "supervised_tokens", "total_tokens",
        F.exists(said, lambda m: F.trim(F.coalesce(m["reasoning_content"], F.lit(""))) != "").alias("has_thinking"), F.exists(said, lambda m: F.size(m["images"]) > 0).alias("has_images"),
    )
    refused = rows.where("reason is not null").select(*SAMPLE, F.concat(F.lit("invalid:"), "reason").alias("fault"))
    outcomes = outcomes.join(refused, list(SAMPLE), "left").select(*SAMPLE, F.coalesce("reason", "fault").alias("reason"), "score")
    return records, measured, outcomes


def build_preferences(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, *, min_margin: float = 0.0, max_turns: int = MAX_TURNS) -> DataFrame:
    """reward.preference_outcomes() of a stored run, by the verification that each task declares."""
    return _preferred(rebuilt(config, tasks, n_samples, store, max_turns), tasks, min_margin, max_turns)


def _preferred(play: Played, tasks: DataFrame, min_margin: float, max_turns: int) -> DataFrame:
    declared = tasks.select(F.col("id").alias("task_id"), F.explode("verification").alias("tool_name"))
    own = play.calls.join(declared, ["task_id", "tool_name"], "left_semi")
    whole = trajectory.summarised(per_turn(play.calls), max_turns)
    return reward.preference_outcomes(reward.rewards(own, whole, ("go_test", "go_build")), min_margin)


def preference_pairs(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, *, min_margin: float = 0.0, max_turns: int = MAX_TURNS) -> tuple[DataFrame, DataFrame]:
    """Pairs (schemas.PAIR: prompt, and both conversations as JSON), and the outcome of every task."""
    play = rebuilt(config, tasks, n_samples, store, max_turns)
    outcomes = _preferred(play, tasks, min_margin, max_turns)
    found = reward.pairs(outcomes).join(tasks.select(F.col("id").alias("task_id"), F.coalesce("prompt", F.lit("")).alias("prompt")), "task_id")
    for side in ("chosen", "rejected"):
        talk = play.conversations.select("task_id", F.col("sample_index").alias(side), F.concat(F.lit("["), F.array_join("messages", ","), F.lit("]")).alias("talk"))
        found = found.join(talk, ["task_id", side]).drop(side).withColumnRenamed("talk", side)
    return found.select("prompt", "chosen", "rejected", "task_id", "chosen_reward", "rejected_reward", "margin"), outcomes


def run_records(play: Played, tasks: DataFrame, max_turns: int = MAX_TURNS) -> DataFrame:
    """task_id, sample_index, prompt, record: what a judge is shown, as JSON."""
    turn = F.concat(F.lit('{"turn":'), F.col("turn").cast("string"), F.lit(',"generated":'), F.col("generated"), F.lit(',"executions":['), F.array_join("executions", ","), F.lit("]}"))
    own = play.turns.groupBy(*SAMPLE).agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("t")))).alias("x"), F.max(F.when(F.size("executions") == 0, F.col("turn"))).alias("end"))
    task = tasks.select(F.col("id").alias("task_id"), F.coalesce("prompt", F.lit("")).alias("prompt"))
    head = F.concat(F.lit('{"task":'), F.to_json(F.struct(F.col("task_id").alias("id"), "prompt")), F.lit(',"truncated":'), F.col("end").isNull().cast("string"))
    return own.join(task, "task_id").select(*SAMPLE, "prompt", F.concat(head, F.lit(',"turns":['), F.array_join(F.transform("x", lambda x: x["t"]), ","), F.lit("]}")).alias("record"))


def queue_entries(config: dict, tasks: DataFrame, n_samples: int, store: ResultStore, max_turns: int = MAX_TURNS) -> DataFrame:
    """key, task_id, sample_index, prompt, trajectory: whole samples without a harness error that no verdict is stored for."""
    play = rebuilt(config, tasks, n_samples, store, max_turns)
    whole = trajectory.summarised(per_turn(play.calls), max_turns)
    open_ = scoring.judge_queue(whole, stored_verdicts(config, whole, store)).select(*SAMPLE)
    keyed = open_.withColumn("key", key_column(config, F.col("task_id"), F.col("sample_index"), F.lit("judge"), F.lit(0)))
    return keyed.join(run_records(play, tasks, max_turns), list(SAMPLE)).select("key", *SAMPLE, "prompt", judging.rendered(F.col("record")).alias("trajectory"))


def per_turn(calls: DataFrame) -> DataFrame:
    """Rows of run_turns() with the last call of a turn only, and its worst status: what summarised() takes."""
    rank = F.when(F.col("status") == "harness_error", 3).when(F.col("status") == "model_error", 2).when(F.col("status") == "tool_error", 1).otherwise(0)
    return calls.groupBy(*SAMPLE, "turn_index").agg(F.max("has_call").alias("has_call"), F.max_by("tool_name", "call_index").alias("tool_name"), F.max_by("status", rank).alias("status"))


def judge_stage(config: dict, trajectories: DataFrame, store: ResultStore, run_id: str, judge, identity: str) -> DataFrame:
    """task_id, sample_index, score of whole trajectories without a harness error. judge() makes a function of {task_id,
    sample_index}, and of record if trajectories have it, that returns {score, reason}; a stored verdict of another judge is an error."""

    def make():
        own = judge()

        def call(row: dict) -> dict:
            said = own(row)
            score = said.get("score") if isinstance(said, dict) else None
            if not isinstance(score, int | float) or isinstance(score, bool) or not 0 <= score <= 1:
                raise HarnessError(f"no verdict: {spaced(said) if isinstance(said, dict) else said!r}")
            return {"score": float(score), "reason": str(said.get("reason", "")), "judge": identity}

        return call

    shown = [*SAMPLE, *[c for c in ("record",) if c in trajectories.columns]]
    open_ = trajectories.where("state <> 'unfinished' and n_harness = 0").select(*shown)
    keyed = open_.withColumn("key", key_column(config, F.col("task_id"), F.col("sample_index"), F.lit("judge"), F.lit(0))).withColumn("stage", F.lit("judge"))
    found = _computed(store, run_id, keyed, make, shown, 0)
    other = F.raise_error(F.concat(F.lit("a verdict is another judge's: "), F.get_json_object("payload", "$.judge"))).cast("double")
    score = F.get_json_object("payload", "$.score").cast("double")
    return found.select(*SAMPLE, F.when(F.get_json_object("payload", "$.judge") == identity, score).otherwise(other).alias("score"))


def ingest_verdicts(verdicts: DataFrame, store: ResultStore, identity: str) -> int:
    """Store verdicts (key, score, reason) under the queue's keys; nothing may be stored under them yet."""
    payload = F.to_json(F.struct(F.lit(identity).alias("judge"), F.coalesce("reason", F.lit("")).alias("reason"), "score"))
    return store.put(verdicts.select("key", F.lit("judge").alias("stage"), payload.alias("payload")), strict=True)


def run_evaluation(config: dict, tasks: DataFrame, store: ResultStore, *, run_id: str, generate, execute, judge=None, identity: str = "", n_samples: int = 1, max_turns: int = MAX_TURNS, k: int = 1) -> DataFrame:
    """The summary of a run, a row per task. A run id is bound to its configuration by its manifest."""
    tools.guard()
    store.start(run_id, {**config, "n_samples": n_samples, "max_turns": max_turns, "judge": identity})
    play = played(config, tasks, n_samples, store, run_id, generate, execute, max_turns)
    whole = trajectory.summarised(per_turn(play.calls), max_turns)
    seen = whole.join(run_records(play, tasks, max_turns).drop("prompt"), list(SAMPLE))
    verdicts = judge_stage(config, seen, store, run_id, judge, identity) if judge else None
    return scoring.run_summary(tasks.select(F.col("id").alias("task_id")), n_samples, whole, verdicts, k)


def session_judge(verdicts: dict[str, float]):
    """A judge that replays verdicts by task#sample; one that is missing is an error."""

    def make():
        def call(row: dict) -> dict:
            name = f"{row['task_id']}#{row['sample_index']}"
            if name not in verdicts:
                raise HarnessError(f"no verdict for {name}")
            return {"score": verdicts[name], "reason": "replayed"}

        return call

    return make


def http_client(base_url: str, key_env: str = "", timeout: float = 600) -> Callable[[dict], str]:
    """post(request): the body of a chat completion. What can't be had is lost infrastructure, not a model's failure."""
    if not base_url.startswith(("http://", "https://")):
        raise ConfigError(f"a model's address begins with http:// or https://, not {base_url!r}")

    def post(request: dict) -> str:
        key = os.environ.get(key_env, "").strip() if key_env else ""
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        sent = urllib.request.Request(f"{base_url.rstrip('/')}/chat/completions", json.dumps(request, ensure_ascii=False).encode(), headers, method="POST")
        try:
            with urllib.request.urlopen(sent, timeout=timeout) as answer:
                return answer.read().decode()
        except urllib.error.HTTPError as e:
            raise HarnessError(f"{request.get('model')}: HTTP {e.code}: {e.read()[:500].decode('utf-8', 'replace')}") from e
        except OSError as e:
            raise HarnessError(f"{request.get('model')} at {base_url}: {e}") from e

    return post


def http_generator(post: Callable[[dict], str], model: str, system: str, seed: int = 0, **decoding):
    """A generator over an injected client: post(request) returns the body of a chat completion."""

    def make():
        def call(row: dict) -> dict:
            history = [json.loads(m) for m in json.loads(row["history_json"])]
            request = {"model": model, "messages": judging.chat_messages(history, system), "seed": seed + 1000 * int(row["sample_index"])}
            return parse_reply(post(request | decoding), model)

        return call

    return make


def http_judge(post: Callable[[dict], str], model: str, **decoding):
    """A judge over an injected client; it reads the whole record."""

    def make():
        def call(row: dict) -> dict:
            messages = [{"role": "system", "content": judging.RUBRIC}, {"role": "user", "content": judging.render(json.loads(row["record"]))}]
            return parse_verdict(parse_reply(post({"model": model, "messages": messages} | decoding), model)["text"], model)

        return call

    return make


def local_execution(root: str, fixture: str | None = None, timeout: float = 120):
    """An executor in a workspace of each sample's own below root, seeded from the fixture. It runs commands of a model on
    this machine: for trusted trials, with root in a folder that all executors of the run share."""

    def make():
        executor = workspace.LocalExecutor(timeout)

        def call(row: dict) -> dict:
            name = f"{re.sub(r'[^\w-]', '_', str(row['task_id']))}-s{row['sample_index']}"
            own = workspace.seed(os.path.join(root, name), fixture)
            return workspace.execute(executor, own, row["tool_name"], json.loads(row["arguments"]))

        return call

    return make


def probe(root: str) -> None:
    """The canary of a local run: a command that must pass and one that must fail."""
    own = workspace.seed(os.path.join(root, "canary"), None)
    cases = [(("go_doc", {"symbol": "errors.Is"}), True), (("go_test", {"pkg": "./definitely-not-a-package"}), False)]
    workspace.canary(lambda case: workspace.execute(workspace.LocalExecutor(), own, *case)["status"] == "ok", cases)
