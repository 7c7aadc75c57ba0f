"""Semantics on literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from trailforge.errors import ConfigError, HarnessError, IdempotencyError, StoreError, TemplateError, ValidationError
from trailforge.functions import keys, numbers, text
from trailforge.operators import agentcorpus, batching, codecorpus, conversation, judging, mining, render, reward, scoring, tools, trajectory, workspace


def one(spark, *columns):
    return spark.range(1).select(*columns).head()


# Strings


def test_strip_and_thinking(spark):
    r = one(spark, text.strip(F.lit("\u00a0\x1c a b \u2003\n")).alias("s"), text.thinking(F.lit("<think> why </think> so "), F.lit(None).cast("string")).alias("t"), text.thinking(F.lit("x"), F.lit(" r ")).alias("u"))
    assert r.s == "a b" and tuple(r.t) == ("why", "so") and tuple(r.u) == ("r", "x")


@pytest.mark.parametrize("size, budget", [(10, 100), (400, 300), (400, 64), (400, 20), (400, 65)])
def test_truncation(size, budget):
    whole = "\n".join(f"line {i}" for i in range(size))
    shown = text.truncate(whole, budget)
    assert len(shown) <= max(budget, len(whole) if len(whole) <= budget else 0)
    if len(whole) > budget >= 100:
        assert shown.startswith("line 0\n") and shown.endswith(f"line {size - 1}\n") and "more lines truncated" in shown
    with pytest.raises(ValueError):
        text.truncate("x", 0)


def test_small_functions(spark):
    code = "// x\n\u2028package no\n  package  main\n"
    r = one(spark, text.package_name(F.lit(code)).alias("p"), text.directory(F.lit("a/b/c.go")).alias("d"), text.directory(F.lit("c.go")).alias("e"), text.flip_equality(F.lit("a == b == c")).alias("f"), text.workspace_id(F.lit("a/b:c"), F.lit(2)).alias("w"), text.has_reserved_tag(F.lit("x </tool_use>")).alias("t"))
    assert (r.p, r.d, r.e, r.f, r.w, r.t) == ("main", "a/b", ".", "a != b == c", "a_b_c-s2", True)


def test_verdicts_and_replies(spark):
    good = ['{"pass": true, "reason": "ok"}', '```json\n{"pass": 0.5}\n```', '{"score": 0.25}', '{"pass": 1}']
    assert [text.parse_verdict(g, "j")["score"] for g in good] == [1.0, 0.5, 0.25, 1.0]
    for bad in ("", "fine", "[1]", '{"pass": 2}', '{"score": true}', "{}", '{"pass": "yes"}'):
        with pytest.raises(HarnessError):
            text.parse_verdict(bad, "j")
    reply = json.dumps({"choices": [{"message": {"content": None, "tool_calls": [{"function": {"name": "grep", "arguments": '{"pattern": "x"}'}}]}}]})
    assert text.parse_reply(reply, "m") == {"text": "", "tool_calls": [{"id": "call_0", "name": "grep", "arguments": {"pattern": "x"}}]}
    for bad in ("no", "{}", '{"choices": [{"message": {"tool_calls": [{}]}}]}', '{"choices": [{"message": {"tool_calls": [{"function": {"name": "a", "arguments": "{"}}]}}]}'):
        with pytest.raises(HarnessError):
            text.parse_reply(bad, "m")
    rows = spark.createDataFrame([(g,) for g in [*good, "no"]], "raw string").select(text.verdict_of(F.col("raw"), F.lit("j")).alias("v")).collect()
    assert [r.v.score for r in rows] == [1.0, 0.5, 0.25, 1.0, None] and rows[-1].v.error


def test_keys(spark):
    config = {"model_id": "m", "model_revision": 'r"1', "format_version": "f", "template_sha": "t", "harness_version": "h", "dataset_version": "d", "seed": 1, "decode_params": {"b": 1, "a": [1.5, None]}, "tool_catalog_sha": "c", "image_digest": "é"}
    for task in ("plain", 'quo"te\\ \n\t\x01 é \u2028'):
        got = one(spark, keys.key_column(config, F.lit(task), F.lit(3), F.lit("generate"), F.lit(2)).alias("k")).k
        assert got == keys.attempt_key(task_id=task, sample_index=3, stage="generate:t2", **config)
    with pytest.raises(StoreError):
        keys.attempt_key(task_id="x")


def test_pass_at_k(spark):
    from math import comb

    for n, c, k in [(5, 0, 1), (5, 2, 2), (5, 5, 3), (3, 1, 4), (3, 0, 4), (10, 3, 5)]:
        want = (1.0 if c else 0.0) if k > n else 1 - comb(n - c, k) / comb(n, k)
        assert one(spark, numbers.pass_at_k(F.lit(n), F.lit(c), k).alias("x")).x == pytest.approx(want)
    with pytest.raises(Exception, match="no such counts"):
        one(spark, numbers.pass_at_k(F.lit(2), F.lit(3), 1).alias("x"))


# Conversations

CALL = {"id": "c1", "type": "function", "function": {"name": "grep", "arguments": '{"pattern": "x"}'}}
USER, ASKS, ANSWER, END = {"role": "user", "content": "hi"}, {"role": "assistant", "content": "", "tool_calls": [CALL]}, {"role": "tool", "tool_call_id": "c1", "content": "out"}, {"role": "assistant", "content": "done"}
TOOL = {"type": "function", "function": {"name": "grep", "description": "d", "parameters": {"type": "object"}}}


@pytest.mark.parametrize("messages, tools_, reason", [
    ([], None, "no_messages"), ([{**END, "images": [1]}], None, "images_off_user"), ([USER, END], [{"function": {}}], "bad_tool"), ([{"role": "robot"}], None, "unknown_role"),
    ([USER, {"role": "system", "content": "s"}], None, "late_system"), ([{"role": "user", "content": "</tool_use>"}], None, "reserved_tag"), ([USER, {"role": "assistant", "content": " \n"}], None, "empty_turn"),
    ([USER, {"role": "assistant", "tool_calls": [{"function": {"name": "g"}}]}], None, "missing_call_id"), ([USER, {"role": "assistant", "tool_calls": [{"id": "a", "function": {"name": "g", "arguments": "["}}]}], None, "bad_arguments"),
    ([USER, ASKS], [{"name": "other"}], "unlisted_tool"), ([USER, ASKS, ASKS], None, "duplicate_call_id"), ([USER, END, ANSWER], None, "dangling_result"), ([USER, ASKS, ANSWER, ANSWER], None, "second_result"),
    ([USER, ASKS, {"role": "tool"}], None, "no_results"), ([END], None, "no_assistant" if False else "no_user"), ([USER], None, "no_assistant"), ([USER, ASKS], None, "unanswered_call"),
    ([{**USER, "images": [{"ref": "../a", "grid_thw": [1, 2, 2]}]}], None, "bad_image_ref"), ([{**USER, "images": [{"ref": "a", "grid_thw": [1, True, 2]}]}], None, "bad_image_grid"), ([{**USER, "images": [{"ref": "a", "grid_thw": [1, 2, 2]}] * 5}], None, "bad_images"),
])
def test_first_fault(messages, tools_, reason):
    with pytest.raises(ValidationError) as e:
        conversation.normalize({"messages": messages, "tools": tools_})
    assert e.value.reason == reason


def test_canonical_form_and_rejects(spark):
    second = {**CALL, "id": "c2"}
    record = {"messages": [USER, {**ASKS, "tool_calls": [CALL, second]}, ANSWER, {**ANSWER, "tool_call_id": "c2"}, END], "tools": [TOOL]}
    got = conversation.normalize(record)
    assert [m["role"] for m in got["messages"]] == ["user", "assistant", "tool", "assistant"] and len(got["messages"][2]["results"]) == 2
    raw = spark.createDataFrame([(json.dumps(record),), ("{",), ("[]",), (json.dumps({"messages": [USER]}),), (None,)], "value string")
    kept, rejected = conversation.kept_and_rejected(conversation.normalize_records(raw))
    assert kept.count() == 1 and sorted(r.reason for r in rejected.collect()) == ["bad_json", "no_assistant", "not_an_object", "not_an_object"]
    with pytest.raises(Exception, match="bad_json|no_assistant|not_an_object"):
        conversation.kept_and_rejected(conversation.normalize_records(raw), strict=True)[0].collect()
    assert conversation.normalize({"messages": [{"role": "user", "content": "a <tool_use> b"}, END]}, sanitize=True)["messages"][0]["content"] == "a ‹tool_use> b"


def test_long_rules(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", " "), (2, 0, "user", "x"), (2, 1, "system", "s"), (3, 0, "robot", ""), (4, 0, "assistant", "a"), (5, 0, "user", "<tool_use>"), (6, 0, "system", "s"), (6, 1, "user", "u"), (6, 2, "assistant", "a")]
    found = {r.conv_id: (r.turn, r.reason) for r in conversation.long_rejects(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert found == {1: (1, "empty_turn"), 2: (1, "late_system"), 3: (0, "unknown_role"), 4: (None, "no_user"), 5: (0, "reserved_tag"), 6: (None, None)}


def test_render_bytes(spark):
    tool = {"name": "grep", "description": "Find.", "input_schema": {"type": "object"}}
    blank = {"content": "", "reasoning_content": "", "tool_calls": [], "results": [], "images": []}
    talk = {"tools": [tool], "messages": [
        {**blank, "role": "system", "content": " Be good. "}, {**blank, "role": "user", "content": "Look é", "images": [{"ref": "a", "grid_thw": [1, 2, 4], "merge_size": 2}]},
        {**blank, "role": "assistant", "content": "Yes.", "reasoning_content": "Hm.", "tool_calls": [{"id": "c", "name": "grep", "arguments": {"b": 1, "a": "é"}}]},
        {**blank, "role": "tool", "results": [{"tool_use_id": "c", "content": "x", "is_error": False}]}, {**blank, "role": "assistant", "content": "Done."},
    ]}
    want = (
        '<|im_start|>system\nBe good.\n\n<available_tools>\n{"name": "grep", "description": "Find.", "input_schema": {"type": "object"}}\n</available_tools><|im_end|>\n'
        "<|im_start|>user\nLook é\n<|vision_start|><|vision_pad|><|vision_pad|><|vision_end|><|im_end|>\n"
        '<|im_start|>assistant\nHm.\n\nYes.\n<tool_use>{"id": "c", "name": "grep", "input": {"b": 1, "a": "é"}}</tool_use>\n<|im_end|>\n'
        '<|im_start|>user\n<tool_result>{"tool_use_id": "c", "content": "x", "is_error": false}</tool_result>\n<|im_end|>\n<|im_start|>assistant\nDone.\n<|im_end|>\n'
    )
    assert render.render_text(talk) == want
    assert render.render_text(talk, add_generation_prompt=True, enable_thinking=False) == want + "<|im_start|>assistant\n<think>\n\n</think>\n\n"
    rows = spark.createDataFrame([("1", json.dumps(talk))], "conv_id string, conversation string")
    x = render.examples(rows).head()
    assert bytes(i for i, m in zip(x.input_ids, x.assistant_mask) if m).decode() == 'Hm.\n\nYes.\n<tool_use>{"id": "c", "name": "grep", "input": {"b": 1, "a": "é"}}</tool_use>\nDone.\n'
    assert render.examples(rows).select(render.mask_problem(rows).alias("p")).head().p is None
    assert render.token_totals(render.examples(rows)).head().records == 1 and rows.select(render.rendered(F.col("conversation")).alias("t")).head().t == want
    quiet = spark.createDataFrame([("1", json.dumps({"messages": talk["messages"][:2], "tools": []}))], "conv_id string, conversation string")
    assert render.examples(quiet, on_empty="skip").count() == 0
    with pytest.raises(Exception, match="nothing is supervised"):
        render.examples(quiet).count()
    with pytest.raises(TemplateError):
        render.segments({"messages": [{**blank, "role": "robot"}]})


def test_dataset_measures(spark):
    blank = {"reasoning_content": "", "tool_calls": [], "results": [], "images": []}
    talk = lambda *turns_: json.dumps({"tools": [], "messages": [{**blank, "role": r, "content": c} for r, c in turns_]})
    rows = spark.createDataFrame([(1, talk(("user", "a"), ("assistant", "b"))), (2, talk(("user", "a"))), (3, talk(("user", "a" * 500), ("assistant", "b"))), (4, talk(("user", "a"), ("assistant", "b")))], "conv_id long, conversation string")
    kept, refused = render.measure_dataset(rows, max_records=3, max_tokens=200)
    assert [r.conv_id for r in kept.collect()] == ["1"] and {r.conv_id: r.reason for r in refused.collect()} == {"2": "nothing_supervised", "3": "truncated"}
    assert {r.conv_id: r.supervised_tokens for r in render.measured_rows(rows).collect()} == {"1": 2, "3": 2, "4": 2}
    pairs = spark.createDataFrame([("t", talk(("user", "a"), ("assistant", "bb")), talk(("user", "a"), ("assistant", "b")))], "task_id string, chosen string, rejected string")
    both = render.pair_examples(pairs)
    assert batching.pair_lengths(both.withColumn("id", F.lit(1))).head().length == len(both.head().chosen.input_ids)
    assert one(spark, render.sequence_logprob(F.array(F.lit(-1.0), F.lit(-2.0)), F.array(F.lit(0), F.lit(1))).alias("x")).x == -2.0


def test_collate(spark):
    schema = "batch int, input_ids array<int>, attention_mask array<int>, labels array<int>, images array<struct<grid_thw:array<int>,merge_size:int>>"
    good = spark.createDataFrame([(0, [9, 9, 1], [1, 1, 1], [9, 9, 1], [([1, 2, 4], 2)]), (0, [1], [1], [1], None)], schema)
    assert sorted(tuple(r.labels) for r in batching.collate(good, 0, 9, "batch").collect()) == [(-100, -100, 1), (1, -100, -100)]
    with pytest.raises(ValueError):
        batching.collate(good, 9, 9, "batch")
    with pytest.raises(Exception, match="fit the images"):
        batching.collate(good.withColumn("images", F.lit(None).cast(good.schema["images"].dataType)), 0, 9, "batch").collect()


# Trajectories, scores, rewards

TURNS = "task_id long, sample_index int, turn_index int, has_call boolean, tool_name string, status string, call_index int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], TURNS)


def test_trajectories(spark):
    rows = [(1, 0, i, True, "go_test", "ok") for i in range(8)] + [(2, 0, 0, True, "go_test", "ok"), (2, 0, 1, False, None, None), (3, 0, 0, True, "go_test", "ok"), (4, 0, 0, True, "grep", None), (4, 0, 1, False, None, None), (5, 0, 1, False, None, None)]
    found = {r.task_id: r.state for r in trajectory.summarised(turns(spark, rows)).collect()}
    assert found == {1: "truncated", 2: "finished", 3: "unfinished", 4: "unfinished", 5: "unfinished"}


def test_refusals_in_order(spark):
    cols = "task_id string, sample_index int, state string, n_turns long, n_calls long, n_executed long, n_harness long"
    rows = [("a", 0, "truncated", 8, 8, 8, 1), ("b", 0, "truncated", 8, 8, 8, 0), ("c", 0, "finished", 0, 0, 0, 0), ("d", 0, "finished", 1, 0, 0, 0), ("e", 0, "finished", 2, 2, 1, 0), ("f", 0, "finished", 2, 1, 1, 0), ("g", 0, "finished", 2, 1, 1, 0), ("h", 0, "finished", 2, 1, 1, 0), ("", 0, "finished", 2, 1, 1, 0)]
    verdicts = spark.createDataFrame([("g", 0, 0.5), ("h", 0, 1.0)], "task_id string, sample_index int, score double")
    tasks = spark.createDataFrame([(x,) for x in "abcdefghi"] + [("",)], "task_id string")
    found = {r.task_id: r.reason for r in mining.screened(spark.createDataFrame(rows, cols), verdicts, tasks=tasks).collect()}
    assert found == {"a": "harness_error", "b": "truncated", "c": "empty", "d": "no_tool_calls", "e": "dangling_call", "f": "unjudged", "g": "below_threshold", "h": None, "i": "unfinished", "": "missing_task_id"}


def test_rewards_and_pairs(spark):
    rows = [(1, s, 0, True, "go_test", st) for s, st in enumerate(["ok", "ok", "tool_error", "tool_error"])] + [(1, s, 1, False, None, None) for s in range(4)]
    rows += [(2, 0, 0, True, "go_test", "ok"), (2, 0, 1, True, "go_build", "harness_error"), (2, 0, 2, False, None, None), (3, 0, 0, True, "grep", "ok"), (3, 0, 1, False, None, None)]
    t = turns(spark, rows)
    scored = reward.rewards(t, trajectory.summarised(t), ("go_test", "go_build"))
    found = {r.task_id: r for r in reward.preference_outcomes(scored).collect()}
    assert (found[1].chosen, found[1].rejected, found[1].margin, found[1].reason) == (0, 2, 1.0, None)
    assert found[2].reason == "too_few_gradable_samples" and found[3].reason == "nothing_gradable"
    assert {r.task_id: r.rewards for r in reward.reward_lists(scored).collect()} == {1: [1.0, 1.0, 0.0, 0.0], 2: [1.0]}
    assert reward.preference_outcomes(scored, 1.0).where("task_id = 1").head().reason == "no_contrast"


def test_verdict_integrity(spark):
    queue = spark.createDataFrame([("a",), ("b",)], "key string")
    verdicts = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("z", 1.0)], "key string, score double")
    assert sorted(tuple(r) for r in scoring.verdict_problems(verdicts, queue).collect()) == [("duplicate_key", "a"), ("missing_key", "b"), ("unknown_key", "z")]
    with pytest.raises(HarnessError):
        scoring.checked_verdicts(verdicts, queue)


def test_verdict_problems_in_one_aggregate(spark):
    """Every key against a plain count, nulls and repeats included; no join, and one shuffle of both sides."""
    key = "task_id long, sample_index int"
    pool = [(t, s) for t in (1, 2, 3, 11, None) for s in (0, 1, None)]
    queued = [k for i, k in enumerate(pool) if i % 3 != 1] * 2
    judged = [k for i, k in enumerate(pool) if i % 4 != 2 for _ in range(1 + i % 3)]
    label = lambda k: "#".join(str(x) for x in k if x is not None)
    whole = lambda k: None not in k
    want = [("unknown_key", label(k)) for k in {*judged} if not (whole(k) and k in queued)]
    want += [("duplicate_key", label(k)) for k in {*judged} if judged.count(k) > 1]
    want += [("missing_key", label(k)) for k in {*queued} if not (whole(k) and k in judged)]
    found = scoring.verdict_problems(spark.createDataFrame(judged, key), spark.createDataFrame(queued, key), trajectory.SAMPLE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert found.columns == ["problem", "key"]


def test_history(spark):
    schema = "task_id string, sample_index int, turn_index int, text string, calls array<struct<id:string,name:string,arguments:string>>, results array<struct<tool_name:string,status:string,exit_code:int,stdout:string,duration_ms:bigint,harness_error:string,call_index:int>>, prompt string"
    rows = [("t", 0, 0, "look", [("", "grep", "{}")], [("grep", "harness_error", None, "", 1, "lost", 0)], "do it"), ("t", 0, 1, "done", [], [], "do it")]
    found = [[json.loads(m) for m in r.history] for r in trajectory.history(spark.createDataFrame(rows, schema)).orderBy("turn_index").collect()]
    assert found[0] == [{"role": "user", "content": "do it"}]
    assert [m["role"] for m in found[1]] == ["user", "assistant", "tool"] and found[1][2]["content"] == "[infrastructure error] lost" and found[1][2]["is_error"]
    assert "tool_calls" in found[1][1]


# Corpora


def test_code_corpus(spark):
    rows = [("h1", "gin-gonic/gin", "a.go", "package a", 0, 1), ("h1", "gin-gonic/gin", "b/b.go", "package b", 0, 0), ("h2", "golang/go", "c.go", "x", 1, 0), ("h3", "ethereum/go-ethereum", "d.go", "package d", 0, 2), ("h4", "who/knows", "e.go", "", 0, 3)]
    pairs = spark.createDataFrame(rows, "sha256 string, repository string, code_path string, code string, split_ord int, row_ord long").withColumn("directory", text.directory(F.col("code_path")))
    table = codecorpus.licences(spark)
    assert [tuple(r)[:2] for r in codecorpus.refusals(pairs, table).collect()] == [("ethereum/go-ethereum", "review_required"), ("who/knows", "unknown_licence")]
    assert codecorpus.admit(pairs, table, include_review=True).count() == 4
    kept = codecorpus.deduplicate(codecorpus.admit(pairs, table))
    assert {r.code_path for r in kept.collect()} == {"b/b.go", "c.go"}
    m = codecorpus.measure(codecorpus.admit(pairs, table)).head()
    assert (m.files, m.repositories, m.packages, m.missing_package_clause) == (3, 2, 3, 1) and m.duplicate_share == pytest.approx(1 / 3)
    assert [r.name for r in codecorpus.findings(codecorpus.measure(pairs.limit(0))).collect()] == ["no_sources"]


def test_agent_corpus(spark):
    schema = "id string, repository string, package string, tools array<string>, supervised_tokens bigint, total_tokens bigint, has_thinking boolean, has_images boolean"
    healthy = [(str(i), f"r{i % 40}", f"p{i}", ["read_file", "grep", tools.NAMES[i % 9]], 50, 100, True, False) for i in range(900)]
    rows = spark.createDataFrame(healthy, schema)
    m, c = agentcorpus.measure(rows), agentcorpus.tool_counts(rows)
    assert agentcorpus.findings(m, c).count() == 0 and agentcorpus.next_targets(m, c).count() == 0
    poor = spark.createDataFrame([("1", "r", "p", ["grep", "odd"], 0, 0, False, False), ("2", "r", "p", [], 5, 100, False, False)], schema)
    m, c = agentcorpus.measure(poor), agentcorpus.tool_counts(poor)
    names = {r.name for r in agentcorpus.findings(m, c).collect()}
    assert {"tools_outside_catalogue", "too_few_supervised_tokens", "one_repository_dominates", "too_few_packages", "tool_undertrained:grep"} <= names
    assert m.head().supervised_fraction == pytest.approx(0.025) and agentcorpus.measure(poor.limit(0)).head().trajectories == 0
    first = agentcorpus.next_targets(m, c).head()
    assert first.blocked_by == "calls_and_coverage" and first.trajectories_needed == 2500


# Batches and layout


def test_padding_and_accounts(spark):
    rows = spark.createDataFrame([(0, [1, 2, 3], [1, 1, 1], [-100, 2, 3]), (0, [9], [1], [9])], "batch int, input_ids array<int>, attention_mask array<int>, labels array<int>")
    a = batching.batch_accounts(rows, 9, "batch").head()
    assert (a.tokens, a.supervised, a.vision, a.width, a.rows) == (4, 3, 1, 3, 2)
    assert sorted(tuple(r.labels) for r in batching.pad(rows, 0, "batch").collect()) == [(-100, 2, 3), (9, -100, -100)]
    assert batching.over_budget(batching.batch_accounts(rows, 9, "batch"), 5).count() == 1
    r = one(spark, batching.mask_vision(F.array(F.lit(1), F.lit(2)), F.array(F.lit(9), F.lit(2)), 9).alias("m"), batching.merged_patches(F.array(F.lit(1), F.lit(4), F.lit(2)), F.lit(2)).alias("p"), batching.layout_problem(F.array(F.array(F.lit(1))), F.array(F.array(F.lit(2)))).alias("l"))
    assert (r.m, r.p, r.l) == ([-100, 2], 2, "grid")
    with pytest.raises(Exception, match="divide"):
        one(spark, batching.merged_patches(F.array(F.lit(1), F.lit(3), F.lit(2)), F.lit(2)).alias("p"))


def test_grouping_saves_padding(spark):
    rows = spark.createDataFrame([(i, 100) for i in range(64)] + [(100, 32_000)], "id long, length long")
    waste = batching.padding_waste(batching.length_batches(rows, 8), "chunk", "batch").head().waste
    assert waste < 0.05 and batching.too_long(rows, 1000).head().id == 100
    steps = spark.createDataFrame([(0, i, float(i)) for i in range(5)], "epoch int, step int, loss double")
    assert sorted((r.window, r.loss, r.micro_batches) for r in batching.accumulation_windows(steps, 2).collect()) == [(0, 0.5, 2), (1, 2.5, 2), (2, 4.0, 1)]
    with pytest.raises(ValueError):
        batching.length_batches(rows, 0)


# Tools, workspace, judge's text


def test_catalogue(spark):
    tools.guard()
    assert tools.binaries() == ["rtk", "go"] and len(tools.catalogue_sha()) == 64 and tools.catalogue(spark).count() == 9
    with pytest.raises(ConfigError):
        tools.guard([("x", (), (), "raw", "", 1)])
    args = F.array(F.lit("pattern")), F.array(F.lit("path"))
    for raw, want in (('{"pattern": "x"}', None), ("{}", "missing: pattern"), ('{"pattern": "x", "z": "1"}', "unexpected: z"), ('{"pattern": 1}', "not_a_string: pattern"), ("no", "no object")):
        assert one(spark, tools.argument_problem(*args, F.lit(raw)).alias("p")).p == want
    assert one(spark, tools.argv(F.lit("rtk grep -r {pattern} {path}"), F.create_map(F.lit("pattern"), F.lit("a b"))).alias("v")).v == ["rtk", "grep", "-r", "a b", ""]


def test_workspace(tmp_path):
    assert workspace.edit("a b a", "b", "c") == ("a c a", True, "edited") and not workspace.edit("a a", "a", "b")[1] and not workspace.edit("a", "a", "a")[1]
    root = str(tmp_path / "w")
    workspace.seed(root, None)
    for bad in ("", "/etc/x", "../x", "C:\\x"):
        with pytest.raises(ValidationError):
            workspace.inside(root, bad)
    run = workspace.LocalExecutor(timeout=5)
    assert workspace.execute(run, root, "write_file", {"path": "d/f.go", "content": "a\r\nb"})["stdout"] == "created d/f.go"
    assert (tmp_path / "w/d/f.go").read_bytes() == b"a\nb"
    assert workspace.execute(run, root, "edit_file", {"path": "d/f.go", "old_string": "a", "new_string": "z"})["status"] == "ok"
    assert workspace.execute(run, root, "grep", {"pattern": "x", "path": "."})["status"] == "harness_error"
    assert workspace.execute(run, root, "grep", {})["status"] == workspace.execute(run, root, "nothing", {})["status"] == "model_error"
    assert run.run(["sh", "-c", "exit 3"], root)[0] == 3
    with pytest.raises(HarnessError):
        workspace.canary(lambda c: True, [(1, True), (2, False)])
    with pytest.raises(HarnessError):
        workspace.canary(lambda c: True, [])


def test_judge_text(spark):
    record = {"task": {"id": "t", "prompt": "p"}, "truncated": True, "turns": [{"turn": 0, "generated": {"text": "hm", "tool_calls": [{"name": "grep", "arguments": {"b": 1, "a": 2}}]}, "executions": [{"tool_name": "grep", "exit_code": 0, "status": "ok", "stdout": " out \n"}, {"tool_name": "x", "exit_code": None, "status": "harness_error", "stdout": "", "harness_error": "lost"}]}]}
    shown = judging.render(record)
    assert 'engineer: hm\ncalls grep({"a": 2, "b": 1})\n-> grep exit=0 status=ok\nout\n-> x exit=None status=harness_error\n[infrastructure error] lost\n' in shown
    assert one(spark, judging.judge_messages(F.lit(json.dumps(record))).alias("m")).m[1].content == shown
    chat = judging.chat_messages([{"role": "user", "content": "p"}, {"role": "assistant", "content": "", "tool_calls": [{"name": "g", "arguments": {}}]}, {"role": "tool", "tool_call_id": "x", "content": "o"}], "s")
    assert [m["role"] for m in chat] == ["system", "user", "assistant", "tool"]
    with pytest.raises(HarnessError):
        judging.chat_messages([{"role": "robot"}], "s")


def test_idempotency_error_is_a_store_error():
    assert issubclass(IdempotencyError, StoreError)
