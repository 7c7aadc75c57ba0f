"""Files, store, runs with fake hooks, streaming, plans, commands."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from trailforge.errors import ConfigError, DatasetError, HarnessError, IdempotencyError, StoreError
from trailforge.operators import evaluation, tasks
from trailforge.operators.store import ResultStore, new_run_id, verify
from trailforge.plans import cli, planning, stages
from trailforge.sources import files
from trailforge.streaming import stats

CONFIG = {"model_id": "m", "model_revision": "r", "format_version": "f", "template_sha": "t", "harness_version": "h", "dataset_version": "d", "seed": 1, "decode_params": {}, "tool_catalog_sha": "c", "image_digest": ""}


# Files


def test_jsonl(spark, tmp_path):
    path = str(tmp_path / "a.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"id": "a\u2028b", "n": 1}\n\n  \n{"id": "c", "n": 2}\n')
    assert [tuple(r) for r in files.read_jsonl(spark, path, "id string, n int").collect()] == [("a\u2028b", 1), ("c", 2)]
    with open(path, "a", encoding="utf-8") as f:
        f.write("[1]\n{bad\n")
    assert files.read_jsonl(spark, path, "id string, n int", strict=False).where("_bad is not null").count() == 2
    assert sorted(r.line for r in files.bad_line_numbers(spark, path).collect()) == [5, 6]
    with pytest.raises(Exception, match="bad record in"):
        files.read_jsonl(spark, path, "id string, n int").collect()
    with pytest.raises(DatasetError):
        files.read_jsonl(spark, path + "x", "id string")
    out = str(tmp_path / "out")
    assert files.write_jsonl(spark.createDataFrame([("é", 1), (None, 2)], "b string, a int"), out, sort_keys=True) == 2
    assert sorted(r.value for r in spark.read.text(out).collect()) == ['{"a": 1, "b": "é"}', '{"a": 2}']


def pair(i, **more):
    return {"SHA256": f"h{i}", "Repository": "golang/go", "File Name": "x", "File path in Repository": f"d{i}/x.go", "Code": "package x", "Code Commit hash": "c", "File Path for Unit Test": "t", "Unit Test - (Ground Truth)": "test", "Unit Test Commit hash": "u", **more}


def test_code_pairs(spark, tmp_path):
    good, bad, odd = (str(tmp_path / n) for n in ("good.json", "bad.json", "odd.json"))
    for path, data in ((good, [pair(0), pair(1)]), (bad, [pair(0), pair(1, Code=" ")]), (odd, {"a": 1})):
        with open(path, "w") as f:
            json.dump(data, f)
    rows = files.read_splits(spark, [good, good]).orderBy("split_ord", "row_ord").collect()
    assert [(r.sha256, r.split_ord, r.row_ord) for r in rows] == [("h0", 0, 0), ("h1", 0, 1), ("h0", 1, 0), ("h1", 1, 1)]
    for path in (bad, odd):
        with pytest.raises(Exception, match="record 1|no JSON array"):
            files.read_pairs(spark, path).collect()


def test_tasks_and_packages(spark, tmp_path):
    for path in ("x.go", "a/y.go", "a/b/z.go", ".git/h.go", "c/readme.md"):
        (tmp_path / "repo" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "repo" / path).write_text("package x\n")
    root = str(tmp_path / "repo")
    assert [r.directory for r in files.harvest_packages(spark, root).collect()] == ["a", "a/b"] and files.harvest_packages(spark, root, 1).count() == 1
    assert files.has_sources(spark, root)
    made = tasks.from_packages(files.harvest_packages(spark, root), "me/repo", root)
    out = str(tmp_path / "tasks.jsonl")
    assert files.write_tasks(made, out) == 2
    assert sorted(r.id for r in files.read_tasks(spark, out).collect()) == ["me/repo:a", "me/repo:a/b"]
    bad = str(tmp_path / "bad.jsonl")
    with open(bad, "w") as f:
        f.write(json.dumps({"id": "a", "repository": "r", "package": "p", "prompt": "", "verification": ["go_vet"], "fixture": ""}) + "\n")
    with pytest.raises(Exception, match="unknown_verification"):
        files.read_tasks(spark, bad).collect()
    both = str(tmp_path / "eval.json")
    with open(both, "w") as f:
        json.dump([{"id": "a", "prompt": "p"}, {"id": "b"}], f)
    assert files.read_eval_tasks(spark, both).count() == 2


def test_queue_and_verdicts(spark, tmp_path):
    queue, verdicts = str(tmp_path / "q"), str(tmp_path / "v")
    entries = spark.createDataFrame([("k2", "b", 0, "p", "t"), ("k1", "a", 0, "p", "t")], "key string, task_id string, sample_index int, prompt string, trajectory string")
    assert files.write_judge_queue(entries, queue) == 2
    read = files.read_judge_queue(spark, queue)
    assert [json.loads(r.value)["key"] for r in spark.read.text(queue).collect()] == ["k1", "k2"]
    files.write_verdicts(spark.createDataFrame([("k1", 1.0, "r"), ("k2", 0.0, "r")], "key string, score double, reason string"), verdicts)
    assert files.read_verdicts(spark, verdicts, read).count() == 2
    with pytest.raises(HarnessError):
        files.read_verdicts(spark, verdicts, read.where("key = 'k1'"))
    with pytest.raises(Exception, match="another version"):
        files.read_judge_queue(spark, verdicts).collect()


def test_preference_pairs_and_conversations(spark, tmp_path):
    path = str(tmp_path / "p")
    pairs = spark.createDataFrame([("q", '[{"role":"user"}]', "[]", "t", 1.0, 0.0, 1.0)], "prompt string, chosen string, rejected string, task_id string, chosen_reward double, rejected_reward double, margin double")
    files.write_preference_pairs(pairs, path)
    assert files.read_preference_pairs(spark, path).select(*pairs.columns).collect() == pairs.collect()
    talk = str(tmp_path / "c.jsonl")
    with open(talk, "w") as f:
        f.write(json.dumps({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}) + "\n")
    got = json.loads(files.read_conversations(spark, talk, [{"name": "grep"}]).head().conversation)
    assert got["tools"][0]["name"] == "grep"
    open(talk, "w").close()
    with pytest.raises(DatasetError):
        files.read_conversations(spark, talk)
    measured = str(tmp_path / "m.jsonl")
    with open(measured, "w") as f:
        f.write('{"id": "1", "repository": "r", "package": "p"}\n')
    assert files.read_measured(spark, measured).head().tools == []


# Store


def test_store(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"))
    key = lambda i: f"{i:064x}"
    rows = lambda *r: spark.createDataFrame([(key(i), "generate", p) for i, p in r], "key string, stage string, payload string")
    assert store.put(rows((1, '{"a":1}'), (2, '{"a":2}'))) == 2 and store.put(rows((1, '{"a":1}'), (3, "{}"))) == 1
    assert store.get(key(1)) == {"a": 1} and store.get(key(9)) is None and store.has(key(2))
    with pytest.raises(IdempotencyError):
        store.put(rows((1, '{"a":9}'), (4, "{}")))
    assert not store.has(key(4))
    with pytest.raises(IdempotencyError):
        store.put(rows((1, '{"a":1}')), strict=True)
    with pytest.raises(StoreError):
        store.get("short")
    again = rows((1, '{"a":1}'), (2, '{"a":0}'), (7, "{}")).select("key", "payload")
    assert sorted((r.key[-1], r.problem) for r in verify(store.objects(), again).collect()) == [("2", "different"), ("7", "missing")]
    run = new_run_id()
    store.start(run, {"seed": 1, "judge": ""})
    assert store.start(run, {"seed": 1, "judge": "j", "store_version": "x"})["judge"] == "j" and store.manifest(run)["judge"] == "j"
    for other in ({"seed": 2, "judge": "j"}, {"seed": 1, "judge": "k"}):
        with pytest.raises(StoreError):
            store.start(run, other)
    with pytest.raises(StoreError):
        store.start("a/b", {})
    store.append_events(run, spark.createDataFrame([("completed", "judge", key(1), 0)], stats.SCHEMA))
    assert store.events(run).count() == 1
    with open(str(tmp_path / "s" / "events" / run / "torn.json"), "w") as f:
        f.write('{"event": "comp')
    with pytest.raises(Exception, match="torn event"):
        store.events(run).collect()


def test_streaming_counts(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [("completed", "generate", "a", 0), ("completed", "generate", "a", 0), ("completed", "judge", "b", 0), ("started", "judge", "c", 0)]
    events = spark.createDataFrame(rows, stats.SCHEMA)
    events.write.json(log)
    run = lambda: stats.run_once(stats.stage_counts(stats.event_stream(spark, log)), str(tmp_path / "t"), str(tmp_path / "c"))
    assert {r.stage: r.n for r in run().collect()} == {"generate": 1, "judge": 1}
    spark.createDataFrame([("completed", "judge", "b", 0), ("completed", "execute", "d", 0)], stats.SCHEMA).write.mode("append").json(log)
    assert {r.stage: r.n for r in run().collect()} == {"generate": 1, "judge": 1, "execute": 1}


# Runs. Hooks are pickled by value: the executors don't have the tests.

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def generator():
    import json

    def call(row):
        assert json.loads(json.loads(row["history_json"])[0])["role"] == "user"
        if row["task_id"] == "loops":
            return {"text": "again", "tool_calls": [{"id": f"c{row['turn']}", "name": "grep", "arguments": {"pattern": "x"}}]}
        if row["turn"] == 0:
            return {"text": "try", "tool_calls": [{"name": "go_test", "arguments": {"pkg": "./..."}}, "noise", {"name": "go_build", "arguments": {"pkg": "."}}]}
        assert len(json.loads(row["history_json"])) == 4
        return {"text": "done", "tool_calls": []}

    return call


def executor():
    def call(row):
        lost = row["task_id"] == "lost"
        return {"tool_name": row["tool_name"], "status": "harness_error" if lost else "tool_error" if int(row["sample_index"]) == 1 else "ok", "exit_code": 0, "stdout": "o", "duration_ms": 1, "harness_error": "gone" if lost else ""}

    return call


def never():
    def call(row):
        raise AssertionError("everything is stored")

    return call


def test_run_and_resume(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"))
    todo = spark.createDataFrame([("a", "do a"), ("lost", "x"), ("loops", "y")], "id string, prompt string")
    args = dict(run_id="r", n_samples=2, max_turns=3, k=2)
    first = evaluation.run_evaluation(CONFIG, todo, store, generate=generator, execute=executor, **args).collect()
    got = {r.task_id: (r.passed, r.tool_errors, r.harness_errors, r.pass_at_n) for r in first}
    assert got == {"a": (1, 1, 0, 1.0), "lost": (0, 0, 2, 0.0), "loops": (1, 3, 0, 1.0)}
    assert evaluation.run_evaluation(CONFIG, todo, store, generate=never, execute=never, **args).collect() == first
    judged = evaluation.run_evaluation(CONFIG, todo, store, generate=never, execute=never, judge=evaluation.session_judge({"a#0": 1.0, "a#1": 0.5, "loops#0": 0.0, "loops#1": 1.0}), identity="j", **args).collect()
    assert {r.task_id: (r.passed, r.judged) for r in judged} == {"a": (1, 2), "lost": (0, 0), "loops": (1, 2)}
    assert {r.stage for r in store.events("r").collect()} == {"generate", "execute", "judge"}
    assert {(r.task_id, r.sample_index): r.reason for r in evaluation.mine(CONFIG, todo, 2, store, max_turns=3).collect()} == {("a", 0): None, ("a", 1): "below_threshold", ("lost", 0): "harness_error", ("lost", 1): "harness_error", ("loops", 0): "truncated", ("loops", 1): "truncated"}
    declared = todo.withColumn("verification", F.array(F.lit("go_test")))
    found = {r.task_id: r for r in evaluation.build_preferences(CONFIG, declared, 2, store, max_turns=3).collect()}
    assert (found["a"].reason, found["a"].chosen, found["a"].rejected) == (None, 0, 1) and found["lost"].reason == found["loops"].reason == "nothing_gradable"
    path = str(tmp_path / "tasks.jsonl")
    with open(path, "w") as f:
        f.write("".join(json.dumps({"id": i, "prompt": p, "verification": ["go_test"]}) + "\n" for i, p in (("a", "do a"), ("lost", "x"), ("loops", "y"))))
    common = ["--store", str(tmp_path / "s"), "--run-id", "r"]
    assert cli.main(["data", "mine", path, *common, "--out", str(tmp_path / "mined")], spark) == 0
    assert cli.main(["data", "preferences", path, *common, "--out", str(tmp_path / "pairs")], spark) == 0
    assert cli.main(["data", "mine", path, *common[:3], "none", "--out", str(tmp_path / "x")], spark) == 1
    with pytest.raises(StoreError):
        evaluation.run_evaluation(CONFIG, todo, store, generate=never, execute=never, run_id="r", n_samples=3, max_turns=3)
    with pytest.raises(ConfigError):
        evaluation.run_turns(CONFIG, todo.limit(0), 1, store, "r2", never, never)


def test_mined_records_are_whole(spark, tmp_path):
    """Messages as the model saw them, the catalogue, metadata; measured by their rendering; refused if they can't be normalised."""
    from trailforge.operators import tools

    def tagged():
        def call(row):
            if row["turn"] == 0:
                return {"text": "<think>look</think>try", "tool_calls": [{"name": "go_test", "arguments": {"pkg": "./..."}}, {"id": "own", "name": "go_build", "arguments": {"pkg": "."}}]}
            return {"text": "done", "tool_calls": []}

        return call

    def says():
        def call(row):
            bad = row["task_id"] == "tags" and row["tool_name"] == "go_test"
            return {"tool_name": row["tool_name"], "status": "tool_error" if row["sample_index"] == 1 and row["tool_name"] == "go_test" else "ok", "exit_code": 0, "stdout": "<tool_use>" if bad else "fine", "duration_ms": 1, "harness_error": ""}

        return call

    store = ResultStore(spark, str(tmp_path / "s"))
    todo = spark.createDataFrame([("a", 'say "hi"\nnow', "me/repo", "pkg", ["go_test"]), ("tags", "x", None, None, ["go_test"])], "id string, prompt string, repository string, package string, verification array<string>")
    evaluation.run_evaluation(CONFIG, todo, store, run_id="r", generate=tagged, execute=says, n_samples=2, max_turns=3)
    records, measured, outcomes = evaluation.mined(CONFIG, todo, 2, store, judged=False, max_turns=3)
    assert {(r.task_id, r.sample_index): r.reason for r in outcomes.collect()} == {("a", 0): None, ("a", 1): None, ("tags", 0): "invalid:reserved_tag", ("tags", 1): "invalid:reserved_tag"}
    got = {r.sample_index: json.loads(r.value) for r in records.collect()}
    messages = got[0]["messages"]
    assert [m["role"] for m in messages] == ["user", "assistant", "tool", "tool", "assistant"] and messages[0]["content"] == 'say "hi"\nnow'
    assert [c["id"] for c in messages[1]["tool_calls"]] == [m["tool_call_id"] for m in messages[2:4]] == ["t0-go_test-0", "own"]
    assert "tool_calls" not in messages[4] and [m["is_error"] for m in got[1]["messages"][2:4]] == [True, False]
    assert got[0]["tools"] == tools.function_specs() and got[0]["metadata"] == {"task_id": "a", "sample_index": 0, "repository": "me/repo", "package": "pkg", "score": 0.0, "source": "eval"}
    rows = {r.id: r for r in measured.collect()}
    from trailforge.operators.conversation import normalize
    from trailforge.operators.render import segments

    parts = segments(normalize(got[0]))
    assert rows["a#0"].total_tokens == sum(len(t.encode()) for t, _ in parts) and rows["a#0"].supervised_tokens == sum(len(t.encode()) for t, s in parts if s)
    assert (rows["a#0"].tools, rows["a#0"].has_thinking, rows["a#0"].has_images, rows["a#0"].repository) == (["go_test", "go_build"], True, False, "me/repo")
    pairs, found = evaluation.preference_pairs(CONFIG, todo, 2, store, max_turns=3)
    assert {r.task_id: r.reason for r in found.collect()} == {"a": None, "tags": None}
    pair = {r.task_id: r for r in pairs.collect()}["a"]
    assert (pair.prompt, pair.chosen_reward, pair.rejected_reward, pair.margin) == ('say "hi"\nnow', 1.0, 0.0, 1.0)
    assert json.loads(pair.chosen) == messages and json.loads(pair.rejected) == got[1]["messages"]
    entries = evaluation.queue_entries(CONFIG, todo, 2, store, 3).orderBy("task_id", "sample_index").collect()
    assert [(r.task_id, r.sample_index) for r in entries] == [("a", 0), ("a", 1), ("tags", 0), ("tags", 1)]
    assert "-> go_test exit=0 status=ok\nfine" in entries[0].trajectory and entries[0].trajectory.startswith("## Task\nid: a\n") and "engineer: done" in entries[0].trajectory


def test_a_turn_runs_once(spark, tmp_path):
    """Each turn is written: what the generator was asked in an earlier turn is never asked again, stored or not."""
    asked = spark.sparkContext.accumulator(0)

    def counting():
        def call(row):
            asked.add(1)
            return {"text": "x", "tool_calls": [{"name": "grep", "arguments": {"pattern": "x"}}] if row["turn"] < 3 else []}

        return call

    todo = spark.createDataFrame([("a", "p"), ("b", "p")], "id string, prompt string")
    calls = evaluation.run_turns(CONFIG, todo, 2, ResultStore(spark, str(tmp_path / "s")), "r", counting, executor, 6)
    assert asked.value == 2 * 2 * 4 and calls.count() == 2 * 2 * 4
    plan = calls._jdf.queryExecution().toString()
    assert "Join" not in plan  # a union of written tables


def test_queue_and_judge_commands(spark, tmp_path, capsys):
    """eval queue against a served model, eval judge with verdicts, data mine: the whole way by commands."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Model(BaseHTTPRequestHandler):
        def do_POST(self):
            sent = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            call = {"id": "c1", "function": {"name": "write_file", "arguments": json.dumps({"path": "a.go", "content": "package a"})}}
            message = {"content": "I write.", "tool_calls": [call]} if len(sent["messages"]) == 2 else {"content": "Done."}
            body = json.dumps({"choices": [{"message": message}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Model)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        tasks_path, out = str(tmp_path / "t.jsonl"), str(tmp_path / "queue")
        with open(tasks_path, "w") as f:
            f.write("".join(json.dumps({"id": i, "prompt": f"do {i}", "repository": "r", "package": "p", "verification": []}) + "\n" for i in "ab"))
        run = ["--store", str(tmp_path / "s"), "--run-id", "r"]
        model = ["--model", "m", "--model-url", f"http://127.0.0.1:{server.server_port}", "--model-revision", "1", "--dataset-version", "d", "--workspace", str(tmp_path / "w"), "--skip-canary"]
        assert cli.main(["eval", "queue", tasks_path, *run, "--out", out, *model], spark) == 1  # not allowed
        assert cli.main(["eval", "queue", tasks_path, *run, "--out", out, *model, "--allow-local-execution"], spark) == 0
        said = json.loads(capsys.readouterr().out.splitlines()[-1])
        assert said["awaiting"] == 2 and said["mean_pass_at_1"] == 1.0 and (tmp_path / "w" / "a-s0" / "a.go").read_text() == "package a"
        queue = files.read_judge_queue(spark, out)
        assert all("created a.go" in r.trajectory for r in queue.collect())
        verdicts = str(tmp_path / "v")
        files.write_verdicts(queue.select("key", F.when(F.col("task_id") == "a", 1.0).otherwise(0.0).alias("score"), F.lit("seen").alias("reason")), verdicts)
        assert cli.main(["eval", "judge", out, verdicts, *run, "--tasks", tasks_path], spark) == 0
        said = json.loads(capsys.readouterr().out.splitlines()[-1])
        assert said["mean_pass_at_1"] == 0.5 and {r["task_id"]: r["passed"] for r in said["per_task"]} == {"a": 1, "b": 0} and not said["reproducible"]
        assert cli.main(["data", "mine", tasks_path, *run, "--out", str(tmp_path / "mined")], spark) == 0
        said = json.loads(capsys.readouterr().out.splitlines()[-1])
        assert said["reasons"] == {"admitted": 1, "below_threshold": 1} and said["corpus"]["trajectories"] == 1
        assert files.read_conversations(spark, str(tmp_path / "mined")).count() == 1
        with pytest.raises(ConfigError):
            evaluation.http_client("ftp://x")
        with pytest.raises(HarnessError):
            evaluation.http_client("http://127.0.0.1:9", timeout=2)({"model": "m"})
    finally:
        server.shutdown()


def test_http_judge():
    reply = lambda text: json.dumps({"choices": [{"message": {"content": text}}]})
    row = {"record": json.dumps({"task": {"id": "a", "prompt": "p"}, "turns": []})}
    sent = []
    call = evaluation.http_judge(lambda r: sent.append(r) or reply('{"pass": true, "reason": "ok"}'), "m", temperature=0.0)()
    assert call(row)["score"] == 1.0 and sent[0]["temperature"] == 0.0 and "id: a" in sent[0]["messages"][1]["content"]
    with pytest.raises(HarnessError):
        evaluation.http_judge(lambda r: reply("no"), "m")()(row)


def test_template_checks():
    from trailforge.errors import TemplateError
    from trailforge.functions.keys import attempt_key, attempt_keys
    from trailforge.operators import render

    good = "{#-\n  format: anthropic-tools-v1\n-#}{% generation %}"
    assert render.template_version(good) == "anthropic-tools-v1" and render.check_token_format(good, 1, 2) is None
    for source, pad in (("{# x #}", 1), (good.replace("v1", "v2"), 1), (good.split("{%")[0], 1), (good, None), (good, 2)):
        with pytest.raises(TemplateError):
            render.check_token_format(source, pad, 2)
    row = {**CONFIG, "task_id": "a", "sample_index": 0, "stage": "generate"}
    assert attempt_keys([row, {**row, "sample_index": 1}]) == [attempt_key(**row), attempt_key(**row | {"sample_index": 1})]


def test_budget_is_refused(spark):
    from trailforge.operators import batching

    accounts = spark.createDataFrame([(0, 10, 5), (1, 100, 5)], "batch int, width int, rows int")
    assert batching.within_budget(accounts, 500).count() == 2
    with pytest.raises(Exception, match="over the budget"):
        batching.within_budget(accounts, 499).collect()


def test_planted_failures():
    texts = {"a": {"f": "x == y"}, "b": {"f": "x"}, "c": {"f": "x == z"}, "d": {"f": "q"}}
    passes = lambda p: p != "d" and ("!=" not in texts[p]["f"] or p == "c")
    write = lambda path, t: texts[now[0]].__setitem__(path, t)
    now = [None]

    def sources(p):
        now[0] = p
        return dict(texts[p])

    found = tasks.plant_failures(list("abcd"), passes, sources, write)
    assert (found.kept, found.considered, found.already_failing, found.nothing_to_flip, found.survived_the_change) == (["a"], 4, 1, 1, 1) and texts["c"]["f"] == "x == z"


def test_http_generator():
    sent = []

    def post(request):
        sent.append(request)
        return json.dumps({"choices": [{"message": {"content": "hi"}}]})

    call = evaluation.http_generator(post, "m", "sys", seed=5)()
    assert call({"history_json": json.dumps([json.dumps({"role": "user", "content": "p"})]), "sample_index": 2})["text"] == "hi"
    assert sent[0]["seed"] == 2005 and [m["content"] for m in sent[0]["messages"]] == ["sys", "p"]


def test_late_rows_are_left_out(spark, tmp_path):
    """A real stream with a watermark: what comes more than an hour behind the latest row of an earlier batch isn't counted,
    and a closed window is written once."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def batch(*rows):
        spark.createDataFrame(rows, "time string, event_type string").select(F.col("time").cast("timestamp").alias("ts"), "event_type").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp, event_type string").parquet(source)
        stats.run_once(stats.windowed_counts(stream).select("start", "event_type", "n"), target, str(tmp_path / "c"), mode="append")

    batch(("2024-01-01 10:01:00", "a"), ("2024-01-01 10:02:00", "a"), ("2024-01-01 12:00:00", "b"))
    batch(("2024-01-01 10:03:00", "a"), ("2024-01-01 11:30:00", "a"), ("2024-01-01 14:00:00", "b"))
    batch(("2024-01-01 15:30:00", "c"))
    found = {(r.start.strftime("%H:%M"), r.event_type): r.n for r in spark.read.parquet(target).collect()}
    assert found == {("10:00", "a"): 2, ("11:30", "a"): 1, ("12:00", "b"): 1, ("14:00", "b"): 1}


def test_stream_state_can_be_bounded(spark, tmp_path):
    rows = spark.createDataFrame([("completed", "generate", "a", "2024-01-01 10:00:00"), ("completed", "generate", "a", "2024-01-01 10:00:01"), ("completed", "judge", "b", "2024-01-01 10:00:02")], "event string, stage string, key string, time string")
    path = str(tmp_path / "in")
    rows.withColumn("time", F.col("time").cast("timestamp")).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("event string, stage string, key string, time timestamp").parquet(path)
    out = stats.run_once(stats.completed_once(stream, "time", "1 hour"), str(tmp_path / "t"), str(tmp_path / "c"), mode="append")
    assert sorted(r.key for r in out.collect()) == ["a", "b"]


# Plans and commands


def test_planning():
    arch = planning.Architecture(32, 2560, 248320, 24, 8, 49152)
    plan = planning.OptimisationPlan(context=8192)
    m = plan.memory(arch, 4.33e9, share=0.32)
    assert m.resident == pytest.approx(17.34, abs=0.01) and m.fits(plan.budget_gb) and plan.steps(17) == 3
    assert plan.rate(10**6, 1000) == pytest.approx(0.05e-5) and plan.rate(29, 1000) == pytest.approx(1e-5)
    assert json.loads(plan.record(plan.record()))["training_mode"] == "full"
    with pytest.raises(StoreError):
        planning.OptimisationPlan(context=4096).record(plan.record())
    for bad in ({"dtype": "int8"}, {"batch": 0}, {"warmup_ratio": 1.0}):
        with pytest.raises(ConfigError):
            planning.OptimisationPlan(**bad)
    policy, pusher = planning.PushPolicy("me/x", 100), planning.DryPusher()
    assert policy.steps(250) == [100, 200, 250] and planning.push_if_due(policy, pusher, "d", 100, 250) == 100 and planning.push_if_due(policy, pusher, "d", 101, 250, 100) == 100
    assert pusher.pushed == [("d", "step 100/250")] and policy.final_pending(250, 200)
    with pytest.raises(ConfigError):
        planning.PushPolicy("", 1)
    assert planning.resume_point("auto", lambda: True) == "remote" and planning.resume_point("auto", lambda: False) is None
    with pytest.raises(ConfigError):
        planning.resume_point("auto", lambda: None)


def test_run_config_and_push_state(tmp_path):
    config = planning.RunConfig("m", "r", "d")
    assert set(config.fingerprint()) == set(CONFIG)
    with pytest.raises(ConfigError):
        planning.RunConfig("m", "", "d")
    assert planning.read_push_state(str(tmp_path)) is None
    planning.write_push_state(str(tmp_path), step=3)
    assert planning.read_push_state(str(tmp_path)) == {"step": 3}


def test_stage_chain(tmp_path):
    folder = str(tmp_path / "logs")
    said = []
    chain = [stages.Stage("one", ["sh", "-c", "echo hi"]), stages.Stage("soft", ["sh", "-c", "exit 2"], fatal=False), stages.Stage("off", ["false"], enabled=False), stages.Stage("boom", function=lambda: 1 / 0), stages.Stage("never", ["true"])]
    results = stages.run_stages(chain, folder, said.append)
    assert [(r.name, r.returncode) for r in results] == [("one", 0), ("soft", 2), ("boom", 1)]
    assert json.load(open(os.path.join(folder, "last_failure.json")))["name"] == "boom" and "failed (1)" in stages.report(results)


def test_commands(spark, tmp_path, capsys):
    path = str(tmp_path / "m.jsonl")
    with open(path, "w") as f:
        f.write('{"id": "1", "repository": "r", "package": "p", "tools": ["grep"]}\n')
    assert cli.main(["data", "measure", path], spark) == 1
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["report"]["trajectories"] == 1
    pairs = str(tmp_path / "p.json")
    with open(pairs, "w") as f:
        json.dump([pair(0), pair(0), pair(1, Repository="no/one")], f)
    assert cli.main(["data", "go-pairs", pairs, "--out", str(tmp_path / "o")], spark) == 1
    said = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert said["written"] == 1 and said["duplicate_share_before"] == 0.5 and said["refused"][0]["refusal"] == "unknown_licence"
    talk = str(tmp_path / "c.jsonl")
    with open(talk, "w") as f:
        f.write(json.dumps({"messages": [{"role": "user", "content": "a"}]}) + "\n")
    assert cli.main(["data", "validate", talk, "--out", str(tmp_path / "t")], spark) == 2
    assert cli.main(["data", "prepare", pairs, "--out", str(tmp_path / "prepared")], spark) == 0
    said = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert said["written"] == 1 and not said["refused"] and said["tokens"]["supervised"] == len("test\n")
    assert cli.main(["data", "prepare", pairs, "--out", str(tmp_path / "none"), "--max-tokens", "10"], spark) == 2
    chain = str(tmp_path / "stages.json")
    with open(chain, "w") as f:
        json.dump([{"name": "a", "command": ["true"]}, {"name": "b", "command": ["false"], "fatal": False}, {"name": "c", "command": ["false"]}], f)
    assert cli.main(["pipeline", "run", chain, "--logs", str(tmp_path / "logs")], spark) == 1
    assert cli.main(["pipeline", "run", chain, "--logs", str(tmp_path / "logs"), "--skip", "c"], spark) == 0
    assert cli.main(["pipeline", "run", chain, "--logs", str(tmp_path / "logs"), "--skip", "d"], spark) == 1
    assert cli.main(["data", "measure", path + "x"], spark) == 1
    assert spark.range(1).select(F.lit(1)).count() == 1
