"""Commands over the operators: python -m trailforge.plans.cli data|eval|pipeline ... Exit codes: 0 fine, 1 inadequate or an error
of the engine, 2 nothing left."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ConfigError, EngineError
from ..operators import agentcorpus, codecorpus, tasks
from ..schemas import MAX_TURNS
from ..sources import files


def _row(df: DataFrame) -> dict:
    return {k: round(v, 4) if isinstance(v, float) else v for k, v in df.head().asDict().items()}


def _rows(df: DataFrame) -> list[dict]:
    """Reports only: a row per threshold, tool or repository."""
    return [r.asDict() for r in df.collect()]


def measure(spark: SparkSession, args) -> int:
    """A corpus of trajectories: its measures, what is missing, and what to collect next."""
    rows = files.read_measured(spark, args.path)
    measured, counts = agentcorpus.measure(rows), agentcorpus.tool_counts(rows)
    found = _rows(agentcorpus.findings(measured, counts))
    print(json.dumps({"report": _row(measured), "findings": found, "targets": _rows(agentcorpus.next_targets(measured, counts)) if found else []}, ensure_ascii=False))
    return 1 if found else 0


def code_pairs(spark: SparkSession, args) -> int:
    """Read, screen licences, measure, keep first copies, measure again, write."""
    pairs = files.read_splits(spark, args.paths)
    pairs = pairs.withColumn("directory", F.when(F.contains("code_path", F.lit("/")), F.regexp_replace("code_path", "/[^/]*$", "")).otherwise(F.lit(".")))
    table = codecorpus.licences(spark)
    admitted = codecorpus.admit(pairs, table, args.include_review)
    kept = codecorpus.deduplicate(admitted)
    before, after = codecorpus.measure(admitted), codecorpus.measure(kept)
    found = _rows(codecorpus.findings(after))
    refused = _rows(codecorpus.refusals(pairs, table, args.include_review))
    n = files.write_jsonl(codecorpus.pretraining_records(kept), args.out) if args.out else None
    print(json.dumps({"report": _row(after), "duplicate_share_before": _row(before)["duplicate_share"], "refused": refused, "findings": found, "written": n}, ensure_ascii=False))
    return 1 if found else 0


def prepare(spark: SparkSession, args) -> int:
    """Instruction records of the code pairs that are admitted, first copies only, in file order; those that render to at
    most max_tokens tokens are written, the others counted by reason."""
    from ..operators import conversation, render

    pairs = codecorpus.deduplicate(codecorpus.admit(files.read_splits(spark, args.paths), codecorpus.licences(spark), args.include_review))
    place = F.concat_ws("-", F.format_string("%04d", F.col("split_ord")), F.format_string("%012d", F.col("row_ord").cast("long")))
    messages = codecorpus.instruction_messages(F.col("code_path"), F.col("repository"), F.col("code"), F.col("test"))
    raw = pairs.select(place.alias("conv_id"), F.to_json(F.struct(messages.alias("messages"))).alias("value"))
    normal = conversation.normalize_records(raw, sanitize=True)
    made, refused = render.measure_dataset(normal.where("reason is null").select("conv_id", "conversation"), args.max_records or None, args.max_tokens)
    n = files.write_lines(made.select("conv_id").join(normal.select("conv_id", "conversation"), "conv_id").orderBy("conv_id"), args.out, "conversation")
    reasons = refused.select("reason").unionByName(normal.where("reason is not null").select("reason")).groupBy("reason").agg(F.count("*").alias("n"))
    print(json.dumps({"written": n, "refused": {r["reason"]: r["n"] for r in _rows(reasons)}, "tokens": _row(render.token_totals(made)) if n else None}))
    return 0 if n else 2


def pipeline(spark: SparkSession, args) -> int:
    """Stages from a JSON list of {name, command, fatal, enabled}; the first fatal failure ends the chain."""
    from . import stages

    with open(args.stages, encoding="utf-8") as f:
        listed = json.load(f)
    off = set(args.skip or [])
    unknown = off - {x.get("name") for x in listed}
    if unknown:
        raise ConfigError(f"no such stages: {sorted(unknown)}")
    chain = [stages.Stage(x["name"], x["command"], fatal=x.get("fatal", True), enabled=x.get("enabled", True) and x["name"] not in off) for x in listed]
    results = stages.run_stages(chain, args.logs, lambda line: print(line, file=sys.stderr))
    print(stages.report(results))
    return 1 if any(r.returncode and s.fatal for r in results for s in chain if s.name == r.name) else 0


def make_tasks(spark: SparkSession, args) -> int:
    packages = files.harvest_packages(spark, args.root, args.limit)
    n = files.write_tasks(tasks.from_packages(packages, args.repository, args.root), args.out)
    print(json.dumps({"tasks": n}))
    return 0 if n else 2


def validate(spark: SparkSession, args) -> int:
    """Kept conversations are written; rejects are counted by reason."""
    from ..operators.conversation import kept_and_rejected, normalize_records

    kept, rejected = kept_and_rejected(normalize_records(files.lines(spark, args.path), sanitize=args.sanitize), args.strict)
    n = files.write_lines(kept, args.out, "conversation")
    print(json.dumps({"kept": n, "rejected": {r["reason"]: r["n"] for r in _rows(rejected.groupBy("reason").agg(F.count("*").alias("n")))}}))
    return 0 if n else 2


def queue(spark: SparkSession, args) -> int:
    """Run the agent over the tasks and write the samples that await a verdict."""
    from ..operators import evaluation, scoring, tools, workspace
    from ..operators.store import ResultStore
    from .planning import RunConfig

    if not args.allow_local_execution:
        raise ConfigError("commands of the model would run on this machine: say --allow-local-execution, for trusted trials")
    decoding = {"temperature": args.temperature, "max_tokens": args.max_tokens}
    config = RunConfig(args.model, args.model_revision, args.dataset_version, args.seed, decoding, args.samples, args.max_turns, tool_catalog_sha=tools.catalogue_sha())
    if not args.skip_canary:
        if absent := workspace.missing_binaries(tools.binaries()):
            raise ConfigError(f"the catalogue needs {absent}, which this machine has not")
        evaluation.probe(args.workspace)
    store, todo = ResultStore(spark, args.store), files.read_eval_tasks(spark, args.tasks)
    generate = evaluation.http_generator(evaluation.http_client(args.model_url, "MODEL_API_KEY"), args.model, args.system, args.seed, **decoding)
    execute = evaluation.local_execution(args.workspace, args.fixture)
    summary = evaluation.run_evaluation(config.fingerprint(), todo, store, run_id=args.run_id, generate=generate, execute=execute, n_samples=args.samples, max_turns=args.max_turns, k=args.samples)
    report = _row(scoring.run_report(summary))
    n = files.write_judge_queue(evaluation.queue_entries(config.fingerprint(), todo, args.samples, store, args.max_turns), args.out)
    print(json.dumps({"scoring": "execution", **report, "awaiting": n}, ensure_ascii=False))
    return 0


def judge(spark: SparkSession, args) -> int:
    """Check verdicts against the queue, store them, and print the scored report. Nothing is executed."""
    from ..operators import evaluation, scoring
    from ..operators.store import ResultStore

    verdicts = files.read_verdicts(spark, args.verdicts, files.read_judge_queue(spark, args.queue))
    n = evaluation.ingest_verdicts(verdicts, ResultStore(spark, args.store), args.identity)
    said = {"stored": n}
    if args.run_id and args.tasks:
        store, config, manifest, todo = _run_of(spark, args)
        samples, turns = manifest["n_samples"], manifest["max_turns"]
        store.start(args.run_id, manifest | {"judge": args.identity})
        calls = evaluation.rebuild_from_store(config, todo, samples, store, turns)
        whole = evaluation.trajectory.summarised(evaluation.per_turn(calls), turns)
        summary = scoring.run_summary(todo.select(F.col("id").alias("task_id")), samples, whole, evaluation.stored_verdicts(config, whole, store), samples)
        said |= {"scoring": "session_judge", "reproducible": False, "judge_identity": args.identity, "run_id": args.run_id, **_row(scoring.run_report(summary, whole)), "per_task": _rows(summary)}
    print(json.dumps(said, ensure_ascii=False))
    return 0


def _run_of(spark, args):
    from ..operators.store import ResultStore

    store = ResultStore(spark, args.store)
    manifest = store.manifest(args.run_id)
    if manifest is None:
        raise EngineError(f"no such run: {args.run_id}")
    rest = {k: v for k, v in manifest.items() if k not in ("n_samples", "max_turns", "judge", "store_version")}
    return store, rest, manifest, files.read_eval_tasks(spark, args.tasks)


def mine(spark: SparkSession, args) -> int:
    """Training records of a stored run; its parameters come from its manifest."""
    from ..operators import evaluation, mining

    store, config, manifest, todo = _run_of(spark, args)
    records, measured, outcomes = evaluation.mined(config, todo, manifest["n_samples"], store, judged=bool(manifest.get("judge")), min_score=args.min_score, max_turns=manifest["max_turns"])
    n = files.write_lines(records, args.out, "value")
    found = {r["reason"]: r["n"] for r in _rows(mining.histogram(outcomes))}
    print(json.dumps({"written": n, "reasons": found, "min_score": args.min_score, "corpus": _row(agentcorpus.measure(measured)) if n else None}, ensure_ascii=False))
    return 0 if n else 2


def preferences(spark: SparkSession, args) -> int:
    """Preference pairs of a stored run, with both conversations."""
    from ..operators import evaluation, mining

    store, config, manifest, todo = _run_of(spark, args)
    pairs, outcomes = evaluation.preference_pairs(config, todo, manifest["n_samples"], store, min_margin=args.min_margin, max_turns=manifest["max_turns"])
    n = files.write_preference_pairs(pairs, args.out)
    found = {("paired" if r["reason"] == "admitted" else r["reason"]): r["n"] for r in _rows(mining.histogram(outcomes))}
    print(json.dumps({"written": n, "reasons": found, "min_margin": args.min_margin}))
    return 0 if n else 2


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trailforge")
    groups = top.add_subparsers(required=True)
    data, evaluate, chains = (groups.add_parser(n).add_subparsers(required=True) for n in ("data", "eval", "pipeline"))
    number = lambda flag, value: ([flag], {"type": type(value), "default": value})

    def add(group, name, run, *options):
        p = group.add_parser(name)
        for flags, more in options:
            p.add_argument(*flags, **more)
        p.set_defaults(run=run)

    add(data, "measure", measure, (["path"], {}))
    add(data, "go-pairs", code_pairs, (["paths"], {"nargs": "+"}), (["--out"], {}), (["--include-review"], {"action": "store_true"}))
    add(data, "prepare", prepare, (["paths"], {"nargs": "+"}), (["--out"], {"required": True}), (["--include-review"], {"action": "store_true"}), number("--max-records", 0), number("--max-tokens", 1_000_000))
    add(chains, "run", pipeline, (["stages"], {}), (["--logs"], {"required": True}), (["--skip"], {"nargs": "*"}))
    add(data, "tasks", make_tasks, (["root"], {}), (["--repository"], {"required": True}), (["--out"], {"required": True}), (["--limit"], {"type": int, "default": 0}))
    add(data, "validate", validate, (["path"], {}), (["--out"], {"required": True}), (["--sanitize"], {"action": "store_true"}), (["--strict"], {"action": "store_true"}))
    stored = [(["tasks"], {}), (["--store"], {"required": True}), (["--run-id"], {"required": True}), (["--out"], {"required": True})]
    add(data, "mine", mine, *stored, (["--min-score"], {"type": float, "default": 1.0}))
    add(data, "preferences", preferences, *stored, (["--min-margin"], {"type": float, "default": 0.0}))
    model = [([x], {"required": True}) for x in ("--model", "--model-url", "--model-revision", "--dataset-version", "--workspace")]
    model += [number("--samples", 1), number("--max-turns", MAX_TURNS), number("--seed", 0), number("--temperature", 0.0), number("--max-tokens", 4096), (["--system"], {"default": ""}), (["--fixture"], {})]
    add(evaluate, "queue", queue, *stored, *model, *[([x], {"action": "store_true"}) for x in ("--skip-canary", "--allow-local-execution")])
    add(evaluate, "judge", judge, (["queue"], {}), (["verdicts"], {}), (["--store"], {"required": True}), (["--identity"], {"default": "session"}), (["--run-id"], {}), (["--tasks"], {}))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("trailforge").getOrCreate()
    try:
        return args.run(spark, args)
    except EngineError as e:
        print(f"{e.code}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
