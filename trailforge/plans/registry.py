"""Every named query of the engine and, where SQL can express it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import keys, numbers, text
from ..operators import agentcorpus, batching, codecorpus, conversation, mining, render, reward, scoring, store, tools, trajectory
from ..streaming import stats
from . import adapters as A
from .adapters import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# Source code


_ADMITTED = with_views("code", "lic") + ", kept as (select c.* from code c join lic using (repository) where not needs_review)"
_DEDUP = _ADMITTED + ", deduped as (select * from kept qualify row_number() over (partition by sha256 order by row_ord) = 1)"


def _admitted(spark, d):
    return codecorpus.admit(A.code_pairs(spark, d), A.licences(spark))


@query(_ADMITTED + " select sha256, repository, code_path from kept")
def code_admit(spark, d):
    return _admitted(spark, d).select("sha256", "repository", "code_path")


@query(with_views("code", "lic") + " select repository, case when licence is null then 'unknown_licence' else 'review_required' end as refusal, count(*) as files from code left join lic using (repository) where licence is null or needs_review group by all")
def code_refusals(spark, d):
    return codecorpus.refusals(A.code_pairs(spark, d), A.licences(spark))


@query(_DEDUP + " select sha256, repository, code_path, row_ord from deduped")
def code_dedup_first(spark, d):
    return codecorpus.deduplicate(_admitted(spark, d)).select("sha256", "repository", "code_path", "row_ord")


_MEASURE = """, m as (select count(*) as files, count(distinct repository) as repositories, count(distinct repository || '/' || directory) as packages, cast(sum(strlen(code)) as bigint) as bytes,
  1 - count(distinct sha256) / count(*) as duplicate_share, (select max(n) from (select count(*) as n from kept group by repository)) / count(*) as largest_repository_share,
  cast(count(*) filter (where regexp_extract(code, '(?m)^\\s*package\\s+([A-Za-z_]\\w*)', 1) = '') as bigint) as missing_package_clause from kept)"""


@query(_ADMITTED + _MEASURE + " select * replace (round(duplicate_share, 6) as duplicate_share, round(largest_repository_share, 6) as largest_repository_share) from m")
def code_measure(spark, d):
    found = codecorpus.measure(_admitted(spark, d))
    return found.withColumns({c: F.round(c, 6) for c in ("duplicate_share", "largest_repository_share")})


@query(_ADMITTED + " select repository, count(*) as files from kept group by 1")
def code_repo_counts(spark, d):
    return codecorpus.repository_counts(_admitted(spark, d))


@query(_ADMITTED + _MEASURE + """ select name, round(measured, 6) as measured, required from (
  select 'too_few_files' as name, cast(files as double) as measured, 1000.0::double as required, files < 1000 as wrong from m union all
  select 'too_few_repositories', repositories, 5, repositories < 5 from m union all select 'one_repository_dominates', largest_repository_share, 0.6, largest_repository_share > 0.6 from m union all
  select 'too_few_packages', packages, 200, packages < 200 from m union all select 'too_many_duplicates', duplicate_share, 0.05, duplicate_share > 0.05 from m) where wrong""")
def code_findings(spark, d):
    return codecorpus.findings(codecorpus.measure(_admitted(spark, d))).withColumn("measured", F.round("measured", 6))


@query("select doc_id, regexp_extract(text, '(?m)^\\s*Licensed\\s+([A-Za-z_]\\w*)', 1) as name from documents")
def leading_identifier(spark, d):
    return codecorpus.leading_identifier(A.table(spark, d, "documents"), "Licensed")


@query(with_views("code") + """ select row_ord, sha256('Write Go unit tests for the file below. It is ' || code_path || ' from ' || repository || E'. Reply with the test file only.\\n\\n```go\\n' || code || E'\\n```') as asked, sha256(directory) as answer from code""")
def instruction_records(spark, d):
    pairs = A.code_pairs(spark, d).withColumn("m", codecorpus.instruction_messages(F.col("code_path"), F.col("repository"), F.col("code"), F.col("directory")))
    return pairs.select("row_ord", F.sha2(F.col("m")[0]["content"], 256).alias("asked"), F.sha2(F.col("m")[1]["content"], 256).alias("answer"))


@query(with_views("code") + " select code as text, repository, code_path as path, sha256 from code")
def pretraining_records(spark, d):
    found = codecorpus.pretraining_records(A.code_pairs(spark, d).withColumn("code_commit", F.lit("")))
    return found.select("text", "metadata.repository", "metadata.path", "metadata.sha256")


# Conversations


def _messages(spark, d):
    return A.table(spark, d, "conversations")


#: The conversations with faults by the length of a text: roles that are late or unknown, empty texts, reserved tags.
_FAULTY = """(select conv_id, turn, case when length(text) % 13 = 0 then 'developer' when length(text) % 29 = 0 then 'robot' else role end as role,
  case when length(text) % 19 = 0 then '' when length(text) % 23 = 0 then '<tool_use>' || text else text end as text from conversations)"""


def _faulty(spark, d):
    n = F.length("text")
    role = F.when(n % 13 == 0, "developer").when(n % 29 == 0, "robot").otherwise(F.col("role"))
    text_ = F.when(n % 19 == 0, "").when(n % 23 == 0, F.concat(F.lit("<tool_use>"), "text")).otherwise(F.col("text"))
    return _messages(spark, d).select("conv_id", "turn", role.alias("role"), text_.alias("text"))


_REJECTS = "with m as (select *, lower(role) as r, min(turn) over (partition by conv_id) as first from " + _FAULTY + """),
  b as (select conv_id, turn, r, case when r is null or r not in ('system', 'developer', 'user', 'assistant', 'tool') then 1 when r in ('system', 'developer') and turn <> first then 2
    when r <> 'assistant' and regexp_matches(coalesce(text, ''), '</?(available_tools|tool_use|tool_result)>') then 3 when r = 'assistant' and trim(coalesce(text, ''), E' \\t\\n\\r') = '' then 4 end as rule from m),
  g as (select conv_id, min(case when rule is not null then row(turn, rule) end) as x, count(*) filter (where r = 'user') as u, count(*) filter (where r = 'assistant') as a from b group by conv_id),
  rej as (select conv_id, x[1] as turn, list_extract(['no_messages', 'unknown_role', 'late_system', 'reserved_tag', 'empty_turn', 'no_user', 'no_assistant'], coalesce(x[2], case when u = 0 then 5 when a = 0 then 6 end) + 1) as reason from g)"""


@query(_REJECTS + " select conv_id, turn, reason from rej")
def conv_validate(spark, d):
    return conversation.long_rejects(_faulty(spark, d))


@query(_REJECTS + " select coalesce(reason, 'admitted') as reason, count(*) as n from rej group by 1")
def conv_reject_counts(spark, d):
    return mining.histogram(conversation.long_rejects(_faulty(spark, d)))


@query("""select conv_id, count(*) as turns, cast(count(*) filter (where role = 'user') as bigint) as users, cast(count(*) filter (where role = 'assistant') as bigint) as assistants, cast(sum(length(text)) as bigint) as chars from conversations group by 1""")
def conv_roles(spark, d):
    n = lambda r: F.count_if(F.col("role") == r).cast("long")
    return _messages(spark, d).groupBy("conv_id").agg(F.count("*").alias("turns"), n("user").alias("users"), n("assistant").alias("assistants"), F.sum(F.length("text")).alias("chars"))


@query("""select conv_id, turn, cast(sum(starts) over (partition by conv_id order by turn) - 1 as bigint) as island from (
  select conv_id, turn, case when role = 'tool' and lag(role) over (partition by conv_id order by turn) = 'tool' then 0 else 1 end as starts from conversations)""")
def conv_islands(spark, d):
    return conversation.islands(_messages(spark, d)).select("conv_id", "turn", F.col("island").cast("long").alias("island"))


@query("""select conv_id, turn, coalesce(string_agg(role || ':' || text, E'\\n') over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), '') as history from conversations""")
def conv_history(spark, d):
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return _messages(spark, d).select("conv_id", "turn", F.array_join(F.collect_list(F.concat("role", F.lit(":"), "text")).over(before), "\n").alias("history"))


@query("""with t as (select conv_id, turn, case when role in ('system', 'developer') then 'system' else role end as r, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') as b from conversations)
  select conv_id, string_agg('<|im_start|>' || r || E'\\n' || b || case when r in ('system', 'assistant') and b <> '' then E'\\n' else '' end || E'<|im_end|>\\n', '' order by turn) as rendered from t group by 1""")
def conv_render(spark, d):
    return render.render_long(_messages(spark, d))


_TURN = """u as (select *, cast(sample_index as varchar) as s, case when status = 'harness_error' then '[infrastructure error] gone' else 'v' || k end as shown from turns where turn_index < 8)"""


_TURN += """, m as (select *, '{"role":"assistant","content":"' || event_type || '"' || case when has_call then ',"tool_calls":[{"id":"","name":"' || tool_name || '","arguments":"{}"}]' else '' end || '}' ||
    case when has_call then E'\\n{"role":"tool","tool_call_id":"t' || turn_index || '-' || tool_name || '-0","name":"' || tool_name || '","status":"' || status || '","content":"' || shown || '","is_error":' || (status <> 'ok') || '}' else '' end as own from u)"""
_TALK = ", " + _TURN + """, talk as (select task_id, sample_index, sha256('{"role":"user","content":"task ' || task_id || '"}' || E'\\n' || string_agg(own, E'\\n' order by turn_index)) as conversation
  from m join ends using (task_id, sample_index) where e is null or turn_index <= e group by task_id, sample_index)"""


def _talked(spark, d):
    """Turns with texts, calls and results."""
    rows = A.turns(spark, d).where("turn_index < 8")
    none = lambda x, kind: F.when(F.col("has_call"), F.array(x)).otherwise(F.array().cast(kind))
    call = F.struct(F.lit("").alias("id"), F.col("tool_name").alias("name"), F.lit("{}").alias("arguments"))
    result = F.struct("tool_name", "status", F.concat(F.lit("v"), "k").alias("stdout"), F.lit("gone").alias("harness_error"), "call_index")
    calls = none(call, "array<struct<id:string,name:string,arguments:string>>")
    results = none(result, "array<struct<tool_name:string,status:string,stdout:string,harness_error:string,call_index:int>>")
    return rows.select(*trajectory.SAMPLE, "turn_index", F.col("event_type").alias("text"), F.concat(F.lit("task "), "task_id").alias("prompt"), calls.alias("calls"), results.alias("results"))


def _conversations(spark, d):
    return trajectory.conversations(_talked(spark, d)).select(*trajectory.SAMPLE, F.sha2(F.array_join("messages", "\n"), 256).alias("conversation"))


@query(with_views("turns") + ", " + _TURN + """
  select task_id, sample_index, turn_index, sha256('{"role":"user","content":"task ' || task_id || '"}' || coalesce(E'\\n' || string_agg(own, E'\\n') over (partition by task_id, sample_index order by turn_index rows between unbounded preceding and 1 preceding), '')) as history from m""")
def traj_history(spark, d):
    """What the model saw before each turn."""
    return trajectory.history(_talked(spark, d)).select(*trajectory.SAMPLE, "turn_index", F.sha2(F.array_join("history", "\n"), 256).alias("history"))


_NESTED = """, c as (select conv_id, turn, r as role, '{"role": ' || to_json(case when r in ('system', 'developer') then 'system' else r end) || ', "content": ' || to_json(text) || ', "reasoning_content": "", "tool_calls": [], "results": [], "images": []}' as shown from m),
  whole as (select conv_id, '{"messages": [' || string_agg(shown, ', ' order by turn) || '], "tools": []}' as conversation, count(*) filter (where role = 'tool') as results from c group by 1)"""


@query(_REJECTS + _NESTED + """ select conv_id, case when reason is null and results > 0 then 'no_results' else reason end as reason, case when reason is null and results = 0 then sha256(conversation) end as conversation from whole join rej using (conv_id)""")
def conv_normalize(spark, d):
    """Whole nested records, normalised one by one; a tool turn without results is refused."""
    turn = F.struct("turn", F.struct("role", F.col("text").alias("content")).alias("m"))
    rows = _faulty(spark, d).withColumn("role", F.lower("role")).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("x"))
    raw = rows.select("conv_id", F.to_json(F.struct(F.transform("x", lambda x: x["m"]).alias("messages"))).alias("value"))
    return conversation.normalize_records(raw).select("conv_id", "reason", F.sha2("conversation", 256).alias("conversation"))


_TAGS = "text"
for _tag in ("<available_tools>", "</available_tools>", "<tool_use>", "</tool_use>", "<tool_result>", "</tool_result>"):
    _TAGS = f"replace({_TAGS}, '{_tag}', '‹{_tag[1:]}')"


@query(f"select doc_id, sha256({_TAGS}) as escaped from (select doc_id, replace(text, ' the ', '<tool_use>') as text from documents)")
def escape_tags(spark, d):
    planted = A.table(spark, d, "documents").select("doc_id", F.replace("text", F.lit(" the "), F.lit("<tool_use>")).alias("text"))
    return planted.select("doc_id", F.sha2(text.escape_reserved_tags(F.col("text")), 256).alias("escaped"))


@query("select event_id, json_valid(props) and json_type(props) = 'OBJECT' as is_object, cast(props ->> '$.k' as int) as k from events")
def props_parse(spark, d):
    return A.table(spark, d, "events").select("event_id", text.is_object(F.col("props")).alias("is_object"), F.get_json_object("props", "$.k").cast("int").alias("k"))


# Trajectories


@query(with_views("turns", "traj") + " select * from traj")
def traj_rebuild(spark, d):
    return trajectory.summarised(A.turns(spark, d))


def _trajectories(spark, d):
    return trajectory.summarised(A.turns(spark, d))


_SCREENED = with_views("turns", "traj", "tasks", "spine", "verdicts") + """, screened as (select task_id, sample_index, score, case when state = 'unfinished' then 'unfinished' when n_harness > 0 then 'harness_error' when state = 'truncated' then 'truncated'
  when n_turns = 0 then 'empty' when n_calls = 0 then 'no_tool_calls' when n_calls <> n_executed then 'dangling_call' when score is null then 'unjudged' when score < 1 then 'below_threshold' end as reason from traj left join verdicts using (task_id, sample_index))"""


def _screened(spark, d):
    return mining.screened(_trajectories(spark, d), A.verdicts(spark, d))


@query(_SCREENED + " select coalesce(reason, 'admitted') as reason, count(*) as n from screened group by 1")
def traj_refusals(spark, d):
    return mining.histogram(_screened(spark, d))


@query(_SCREENED + " select task_id, sample_index, 'repo' || task_id % 7 as repository, 'pkg' || task_id % 50 as package, coalesce(score, 0) as score, 'eval' as source from screened where reason is null")
def mined_records(spark, d):
    return mining.records(_screened(spark, d), A.tasks(spark, d)).select("metadata.*")


@query(_SCREENED + _TALK + " select task_id, sample_index, conversation from screened join talk using (task_id, sample_index) where reason is null")
def mined_conversations(spark, d):
    """The conversations of admitted samples."""
    return _screened(spark, d).where("reason is null").select(*trajectory.SAMPLE).join(_conversations(spark, d), list(trajectory.SAMPLE))


def _pass(n: str, c: str, k: int) -> str:
    terms = " * ".join(f"(({n}) - ({c}) - {i}) / (({n}) - {i})" for i in range(k))
    return f"round(case when {k} > ({n}) then case when ({c}) > 0 then 1.0 else 0.0 end when ({n}) - ({c}) < {k} then 1.0 else 1 - {terms} end, 6)"


_EXEC = """, x as (select task_id, count(*) as samples, cast(count(*) filter (where status = 'ok') as bigint) as passed, cast(count(*) filter (where status = 'tool_error') as bigint) as tool_errors,
  cast(count(*) filter (where status = 'model_error') as bigint) as model_errors, cast(count(*) filter (where status = 'harness_error') as bigint) as harness_errors from turns where status is not null group by 1)"""


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(with_views("turns") + _EXEC + f" select *, round(passed / samples, 6) as pass_at_1, {_pass('samples', 'passed', 4)} as pass_at_n from x")
def exec_summary(spark, d):
    return _rounded(scoring.execution_summary(A.turns(spark, d).where("status is not null"), 4), "pass_at_1", "pass_at_n")


@query(with_views("turns") + _EXEC + f" select task_id, {_pass('samples', 'passed', 4)} as pass_at_4 from x")
def pass_at_k(spark, d):
    found = scoring.execution_summary(A.turns(spark, d).where("status is not null"), 4)
    return found.select("task_id", F.round("pass_at_n", 6).alias("pass_at_4"))


def _summary_sql(value: str, judged: str) -> str:
    return with_views("turns", "traj", "tasks", "spine", "verdicts") + f""", s as (select task_id, count(*) as samples, cast(count(*) filter (where v >= 1) as bigint) as passed, cast(coalesce(sum(n_tool_error), 0) as bigint) as tool_errors,
      cast(coalesce(sum(n_model_error), 0) as bigint) as model_errors, cast(coalesce(sum(n_harness), 0) as bigint) as harness_errors, cast(sum({judged}) as bigint) as judged
      from (select *, {value} as v from spine left join traj using (task_id, sample_index) left join verdicts using (task_id, sample_index)) group by 1)"""


_JUDGED = _summary_sql("coalesce(score, 0)", "case when score is not null then 1 else 0 end")
_BY_EXECUTION = _summary_sql("case when n_executed > 0 and n_ok = n_executed and state <> 'unfinished' then 1 else 0 end", "0")


def _run_summary(spark, d, judged):
    verdicts = A.verdicts(spark, d) if judged else None
    return _rounded(scoring.run_summary(A.tasks(spark, d), A.N_SAMPLES, _trajectories(spark, d), verdicts, 4), "pass_at_1", "pass_at_n")


@query(_JUDGED + f" select *, round(passed / samples, 6) as pass_at_1, {_pass('samples', 'passed', 4)} as pass_at_n from s")
def run_summary_judged(spark, d):
    return _run_summary(spark, d, True)


@query(_BY_EXECUTION + f" select *, round(passed / samples, 6) as pass_at_1, {_pass('samples', 'passed', 4)} as pass_at_n from s")
def run_summary_exec(spark, d):
    return _run_summary(spark, d, False)


@query(_JUDGED + f" select count(*) as tasks, round(avg(round(passed / samples, 6)), 4) as mean_pass_at_1, round(avg({_pass('samples', 'passed', 4)}), 4) as mean_pass_at_n, cast(count(*) filter (where judged = 0) as bigint) as unjudged_tasks from s")
def run_report(spark, d):
    found = scoring.run_report(_run_summary(spark, d, True))
    return found.withColumns({n: F.round(n, 4) for n in ("mean_pass_at_1", "mean_pass_at_n")})


@query(with_views("turns", "traj", "tasks", "spine", "verdicts") + " select task_id, sample_index, state, n_turns from traj where state <> 'unfinished' and n_harness = 0 and not exists (select 1 from verdicts v where v.task_id = traj.task_id and v.sample_index = traj.sample_index)")
def judge_queue(spark, d):
    return scoring.judge_queue(_trajectories(spark, d), A.verdicts(spark, d))


@query(with_views("turns", "traj", "tasks", "spine", "verdicts") + """, q as (select task_id, sample_index from traj where state <> 'unfinished')
  select 'unknown_key' as problem, task_id || '#' || sample_index as key from verdicts where (task_id, sample_index) not in (select (task_id, sample_index) from q)
  union all select 'duplicate_key', task_id || '#' || sample_index from verdicts where score = 0
  union all select 'missing_key', task_id || '#' || sample_index from q where (task_id, sample_index) not in (select (task_id, sample_index) from verdicts)""")
def verdict_integrity(spark, d):
    """Verdicts of score 0 are there twice."""
    queue = _trajectories(spark, d).where("state <> 'unfinished'").select(*trajectory.SAMPLE)
    twice = F.when(F.col("score") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return scoring.verdict_problems(A.verdicts(spark, d).withColumn("copy", F.explode(twice)), queue, trajectory.SAMPLE)


def _scored(spark, d):
    rows = A.turns(spark, d)
    return reward.rewards(rows.where("turn_index < 8"), trajectory.summarised(rows), A.VERIFICATION)


@query(with_views("turns", "traj", "scored") + " select task_id, sample_index, cast(reward as double) as reward, complete from scored")
def reward_last_verification(spark, d):
    return _scored(spark, d)


_PAIRS = with_views("turns", "traj", "scored") + """, g as (select task_id, count(*) filter (where reward is not null and complete) as gradable, count(*) filter (where reward is not null) as graded,
  max(case when reward is not null and complete then row(reward, -sample_index) end) as best, min(case when reward is not null and complete then row(reward, sample_index) end) as worst from scored group by 1),
  o as (select task_id, case when graded = 0 then 'nothing_gradable' when gradable < 2 then 'too_few_gradable_samples' when best[1] - worst[1] <= 0 or -best[2] = worst[2] then 'no_contrast' end as reason,
  -best[2] as chosen, worst[2] as rejected, cast(best[1] as double) as chosen_reward, cast(worst[1] as double) as rejected_reward, cast(best[1] - worst[1] as double) as margin from g)"""


@query(_PAIRS + " select task_id, chosen, rejected, chosen_reward, rejected_reward, margin from o where reason is null")
def preference_pairs(spark, d):
    return reward.pairs(reward.preference_outcomes(_scored(spark, d)))


@query(_PAIRS + _TALK + " select o.task_id, margin, c.conversation as chosen, r.conversation as rejected from o join talk c on c.task_id = o.task_id and c.sample_index = chosen join talk r on r.task_id = o.task_id and r.sample_index = rejected where reason is null")
def preference_conversations(spark, d):
    """Pairs with both conversations."""
    found = reward.pairs(reward.preference_outcomes(_scored(spark, d)))
    talk = _conversations(spark, d)
    for side in ("chosen", "rejected"):
        found = found.join(talk.select("task_id", F.col("sample_index").alias(side), F.col("conversation").alias("talk")), ["task_id", side]).drop(side).withColumnRenamed("talk", side)
    return found.select("task_id", "margin", "chosen", "rejected")


@query(_PAIRS + " select coalesce(reason, 'admitted') as reason, count(*) as n from o group by 1")
def preference_refusals(spark, d):
    return mining.histogram(reward.preference_outcomes(_scored(spark, d)))


@query(with_views("turns", "traj", "scored") + " select task_id, to_json(list(cast(reward as int) order by sample_index)) as rewards from scored where reward is not null group by 1")
def reward_lists(spark, d):
    return reward.reward_lists(_scored(spark, d)).select("task_id", F.to_json(F.transform("rewards", lambda x: x.cast("int"))).alias("rewards"))


# Agent corpus

_MEASURED = with_views("turns", "measured", "counts")
_PLANTED = with_views("turns", "measured").replace("measured as", "whole as") + ",\n" + A.SQL["planted"] + ",\n" + A.SQL["counts"]
_TOTALS = """, m as (select count(*) as trajectories, count(distinct repository) as repositories, count(distinct repository || '/' || package) as packages, count(*) filter (where len(tools) >= 2) / count(*) as multi_turn_fraction,
  avg(case when total > 0 then supervised / total else 0 end) as supervised_fraction, (select max(n) from (select count(*) as n from measured group by repository)) / count(*) as largest_repository_fraction,
  count(*) filter (where has_thinking) / count(*) as thinking_fraction, 0.0::double as image_fraction, cast(sum(total) as bigint) as total_tokens, cast(sum(supervised) as bigint) as supervised_tokens from measured)"""
_SHARES = ("multi_turn_fraction", "supervised_fraction", "largest_repository_fraction", "thinking_fraction", "image_fraction")


@query(_MEASURED + " select tool, calls, trajectories, round(coverage, 6) as coverage from counts")
def tool_counts(spark, d):
    return agentcorpus.tool_counts(A.measured(spark, d)).withColumn("coverage", F.round("coverage", 6))


@query(_MEASURED + _TOTALS + " select * replace (" + ", ".join(f"round({c}, 6) as {c}" for c in _SHARES) + ") from m")
def corpus_measure(spark, d):
    return _rounded(agentcorpus.measure(A.measured(spark, d)), *_SHARES)


_CATALOGUE = ", cat as (select n as tool, coalesce(calls, 0) as calls, coalesce(coverage, 0) as coverage from (select unnest([" + ", ".join(f"'{n}'" for n in tools.NAMES) + "]) as n) left join counts on tool = n)"


@query(_PLANTED + _TOTALS + _CATALOGUE + """ select name, round(measured, 6) as measured, required from (
  select 'tool_undertrained:' || tool as name, case when calls < 50 then calls else coverage end as measured, case when calls < 50 then 50.0 else 0.02 end::double as required, calls < 50 or coverage < 0.02 as wrong from cat union all
  select 'tools_outside_catalogue', count(*), 0.0, count(*) > 0 from counts where tool = 'go_vet' union all
  select 'too_few_multi_turn', multi_turn_fraction, 0.3, multi_turn_fraction < 0.3 from m union all select 'too_few_supervised_tokens', supervised_fraction, 0.1, supervised_fraction < 0.1 from m union all
  select 'one_repository_dominates', largest_repository_fraction, 0.8, largest_repository_fraction > 0.8 from m union all select 'too_few_packages', packages, 200, packages < 200 from m) where wrong""")
def corpus_findings(spark, d):
    rows = A.planted(spark, d)
    return agentcorpus.findings(agentcorpus.measure(rows), agentcorpus.tool_counts(rows)).withColumn("measured", F.round("measured", 6))


@query(_PLANTED + _TOTALS + _CATALOGUE + """ select tool, blocked_by, missing_calls, round(coverage, 6) as current_coverage, trajectories_needed, records_to_extend from (
  select tool, case when calls < 50 and coverage < 0.02 then 'calls_and_coverage' when calls < 50 then 'calls' else 'coverage' end as blocked_by, cast(greatest(0, 50 - calls) as bigint) as missing_calls, coverage,
    cast(case when calls < 50 and coverage < 0.02 then ceil((50 - calls) / greatest(0.02, coverage)) else 0 end as bigint) as trajectories_needed,
    cast(case when calls >= 50 then greatest(0, ceil(0.02 * trajectories) - round(coverage * trajectories)) else 0 end as bigint) as records_to_extend from cat, m where calls < 50 or coverage < 0.02
  union all select null, 'multi_turn', 0, multi_turn_fraction, cast(greatest(0, ceil(0.3 * trajectories) - round(multi_turn_fraction * trajectories)) as bigint), 0 from m where multi_turn_fraction < 0.3)""")
def next_targets(spark, d):
    rows = A.planted(spark, d)
    return agentcorpus.next_targets(agentcorpus.measure(rows), agentcorpus.tool_counts(rows)).withColumn("current_coverage", F.round("current_coverage", 6))


# Store, keys, resume


def _keyed(spark, d):
    rows = A.table(spark, d, "events")
    return rows.select(F.sha2(F.concat_ws("|", "user_id", "event_type", F.get_json_object("props", "$.k")), 256).alias("key"), F.element_at(F.array(*map(F.lit, ("generate", "execute", "judge"))), (F.col("event_id") % 3 + 1).cast("int")).alias("stage"), F.concat(F.lit("v"), F.col("event_id") % 2).alias("payload"), "event_id")


_KEYED = "with k as (select sha256(user_id || '|' || event_type || '|' || (props ->> '$.k')) as key, list_extract(['generate', 'execute', 'judge'], event_id % 3 + 1) as stage, 'v' || event_id % 2 as payload, event_id from events)"


@query(_KEYED + " select key, count(distinct payload) as versions from k group by 1 having count(distinct payload) > 1")
def store_conflicts(spark, d):
    return store.conflicts(_keyed(spark, d))


@query(_KEYED + " select distinct a.key from k a where not exists (select 1 from k b where b.key = a.key and b.stage <> 'judge')")
def resume_pending(spark, d):
    """Every key is requested; results of the generate and execute stages are stored."""
    rows = _keyed(spark, d)
    return store.pending(rows, rows.where("stage <> 'judge'")).select("key").distinct()


def _log(spark, d):
    return _keyed(spark, d).where("stage <> 'judge'").select(F.lit("completed").alias("event"), "stage", "key", F.lit(0).alias("turn"))


@query(_KEYED + " select s as stage, count(key) as n from (select unnest(['generate', 'execute', 'judge']) as s) left join (select * from k where stage <> 'judge') on stage = s group by 1")
def stage_stats(spark, d):
    return store.stage_stats(_log(spark, d))


@query(_KEYED + " select case when stored is null then 'missing' else 'different' end as problem, count(*) as n from (select a.key, max(a.payload) as new, min(b.payload) as stored from k a left join (select key, min(payload) as payload from k where stage = 'generate' group by 1) b using (key) group by 1) where stored is null or new <> stored group by 1")
def idempotency_report(spark, d):
    """The largest payload of every key against what the generate stage has stored, its smallest."""
    rows = _keyed(spark, d)
    stored = rows.where("stage = 'generate'").groupBy("key").agg(F.min("payload").alias("payload"))
    return store.verify(stored, rows.groupBy("key").agg(F.max("payload").alias("payload"))).groupBy("problem").agg(F.count("*").alias("n"))


_CONFIG = {"model_id": "m", "model_revision": "r1", "format_version": "anthropic-tools-v1", "template_sha": "t", "harness_version": "0.2.0", "dataset_version": "d1", "seed": 7, "decode_params": {"top_p": 0.9, "max_tokens": 64}, "tool_catalog_sha": "c", "image_digest": ""}


@query(with_views("turns") + """ select distinct task_id, sample_index, turn_index, sha256('{"dataset_version":"d1","decode_params":{"max_tokens":64,"top_p":0.9},"format_version":"anthropic-tools-v1","harness_version":"0.2.0","image_digest":"","model_id":"m","model_revision":"r1","sample_index":'
  || sample_index || ',"seed":7,"stage":"generate:t' || turn_index || '","store_version":"evalstore-v1","task_id":"' || task_id || '","template_sha":"t","tool_catalog_sha":"c"}') as key from turns""")
def fingerprint_keys(spark, d):
    rows = A.turns(spark, d).select("task_id", "sample_index", "turn_index").distinct()
    return rows.withColumn("key", keys.key_column(_CONFIG, F.col("task_id"), F.col("sample_index"), F.lit("generate"), F.col("turn_index")))


# Batches, text, numbers


def _lengths(spark, d):
    return A.table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.greatest(F.length("text"), F.lit(1)).cast("long").alias("length"))


@query("""with recursive d as (select doc_id as id, cast(greatest(length(text), 1) as bigint) as length, ('0x' || substr(md5('0:' || doc_id), 1, 15))::bigint % (select greatest(1, (count(*) + 255) // 256) from documents) as chunk from documents),
  o as (select *, row_number() over (partition by chunk order by length, id) as i from d),
  r as (select id, length, chunk, i, 0 as batch, 0 as place, length as first from o where i = 1 union all
    select o.id, o.length, o.chunk, o.i, case when x then batch + 1 else batch end, case when x then 0 else place + 1 end, case when x then o.length else first end
    from (select r.*, o.id as oid, place + 1 >= 8 or o.length > 4 * first as x from r join o on o.chunk = r.chunk and o.i = r.i + 1) r join o on o.id = r.oid)
  select id, length, chunk, batch, place from r""")
def length_batches(spark, d):
    return batching.length_batches(_lengths(spark, d), 8)


@query("""select cast(sum(length) as bigint) as real, cast(sum(padded) as bigint) as padded, round((sum(padded) - sum(length)) / sum(padded), 6) as waste from (
  select sum(greatest(length(text), 1)) as length, max(greatest(length(text), 1)) * count(*) as padded from documents group by doc_id // 8)""")
def padding_waste(spark, d):
    found = batching.padding_waste(_lengths(spark, d).withColumn("batch", F.floor(F.col("id") / 8)), "batch")
    return found.withColumn("waste", F.round("waste", 6))


@query("""with d as (select doc_id, text, case when text like E'%\n' then list_slice(string_split(text, E'\n'), 1, -2) else string_split(text, E'\n') end as lines from documents),
  n as (select *, len(lines) as n from d), l as (select doc_id, i, length(lines[i]) + 1 as size from n, unnest(range(1, n + 1)) t(i) where length(text) > 2000),
  a as (select *, sum(size) over (partition by doc_id order by i) as upto from l), h as (select doc_id, count(*) filter (where upto <= 968) as head from a group by 1),
  b as (select a.doc_id, sum(size) over (partition by a.doc_id order by i desc) as back from a join h using (doc_id) where i > head), t as (select doc_id, count(*) filter (where back <= 968) as tail from b group by 1)
  select doc_id, case when length(text) <= 2000 then text else coalesce(array_to_string(list_transform(lines[1:head], lambda x: x || E'\n'), ''), '') || E'\n... (+' || (n - head - coalesce(tail, 0)) || E' more lines truncated)\n'
    || coalesce(array_to_string(list_transform(lines[n - coalesce(tail, 0) + 1:n], lambda x: x || E'\n'), ''), '') end as shown from n left join h using (doc_id) left join t using (doc_id)""")
def truncate_text(spark, d):
    return A.table(spark, d, "documents").select("doc_id", text.truncate_output(F.col("text"), 2000).alias("shown"))


@query("with s as (select i as step, 1000 as total, 100 as w, 2e-5::double as base from range(1101) r(i)) select step, round(1e9 * case when step < w then base * (step + 1) / w when step >= total then 0.05 * base else base * (0.05 + 0.475 * (1 + cos(pi() * least(1.0, (step - w) / greatest(1, total - w))))) end, 3) as nano_lr from s")
def lr_schedule(spark, d):
    total, base = F.lit(1000), F.lit(2e-5)
    steps = spark.range(1101).withColumnRenamed("id", "step")
    return steps.select("step", F.round(numbers.learning_rate(F.col("step"), total, numbers.warmup_steps(total, F.lit(0.1)), base) * 1e9, 3).alias("nano_lr"))


@query("select n as every, t as total, s as step from (select unnest([1, 7, 100, 500]) as n), (select unnest([1, 70, 333]) as t), range(1, 334) r(s) where s <= t and (s % n = 0 or s = t)")
def push_steps(spark, d):
    grid = spark.createDataFrame([(n, t) for n in (1, 7, 100, 500) for t in (1, 70, 333)], "every int, total int")
    return grid.select("every", "total", F.explode(numbers.push_steps(F.col("every").cast("long"), F.col("total").cast("long"))).alias("step"))


@query("""select c as context, round(4.33e9 / 1e9 * 2, 3) as weights, round(4.33e9 * 2 / 1e9, 3) as gradients, round(32.0 * c * 2560 * 2 / 1073741824.0, 3) as stored, round((49152.0 * c + c * 2560 * 16) / 1073741824.0, 3) as transient, round(0.32 * c * 248320 * 4 / 1073741824.0, 3) as loss from (select unnest([2048, 4096, 8192, 16384]) as c)""")
def memory_grid(spark, d):
    grid = spark.createDataFrame([(c,) for c in (2048, 4096, 8192, 16384)], "context long")
    terms = numbers.memory_terms(params=F.lit(4.33e9), trained=F.lit(4.33e9), context=F.col("context"), batch=1, layers=32, hidden=2560, vocab=248320, linear_layers=24, state_bytes=49152, share=0.32)
    return grid.select("context", *[F.round(terms[n], 3).alias(n) for n in ("weights", "gradients", "stored", "transient", "loss")])


@query("""with m as (select user_id, (value - 1) - (value * 0.5 - 2) as m from events) select user_id, round(avg(greatest(-0.1 * m, 0) + ln(1 + exp(-abs(0.1 * m)))), 6) as loss, round(avg(m), 4) as margin, round(avg(case when m > 0 then 1.0 else 0.0 end), 6) as accuracy from m group by 1""")
def dpo_loss(spark, d):
    m = numbers.dpo_margin(F.col("value"), F.col("value") * 0.5, F.lit(1.0), F.lit(2.0))
    rows = A.table(spark, d, "events").select("user_id", m.alias("m"))
    return rows.groupBy("user_id").agg(F.round(F.avg(numbers.dpo_loss(F.col("m"))), 6).alias("loss"), F.round(F.avg("m"), 4).alias("margin"), F.round(F.avg(F.when(F.col("m") > 0, 1.0).otherwise(0.0)), 6).alias("accuracy"))


@query("select h, w, m, cast(h * w // (m * m) as int) as tokens from (select i * 4 as h from range(1, 9) r(i)), (select i * 4 as w from range(1, 9) r(i)), (select unnest([1, 2, 4]) as m)")
def image_layout(spark, d):
    grid = spark.createDataFrame([(h * 4, w * 4, m) for h in range(1, 9) for w in range(1, 9) for m in (1, 2, 4)], "h long, w long, m int")
    return grid.select("h", "w", "m", numbers.vision_tokens(F.array(F.lit(1), "h", "w"), F.col("m")).alias("tokens"))


@query("select event_type, count(*) as n, time_bucket(interval '10 minutes', ts) as start from events group by event_type, start")
def windowed_counts(spark, d):
    found = stats.windowed_counts(A.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    return found.select("event_type", "n", "start")
