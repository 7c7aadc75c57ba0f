"""Deterministic views of the test tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.shipping import ship
from ..operators.tools import NAMES

N_SAMPLES = 16
#: Catalogue names with the recall tool last: the order in which k selects them.
ORDERED = (*[n for n in NAMES if n != "rtk_recall"], "rtk_recall")
VERIFICATION = ("go_test", "go_build")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_pairs(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.sha2("text", 256).alias("sha256"), F.col("source").alias("repository"), F.col("lang").alias("directory"), F.col("text").alias("code"),
        F.concat("lang", F.lit("/"), "doc_id").alias("code_path"), F.lit(0).alias("split_ord"), F.col("doc_id").alias("row_ord"),
    )


def licences(spark) -> DataFrame:
    """src0 to src13 are permissive, src14 and src15 need a review, others are unknown."""
    return spark.createDataFrame([(f"src{i}", "MIT" if i < 14 else "LGPL-3.0", i >= 14) for i in range(16)], "repository string, licence string, needs_review boolean")


def turns(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    sample = (F.col("event_id") % N_SAMPLES).cast("int")
    rows = events.select(F.col("user_id").alias("task_id"), sample.alias("sample_index"), "event_id", "event_type", "value", k.alias("k"), (F.col("event_type") != "view").alias("has_call"))
    rows = rows.withColumn("turn_index", F.row_number().over(Window.partitionBy("task_id", "sample_index").orderBy("event_id")) - 1)
    status = F.when(F.col("event_type") != "error", "ok").when(F.col("k") % 5 == 0, "harness_error").when(F.col("k") % 5 == 1, "model_error").otherwise("tool_error")
    tool = F.element_at(F.array(*map(F.lit, ORDERED)), F.col("k") % 9 + 1)
    return rows.withColumn("tool_name", F.when(F.col("has_call"), tool)).withColumn("status", F.when(F.col("has_call"), status)).withColumn("call_index", F.lit(0))


def tasks(spark, sf_dir) -> DataFrame:
    own = table(spark, sf_dir, "events").select(F.col("user_id").alias("task_id")).distinct()
    return own.withColumn("repository", F.concat(F.lit("repo"), F.col("task_id") % 7)).withColumn("package", F.concat(F.lit("pkg"), F.col("task_id") % 50))


def verdicts(spark, sf_dir) -> DataFrame:
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    size = F.broadcast(docs.agg((F.max("doc_id") + 1).alias("size")))
    spine = tasks(spark, sf_dir).select("task_id").withColumn("sample_index", F.explode(F.sequence(F.lit(0), F.lit(N_SAMPLES - 1))))
    keyed = spine.join(size).withColumn("doc_id", (F.col("task_id") * N_SAMPLES + F.col("sample_index")) % F.col("size"))
    return keyed.join(labels, "doc_id").select("task_id", "sample_index", F.col("quality").cast("double").alias("score"))


def measured(spark, sf_dir) -> DataFrame:
    """A measured trajectory per task and sample: its tools in order; the tokens are sums of k."""
    rows = turns(spark, sf_dir)
    called = F.array_sort(F.collect_list(F.when(F.col("has_call"), F.struct("turn_index", "tool_name"))))
    found = rows.groupBy("task_id", "sample_index").agg(called.alias("x"), F.sum(F.when(F.col("has_call"), F.col("k"))).alias("supervised"), F.sum("k").alias("total"), F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("bought"))
    return found.select(
        F.concat_ws("#", "task_id", "sample_index").alias("id"), F.concat(F.lit("repo"), F.col("task_id") % 7).alias("repository"), F.concat(F.lit("pkg"), F.col("task_id") % 50).alias("package"),
        F.transform("x", lambda t: t["tool_name"]).alias("tools"), F.coalesce("supervised", F.lit(0)).alias("supervised_tokens"), F.coalesce("total", F.lit(0)).alias("total_tokens"),
        (F.col("bought") == 1).alias("has_thinking"), F.lit(False).alias("has_images"),
    )


def planted(spark, sf_dir) -> DataFrame:
    """measured() with faults: go_doc is go_vet, which no catalogue has; go_mod_tidy is rare; only long ones call rtk_recall; few have several calls."""
    tokens = F.col("total_tokens")
    tool = lambda t: F.when(t == "go_doc", "go_vet").when((t == "go_mod_tidy") & (tokens < 400), "go_test").when((t == "rtk_recall") & (tokens < 250), "grep").otherwise(t)
    rows = measured(spark, sf_dir).withColumn("tools", F.transform("tools", tool))
    return rows.withColumn("tools", F.when(tokens < 150, F.slice("tools", 1, 1)).otherwise(F.col("tools")))


# The same views in SQL, as common table expressions of the oracle queries.
_TOOLS = ", ".join(f"'{n}'" for n in ORDERED)
SQL = {
    "code": "code as (select sha256(text) as sha256, source as repository, lang as directory, text as code, lang || '/' || doc_id as code_path, doc_id as row_ord from documents)",
    "lic": "lic as (select 'src' || i as repository, case when i < 14 then 'MIT' else 'LGPL-3.0' end as licence, i >= 14 as needs_review from range(16) t(i))",
    "turns": f"""turns as (select *, case when has_call then list_extract([{_TOOLS}], k % 9 + 1) end as tool_name,
      case when not has_call then null when event_type <> 'error' then 'ok' when k % 5 = 0 then 'harness_error' when k % 5 = 1 then 'model_error' else 'tool_error' end as status
      from (select user_id as task_id, cast(event_id % 16 as int) as sample_index, event_id, event_type, value, cast(props ->> '$.k' as int) as k, event_type <> 'view' as has_call,
        row_number() over (partition by user_id, event_id % 16 order by event_id) - 1 as turn_index from events))""",
    "traj": """ends as (select task_id, sample_index, min(case when not has_call then turn_index end) as e from turns where turn_index < 8 group by all),
    traj as (select t.task_id, t.sample_index, case when max(e) is not null then 'finished' when count(*) = 8 then 'truncated' else 'unfinished' end as state,
      count(*) as n_turns, count(*) filter (where has_call) as n_calls, count(*) filter (where status is not null) as n_executed, count(*) filter (where status = 'harness_error') as n_harness,
      count(*) filter (where status = 'tool_error') as n_tool_error, count(*) filter (where status = 'model_error') as n_model_error, count(*) filter (where status = 'ok') as n_ok
      from turns t join ends using (task_id, sample_index) where turn_index < 8 and (e is null or turn_index <= e) group by all)""",
    "tasks": "tasks as (select distinct user_id as task_id from events)",
    "spine": "spine as (select task_id, cast(i as int) as sample_index from tasks, range(16) r(i))",
    "verdicts": "verdicts as (select task_id, sample_index, cast(quality as double) as score from spine join labels l on l.doc_id = (task_id * 16 + sample_index) % (select max(doc_id) + 1 from documents))",
    "measured": """measured as (select task_id || '#' || sample_index as id, 'repo' || task_id % 7 as repository, 'pkg' || task_id % 50 as package,
      list(tool_name order by turn_index) filter (where has_call) as tools, coalesce(sum(k) filter (where has_call), 0) as supervised, coalesce(sum(k), 0) as total, bool_or(event_type = 'purchase') as has_thinking
      from turns group by task_id, sample_index)""",
    "planted": """measured as (select * replace (case when total < 150 then x[1:1] else x end as tools) from (select *, list_transform(coalesce(tools, []), lambda t: case when t = 'go_doc' then 'go_vet'
      when t = 'go_mod_tidy' and total < 400 then 'go_test' when t = 'rtk_recall' and total < 250 then 'grep' else t end) as x from whole))""",
    "counts": """counts as (select tool, cast(count(*) as bigint) as calls, count(distinct id) as trajectories, count(distinct id) / (select count(*) from measured) as coverage
      from (select id, unnest(tools) as tool from measured) group by tool)""",
    "scored": """scored as (select task_id, sample_index, state = 'finished' as complete, case when last = 'ok' then 1.0 when last is not null then 0.0 end as reward
      from traj left join (select task_id, sample_index, arg_max(status, turn_index) as last from turns where tool_name in ('go_test', 'go_build') and status <> 'harness_error' and turn_index < 8 group by all)
      using (task_id, sample_index) where state <> 'unfinished')""",
}


def with_views(*names: str) -> str:
    return "with " + ",\n".join(SQL[n] for n in names)
