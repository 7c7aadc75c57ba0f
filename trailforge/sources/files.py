"""Readers and writers with fixed schemas. Strict readers raise on the first bad record; others keep bad records apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DatasetError, HarnessError
from ..functions.shipping import ship
from ..functions.text import blank, json_style, strip
from ..schemas import CODE_PAIR, MEASURED, PAIR, QUEUE_ENTRY, QUEUE_VERSION, TASK, VERDICT, VERDICTS_VERSION, VERIFIERS

# The field names of the published code pairs, and of ours.
PAIR_FIELDS = {
    "SHA256": "sha256", "Repository": "repository", "File path in Repository": "code_path", "Code": "code", "Code Commit hash": "code_commit",
    "File Path for Unit Test": "test_path", "Unit Test - (Ground Truth)": "test", "Unit Test Commit hash": "test_commit",
}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file of the lines that are not blank; only \\n ends a line, so U+2028 and the like stay inside."""
    ship(spark)
    if not exists(spark, path):
        raise DatasetError(f"no such file: {path}")
    return spark.read.option("lineSep", "\n").text(path).select(strip(F.col("value")).alias("value"), F.col("_metadata.file_path").alias("file")).where("value <> ''")


def _object(x: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(x)).like("OBJECT%"), F.lit(False))


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True, required: tuple[str, ...] = ()) -> DataFrame:
    """The records of schema. Bad JSON, a value that is no object, or a required field that is null: an error that names
    the file and the line's start, or, if not strict, a row with `_bad` (the line) and nulls."""
    parsed = lines(spark, path).withColumn("x", F.from_json("value", schema)).withColumn("_ok", _object(F.col("value")))
    for name in required:
        parsed = parsed.withColumn("_ok", F.col("_ok") & F.col(f"x.{name}").isNotNull())
    if strict:
        fail = F.raise_error(F.concat(F.lit("bad record in "), "file", F.lit(": "), F.substring("value", 1, 80))).cast("boolean")
        return parsed.where(F.when(F.col("_ok"), True).otherwise(fail)).select("x.*")
    return parsed.select("x.*", F.when(~F.col("_ok"), F.col("value")).alias("_bad"))


def bad_line_numbers(spark: SparkSession, path: str) -> DataFrame:
    """file, line, value of the lines that are no JSON object: read whole, for error messages only."""
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line", "value"), F.col("_metadata.file_path").alias("file"))
    return whole.where(~blank(F.col("value")) & ~_object(F.col("value"))).select("file", (F.col("line") + 1).alias("line"), "value")


def write_lines(rows: DataFrame, path: str, column: str = "value") -> int:
    """Lines of text; returns how many, observed while writing."""
    from pyspark.sql import Observation

    seen = Observation()
    rows.select(F.col(column).alias("value")).observe(seen, F.count("*").alias("n")).write.option("lineSep", "\n").text(path)
    return seen.get["n"]


def write_jsonl(rows: DataFrame, path: str, sort_keys: bool = False) -> int:
    """A JSON line per row; null fields are left out; keys in the columns' order, or sorted."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    return write_lines(rows.select((json_style(text, "sorted_spaced") if sort_keys else text).alias("value")), path)


def read_pairs(spark: SparkSession, path: str, split_ord: int = 0) -> DataFrame:
    """Code pairs of one split: a JSON array of objects with eight required fields; code and test may not be blank. Any
    fault is an error, never a dropped row. row_ord is the place in the array."""
    ship(spark)
    schema = ", ".join(f"`{name}` string" for name in PAIR_FIELDS)
    whole = spark.read.text(path, wholetext=True)
    listed = whole.select(F.from_json("value", "array<string>").alias("x"), F.ltrim("value").startswith("[").alias("ok"))
    listed = listed.withColumn("x", F.when(F.col("ok") & F.col("x").isNotNull(), F.col("x")).otherwise(F.raise_error(F.lit(f"{path}: no JSON array")).cast("array<string>")))
    rows = listed.select(F.posexplode("x").alias("row_ord", "raw")).withColumn("r", F.from_json("raw", schema))
    whole_row = _object(F.col("raw"))
    for name in PAIR_FIELDS:
        whole_row = whole_row & F.col(f"r.`{name}`").isNotNull()
    whole_row = whole_row & ~blank(F.col("r.`Code`")) & ~blank(F.col("r.`Unit Test - (Ground Truth)`"))
    fail = F.raise_error(F.concat(F.lit(f"{path}: record "), F.col("row_ord").cast("string"), F.lit(" lacks a field, or its code or test is blank"))).cast("boolean")
    rows = rows.where(F.when(F.coalesce(whole_row, F.lit(False)), True).otherwise(fail))
    return rows.select(*[F.col(f"r.`{theirs}`").alias(ours) for theirs, ours in PAIR_FIELDS.items()], F.lit(split_ord).alias("split_ord"), F.col("row_ord").cast("long").alias("row_ord"))


def read_splits(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All splits, in the order of paths."""
    if not paths:
        raise DatasetError("no splits")
    found = read_pairs(spark, paths[0])
    for i, path in enumerate(paths[1:], 1):
        found = found.unionByName(read_pairs(spark, path, i))
    return found


def read_measured(spark: SparkSession, path: str) -> DataFrame:
    rows = read_jsonl(spark, path, MEASURED, required=("id", "repository", "package"))
    zero, no = F.lit(0).cast("long"), F.lit(False)
    return rows.withColumns({"tools": F.coalesce("tools", F.array().cast("array<string>")), "supervised_tokens": F.coalesce("supervised_tokens", zero), "total_tokens": F.coalesce("total_tokens", zero), "has_thinking": F.coalesce("has_thinking", no), "has_images": F.coalesce("has_images", no)})


def task_problem() -> Column:
    """Why a task can't be used, or null: it needs an id, a repository, a package, and known verification commands."""
    named = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return F.when(~(named("id") & named("repository") & named("package")), "unnamed").when(F.coalesce(F.size("verification"), F.lit(0)) < 1, "no_verification").when(F.size(F.array_except("verification", F.array(*map(F.lit, VERIFIERS)))) > 0, "unknown_verification")


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks with their constraints checked row by row."""
    rows = read_jsonl(spark, path, TASK, required=("id", "repository", "package", "prompt", "verification", "fixture"))
    fail = F.raise_error(F.concat(F.lit("task "), F.coalesce("id", F.lit("?")), F.lit(": "), task_problem())).cast("boolean")
    return rows.where(F.when(task_problem().isNull(), True).otherwise(fail)).withColumn("has_images", F.coalesce("has_images", F.lit(False)))


def write_tasks(tasks: DataFrame, path: str) -> int:
    return write_jsonl(tasks, path, sort_keys=True)


def read_eval_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks for a run, from .jsonl or a JSON array; each needs an id."""
    schema = "id string, prompt string, repository string, package string, verification array<string>"
    if path.endswith(".jsonl"):
        return read_jsonl(spark, path, schema, required=("id",))
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")).alias("x")).select("x.*")
    return rows.where(F.when(F.coalesce("id", F.lit("")) != "", True).otherwise(F.raise_error(F.lit(f"{path}: a task without an id")).cast("boolean")))


def _of_version(rows: DataFrame, version: str) -> DataFrame:
    fail = F.raise_error(F.concat(F.lit(f"made for another version than {version}: "), F.coalesce("version", F.lit("none")))).cast("boolean")
    return rows.where(F.when(F.col("version") == version, True).otherwise(fail))


def write_judge_queue(entries: DataFrame, path: str) -> int:
    """In order of task and sample, as one file with sorted keys: a queue is read by people."""
    rows = entries.withColumn("version", F.lit(QUEUE_VERSION)).orderBy("task_id", "sample_index")
    text = F.to_json(F.struct("key", "prompt", "sample_index", "task_id", "trajectory", "version"))
    return write_lines(rows.select(json_style(text, "sorted_spaced").alias("value")).coalesce(1), path)


def read_judge_queue(spark: SparkSession, path: str) -> DataFrame:
    return _of_version(read_jsonl(spark, path, QUEUE_ENTRY, required=("key",)), QUEUE_VERSION)


def write_verdicts(verdicts: DataFrame, path: str) -> int:
    rows = verdicts.withColumn("version", F.lit(VERDICTS_VERSION)).orderBy("key")
    return write_lines(rows.select(json_style(F.to_json(F.struct("key", "reason", "score", "version")), "sorted_spaced").alias("value")).coalesce(1), path)


def read_verdicts(spark: SparkSession, path: str, queue: DataFrame) -> DataFrame:
    """Verdicts of the current version with scores between 0 and 1, whose keys are those of the queue, each once."""
    from ..operators.scoring import checked_verdicts

    rows = _of_version(read_jsonl(spark, path, VERDICT, required=("key", "score")), VERDICTS_VERSION)
    wrong = rows.where(~F.col("score").between(0, 1))
    if not wrong.isEmpty():
        raise HarnessError(f"{path}: a score outside 0 to 1")
    return checked_verdicts(rows, queue)


def read_preference_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Chosen and rejected messages (JSON) are required; rewards default to 1 and 0, the margin to 1, the id to pair-N."""
    raw = "prompt string, chosen string, rejected string, metadata struct<task_id:string,chosen_reward:double,rejected_reward:double,margin:double>"
    rows = read_jsonl(spark, path, raw, required=("chosen", "rejected")).withColumn("n", F.monotonically_increasing_id())
    m = lambda c, default: F.coalesce(f"metadata.{c}", default).alias(c)
    return rows.select("prompt", "chosen", "rejected", m("task_id", F.concat(F.lit("pair-"), "n")), m("chosen_reward", F.lit(1.0)), m("rejected_reward", F.lit(0.0)), m("margin", F.lit(1.0)))


def write_preference_pairs(pairs: DataFrame, path: str) -> int:
    """pairs: schemas.PAIR, with messages as JSON text."""
    assert set(pairs.columns) >= {c.split()[0] for c in PAIR.split(", ")}
    parsed = F.struct("prompt", F.parse_json("chosen").alias("chosen"), F.parse_json("rejected").alias("rejected"), F.struct("task_id", "chosen_reward", "rejected_reward", "margin").alias("metadata"))
    return write_lines(pairs.select(F.to_json(parsed).alias("value")), path)


def read_conversations(spark: SparkSession, path: str, catalogue: list[dict] | None = None) -> DataFrame:
    """conv_id, conversation (canonical JSON) of a training file; an empty file or a bad record is an error; records
    without tools take the catalogue."""
    import json

    from ..operators.conversation import kept_and_rejected, normalize_records

    raw = lines(spark, path)
    if raw.isEmpty():
        raise DatasetError(f"{path} is empty")
    if catalogue is not None:
        bare = F.get_json_object("value", "$.tools").isNull()
        raw = raw.withColumn("value", F.when(bare, F.concat(F.regexp_replace("value", r"\}\s*$", ""), F.lit(', "tools": ' + json.dumps(catalogue) + "}"))).otherwise(F.col("value")))
    kept, _ = kept_and_rejected(normalize_records(raw), strict=True)
    return kept.select(F.monotonically_increasing_id().alias("conv_id"), "conversation")


def repository_files(spark: SparkSession, root: str, pattern: str = "*.go") -> DataFrame:
    """path (below root), directory of the files that match, without reading them."""
    ship(spark)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path")
    below = F.regexp_replace("path", r"^.*?" + root.rstrip("/").replace(".", r"\.") + "/", "")
    return listed.select(below.alias("path")).withColumn("directory", F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit(".")))


def harvest_packages(spark: SparkSession, root: str, limit: int = 0) -> DataFrame:
    """The directories with sources, but the root and those below a name with a leading dot, in order; 0: all."""
    found = repository_files(spark, root).where("directory <> '.'").where(~F.col("directory").rlike(r"(^|/)\.")).select("directory").distinct().orderBy("directory")
    return found.limit(limit) if limit else found


def has_sources(spark: SparkSession, root: str) -> bool:
    return any(not repository_files(spark, root, p).isEmpty() for p in ("*.go", "go.mod", "go.work"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def images(spark: SparkSession, root: str) -> DataFrame:
    """ref (below root), content: only files that lie below root are listed at all."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return listed.select(F.regexp_replace("path", r"^.*?" + root.rstrip("/").replace(".", r"\.") + "/", "").alias("ref"), "content", "length")


def schema_of_pairs() -> str:
    return CODE_PAIR
