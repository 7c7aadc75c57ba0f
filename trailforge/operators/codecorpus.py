"""Source-code corpora: licence admission, keep-first de-duplication, measures, findings, training records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

# Repositories with their licences, those that need a review, and the thresholds of an adequate corpus.
LICENCES = {
    "gin-gonic/gin": "MIT",
    "gohugoio/hugo": "Apache-2.0",
    "golang/go": "BSD-3-Clause",
    "hashicorp/terraform": "BUSL-1.1",
    "kubernetes/kubernetes": "Apache-2.0",
    "moby/moby": "Apache-2.0",
    "pingcap/tidb": "Apache-2.0",
    "prometheus/prometheus": "Apache-2.0",
    "kserve/kserve": "Apache-2.0",
    "ethereum/go-ethereum": "LGPL-3.0",
}
REVIEW = ("hashicorp/terraform", "ethereum/go-ethereum")
MIN_FILES, MIN_REPOSITORIES, MIN_PACKAGES = 1000, 5, 200
MAX_REPOSITORY_SHARE, MAX_DUPLICATE_SHARE = 0.60, 0.05


def licences(spark, table: dict[str, str] | None = None, review=REVIEW) -> DataFrame:
    """repository, licence, needs_review: a constant relation, small by construction."""
    rows = [(k, v, k in review) for k, v in (LICENCES if table is None else table).items()]
    return spark.createDataFrame(rows, "repository string, licence string, needs_review boolean")


def _screened(pairs: DataFrame, table: DataFrame, include_review: bool) -> DataFrame:
    reason = F.when(F.col("licence").isNull(), "unknown_licence").when(F.col("needs_review") & ~F.lit(include_review), "review_required")
    return pairs.join(F.broadcast(table), "repository", "left").withColumn("refusal", reason)


def admit(pairs: DataFrame, table: DataFrame, include_review: bool = False) -> DataFrame:
    """The pairs of admitted repositories."""
    return _screened(pairs, table, include_review).where("refusal is null").drop("licence", "needs_review", "refusal")


def refusals(pairs: DataFrame, table: DataFrame, include_review: bool = False) -> DataFrame:
    """repository, refusal, files: a row per refused repository, in order."""
    refused = _screened(pairs, table, include_review).where("refusal is not null")
    return refused.groupBy("repository", "refusal").agg(F.count("*").alias("files")).orderBy("repository")


def deduplicate(pairs: DataFrame, order=("split_ord", "row_ord")) -> DataFrame:
    """The first row of each hash, in input order: a minimum per hash by partial aggregation, so that a hash that many
    rows share is no hot task."""
    rest = [c for c in pairs.columns if c not in ("sha256", *order)]
    first = pairs.groupBy("sha256").agg(F.min_by(F.struct(*rest, *order), F.struct(*order)).alias("x"))
    return first.select("sha256", *[F.col(f"x.`{c}`").alias(c) for c in (*rest, *order)])


def measure(pairs: DataFrame) -> DataFrame:
    """One row of totals; nothing at all gives zeros. Two levels of sums, so that no distinct count is one task's work."""
    named = pairs.select("sha256", "repository", F.concat("repository", F.lit("/"), "directory").alias("package"), F.octet_length("code").cast("long").alias("bytes"), (text.package_name(F.col("code")) == "").cast("long").alias("nameless"))
    per_repository = named.groupBy("repository").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("nameless").alias("nameless"))
    totals = per_repository.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.count("*").alias("repositories"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("nameless"), F.lit(0)).alias("missing_package_clause"), F.coalesce(F.max("files"), F.lit(0)).alias("largest"),
    )
    packages = named.groupBy("package").agg(F.lit(1).alias("x")).agg(F.count("*").alias("packages"))
    hashes = named.groupBy("sha256").agg(F.lit(1).alias("x")).agg(F.count("*").alias("hashes"))
    share = lambda part: F.when(F.col("files") > 0, part / F.col("files")).otherwise(0.0)
    return totals.join(F.broadcast(packages)).join(F.broadcast(hashes)).select("files", "repositories", "packages", "bytes", share(F.col("files") - F.col("hashes")).alias("duplicate_share"), share(F.col("largest")).alias("largest_repository_share"), "missing_package_clause")


def repository_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("repository").agg(F.count("*").alias("files")).orderBy("repository")


def findings(measured: DataFrame) -> DataFrame:
    """name, measured, required: a row per threshold that is missed; an empty corpus has one finding only."""
    rules = [
        ("too_few_files", "files", MIN_FILES, F.col("files") < MIN_FILES),
        ("too_few_repositories", "repositories", MIN_REPOSITORIES, F.col("repositories") < MIN_REPOSITORIES),
        ("one_repository_dominates", "largest_repository_share", MAX_REPOSITORY_SHARE, F.col("largest_repository_share") > MAX_REPOSITORY_SHARE),
        ("too_few_packages", "packages", MIN_PACKAGES, F.col("packages") < MIN_PACKAGES),
        ("too_many_duplicates", "duplicate_share", MAX_DUPLICATE_SHARE, F.col("duplicate_share") > MAX_DUPLICATE_SHARE),
    ]
    some = F.col("files") > 0
    one = lambda name, x, required: F.struct(F.lit(name).alias("name"), x.cast("double").alias("measured"), F.lit(float(required)).alias("required"))
    cases = [F.when(~some, one("no_sources", F.col("files"), MIN_FILES)), *(F.when(some & wrong, one(name, F.col(c), limit)) for name, c, limit, wrong in rules)]
    return measured.select(F.explode(F.array_compact(F.array(*cases))).alias("x")).select("x.*")


def pretraining_records(pairs: DataFrame) -> DataFrame:
    """text and metadata of each source file."""
    return pairs.select(F.col("code").alias("text"), F.struct("repository", F.col("code_path").alias("path"), F.col("code_commit").alias("commit"), "sha256").alias("metadata"))


def instruction_messages(code_path, repository, code, test):
    """A two-turn record that asks for a file's unit tests."""
    # The wording of the request.
    asked = F.concat(F.lit("Write Go unit tests for the file below. It is "), code_path, F.lit(" from "), repository, F.lit(". Reply with the test file only.\n\n```go\n"), code, F.lit("\n```"))
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("user", asked), turn("assistant", test))


def leading_identifier(docs: DataFrame, word: str) -> DataFrame:
    """doc_id, name: the identifier after the first line that starts with a keyword."""
    return docs.select("doc_id", F.regexp_extract("text", rf"(?md)^\s*{word}\s+([A-Za-z_]\w*)", 1).alias("name"))
