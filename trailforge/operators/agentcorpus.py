"""Measures of a corpus of trajectories, findings against fixed thresholds, and what data is needed next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tools import NAMES

# The thresholds of an adequate corpus.
MIN_COVERAGE, MIN_CALLS, MIN_MULTI_TURN, MIN_SUPERVISED, MAX_REPOSITORY, MIN_PACKAGES = 0.02, 50, 0.30, 0.10, 0.80, 200


def tool_counts(rows: DataFrame) -> DataFrame:
    """tool, calls, trajectories (that use it at least once), coverage. rows: schemas.MEASURED."""
    own = rows.select(F.explode(F.transform(F.array_distinct("tools"), lambda t: F.struct(t.alias("tool"), F.size(F.filter("tools", lambda x: x == t)).alias("n")))).alias("x"))
    found = own.groupBy("x.tool").agg(F.sum("x.n").alias("calls"), F.count("*").alias("trajectories"))
    total = rows.agg(F.count("*").alias("total"))
    return found.join(F.broadcast(total)).select("tool", "calls", "trajectories", (F.col("trajectories") / F.col("total")).alias("coverage"))


def measure(rows: DataFrame) -> DataFrame:
    """One row. Shares are of rows; the supervised share is the mean of the rows' own ratios (0 without tokens)."""
    ratio = F.when(F.col("total_tokens") > 0, F.col("supervised_tokens") / F.col("total_tokens")).otherwise(0.0)
    one = lambda c: F.sum(c.cast("long"))
    per_repository = rows.groupBy("repository").agg(
        F.count("*").alias("n"), one(F.size("tools") >= 2).alias("multi"), F.sum(ratio).alias("ratio"), one(F.col("has_thinking")).alias("thinking"),
        one(F.col("has_images")).alias("images"), F.sum("total_tokens").alias("total"), F.sum("supervised_tokens").alias("supervised"),
    )
    packages = rows.groupBy(F.concat_ws("/", "repository", "package").alias("p")).agg(F.lit(1).alias("x")).agg(F.count("*").alias("packages"))
    n = F.sum("n")
    share = lambda c: F.coalesce(F.sum(c) / n, F.lit(0.0))
    totals = per_repository.agg(
        F.coalesce(n, F.lit(0)).alias("trajectories"), F.count("*").alias("repositories"), share("multi").alias("multi_turn_fraction"), share("ratio").alias("supervised_fraction"),
        F.coalesce(F.max("n") / n, F.lit(0.0)).alias("largest_repository_fraction"), share("thinking").alias("thinking_fraction"), share("images").alias("image_fraction"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_tokens"), F.coalesce(F.sum("supervised"), F.lit(0)).alias("supervised_tokens"),
    )
    return totals.join(F.broadcast(packages))


def per_catalogue_tool(counts: DataFrame) -> DataFrame:
    """Every tool of the catalogue with its counts, zero where unused."""
    names = counts.sparkSession.createDataFrame([(n,) for n in NAMES], "tool string")
    return F.broadcast(names).join(counts, "tool", "left").select("tool", F.coalesce("calls", F.lit(0)).alias("calls"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def findings(measured: DataFrame, counts: DataFrame) -> DataFrame:
    """name, measured, required."""
    low = per_catalogue_tool(counts).where((F.col("calls") < MIN_CALLS) | (F.col("coverage") < MIN_COVERAGE))
    tools = low.select(F.concat(F.lit("tool_undertrained:"), "tool").alias("name"), F.when(F.col("calls") < MIN_CALLS, F.col("calls").cast("double")).otherwise(F.col("coverage")).alias("measured"), F.when(F.col("calls") < MIN_CALLS, F.lit(float(MIN_CALLS))).otherwise(F.lit(MIN_COVERAGE)).alias("required"))
    outside = counts.where(~F.col("tool").isin(*NAMES)).agg(F.count("*").alias("n")).where("n > 0").select(F.lit("tools_outside_catalogue").alias("name"), F.col("n").cast("double").alias("measured"), F.lit(0.0).alias("required"))
    rules = [
        ("too_few_multi_turn", "multi_turn_fraction", MIN_MULTI_TURN, F.col("multi_turn_fraction") < MIN_MULTI_TURN),
        ("too_few_supervised_tokens", "supervised_fraction", MIN_SUPERVISED, F.col("supervised_fraction") < MIN_SUPERVISED),
        ("one_repository_dominates", "largest_repository_fraction", MAX_REPOSITORY, F.col("largest_repository_fraction") > MAX_REPOSITORY),
        ("too_few_packages", "packages", MIN_PACKAGES, F.col("packages") < MIN_PACKAGES),
    ]
    cases = F.array(*(F.when(wrong, F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("measured"), F.lit(float(limit)).alias("required"))) for n, c, limit, wrong in rules))
    rest = measured.select(F.explode(F.array_compact(cases)).alias("x")).select("x.*")
    return tools.unionByName(outside).unionByName(rest)


def next_targets(measured: DataFrame, counts: DataFrame) -> DataFrame:
    """tool (null for turns), blocked_by, missing_calls, current_coverage, trajectories_needed, records_to_extend."""
    totals = F.broadcast(measured.select("trajectories", "multi_turn_fraction"))
    met = per_catalogue_tool(counts).join(totals)
    few, narrow = F.col("calls") < MIN_CALLS, F.col("coverage") < MIN_COVERAGE
    missing = F.when(few, MIN_CALLS - F.col("calls")).otherwise(0)
    reach = F.ceil(F.col("trajectories") * MIN_COVERAGE) - F.round(F.col("coverage") * F.col("trajectories"))
    tools = met.where(few | narrow).select(
        "tool", F.when(few & narrow, "calls_and_coverage").when(few, "calls").otherwise("coverage").alias("blocked_by"), missing.cast("long").alias("missing_calls"), "coverage",
        F.when(few & narrow, F.ceil(missing / F.greatest(F.lit(MIN_COVERAGE), "coverage"))).otherwise(0).cast("long").alias("trajectories_needed"),
        F.when(narrow & ~few, F.greatest(F.lit(0), reach)).otherwise(0).cast("long").alias("records_to_extend"),
    )
    short = F.greatest(F.lit(0), F.ceil(F.col("trajectories") * MIN_MULTI_TURN) - F.round(F.col("multi_turn_fraction") * F.col("trajectories")))
    turns = measured.where(F.col("multi_turn_fraction") < MIN_MULTI_TURN).select(F.lit(None).cast("string").alias("tool"), F.lit("multi_turn").alias("blocked_by"), F.lit(0).cast("long").alias("missing_calls"), F.col("multi_turn_fraction").alias("coverage"), short.cast("long").alias("trajectories_needed"), F.lit(0).cast("long").alias("records_to_extend"))
    return tools.unionByName(turns).withColumnRenamed("coverage", "current_coverage").orderBy(F.desc("trajectories_needed"), F.coalesce("tool", F.lit("")))
