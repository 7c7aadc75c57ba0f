"""Mixing sources to target weights by a low-discrepancy schedule.

1. Targets. Sources in code-point order (null last) weigh 5, 2, 1, repeating; together they get `share` times all
   words. A source gets min(cap * its size, level * weight), the level chosen so that the targets add up: that is
   the fixed point of "stop at the cap and reshare the excess by weight".
2. Schedule. Slot t of N maps the golden-ratio point frac((t + 0.5) / phi) through the cumulative targets to a
   source; the rank of a slot among the slots of its source is the block that it takes.
3. Blocks. A source's documents are shuffled by a hash and laid on one line of words, cut into blocks of `block`
   words; after the last word the line starts again (a second epoch). Documents join the slots on (source, block);
   the words of a document that lie in taken blocks are `taken`. A source's last block ends at its target, rounded to
   words (one word at least), and blocks that the schedule leaves out before it get slots of their own at its end: so
   the words of a source come to its target, however few blocks these are.

Prefix sums never gather a source in one task: documents are dealt to about sqrt(rows) hash buckets per source, only
the buckets' sums are ordered per source, and documents are ordered inside their bucket. Slots are ranked alike, by
chunks of slots. Only the table of sources (one row each) is ordered as a whole, in one task: that holds for millions of
sources, whose rows are some ten bytes each, and is no way for sources as many as documents.

Defined cases: null text has size 0; null source is a source of its own, the last; documents of size 0 take 0;
repeated rows are rows of their own; rows without doc_id are shuffled by their text, and in copies() count as one document; an empty table gives an empty result. Only doc_id, source and text are read, so
other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SLOTS = 65536
LONGEST_BLOCK = 1 << 20
CHUNK = 512
U_BUCKETS = 4096
INV_PHI = (math.sqrt(5) - 1) / 2


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words; null text: 0), hash (of doc_id, or of the text of a row without one)."""
    own = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("null"), "text")).otherwise(F.xxhash64("doc_id"))
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), own.alias("hash"))


def targets(base: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, sid (1, 2, ... in code-point order, null last), source_size, target."""
    by_source = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    ordered = everything.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("sid", F.row_number().over(ordered))
    ranked = ranked.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_ratio = everything.orderBy(F.col("most") / F.col("w"), "sid")
    full = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - full) / rest
    found = ranked.withColumn("level", level).withColumn("at", F.row_number().over(by_ratio))
    found = found.withColumn("ok", F.col("level") <= F.col("most") / F.col("w"))
    first = F.min(F.when(F.col("ok"), F.struct("at", "level"))).over(everything).getField("level")
    return found.withColumn("target", F.least("most", F.coalesce(first, F.lit(math.inf)) * F.col("w"))).select("source", "sid", "source_size", "target")


def schedule(aims: DataFrame, n_slots: int) -> DataFrame:
    """sid, block (0, 1, ... per source), slot: which source and which of its blocks each of n_slots slots takes."""
    spark = aims.sparkSession
    line = Window.partitionBy(F.lit(0)).orderBy("sid")
    total = F.sum("target").over(Window.partitionBy(F.lit(0)))
    spans = aims.where("target > 0").withColumn("high", F.sum("target").over(line.rowsBetween(Window.unboundedPreceding, 0)) / total)
    spans = spans.withColumn("low", F.coalesce(F.lag("high").over(line), F.lit(0.0)))
    spans = spans.withColumn("high", F.when(F.lead("sid").over(line).isNull(), F.lit(1.0)).otherwise(F.col("high")))
    cell = F.sequence(F.floor(F.col("low") * U_BUCKETS), F.least(F.floor(F.col("high") * U_BUCKETS), F.lit(U_BUCKETS - 1)))
    spans = spans.select("sid", "low", "high", F.explode(cell).alias("cell"))
    point = (F.col("slot") + 0.5) * INV_PHI
    slots = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("u", point - F.floor(point))
    slots = slots.withColumn("cell", F.floor(F.col("u") * U_BUCKETS))
    dealt = slots.join(spans, "cell").where("u >= low and u < high").select("sid", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    chunks = dealt.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot"))
    return dealt.withColumn("inside", inside).join(chunks, ["sid", "chunk"]).select("sid", (F.col("before") + F.col("inside") - 1).alias("block"), "slot")


def filled(plan: DataFrame, aims: DataFrame, n_slots: int, block: int) -> DataFrame:
    """plan (of schedule(), written) with slots from n_slots on for the blocks below each source's goal that it lacks."""
    got = plan.groupBy("sid").agg(F.count("*").alias("got"))
    lacking = aims.join(got, "sid", "left").select("sid", F.coalesce("got", F.lit(0)).alias("got"), F.ceil(F.col("goal") / block).alias("needed")).where("needed > got")
    more = lacking.select("sid", F.explode(F.sequence("got", F.col("needed") - 1)).alias("block"))
    slot = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("block", "sid")) + F.lit(n_slots - 1).cast("long")
    return plan.unionByName(more.withColumn("slot", slot))


def mix(docs: DataFrame, *, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, slots: int = SLOTS, longest_block: int = LONGEST_BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_slot (the earliest slot that takes words of it; null if none)."""
    base = written(sizes(docs), "mix-sizes")
    count, words = base.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    goal = F.least(F.greatest(F.round("target"), F.lit(1.0)), F.floor(F.col("source_size") * F.lit(float(cap)))).cast("long")
    aims = written(targets(base, weights, share, cap).withColumn("goal", F.when(F.col("target") > 0, goal).otherwise(0)), "mix-targets")
    block = max(1, min(longest_block, math.ceil(share * words / slots)))
    n_slots = math.ceil(share * words / block)
    plan = filled(written(schedule(aims, n_slots), "mix-plan"), aims, n_slots, block)
    bucket = F.pmod(F.col("hash"), F.lit(max(1, math.isqrt(count))))
    base = base.withColumn("bucket", bucket)
    buckets = base.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    buckets = buckets.join(aims, buckets["source"].eqNullSafe(aims["source"])).select(buckets["source"].alias("b_source"), F.col("bucket").alias("b_bucket"), "start", "sid", "source_size", "target", "goal")
    inside = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "hash", "size")
    laid = base.withColumn("no", F.row_number().over(inside)).withColumn("offset", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    laid = laid.join(buckets, laid["source"].eqNullSafe(buckets["b_source"]) & (laid["bucket"] == buckets["b_bucket"]))
    laid = laid.withColumn("offset", F.col("offset") + F.col("start"))
    epochs = F.sequence(F.lit(0), F.lit(math.ceil(cap) - 1))
    runs = laid.withColumn("epoch", F.explode(epochs)).withColumn("from", F.col("offset") + F.col("epoch") * F.col("source_size"))
    runs = runs.withColumn("to", F.least(F.col("from") + F.col("size"), "goal"))
    numbers = F.when(F.col("to") > F.col("from"), F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)))
    runs = runs.withColumn("block", F.explode_outer(numbers))
    met = runs.join(plan, ["sid", "block"], "left")
    words_in = F.when(F.col("slot").isNotNull(), F.least("to", (F.col("block") + 1) * block) - F.greatest("from", F.col("block") * block)).otherwise(0)
    row = ["doc_id", "source", "size", "source_size", "target", "bucket", "no"]
    return met.groupBy(*row).agg(F.sum(words_in).cast("long").alias("taken"), F.min("slot").alias("first_slot")).select(*row[:5], "taken", "first_slot")


def copies(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents that the mix takes, each as often as its words are taken (rounded up), with the columns of docs.

    A document of which no word is taken goes. Rows are joined on doc_id, null included; of rows that share a doc_id the
    largest count holds."""
    times = mixed.where("taken > 0").groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias("__times"))
    met = docs.join(times, docs["doc_id"].eqNullSafe(times["__id"]))
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*[F.col(f"`{c}`") for c in docs.columns])
