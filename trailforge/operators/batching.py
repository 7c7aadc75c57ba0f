"""Length-grouped batches, padding, accounting, and the layout of vision tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import IGNORED_LABEL

BUCKETS = 32
RATIO = 4.0


def length_batches(rows: DataFrame, batch_size: int, bucket_multiplier: int = BUCKETS, ratio: float = RATIO, seed: int = 0, chunk_rows: int | None = None) -> DataFrame:
    """id, length, chunk, batch, place. rows: id, length.

    In expressions only. Rows are shuffled by a hash into chunks of about batch_size * bucket_multiplier rows; a chunk is sorted by length and
    cut where a batch is full or a length exceeds ratio times the batch's first. Chunks come from the hash alone, so no
    order over all rows is needed and every chunk is a bounded group."""
    if batch_size < 1 or ratio < 1 or bucket_multiplier < 1:
        raise ValueError("batch_size, ratio and bucket_multiplier are 1 at least")
    size = chunk_rows or batch_size * bucket_multiplier
    chunks = max(1, -(-rows.count() // size))
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col("id").cast("string"))), 1, 15), 16, 10).cast("long")
    dealt = rows.select("id", "length", F.pmod(number, F.lit(chunks)).alias("chunk"))
    sorted_ = dealt.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("length", "id"))).alias("rows"))

    def step(acc: Column, x: Column) -> Column:
        new = (acc["batch"] < 0) | (acc["place"] + 1 >= batch_size) | (x["length"] > ratio * acc["first"])
        place = F.when(new, 0).otherwise(acc["place"] + 1)
        batch = F.when(new, acc["batch"] + 1).otherwise(acc["batch"])
        first = F.when(new, x["length"]).otherwise(acc["first"])
        return F.struct(batch.alias("batch"), place.alias("place"), first.alias("first"), F.concat(acc["out"], F.array(F.struct(batch.alias("batch"), place.alias("place")))).alias("out"))

    kind = rows.schema["length"].dataType.simpleString()
    start = F.struct(F.lit(-1).alias("batch"), F.lit(0).alias("place"), F.lit(0).cast(kind).alias("first"), F.from_json(F.lit("[]"), "array<struct<batch:int,place:int>>").alias("out"))
    cut = F.aggregate("rows", start, step, lambda acc: acc["out"])
    found = sorted_.select("chunk", F.explode(F.arrays_zip(F.col("rows"), cut.alias("cut"))).alias("x"))
    return found.select("x.rows.id", "x.rows.length", "chunk", "x.cut.batch", "x.cut.place")


def epoch_order(batches: DataFrame, epoch: int, seed: int = 0) -> DataFrame:
    """The batches (chunk, batch) in an epoch's order."""
    return batches.select("chunk", "batch").distinct().orderBy(F.xxhash64(F.lit(seed), F.lit(epoch), "chunk", "batch"), "chunk", "batch")


def accumulation_windows(steps: DataFrame, accumulation: int) -> DataFrame:
    """epoch, window, loss: means over each epoch's windows of micro-batches; the last may be partial. steps: epoch, step, loss."""
    own = Window.partitionBy("epoch").orderBy("step")
    return steps.withColumn("window", F.floor((F.row_number().over(own) - 1) / accumulation)).groupBy("epoch", "window").agg(F.avg("loss").alias("loss"), F.count("*").alias("micro_batches"))


def padding_waste(rows: DataFrame, *batch: str) -> DataFrame:
    """real, padded, waste of rows (length) in batches named by columns."""
    per = rows.groupBy(*batch).agg(F.sum("length").alias("real"), (F.max("length") * F.count("*")).alias("padded"))
    total = per.agg(F.sum("real").alias("real"), F.sum("padded").alias("padded"))
    return total.select("real", "padded", ((F.col("padded") - F.col("real")) / F.col("padded")).alias("waste"))


def pad(rows: DataFrame, pad_id: int, *batch: str) -> DataFrame:
    """input_ids, attention_mask and labels filled on the right to the width of their batch."""
    width = F.max(F.size("input_ids")).over(Window.partitionBy(*batch))
    rows = rows.withColumn("width", width)
    fill = lambda c, v: F.concat(c, F.array_repeat(F.lit(v), F.col("width") - F.size(c)))
    return rows.withColumns({"labels": fill("labels", IGNORED_LABEL), "attention_mask": fill("attention_mask", 0), "input_ids": fill("input_ids", pad_id)})


def batch_accounts(rows: DataFrame, vision_pad: int, *batch: str) -> DataFrame:
    """Per batch: rows, tokens, supervised, vision, width."""
    total = lambda c: F.sum(c).cast("long")
    return rows.groupBy(*batch).agg(
        F.count("*").alias("rows"), total(F.size("input_ids")).alias("tokens"), total(F.size(F.filter("labels", lambda v: v != IGNORED_LABEL))).alias("supervised"),
        total(count_vision(F.col("input_ids"), vision_pad)).alias("vision"), F.max(F.size("input_ids")).alias("width"),
    )


def count_vision(ids: Column, pad_id: int) -> Column:
    return F.size(F.filter(ids, lambda v: v == pad_id))


def mask_vision(labels: Column, ids: Column, pad_id: int) -> Column:
    return F.zip_with(labels, ids, lambda a, b: F.when(b == pad_id, IGNORED_LABEL).otherwise(a))


def merged_patches(grid: Column, merge: Column) -> Column:
    """Tokens of an image; height and width must divide, else an error."""
    wrong = (grid[1] % merge != 0) | (grid[2] % merge != 0)
    return F.when(wrong, F.raise_error(F.lit("the grid does not divide by the merge size")).cast("int")).otherwise((grid[0] * grid[1] * grid[2] / (merge * merge)).cast("int"))


def layout_problem(declared: Column, processed: Column) -> Column:
    """Compare two lists of grids by position."""
    return F.when(F.size(declared) != F.size(processed), "count").when(F.exists(F.zip_with(declared, processed, lambda a, b: a != b), lambda v: v), "grid")


def over_budget(accounts: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Batches whose width times rows exceeds the token budget."""
    return accounts.where(F.col("width") * F.col("rows") > most)


def within_budget(accounts: DataFrame, most: int = 1_000_000) -> DataFrame:
    """accounts, of which a batch over the token budget is an error once it is read."""
    tokens = F.col("width") * F.col("rows")
    fail = F.raise_error(F.concat(F.lit("a batch of "), tokens.cast("string"), F.lit(f" tokens is over the budget of {most}"))).cast("boolean")
    return accounts.where(F.when(tokens <= most, True).otherwise(fail))


def too_long(rows: DataFrame, limit: int) -> DataFrame:
    """The first example (id, length) over the context limit; no row if all fit."""
    return rows.where(F.col("length") > limit).agg(F.min_by(F.struct("id", "length"), "id").alias("x")).where("x is not null").select("x.*")


def pair_lengths(pairs: DataFrame) -> DataFrame:
    """id, length of pairs (id, chosen, rejected with input_ids) by their longer side: what length_batches() takes."""
    return pairs.select("id", F.greatest(F.size("chosen.input_ids"), F.size("rejected.input_ids")).cast("long").alias("length"))


def collate(rows: DataFrame, pad_id: int, vision_pad: int, *batch: str) -> DataFrame:
    """pad() with vision labels masked; the pads must differ, and each row hold as many vision tokens as its images
    (grids, merge_size) declare."""
    if pad_id == vision_pad:
        raise ValueError("the pad of texts and the pad of images are the same")
    declared = F.aggregate(F.coalesce("images", F.array().cast("array<struct<grid_thw:array<int>,merge_size:int>>")), F.lit(0), lambda a, x: a + merged_patches(x["grid_thw"], x["merge_size"]))
    right = declared == count_vision(F.col("input_ids"), vision_pad)
    checked = rows.where(F.when(right, True).otherwise(F.raise_error(F.lit("vision tokens don't fit the images")).cast("boolean")))
    return pad(checked.withColumn("labels", mask_vision(F.col("labels"), F.col("input_ids"), vision_pad)), pad_id, *batch)


def pixel_budget(patches: Column, values: int) -> Column:
    return patches * values
