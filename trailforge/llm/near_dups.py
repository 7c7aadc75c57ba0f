"""Near-duplicate documents from bottom-k sketches of one hash function.

1. A text's words (A-Z lower-cased) give its set of hashed word shingles. Texts with equal sets form a class; the
   class's smallest doc_id stands for it from here on.
2. A class keeps the `k` smallest hashes: its sketch. Inverted lists of the retained values hold the classes that share
   one. Two sets of similarity t share at least need(s) of s retained values (s * t less 4.3 standard deviations); so,
   with values ordered by rarity, they share one of the s - need(s) + 1 rarest of each: only those enter the lists.
   A passage that very many documents share fills only the common end, and so makes no long lists.
3. Pairs come from the lists without taking all pairs of one: first each member with the list's pivot, the member with
   the fewest rare values (the least edited copy). Where a list's members aren't one component yet, their full sets
   are listed anew: with shingles ordered by rarity, similar sets of sizes n and m share one of the first
   n - ceil(t / (1 + t) * (n + m)) + 1 of each; the lists are kept per pair of size ranges, so that this bound is tight
   and copies with too many edits enter no common list at all. Again members meet pivots, and last those pairs
   across components whose positions leave room for enough in common. Pairs within one component need no test: they
   change nothing.
4. A pair is estimated on the sketch of its union (the k smallest of both: the share found in both); what is not
   clearly below the threshold is verified on the full sets: 100 * common >= percent * union.
5. Components of the verified links; a document is kept if its doc_id is its component's smallest.

The miss probability of step 2 and 4 for a pair just at the threshold is below 1e-4; components need only one path.
Full sets are made for the classes in lists of two members or more only.

Defined cases: null text or no word: an empty set, linked with nothing; fewer words than a shingle: the whole sequence
is one; null doc_id: component null, kept, linked with nothing; repeated rows are in one class; an empty table gives
an empty result. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, in_arrow, slices, written
from .components import components

K = 32
#: Classes of which the ids are broadcast at most (two longs each); beyond, the join is by shuffle.
MOST_BROADCAST = 1_000_000
HELD_WORDS = 100_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Sizes of sets in one range differ by this factor at most.
SIZE_STEP = 1.05
FULL_KEY = ["value", "low", "high"]


class _Words(dict):
    """Hashes of words, a bounded number of them held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_words = _Words()
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of the text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    width = min(size, n)
    total = np.full(n - width + 1, 0 if width == size else width, np.uint64)
    for i in range(width):
        total = (total ^ (total >> np.uint64(29))) * _FACTORS[i % 7] + hashes[i : n - width + 1 + i]
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(total ^ (total >> np.uint64(32)))


def need(s: int, percent: int) -> int:
    t = percent / 100
    return max(1, math.floor(s * t - 4.3 * math.sqrt(s * t * (1 - t))))


def sketched(docs: DataFrame, size: int, k: int = K) -> DataFrame:
    """doc_id, n (set size), f1, f2 (fingerprint of the set), sketch (ascending as unsigned, kept as long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            n, prints, sketches = [], [], []
            for text in texts:
                found = shingles(text, size)
                n.append(len(found))
                prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                sketches.append(found[:k].view(np.int64))
            both = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sketches, pa.list_(pa.int64()))], names=["doc_id", "n", "f1", "f2", "sketch"])

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, n long, f1 long, f2 long, sketch array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """id, n, set of the documents whose doc_id is in ids (id)."""
    if ids.count() <= MOST_BROADCAST:
        ids = F.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            sets = [shingles(t, size).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    return in_arrow(docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id"), "left_semi"), run, "id long, set array<long>")


def _ranked(postings: DataFrame) -> DataFrame:
    """postings (id, s, value; s values in all) of values of two members or more, with pos: the place in the order from
    rare to common among all of the id's values. An id's own values are its group; nothing larger is gathered."""
    shared = written(postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "near-shared")
    own = Window.partitionBy("id")
    met = postings.join(shared, "value").withColumn("rank", F.row_number().over(own.orderBy("df", "value"))).withColumn("n_shared", F.count("*").over(own))
    return met.select("id", "s", "value", (F.col("s") - F.col("n_shared") + F.col("rank")).alias("pos"))


def _long(entered: DataFrame, key: list[str]) -> DataFrame:
    """The entries of lists of two members or more."""
    entered = written(entered, "near-entered")
    long = written(entered.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1").drop("members"), "near-long")
    return written(entered.join(long, key), "near-lists")


def lists(classes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """value, id, pos: the inverted lists of sketches. classes: id, sketch."""
    ranked = _ranked(classes.select("id", F.size("sketch").alias("s"), F.explode("sketch").alias("value")))
    needs = F.element_at(F.array(*[F.lit(need(s, percent)) for s in range(1, k + 1)]), F.col("s"))
    return _long(ranked.where(F.col("pos") <= F.col("s") - needs + 1).select("value", "id", "pos"), ["value"])


def full_lists(sets: DataFrame, percent: int) -> DataFrame:
    """value, low, high (size ranges), id, n, pos: the inverted lists of full sets. sets: id, set."""
    t = percent / 100
    n, range_of = F.col("n"), lambda x: F.floor(F.log(x) / math.log(SIZE_STEP) + 1e-9)
    ranked = _ranked(sets.select("id", F.size("set").alias("s"), F.explode("set").alias("value"))).withColumnRenamed("s", "n")
    most = F.least(n / t, (n - F.col("pos") + 1) * ((1 + t) / t) - n)
    met = ranked.withColumn("most", most).where(F.col("most") >= n * t)
    ranges = met.withColumn("own", range_of(n)).withColumn("other", F.explode(F.sequence(range_of(F.ceil(n * t - 1e-9)), range_of(F.greatest(F.col("most"), F.ceil(n * t - 1e-9)) + 1e-6))))
    entered = ranges.select("value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "n", "pos")
    return _long(entered, FULL_KEY)


def estimated(pairs: DataFrame, classes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """The pairs (a, b) whose union sketch doesn't speak against them."""
    of = lambda side: classes.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    names = ("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b"), strict=True):
                x, y = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (x, y))
                union = np.union1d(x, y)[:k]
                common = np.intersect1d(x, y, assume_unique=True)
                kept.append(int(np.count_nonzero(common <= union[-1])) >= need(len(union), percent))
            yield batch.select(names).filter(pa.array(kept, pa.bool_()))

    return in_arrow(met.select("a", "b", "s_a", "s_b"), run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    met = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b").join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (v.values.to_numpy(zero_copy_only=False) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(("a", "b")).filter(pa.array(kept, pa.bool_()))

    return in_arrow(met.select("a", "b", "x", "y"), run, "a long, b long")


def _from_pivots(members: DataFrame, key: list[str]) -> DataFrame:
    """Pairs (a < b) of each list's pivot, the member at the smallest position, with its members of other components."""
    first = F.min(F.struct("pos", F.xxhash64("id").alias("o"), F.col("id").alias("pivot"), F.col("component").alias("own")))
    pivots = written(members.groupBy(*key).agg(first.alias("x")).select(*key, "x.pivot", "x.own"), "near-pivots")
    met = members.join(pivots, key).where("id <> pivot and component <> own")
    return met.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of a full list's members in different components, with room for enough in common."""
    t = percent / 100
    of = lambda x: members.select(*FULL_KEY, F.col("id").alias(x), F.col("component").alias(f"c_{x}"), F.col("n").alias(f"n_{x}"), F.col("pos").alias(f"p_{x}"))
    room = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) + 1 >= F.ceil((F.col("n_a") + F.col("n_b")) * (t / (1 + t)) - 1e-9)
    left, right = of("a"), of("b")
    same = [left[c] == right[c] for c in FULL_KEY]
    met = left.join(right, [*same, F.col("a") < F.col("b"), F.col("c_a") != F.col("c_b"), room])
    return met.select("a", "b").distinct()


def _open(members: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """The members of lists that have more than one component, with their components."""
    rest = [c for c in members.columns if c != "id"]
    marked = written(members.join(labels, "id", "left").select("id", *rest, F.coalesce("component", "id").alias("component")), "near-marked")
    several = marked.groupBy(*key).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select(*key)
    return written(marked.join(written(several, "near-several"), key), "near-open")


def link(docs: DataFrame, classes: DataFrame, size: int, percent: int, k: int = K) -> DataFrame:
    """id, component of the classes that are linked. classes: a written table (id, n, sketch)."""
    members = lists(classes, percent, k)
    sets = written(full_sets(docs, members.select("id").distinct(), size), "near-sets")
    found = tested = None

    def test(pairs: DataFrame) -> DataFrame:
        """Verify pairs that were not tested yet; the components of all links so far."""
        nonlocal found, tested
        new = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        tested = new if tested is None else tested.unionByName(new)
        links = written(verified(written(estimated(new, classes, percent, k), "near-likely"), sets, percent), "near-links")
        found = links if found is None else found.unionByName(links)
        return components(found)

    labels = test(_from_pivots(members.withColumn("component", F.col("id")), ["value"]))
    unsettled = written(_open(members, labels, ["value"]).select("id").distinct(), "near-unsettled")
    if unsettled.isEmpty():
        return labels
    full = full_lists(sets.join(unsettled, "id", "left_semi"), percent)
    labels = test(_from_pivots(_open(full, labels, FULL_KEY), FULL_KEY))
    rest = _open(full, labels, FULL_KEY)
    return labels if rest.isEmpty() else test(_across(rest, percent))


def near_dups(docs: DataFrame, size: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.keep(written(sketched(docs, size, k), "near-rows"))
        full = rows.where("n > 0 and doc_id is not null")
        grouped = full.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("x"))
        classes = written(grouped.select("f1", "f2", F.col("x.doc_id").alias("id"), F.col("x.n").alias("n"), F.col("x.sketch").alias("sketch")), "near-classes")
        labels = link(docs, classes.select("id", "n", "sketch"), size, percent, k)
        named = classes.select("f1", "f2", "id").join(labels, "id", "left").select("f1", "f2", F.coalesce("component", "id").alias("class"))
        named = scratch.keep(written(named, "near-named"))
    met = rows.select("doc_id", "n", "f1", "f2").join(named, ["f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("class")).otherwise(F.col("doc_id"))
    return met.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents kept, with all their columns: of each component the one of smallest doc_id.

    Of rows that share doc_id (or have none) and the words of their texts one is left, that of the smallest text. Rows
    without a doc_id are linked with each other by that only, and with no row that has one; texts without a word stay."""
    with Scratch(docs.sparkSession) as scratch:
        found = written(near_dups(docs, size, percent), "near-found")
        gone = scratch.keep(written(found.where("not kept").select(F.col("doc_id").alias("gone")).distinct(), "near-gone"))
        again = found.where("kept and n_shingles > 0").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
        again = scratch.keep(written(again.select(F.col("doc_id").alias("again"), F.lit(True).alias("repeated")), "near-again"))
    few = lambda ids: F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    left = docs.join(few(gone), docs["doc_id"] == gone["gone"], "left_anti")
    if again.isEmpty():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = left.join(few(again), left["doc_id"].eqNullSafe(again["again"]), "left")
    marked = marked.select(row.alias("row"), (F.coalesce("repeated", F.lit(False)) & F.coalesce(F.col("text").rlike(WORD), F.lit(False))).alias("repeated"))
    words = F.regexp_replace(F.translate("row.text", UPPER, UPPER.lower()), r"[\x20\x09-\x0D]+", " ")
    one = marked.where("repeated").groupBy("row.doc_id", F.sha2(F.trim(words), 256).alias("words")).agg(F.min_by("row", "row.text").alias("row"))
    return marked.where("not repeated").select("row.*").unionByName(one.select("row.*"))
