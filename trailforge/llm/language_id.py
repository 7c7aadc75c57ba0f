"""Language identification with language-bitmask n-gram filters.

Training counts letter trigrams (words lower-cased, a space on either side) per language over all training rows. A
trigram belongs to a language if its share there is at least MIN_SHARE, and at least CLOSE of its largest share in any
language: so one trigram can belong to several languages, and a language has at most 1 / MIN_SHARE of them, at any size
of the corpus. A bit-sliced Bloom filter keeps, at each of its `slots` positions, the bitmask of the languages that set
it: the AND of the masks at a trigram's HASHES positions is the set of all languages that contain it.

Prediction counts, for each language, the trigrams of a text whose mask has its bit, corrected for the filter's false
positives, (hits - n * fp) / (1 - fp); the largest decides, ties go to the first language by code point. The score is the
winner's share of all languages' corrected counts.

Defined cases: `und` with score 0 for null text, text without a letter, or nothing learned; without a hit the most
frequent learned language with score 0; rows with null text or lang don't train; repeated rows count as often as they
occur; rows without doc_id are predicted as others, and held_out() takes their id for ''; an empty table gives an empty result. Only doc_id, text and lang are read, so others may have any name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, in_arrow, slices, written

SLOTS = 1 << 20
HASHES = 2
MIN_SHARE = 2e-6
CLOSE = 0.5
UNKNOWN = "und"
HELD = 2_000_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def trigrams(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams of the texts, packed into 63 bits, and the number of the text that each is from."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(low) + 2), [1, *(len(t) + 1 for t in low), 0])
    points = np.where(letters()[points], points, 32).astype(np.uint64)
    held = np.ones(len(points), bool)
    held[1:] = (points[1:] != 32) | (points[:-1] != 32)
    points, text = points[held], text[held]
    if len(points) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    middle = points[1:-1] != 32
    packed = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    return packed[middle], text[1:-1][middle] - 1


def positions(grams: np.ndarray, slots: int, hashes: int = HASHES) -> list[np.ndarray]:
    bits = np.uint64(64 - (slots.bit_length() - 1))
    mixed = grams ^ (grams >> np.uint64(29))
    return [((mixed * np.uint64(m)) >> bits).astype(np.int64) for m in _MULTIPLIERS[:hashes]]


def counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n: trigram counts of docs (text, lang), summed inside each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out(lang: str) -> pa.RecordBatch:
            grams, n = held.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(grams), np.int32))), pa.array(grams.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for batch, texts in slices(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            grams, text = trigrams(texts)
            for lang in sorted(set(langs)):
                own, n = np.unique(grams[(langs == lang)[text]], return_counts=True)
                if lang in held:
                    both = np.concatenate([held[lang][0], own])
                    own, at = np.unique(both, return_inverse=True)
                    n = np.bincount(at, np.concatenate([held[lang][1], n])).astype(np.int64)
                held[lang] = own, n.astype(np.int64)
                if len(own) > HELD:
                    yield out(lang)
        for lang in list(held):
            yield out(lang)

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    return in_arrow(rows, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    masks: np.ndarray  # slots x words of 64 languages
    false_positive: np.ndarray
    usual: int

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        grams, text = trigrams(texts)
        n = np.bincount(text, minlength=len(texts)).astype(float)
        found = np.zeros((len(texts), len(self.langs)))
        if len(grams):
            at = positions(grams, len(self.masks))
            for word in range(self.masks.shape[1]):
                slice_ = self.masks[:, word]
                mask = slice_[at[0]]
                for p in at[1:]:
                    mask &= slice_[p]
                for k in range(word * 64, min(len(self.langs), word * 64 + 64)):
                    found[:, k] = np.bincount(text, (mask >> np.uint64(k % 64)) & np.uint64(1), minlength=len(texts))
        fp = self.false_positive
        right = np.maximum((found - n[:, None] * fp) / (1 - fp), 0) if self.langs else found
        total = right.sum(1)
        best = np.where(total > 0, right.argmax(1), self.usual) if self.langs else np.zeros(len(texts), int)
        score = np.where(total > 0, right.max(1, initial=0) / np.maximum(total, 1e-300), 0.0)
        names = [self.langs[b] if m > 0 and self.langs else UNKNOWN for b, m in zip(best, n, strict=True)]
        return names, score


def train(docs: DataFrame, *, slots: int = SLOTS, min_share: float = MIN_SHARE, close: float = CLOSE) -> Model:
    """docs: text, lang. What reaches the driver: a row per language and one per position of the filter that is set."""
    with Scratch(docs.sparkSession):
        return _train(docs, slots, min_share, close)


def _train(docs: DataFrame, slots: int, min_share: float, close: float) -> Model:
    table = written(counts(docs), "lang-counts")
    sums = {r.lang: r.n for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sums, key=lambda x: x.encode("utf-8", "surrogatepass"))
    words = max(1, -(-len(langs) // 64))
    masks = np.zeros((slots, words), np.uint64)
    if langs:
        index = table.sparkSession.createDataFrame([(x, i, sums[x]) for i, x in enumerate(langs)], "lang string, k int, total long")
        shares = table.join(F.broadcast(index), "lang").select("gram", "k", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= min_share)
        most = shares.groupBy("gram").agg(F.max("share").alias("most"), F.collect_list(F.struct("k", "share")).alias("x"))
        chosen = most.select("gram", F.explode("x").alias("x"), "most").where(F.col("x.share") >= F.col("most") * close).select("gram", F.col("x.k").alias("k"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                grams, k = batch.column(0).to_numpy(False).astype(np.uint64), batch.column(1).to_numpy(False)
                bit = np.left_shift(np.uint64(1), (k % 64).astype(np.uint64)).view(np.int64)
                for p in positions(grams, slots):
                    yield pa.RecordBatch.from_arrays([pa.array(p), pa.array((k // 64).astype(np.int32)), pa.array(bit)], names=["at", "word", "bits"])

        sets = in_arrow(chosen, run, "at long, word int, bits long").groupBy("at", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
        at, word, bits = (sets.column(c).to_numpy() for c in ("at", "word", "bits"))
        masks[at, word] = bits.astype(np.int64).view(np.uint64)
    fill = np.array([((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(langs))])
    usual = max(range(len(langs)), key=lambda k: (sums[langs[k]], -k), default=0)
    return Model(langs, masks, np.minimum(fill**HASHES, 0.999), usual)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            names, score = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1
