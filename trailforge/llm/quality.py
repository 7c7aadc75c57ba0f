"""Quality rules and an isolation forest on their statistics.

Each text gets counts (words, repeats, symbols, ...). Hard rules reject a text with fewer than 50 words or with more than
half of its words in repeated 3-word windows. An isolation forest over rates of all those counts judges the rest: trees of
random splits, cut over the range of all labelled rows, are grown on subsamples of the good ones of one half; a row's score is 2^(-mean path length / expected path length),
and the threshold is the score that best tells good from bad in the other half, which no tree has seen, with few good ones lost. (Trees grown on good and bad rows
alike isolate the bad ones less well, since these are a seventh of the rows; the README has the figures.)

The forest is fitted on the MOST_LABELS labelled rows of smallest hash at most (a documented bound); statistics and
verdicts cover every row. Without labels of both kinds there is no threshold and only the hard rules hold.

Words are taken a megabyte of text at a time and held as 64-bit hashes, windows as hashes of these, so that a text costs 8 bytes a
word beside itself, and twice that while windows are sorted.

Defined cases: null text counts as '' (0 words: rejected); labels that are null are left out, of several labels for
one doc_id the smallest holds; repeated rows and null ids are judged alike; an empty table gives an empty result. Only the columns
named are read, so others may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, slices

SYMBOLS = "#*$%&|<>"
MOST_LABELS = 4096
TREES = 128
SAMPLE = 256
MOST_GOOD_LOST = 0.01
SEED = 5
PART = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_distinct")


def words_of(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words, in order; equal within one process only."""
    parts, at = [np.zeros(0, np.int64)], 0
    while at < len(raw):
        end = SPACE.search(raw, at + PART)
        end = end.start() if end else len(raw)
        words = raw[at:end].split()  # on ASCII white space, as the contract's word
        parts.append(np.fromiter(map(hash, words), np.int64, len(words)))
        at = end
    return np.concatenate(parts)


def repeated_words(words: np.ndarray) -> int:
    """Words in windows of three that are there twice or more."""
    if len(words) < 4:
        return 0
    a, b, c = (words[k : len(words) - 2 + k].view(np.uint64) for k in range(3))
    windows = (a * np.uint64(0x9E3779B97F4A7C15) ^ (b >> np.uint64(7) | b << np.uint64(57))) * np.uint64(0xC2B2AE3D27D4EB4F) ^ (c >> np.uint64(19) | c << np.uint64(45)) * np.uint64(0x165667B19E3779F9)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    often = np.isin(windows, twice)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= often
    return int(covered.sum())


def stats(text: str | None) -> tuple[int, ...]:
    """The counts named in STATS."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = words_of(raw)
    spaces = sum(map(text.count, " \t\n\r\v\f"))
    seen: set[str] = set()
    dup = full = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\v\f"):
            full += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    characters = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if len(raw) < PART else sum(np.bincount(np.frombuffer(raw[k : k + PART], np.uint8), minlength=256) for k in range(0, len(raw), PART))
    return len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), dup, repeated_words(words), full, int(characters[65:91].sum()), int(characters[48:58].sum()), len(np.unique(words))


def features(counts: np.ndarray) -> np.ndarray:
    """Rates of all counts, a row per text."""
    n, chars, symbols, dup, repeat, lines, upper, digits, distinct = np.asarray(counts, np.float64).reshape(-1, len(STATS)).T
    words, letters, full = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    spread = np.where(n > 1, np.log(np.maximum(distinct, 1)) / np.log(np.maximum(n, 2)), 1.0)
    rates = [np.sqrt(x / letters) for x in (symbols, upper, digits)]
    return np.column_stack([*rates, repeat / words, np.sqrt(dup / full), spread, np.log(letters / words), np.log1p(n / full), np.log1p(n)])


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def expected_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation forest: arrays of nodes; a leaf has feature -1 and, as value, what it adds to the path."""

    def __init__(self, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED):
        self.trees, self.sample, self.seed = trees, sample, seed
        self.threshold = math.inf

    def fit(self, x: np.ndarray, ranges: np.ndarray | None = None) -> Forest:
        """Grow the trees on x. Cuts are drawn over the range of `ranges` (default: x) at the root, narrowed by the cuts
        above: what lies where no row of x does is then alone after few cuts."""
        rng = np.random.default_rng(self.seed)
        size = min(self.sample, len(x))
        self.norm = max(float(expected_path(size)), 1e-9)
        deepest = math.ceil(math.log2(max(size, 2)))
        ends = x if ranges is None else ranges
        ends = ends.min(0), ends.max(0)
        self.nodes = []
        for _ in range(self.trees):
            nodes: list[list[float]] = []

            def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
                at = len(nodes)
                wide = np.flatnonzero(high > low)
                if depth >= deepest or len(rows) <= 1 or not len(wide):
                    nodes.append([-1, depth + float(expected_path(len(rows))), 0, 0])
                    return at
                f = int(rng.choice(wide))
                cut = rng.uniform(low[f], high[f])
                nodes.append([f, cut, 0, 0])
                left = rows[:, f] < cut
                middle_low, middle_high = low.copy(), high.copy()
                middle_low[f] = middle_high[f] = cut
                nodes[at][2], nodes[at][3] = grow(rows[left], low, middle_high, depth + 1), grow(rows[~left], middle_low, high, depth + 1)
                return at

            grow(x[rng.choice(len(x), size, replace=False)], ends[0], ends[1], 0)
            self.nodes.append(np.array(nodes))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; anomalous rows are high."""
        paths = np.zeros(len(x))
        rows = np.arange(len(x))
        for nodes in self.nodes:
            feature, value, left, right = nodes[:, 0].astype(int), nodes[:, 1], nodes[:, 2].astype(int), nodes[:, 3].astype(int)
            at = np.zeros(len(x), int)
            while (inner := feature[at] >= 0).any():
                below = x[rows, np.maximum(feature[at], 0)] < value[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            paths += value[at]
        return 2.0 ** (-paths / len(self.nodes) / self.norm)

    def calibrate(self, x: np.ndarray, good: np.ndarray, most_lost: float = MOST_GOOD_LOST) -> Forest:
        """The threshold that maximises bad rows caught minus good rows lost, losing most_lost of the good at most."""
        score = self.score(x)
        if not good.any() or good.all():
            return self
        best = 0.0
        for cut in np.unique(score):
            lost, caught = float((score[good] >= cut).mean()), float((score[~good] >= cut).mean())
            if lost <= most_lost and caught - lost > best:
                best, self.threshold = caught - lost, float(cut)
        return self


def labelled(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> tuple[np.ndarray, np.ndarray]:
    """Counts and quality of the labelled documents of smallest hash, `most` at most."""
    own = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # the bound of the broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            counts = pa.array([list(stats(t)) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), counts], names=["doc_id", "quality", "counts"])

    found = in_arrow(rows.select("doc_id", F.col("quality").cast("int"), "text"), run, "doc_id long, quality int, counts array<long>")
    found = sorted(found.groupBy("doc_id").agg(F.min(F.struct("quality", "counts")).alias("x")).collect(), key=lambda r: r[0])
    return np.array([list(r.x.counts) for r in found], np.int64).reshape(-1, len(STATS)), np.array([r.x.quality > 0 for r in found], bool)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Forest | None:
    counts, good = labelled(docs, labels, most)
    if len(counts) < 2:
        return None
    x, ruled = features(counts), np.array([failed(*row) for row in counts[:, [0, 4]]], bool)
    half = np.random.default_rng(SEED).random(len(x)) < 0.5
    grown, held = half & good & ~ruled, ~half & ~ruled
    if not grown.any() or good[held].all() or not good[held].any():
        grown, held = good, np.ones(len(x), bool)  # too few labels to hold some out
    return Forest().fit(x[grown] if grown.any() else x, x).calibrate(x[held], good[held])


def verdicts(texts: list, forest: Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, base_failed, score, kept of each text."""
    counts = np.array([stats(t) for t in texts], np.int64).reshape(-1, len(STATS))
    bad = np.array([failed(n, r) for n, r in zip(counts[:, 0], counts[:, 4], strict=True)], bool)
    score = forest.score(features(counts)) if forest else np.zeros(len(texts))
    return counts, bad, score, ~bad & (score < (forest.threshold if forest else math.inf))


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score."""
    names = ["doc_id", *STATS[:5], "base_failed", "kept", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            counts, bad, score, kept = verdicts(texts, forest)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(counts[:, i]) for i in range(5)), pa.array(bad), pa.array(kept), pa.array(score)], names=names)

    schema = "doc_id long, " + ", ".join(f"{x} long" for x in STATS[:5]) + ", base_failed boolean, kept boolean, score double"
    return in_arrow(docs.select("doc_id", "text"), run, schema)


def keep(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The documents kept, with all their columns."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield batch.filter(pa.array(verdicts(texts, forest)[3]))

    return in_arrow(docs, run, schema)
