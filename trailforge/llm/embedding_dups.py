"""Near-duplicate embeddings by spherical-cap filters.

Vectors are scaled to length one and turned by a random rotation. Filter directions are a random product code: BLOCKS
blocks of coordinates with `codes` random unit vectors each, a direction being one code of each block. A vector belongs to
the cap of every direction whose inner product with it reaches alpha = (its largest inner product) - margin; all of these are
decoded, however many they are. The margin is WIDE * sin(angle) / sqrt(dimension): for two vectors at that angle, the best
direction of one falls short of the best of the other by a sum of normal deviates of that size, whatever the number of
codes. So the recall at the limit doesn't depend on how many vectors there are; the tests measure it. List decoding finds
the directions without trying all codes^BLOCKS: codes that are too far below the best of their block, then sums of two blocks
too far below the best such sum, take no part. `codes` grows with the number of vectors, so that caps stay small.

Vectors meet in their caps; all pairs of a cap are verified by cosine in double precision, and a pair belongs to the
smallest cap that both are in, so that links count once. A large cap of m vectors is cut into hashed parts (sixteen at least
beyond 16 * LEAST_PART vectors, of MOST_PART vectors at most) and its pairs of parts become tasks of their own, each working
tile by tile; so m * m / MOST_PART vectors are sent for the m * m / 2 cosines that the exact number of links asks for. What leaves
a task are sums of links and, for the components, one edge for each vector at most; never all pairs.

Equal vectors are one class, found by two hashes of 64 bits from different seeds, which its smallest vec_id stands for;
copies are linked with each other and with all that their class is linked with.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different dimensions don't link; a null vec_id is counted as a partner, but has a null component; repeated rows are copies;
an empty table gives an empty result. Only vec_id and embedding are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, in_arrow, written
from .components import components

COSINE = 0.95
BLOCKS = 4
WIDE = 2.25
LEAST_CODES = 16
LEAST_PART = 512
MOST_PART = 4096
TILE = 512
SEED = 6


def margin(dim: int, cosine: float = COSINE) -> float:
    return WIDE * math.sqrt(max(0.0, 1 - cosine * cosine) / dim)


@lru_cache(maxsize=8)
def code(dim: int, codes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation (padded to whole blocks) and the blocks' codes; no more codes in a block than its width tells apart."""
    rng = np.random.default_rng([SEED, dim, codes])
    width = -(-dim // BLOCKS)
    turn = np.linalg.qr(rng.normal(size=(width * BLOCKS, width * BLOCKS)))[0][:dim]
    blocks = []
    for _ in range(BLOCKS):
        x = rng.normal(size=(min(codes, 2 ** min(width, 30)), width))
        blocks.append(x / np.linalg.norm(x, axis=1, keepdims=True))
    return turn, blocks


def _sums(a: np.ndarray, b: np.ndarray, names_a: np.ndarray, names_b: np.ndarray, base: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums of two falling lists that reach least, falling, and their joint names."""
    n = np.searchsorted(-b, a - least, side="right")
    at = np.repeat(np.arange(len(a)), n)
    other = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    sums = a[at] + b[other]
    order = np.argsort(-sums)
    return sums[order], (names_a[at] * base + names_b[other])[order]


def decode(x: np.ndarray, codes: int, cosine: float = COSINE) -> list[np.ndarray]:
    """For each unit vector, the sorted numbers of all filters that exceed its alpha."""
    turn, blocks = code(x.shape[1], codes)
    y = x @ turn
    width, many = y.shape[1] // BLOCKS, len(blocks[0])
    below = -margin(x.shape[1], cosine)
    order, value, size = [], [], []
    for i, block in enumerate(blocks):
        inner = y[:, i * width : (i + 1) * width] @ block.T
        inner -= inner.max(1, keepdims=True)
        o = np.argsort(-inner, axis=1)
        order.append(o)
        value.append(np.take_along_axis(inner, o, 1))
        size.append((inner >= below).sum(1))
    found = []
    for n in range(len(x)):
        v = [value[i][n, : size[i][n]] for i in range(BLOCKS)]
        o = [order[i][n, : size[i][n]] for i in range(BLOCKS)]
        halves = [_sums(v[i], v[i + 1], o[i], o[i + 1], many, below) for i in (0, 2)]
        found.append(np.sort(_sums(halves[0][0], halves[1][0], halves[0][1], halves[1][1], many * many, below)[1]))
    return found


def unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors that can link; these scaled to length one, in double precision. All of one dimension."""
    rows = column.to_pylist()
    x = np.array([[np.nan if v is None else v for v in r] for r in rows], np.float64)
    ok = np.isfinite(x).all(1) & (np.abs(x).max(1, initial=0) > 0)
    x = x[ok]
    x /= np.abs(x).max(1, keepdims=True)
    return ok, x / np.linalg.norm(x, axis=1, keepdims=True)


def by_dimension(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.array(pa.compute.fill_null(pa.compute.list_value_length(batch.column("embedding")), 0))
    for dim in np.unique(sizes[sizes > 0]):
        yield batch.filter(pa.array(sizes == dim))


def filtered(vectors: DataFrame, codes: int, carry: bool, cosine: float = COSINE) -> DataFrame:
    """dim, filter, id and, with carry, n (copies), smaller (the vector's filters below this one), vector (unit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in by_dimension(batch):
                for at in range(0, one.num_rows, 256):
                    part = one.slice(at, 256)
                    ok, x = unit(part.column("embedding"))
                    if not len(x):
                        continue
                    lists = decode(x, codes, cosine)
                    row = np.repeat(np.arange(len(x)), [len(f) for f in lists])
                    ids = part.column("id").filter(pa.array(ok)).take(pa.array(row))
                    columns = {"dim": pa.array(np.full(len(row), x.shape[1], np.int32)), "filter": pa.array(np.concatenate(lists).astype(np.int64)), "id": ids}
                    if carry:
                        columns["n"] = part.column("n").filter(pa.array(ok)).take(pa.array(row))
                        columns["smaller"] = pa.array([f[:k].astype(np.int64).tobytes() for f in lists for k in range(len(f))], pa.binary())
                        columns["vector"] = pa.array([v.tobytes() for v in x], pa.binary()).take(pa.array(row))
                    yield pa.RecordBatch.from_pydict(columns)

    schema = "dim int, filter long, id long" + ", n long, smaller binary, vector binary" * carry
    return in_arrow(vectors, run, schema)


def _tile(x, n, smaller, rows: np.ndarray, columns: np.ndarray, cosine: float):
    """Of the pairs rows x columns (or all pairs of rows, if both are the same): sums of owned links by row number, and edges
    (row number, row number) of the components, one for each vector. A pair is owned if no smaller cap holds both."""
    near = x[rows] @ x[columns].T >= cosine
    alike = rows is columns
    if alike:
        np.fill_diagonal(near, False)
    a, b = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(a):
        return None
    near = near[np.ix_(a, b)]
    rows, columns = rows[a], columns[b]
    used = np.concatenate([rows, columns])
    sizes = [len(smaller[i]) for i in used]
    names, at = np.unique(np.concatenate([smaller[i] for i in used]), return_inverse=True)
    met = np.zeros((len(used), len(names)), np.float32)
    met[np.repeat(np.arange(len(used)), sizes), at] = 1
    owned = near & (met[: len(rows)] @ met[len(rows) :].T < 0.5)
    sums = [(rows, owned @ n[columns])] + ([] if alike else [(columns, owned.T @ n[rows])])
    low = near.argmax(1)  # the first column that a row reaches, by more and more steps
    while True:
        reach = np.where(near, low[:, None], len(columns)).min(0)
        new = np.where(near, reach[None, :], len(columns)).min(1)
        if (new == low).all():
            break
        low = new
    edges = [(rows, columns[low]), (columns, columns[reach])]
    return sums, edges


def _group(ids, n, part, smaller, x, low: int, high: int, cosine: float):
    """Sums of links (id, n) and edges (id, id) of one cap, or of one pair of its parts, by tiles."""
    sides = [np.flatnonzero(part == low), np.flatnonzero(part == high)] if low != high else [np.arange(len(ids))] * 2
    tiles = [[s[k : k + TILE] for k in range(0, len(s), TILE)] for s in sides]
    sums = np.zeros(len(ids), np.int64)
    up = np.arange(len(ids))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for i, rows in enumerate(tiles[0]):
        for columns in [rows, *tiles[0][i + 1 :]] if low == high else tiles[1]:
            if (met := _tile(x, n, smaller, rows, columns, cosine)) is None:
                continue
            for at, links in met[0]:
                sums[at] += links
            for from_, to in met[1]:
                for a, b in zip(from_.tolist(), to.tolist(), strict=True):
                    a, b = top(a), top(b)
                    up[max(a, b)] = min(a, b)
    roots = [top(i) for i in range(len(ids))]
    return [(int(ids[i]), int(sums[i])) for i in np.flatnonzero(sums)], [(int(ids[i]), int(ids[k])) for i, k in enumerate(roots) if i != k]


def found_in_caps(vectors: DataFrame, codes: int, cosine: float = COSINE) -> DataFrame:
    """a, b, n: sums of links of a (b null), and edges a - b (n null). vectors: id, n, embedding of distinct vectors."""
    large = filtered(vectors, codes, False, cosine).groupBy("dim", "filter").agg(F.count("*").alias("members")).where(F.col("members") > LEAST_PART)
    parts = F.greatest(F.ceil(F.col("members") / MOST_PART), F.least(F.lit(16), F.ceil(F.col("members") / LEAST_PART)))
    large = written(large.select("dim", "filter", parts.cast("int").alias("parts")), "caps-large")
    rows = filtered(vectors, codes, True, cosine).join(large, ["dim", "filter"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    key = ["dim", "filter", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def out():
            ids, n, part, smaller, vector = zip(*held, strict=True)
            x = np.frombuffer(b"".join(vector), np.float64).reshape(len(ids), -1)
            return _group(np.array(ids, np.int64), np.array(n, np.int64), np.array(part), [np.frombuffer(f, np.int64) for f in smaller], x, now[2], now[3], cosine)

        def batch_of(sums, edges):
            a = [i for i, _ in sums] + [i for i, _ in edges]
            b = [None] * len(sums) + [k for _, k in edges]
            n = [v for _, v in sums] + [None] * len(edges)
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

        sums: list = []
        edges: list = []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
            for k, *row in zip(keys, *(batch.column(c).to_pylist() for c in ("id", "n", "part", "smaller", "vector")), strict=True):
                if k != now:
                    if len(held) > 1:
                        s, e = out()
                        sums += s
                        edges += e
                    held, now = [], k
                held.append(row)
            if sums or edges:
                yield batch_of(sums, edges)
                sums, edges = [], []
        if len(held) > 1:
            yield batch_of(*out())

    return in_arrow(rows.repartition(*key).sortWithinPartitions(*key).select(*key, "id", "n", "part", "smaller", "vector"), run, "a long, b long, n long")


def embedding_dups(rows: DataFrame, cosine: float = COSINE, codes: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept. rows: vec_id, embedding (array of float or double)."""
    own = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    own = own.withColumn("f1", F.xxhash64(F.lit(1), "embedding")).withColumn("f2", F.xxhash64(F.lit(2), "embedding"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == math.inf)
    good = F.coalesce(F.size("embedding") > 0, F.lit(False)) & ~F.exists("embedding", bad) & F.exists("embedding", lambda v: v != 0)
    own = own.withColumn("good", F.coalesce(good, F.lit(False)))
    grouped = own.where("good").groupBy("f1", "f2").agg(F.count("*").alias("n"), F.coalesce(F.min("vec_id"), F.lit(-(2**63)).cast("long")).alias("id"), F.min("embedding").alias("embedding"))
    with Scratch(rows.sparkSession) as scratch:
        classes = written(grouped, "caps-classes")
        count = classes.count()
        codes = codes or max(LEAST_CODES, math.ceil((count / 4) ** (1 / BLOCKS)))
        found = written(found_in_caps(classes.select("id", "n", "embedding"), codes, cosine), "caps-found")
        sums = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
        labels = components(found.where("b is not null").select("a", "b"))
        named = classes.select("f1", "f2", "id", "n").join(sums.withColumnRenamed("a", "id"), "id", "left").join(labels, "id", "left")
        named = scratch.keep(written(named.select("f1", "f2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component")), "caps-named"))
    met = own.select("vec_id", "good", "f1", "f2").join(named, ["f1", "f2"], "left")
    component = F.when(F.col("vec_id").isNull(), F.lit(None)).when(F.col("good"), F.col("component")).otherwise(F.col("vec_id"))
    links = F.when(F.col("good"), F.col("links")).otherwise(F.lit(0)).cast("long")
    return met.select("vec_id", links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
