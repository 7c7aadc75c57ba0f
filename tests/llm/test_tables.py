"""Operators on whole tables: near-duplicates, mixing, embeddings, archives, components, the pipeline."""

import collections
import hashlib
import math
import random
import re
import time

import numpy as np
import pytest

from trailforge.llm import embedding_dups, mixing, near_dups, warc
from trailforge.llm.common import new_path, table
from trailforge.llm.components import components

from .cases import SF, TEXTS, docs, nothing


class Sets:
    """Union-find for the brute-force versions."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(100)] + [(5, 5)]
    own = Sets()
    for a, b in links:
        own.join(a, b)
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[x] == own.find(x) for a, b in links if a != b for x in (a, b))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_near(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset([tuple(w[j : j + size]) for j in range(len(w) - size + 1)] or ([tuple(w)] if w else []))
    own = Sets()
    ids = [i for i in sets if sets[i]]
    inverted = collections.defaultdict(list)
    for i in ids:
        for s in sets[i]:
            inverted[s].append(i)
    for i in ids:
        met = collections.Counter(j for s in sets[i] for j in inverted[s] if j < i)
        for j, n in met.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                own.join(i, j)
    return {i: (len(s), own.find(i)) for i, s in sets.items()}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_dups_by_brute_force(spark, size, percent):
    rng = random.Random(size)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [edited(base, rng.randrange(9), rng) for _ in range(120)] + [edited(base, 0, rng)] * 5
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    texts += [" ".join(f"s{rng.randrange(4)}" for _ in range(rng.randrange(8))) for _ in range(60)] + TEXTS
    rng.shuffle(texts)
    want = slow_near(dict(enumerate(texts)), size, percent)
    rows = near_dups.near_dups(docs(spark, texts), size, percent).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_dups_edges(spark):
    assert near_dups.near_dups(nothing(spark)).count() == 0
    d = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "A B c d e f"), (2, "A B c d e f")], "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dups.near_dups(d).collect()), key=str)
    assert found == [(1, 1, True), (2, 1, False), (2, 1, False), (None, None, True)]
    kept = near_dups.keep(d)
    assert kept.columns == d.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1]


def test_near_dups_keep_one_of_repeated_rows(spark):
    rows = [(None, "a b c d e f")] * 3 + [(None, "A  b c d e f "), (None, "q r s t u v"), (2, "h i j k l m"), (2, "h i j k l m"), (2, " H i j k l m"), (3, "h i j k l m"), (4, "v w x y z"), (None, None), (None, None), (5, ""), (5, "")]
    kept = near_dups.keep(spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, more map<string,int>"))
    found = collections.Counter((r.doc_id, " ".join((r.text or "").lower().split())) for r in kept.collect())
    assert found == {(None, "a b c d e f"): 1, (None, "q r s t u v"): 1, (2, "h i j k l m"): 1, (4, "v w x y z"): 1, (None, ""): 2, (5, ""): 2}


def slow_targets(sizes, share=1.5, cap=2.0, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > cap * sizes[s] + 1e-9}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= cap * sizes[s]
        open_ -= full
    return target


def test_mixing(spark):
    for d in (table(spark, SF, "documents"), docs(spark)):
        rows = mixing.mix(d).collect()
        sizes = collections.Counter()
        source = {r.doc_id: r.source for r in d.collect()}
        for r in rows:
            sizes[source[r.doc_id]] += r.size
        want = slow_targets(sizes)
        taken = collections.Counter()
        for r in rows:
            assert r.source_size == sizes[source[r.doc_id]] and abs(r.target - want[source[r.doc_id]]) < 1e-6 * max(1, r.target)
            assert 0 <= r.taken <= 2 * r.size
            taken[source[r.doc_id]] += r.taken
        for s, t in want.items():
            assert abs(taken[s] - t) <= 0.02 * t + 4 * max(1, sum(sizes.values()) * 1.5 / mixing.SLOTS)
        assert sorted((r.doc_id, r.taken) for r in mixing.mix(d).collect()) == sorted((r.doc_id, r.taken) for r in rows)


def test_mixing_of_small_sources_beside_a_hot_one(spark):
    small = {f"s{k:02}": 10 + 13 * k for k in range(30)}
    rows = [(i, "hot", "w " * 1000) for i in range(200)] + [(1000 * k + i, s, "w " * 10) for k, s in enumerate(small, 1) for i in range(small[s] // 10)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for slots in (16, 128):
        found = mixing.mix(d, slots=slots).collect()
        taken, target = collections.Counter(), {}
        for r in found:
            taken[r.source] += r.taken
            target[r.source] = r.target
            assert 0 <= r.taken <= 2 * r.size and (r.taken > 0) == (r.first_slot is not None)
        assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())


def slow_mix(rows, slots):
    """taken and first slot of each row: targets by repeated resharing, the schedule point by point, documents on one line."""
    import struct

    import xxhash

    weights, share, cap = (5, 2, 1), 1.5, 2.0
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    first_hash = lambda i: xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest()
    second = lambda i: signed(xxhash.xxh64(struct.pack("<i", 7), seed=first_hash(i)).intdigest())
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    words = sum(total.values())
    weight = {s: weights[k % 3] for k, s in enumerate(sources)}
    full: set = set()
    while True:
        rest = share * words - sum(cap * total[s] for s in full)
        level = rest / max(1, sum(weight[s] for s in sources if s not in full))
        over = {s for s in sources if s not in full and level * weight[s] > cap * total[s]}
        if not over:
            break
        full |= over
    target = {s: cap * total[s] if s in full else level * weight[s] for s in sources}
    goal = {s: min(max(round(target[s]), 1), int(total[s] * cap)) if target[s] > 0 else 0 for s in sources}
    block = max(1, math.ceil(share * words / slots))
    n_slots = math.ceil(share * words / block)
    blocks = {s: [] for s in sources}
    for t in range(n_slots):
        u = (t + 0.5) * mixing.INV_PHI
        u -= math.floor(u)
        at = 0.0
        for s in sources:
            at += target[s] / sum(target.values())
            if u < at or s == sources[-1]:
                blocks[s].append(t)
                break
    lacking = sorted((b, k, s) for k, s in enumerate(sources) for b in range(len(blocks[s]), math.ceil(goal[s] / block)))
    for n, (_, _, s) in enumerate(lacking):
        blocks[s].append(n_slots + n)
    found, buckets = {}, max(1, math.isqrt(len(rows)))
    for s in sources:
        own = sorted((i for i, _, x in rows if x == s), key=lambda i: (signed(first_hash(i)) % buckets, second(i), i))
        at = 0
        for i in own:
            taken, slot = 0, None
            for epoch in range(2):
                a = at + epoch * total[s]
                b = min(a + size[i], goal[s])
                if b > a:
                    taken += b - a
                    slot = min([*blocks[s][a // block : (b - 1) // block + 1], *([slot] if slot is not None else [])])
            found[i] = (taken, slot, target[s])
            at += size[i]
    return found


@pytest.mark.parametrize("slots", [7, 60, 1000])
def test_mixing_by_brute_force(spark, slots):
    rng = random.Random(slots)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(40) if i % 9 else 300)), rng.choice(["a", "a", "a", "a", "b", "c", "d", None])) for i in range(150)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = slow_mix(rows, slots)
    size = {i: len(t.split()) for i, t, _ in rows}
    times = collections.Counter(r.doc_id for r in mixing.copies(d, mixing.mix(d, slots=slots)).collect())
    assert times == {i: math.ceil(taken / size[i]) for i, (taken, *_) in want.items() if taken}
    for r in mixing.mix(d, slots=slots).collect():
        taken, slot, target = want[r.doc_id]
        assert (r.taken, r.first_slot) == (taken, slot) and abs(r.target - target) < 1e-6 * max(1, target)


def test_pipeline_stages_on_awkward_rows(spark):
    """Nulls, repeated rows, ties, very long texts and columns with clashing names pass through every stage."""
    import corpus_pipeline
    from trailforge.llm.common import written

    from pyspark.sql import functions as F

    own = table(spark, SF, "documents").withColumn("size", F.lit(7)).withColumn("id", F.lit("x"))
    odd = docs(spark).select((F.col("doc_id") + 100_000).alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"), F.col("size").cast("int").alias("size"), "id")
    nameless = own.where("doc_id % 9 = 0").withColumn("doc_id", F.lit(None).cast("long"))
    nothing_at_all = own.limit(1).select(*[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in own.columns])
    d = written(own.unionByName(own.where("doc_id % 4 = 0")).unionByName(odd).unionByName(nameless).unionByName(nothing_at_all), "test")
    columns = d.columns
    for name, stage in corpus_pipeline.STAGES:
        before = d.count()
        d = written(stage(spark, d, SF), "test")
        if name != "bpe":
            assert d.columns == columns
        if name in ("quality", "near_dups"):
            assert 0 < d.count() <= before
        if name in ("pii", "bpe"):
            assert d.count() == before


def test_mixing_edges(spark):
    assert mixing.mix(nothing(spark)).count() == 0
    d = docs(spark)
    out = mixing.copies(d, mixing.mix(d))
    assert out.columns == d.columns
    n = collections.Counter(r.doc_id for r in out.collect())
    assert max(n.values()) <= 2 and 0 not in n
    assert mixing.mix(docs(spark, [None, "", " "])).agg({"taken": "sum"}).head()[0] == 0


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, n long, id string").select("vec_id", "embedding", "label", "n", "id")


def slow_links(rows):
    good = {}
    for i, v, *_ in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = x / np.linalg.norm(x)
    own, n = Sets(), collections.Counter()
    ids = list(good)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.95:
                own.join(i, j)
                n[i] += 1
                n[j] += 1
    return {i: (n[i], own.find(i)) for i, *_ in rows}


def test_embeddings_by_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(30):
        base = rng.normal(size=64)
        rows += [base + rng.normal(size=64) * rng.uniform(0, 0.4) for _ in range(12)]
    rows += [rows[0]] * 20 + [rows[1] * 3]
    rows = [[float(np.float32(x)) for x in v] for v in rows]
    rows += [None, [], [0.0] * 64, [float("nan")] * 64, [None] + [1.0] * 63, [1.0, 2.0], [1.0, 2.0], [float("inf")] * 64]
    rng.shuffle(order := list(range(len(rows))))
    rows = [(i, rows[k], 0, 1, "x") for i, k in enumerate(order)]
    want = slow_links(rows)
    for parts in ((512, 4096, 512), (16, 16, 512), (40, 80, 7)):
        held = embedding_dups.LEAST_PART, embedding_dups.MOST_PART, embedding_dups.TILE
        embedding_dups.LEAST_PART, embedding_dups.MOST_PART, embedding_dups.TILE = parts
        try:
            found = {r.vec_id: r for r in embedding_dups.embedding_dups(vectors(spark, rows)).collect()}
        finally:
            embedding_dups.LEAST_PART, embedding_dups.MOST_PART, embedding_dups.TILE = held
        assert len(found) == len(rows) and all(r.n_links <= want[i][0] for i, r in found.items())
        links = sum(n for n, _ in want.values())
        assert sum(r.n_links for r in found.values()) >= 0.98 * links
        assert sum(r.component_id == want[i][1] for i, r in found.items()) >= 0.98 * len(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_embeddings_edges(spark):
    assert embedding_dups.embedding_dups(vectors(spark, [])).count() == 0
    found = embedding_dups.embedding_dups(vectors(spark, [(7, [1e200, 1e200], 0, 1, "x"), (3, [1e200, 1e200], 0, 1, "x"), (9, [1e-200, 1e-200], 0, 1, "x")], "double")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {3: (2, 3), 7: (2, 3), 9: (2, 3)}


@pytest.mark.parametrize("dim", [64, 384])
@pytest.mark.parametrize("codes", [16, 71, 126])
def test_caps_meet_at_the_limit_whatever_the_codes(dim, codes):
    """Pairs at cosine exactly 0.95 share a cap; 126 codes are those of a billion vectors."""
    rng = np.random.default_rng(codes)
    x = rng.normal(size=(300, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(300, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    met = [bool(np.intersect1d(a, b).size) for a, b in zip(embedding_dups.decode(x, codes), embedding_dups.decode(y, codes), strict=True)]
    assert np.mean(met) >= 0.98


def test_all_exceeding_directions_are_decoded():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn, blocks = embedding_dups.code(24, 5)
    y = x @ turn
    inner = [y[:, 6 * i : 6 * i + 6] @ b.T for i, b in enumerate(blocks)]
    for n, found in enumerate(embedding_dups.decode(x, 5)):
        every = (inner[0][n][:, None, None, None] + inner[1][n][:, None, None] + inner[2][n][:, None] + inner[3][n]).ravel()
        assert found.tolist() == np.flatnonzero(every >= every.max() - embedding_dups.margin(24)).tolist()


def test_repeated_and_null_vec_ids(spark):
    v, w = [1.0] * 8, [1.0] * 7 + [-1.0]
    found = embedding_dups.embedding_dups(vectors(spark, [(5, v, 0, 1, "x"), (5, v, 0, 1, "x"), (None, v, 0, 1, "x"), (8, w, 0, 1, "x")])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in found) == [(0, 2, 0), (5, 2, 5), (5, 2, 5), (8, 0, 8)]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, n long, digest string, first long")


def test_warc_round_trip(spark):
    long = "<p>é long</p>" * 200_000
    raw = [(9, "u", "x" * 100), (4, None, "x" * 100), (4, "u", "x" * 100), (6, "a\r\nb", "x" * 99), (7, "u", "x" * 99), (1, "u", None), (2, "u", ""), (None, "u", "x" * 100), (3, "u", long), (5, "u", long)]
    folder = new_path(spark, "warc-test")
    index = warc.write(pages(spark, [(*r, 1, "d", 2) for r in raw]), folder)
    rows = warc.read(index, folder, payloads=True).collect()
    html = {i: h or "" for i, _, h in raw}
    assert len(rows) == len(raw)
    for r in rows:
        payload = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert r.payload == (payload if r.record_type == "response" else b"")
    assert {(r.page_id, r.record_type, r.refers_to) for r in rows} == {(9, "revisit", 4), (4, "response", None), (6, "response", None), (7, "response", None), (1, "response", None), (2, "response", None), (None, "revisit", 4), (3, "response", None), (5, "revisit", 3)}
    assert warc.archive(pages(spark, [])).count() == 0


@pytest.mark.parametrize("few", [100_000, 0])
def test_revisits_by_either_join(spark, few, monkeypatch):
    monkeypatch.setattr(warc, "FEW", few)
    rows = [(i, "u", f"{i % 7}" * (99 + i % 7), 1, "d", 2) for i in range(60)]
    found = {r.page_id: (r.record_type, r.refers_to) for r in warc.archive(pages(spark, rows)).collect()}
    assert found == {i: ("response", None) if i % 7 == 0 or i < 7 else ("revisit", i % 7) for i in range(60)}


def test_an_operator_sends_the_package_itself(tmp_path):
    """In a fresh session, with the package known to the driver only, and no query before."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
import sys
sys.path.insert(0, {str(Path(near_dups.__file__).parents[2])!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
docs = spark.createDataFrame([(i, "one two three four five six " * 3 + str(i)) for i in range(4)], "doc_id long, text string")
from trailforge.llm import near_dups
assert near_dups.near_dups(docs).count() == 4
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    for _ in range(60):  # the application's tables go with it
        if not list((tmp_path / "shared").rglob("*.parquet")):
            break
        time.sleep(0.5)
    else:
        raise AssertionError("tables were left behind")


def test_each_thread_has_its_own_scratch(spark):
    import threading

    from trailforge.llm.common import Scratch, written

    inside, over = threading.Event(), threading.Event()
    counts = []

    def other():
        with Scratch(spark):
            inside.set()
            over.wait(60)

    thread = threading.Thread(target=other)
    thread.start()
    assert inside.wait(60)
    with Scratch(spark) as scratch:
        kept = scratch.keep(written(spark.range(3), "mine"))
        gone = written(spark.range(4), "gone")
        counts.append(gone.count())
    over.set()
    thread.join()
    assert counts == [4] and kept.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        gone.count()


def test_release_leaves_nothing(spark, tmp_path):
    import pathlib

    import corpus_pipeline
    from trailforge.llm.common import own_folder, release

    release(spark)  # what earlier tests left
    corpus_pipeline.run(spark, SF).write.parquet(str(tmp_path / "out"))
    folder = pathlib.Path(own_folder(spark).removeprefix("file://").removeprefix("file:"))
    names = {p.name.rsplit("-", 1)[0] for p in folder.iterdir()}
    assert not names & {"pipeline-quality", "pipeline-near_dups", "pipeline-pii", "pii-spans", "near-rows"}  # intermediate tables go at once
    release(spark)
    assert not folder.exists() and spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_bundles_are_plain_zstandard(spark, tmp_path):
    import zstandard

    warc.write(table(spark, SF, "pages"), f"file://{tmp_path}/out").count()
    data = b""
    for part in sorted((tmp_path / "out").iterdir()):
        reader = zstandard.ZstdDecompressor().stream_reader(part.read_bytes(), read_across_frames=True)
        data += reader.read()
    assert data.count(b"WARC/1.1\r\n") == table(spark, SF, "pages").count()


def test_pipeline_stages(spark):
    import corpus_pipeline

    d = table(spark, SF, "documents")
    columns, seen = d.columns, {r.doc_id: r for r in d.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    from trailforge.llm.common import written

    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in d.select("doc_id").collect()}
        d = written(stage(spark, d, SF), "test")
        rows = d.collect()
        after = {r.doc_id for r in rows}
        assert after <= before
        if name != "bpe":
            assert d.columns == columns
        if name == "quality":
            clean = {i for i in before if labels.get(i) == 1 and len(seen[i].text.split()) >= 50}
            assert len(clean - after) <= 0.05 * len(clean)
        if name == "near_dups":
            want = slow_near({i: seen[i].text for i in before}, 5, 80)
            assert after == {i for i in before if want[i][1] == i}
        if name == "pii":
            from .test_texts import slow_spans

            assert after == before
            assert all(r.text == seen[r.doc_id].text for r in rows if not slow_spans(seen[r.doc_id].text))
            assert all(not slow_spans(r.text) for r in rows)
    assert {r.doc_id: r for r in rows} and all(r.n_tokens == len(r.ids) for r in rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, SF, "documents").limit(0), SF).count() == 0
