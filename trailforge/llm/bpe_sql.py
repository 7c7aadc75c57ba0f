"""Byte-level BPE as recursive DuckDB queries, one engine per Python worker.

Texts are cut by the tokenizer's pattern; the distinct pieces that a worker has not met yet go through DuckDB:

* encode: a piece is a list of rows (w, pos, tok), each with its next token's place and id. Each step of a recursive
  query joins them with the merge table, finds for every piece its leftmost pair of minimum rank and
  contracts it; pieces without a pair leave the recursion: the fixpoint. A recursive query keeps the rows of all its steps, so it
  ends after STEPS steps (fewer where rows are many) and the pieces that still have pairs start the next one.
* decode: the tokens' rows join the vocabulary and an ordered aggregation puts the bytes together.

Chunks of pieces are bounded by number and bytes; a piece that exceeds them is a chunk of its own. Chunks of short pieces contract one pair of a
piece per step. Chunks with a piece over SHORT bytes contract all occurrences of a piece's minimum pair per step, every second one of
those that overlap, from the left: the same contractions in the same order, in far fewer steps. A merge whose result is
part of a pair of lower rank could change that order, so of such a merge only the leftmost occurrence is contracted.
DuckDB has no folder to spill to; its memory is bounded, and grows only with a single piece of half a megabyte and more.

A text's ids and decoded bytes are those of its pieces, one after the other. Results of pieces stay in two dictionaries of
HELD entries at most, which changes nothing but the speed.

Defined cases: null text is empty (0 tokens; digests of the empty string); repeated rows and null ids are encoded alike; an empty
table gives an empty result. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, slices

HELD = 600_000
CHUNK = 8_192
CHUNK_BYTES = 1 << 17
SHORT = 96
STEPS = 16
#: Rows that a recursive query may keep, all steps together.
KEPT_ROWS = 1 << 21
MEMORY_MB = 300

#: A row has its token, the next token's place and the next token. Places are below 2^22 here, so that a pair (rank, its
#: place, the next token's place) is one number.
ONE_PAIR = """
    with best as (
      select w, min((m.id::bigint << 44) | (pos::bigint << 22) | nx) as pair
      from s join merges m on m.l = s.tok and m.r = s.nt where s.step < {steps} group by w),
    met as (
      select b.w, (b.pair >> 44)::int as id, ((b.pair >> 22) & 4194303)::int as here, (b.pair & 4194303)::int as gone, r.nx, r.nt
      from best b join s r on r.w = b.w and r.pos = (b.pair & 4194303))
    select s.w, s.pos,
      case when s.pos = met.here then met.id else s.tok end,
      case when s.pos = met.here then met.nx else s.nx end,
      case when s.pos = met.here then met.nt when s.nx = met.here then met.id else s.nt end,
      s.step + 1
    from s join met on met.w = s.w where s.pos <> met.gone
"""

#: All occurrences of a piece's minimum pair: run numbers them, `head` is the number at which a run of overlapping ones
#: begins, pair keeps every second of these.
ALL_PAIRS = """
    with hit as (
      select s.w, s.pos, s.nx, m.id, m.alone from s join merges m on m.l = s.tok and m.r = s.nt where s.step < {steps}),
    best as (select w, min(id) as id from hit group by w),
    run as (
      select h.*, row_number() over o as n, lag(h.nx) over o is distinct from h.pos as first
      from hit h join best b on b.w = h.w and b.id = h.id window o as (partition by h.w order by h.pos)),
    pair as (
      select w, pos, nx, id from (select *, max(case when first then n end) over (partition by w order by pos) as head from run)
      where (n - head) % 2 = 0 and (n = 1 or not alone)),
    met as (select p.w, p.pos, p.id, p.nx as gone, r.nx, r.nt from pair p join s r on r.w = p.w and r.pos = p.nx)
    select s.w, s.pos, coalesce(a.id, s.tok), coalesce(a.nx, s.nx), coalesce(b.id, a.nt, s.nt), s.step + 1
    from s join best on best.w = s.w
      left join met a on a.w = s.w and a.pos = s.pos
      left join met b on b.w = s.w and b.pos = coalesce(a.nx, s.nx)
      anti join met g on g.w = s.w and g.gone = s.pos
"""

RECURSION = """
with recursive s(w, pos, tok, nx, nt, step) as (
  select w, pos, tok, nx, nt, 0 from pieces
  union all ({step})
), last as (select s.* from s join (select w, max(step) as step from s group by w) e on e.w = s.w and e.step = s.step)
"""

DECODE = """
select t.w, string_agg(v.hex, '' order by t.pos) as hex, string_agg(t.tok::varchar, ' ' order by t.pos) as ids
from tokens t join vocabulary v on v.id = t.tok group by t.w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merger:
    """The DuckDB side: merge table and vocabulary of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        left, right, whole = [], [], []
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), whole.append(i)
        l, r, i = (np.array(x, np.int32) for x in (left, right, whole))
        lowest = np.full(max(ranks.values()) + 1, np.iinfo(np.int32).max, np.int32)  # rank of a pair with this token in it
        np.minimum.at(lowest, l, i)
        np.minimum.at(lowest, r, i)
        self.merges = pa.table({"l": l, "r": r, "id": i, "alone": lowest[i] < i})
        self.vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])})
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = None

    def open(self) -> None:
        """A connection with the two tables; close() gives DuckDB's memory back."""
        import duckdb

        if self.con is None:
            self.con = duckdb.connect()
            self.con.execute("set threads = 1")
            self.con.execute(f"set memory_limit = '{MEMORY_MB}MB'")
            self.con.execute("set temp_directory = ''")
            for name in ("merges", "vocabulary"):
                self.con.register("given", getattr(self, name))
                self.con.execute(f"create table {name} as select * from given")
                self.con.unregister("given")

    def close(self) -> None:
        if self.con is not None:
            self.con.close()
        self.con = None

    def encode(self, pieces: list[bytes]) -> tuple[list[int], list[str], list[str]]:
        """For each piece, in any order: its number, its decoded bytes in hex, and its ids in decimal, in order."""
        whole = [self.ranks.get(p) for p in pieces]
        rest = [w for w, r in enumerate(whole) if r is None]
        done = [w for w, r in enumerate(whole) if r is not None]
        self.open()
        raw = np.frombuffer(b"".join([pieces[w] for w in rest]), np.uint8)
        sizes = np.array([len(pieces[w]) for w in rest], np.int64)
        longest = int(sizes.max(initial=0))
        pos = (np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        tok = self.byte_ids[raw]
        follows = np.append(tok[1:], np.int32(-1))
        follows[np.cumsum(sizes) - 1] = -1  # no merge has it
        live = pa.table({"w": np.repeat(np.array(rest, np.int32), sizes), "pos": pos, "tok": tok, "nx": pos + np.int32(1), "nt": follows[: len(raw)]})
        self.con.register("known", pa.table({"w": pa.array(done, pa.int32()), "pos": pa.array([0] * len(done), pa.int32()), "tok": pa.array([whole[w] for w in done], pa.int32())}))
        if longest <= STEPS:  # one query sees all to the end
            found = self._read(RECURSION.format(step=ONE_PAIR.format(steps=STEPS)) + ", tokens as (select w, pos, tok from last union all select * from known)" + DECODE, live)
        else:
            self.con.execute("create or replace temp table tokens as select * from known")
            self.con.execute(f"set memory_limit = '{max(MEMORY_MB, longest * 600 // 1_000_000)}MB'")
            while live.num_rows:
                steps = max(1, min(STEPS, KEPT_ROWS // live.num_rows))
                self.con.register("pieces", live)
                self.con.execute("create or replace temp table last as " + RECURSION.format(step=(ONE_PAIR if longest <= SHORT else ALL_PAIRS).format(steps=steps)) + "select * from last")
                self.con.unregister("pieces")
                self.con.execute(f"insert into tokens select w, pos, tok from last where step < {steps}")
                live = self.con.sql(f"select w, pos, tok, nx, nt from last where step = {steps}").to_arrow_table()
            found = self._read(DECODE)
        self.con.unregister("known")
        return found

    def _read(self, query: str, pieces: pa.Table | None = None) -> tuple[list[int], list[str], list[str]]:
        if pieces is not None:
            self.con.register("pieces", pieces)
        found = self.con.sql(query).to_arrow_table()
        if pieces is not None:
            self.con.unregister("pieces")
        return tuple(found.column(c).to_pylist() for c in ("w", "hex", "ids"))

    def decode(self, tokens: pa.Table) -> tuple[list[int], list[str], list[str]]:
        """For each w of rows (w, pos, tok): w, the decoded bytes in hex, and the ids in decimal, in order."""
        self.open()
        self.con.register("given", tokens)
        self.con.execute("create or replace temp table tokens as select * from given")
        self.con.unregister("given")
        return self._read(DECODE)


def chunks(pieces: list[bytes]) -> Iterator[tuple[int, int]]:
    """Borders of chunks of CHUNK pieces and CHUNK_BYTES bytes at most, or one piece."""
    start = held = 0
    for i, p in enumerate(pieces):
        if i > start and (i - start == CHUNK or held + len(p) > CHUNK_BYTES):
            yield start, i
            start, held = i, 0
        held += len(p)
    if pieces:
        yield start, len(pieces)


class Codec:
    """Pieces with their ids in decimal and their decoded bytes. What is new waits in `young`; what is met again in a later
    batch of texts is `proven` and outlives the task. Both are bounded."""

    def __init__(self, path: str, pattern: str, held: int = HELD):
        import regex

        self.most = held
        self.merger = Merger(read_ranks(path))
        self.find = regex.compile(pattern).findall
        self.young: dict[str, tuple[str, bytes]] = {}
        self.proven: dict[str, tuple[str, bytes]] = {}

    def forget(self) -> None:
        """Give the memory of what is not proven, and of DuckDB, back; ranks and merges stay."""
        self.young = {}
        self.merger.close()

    def _learned(self, pieces: list[str]) -> Iterator[tuple[str, tuple[str, bytes]]]:
        pieces = sorted(pieces, key=len)  # long ones don't hold short ones up
        raw = [p.encode() for p in pieces]
        for start, end in chunks(raw):
            for w, text, ids in zip(*self.merger.encode(raw[start:end]), strict=True):
                yield pieces[start + w], (ids, bytes.fromhex(text))

    def run(self, texts: list) -> Iterator[list[tuple[str, bytes]]]:
        """For each text, (ids in decimal, decoded bytes) of its pieces."""
        cut = [self.find(t) if t else [] for t in texts]
        met = set().union(*cut)
        old = met & self.proven.keys()
        again = (met - old) & self.young.keys()
        held = dict(zip(old, map(self.proven.__getitem__, old), strict=True))
        if len(self.proven) + len(again) > self.most:
            self.proven = held.copy()
        for p in again:
            held[p] = self.proven[p] = self.young[p]
        new = dict(self._learned(list(met - old - again)))
        if len(self.young) + len(new) > self.most:
            self.young = {}
        self.young.update(new)
        held.update(new)
        get = held.__getitem__
        for pieces in cut:
            yield list(map(get, pieces))


_codecs: dict[tuple[str, str, int], Codec] = {}


def codec(path: str, pattern: str, held: int = HELD) -> Codec:
    """The worker's own codec; made once."""
    if (path, pattern, held) not in _codecs:
        _codecs[path, pattern, held] = Codec(path, pattern, held)
    return _codecs[path, pattern, held]


def encode(docs: DataFrame, path: str, pattern: str, ids: bool = True, held: int = HELD) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array<int>). held: pieces in memory at most,
    about 0.3 KB each; fewer where workers also serve other stages, at the price of time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern, held)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        try:
            yield from encoded(own, sha, batches)
        finally:
            own.forget()

    def encoded(own: Codec, sha, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, most=2 << 20):
            n, first, second, all_ids = [], [], [], []
            for got in own.run(texts):
                text = " ".join([x[0] for x in got])
                n.append(text.count(" ") + 1 if text else 0)
                first.append(sha(text.encode()))
                second.append(sha(b"".join([x[1] for x in got])))
                if ids:
                    all_ids.append(np.fromiter(map(int, text.split()), np.int32))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return in_arrow(docs.select("doc_id", "text"), run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids): an ordered aggregation per batch; bytes that are no UTF-8 are replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        try:
            yield from decoded(own.merger, batches)
        finally:
            own.forget()

    def decoded(own: Merger, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("ids")
            sizes = [0 if n is None else n for n in pa.compute.list_value_length(rows).to_pylist()]
            tok = pa.compute.list_flatten(rows).cast(pa.int32())
            w = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            pos = (np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            texts = [""] * len(sizes)
            for at, text, _ in zip(*own.decode(pa.table({"w": w, "pos": pos, "tok": tok})), strict=True):
                texts[at] = bytes.fromhex(text).decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return in_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
