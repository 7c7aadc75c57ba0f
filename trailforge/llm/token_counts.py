"""Token counts by a compiled finite-state tokenizer.

A byte-level BPE tokenizer (pattern and merges) is compiled, as far as texts need it, into one deterministic transducer
over bytes. Its transitions carry the change of the token count; a final value per state adds what the end of a text
still settles.

* Merges. The last token of a prefix's encoding is the only token t that ends the prefix such that t follows the last
  token of the prefix before t (the pair encodes to itself). So a state needs no more of the past than the longest
  suffix that begins a token of the vocabulary, and at each of its positions the last token and the count relative to
  now. Such states are finite in number, whatever the length of a piece.
* Pattern. On top are the states of the splitting pattern: in letters, digits or other signs, after a lone apostrophe,
  in white space (whose last character waits for what follows), and inside a character's bytes.

States and transitions are interned on first use (at most CELLS cells; then the machine starts anew, which only costs
time), so the table stays small though the whole product would be huge.

Texts are cut into chunks of CHUNK bytes (whole characters; special tokens in a text cut it too, and count one each). A chunk's
map takes each live start state to (end state, count). Which states are live is found by running the BACK bytes before the
chunk, from a space after an ASCII letter, digit or full stop if there is one, since that ends the piece before it in every state.
All pairs of a chunk and a start state run in step, one table look-up per byte each, equal chunks once. The maps then compose
by a parallel prefix scan, in which each round doubles the number of chunks that a map spans. Where a chunk's map lacks the state that the
one before it ends in, that state becomes live too and the scan is done again: in the first WIDENED rounds for all chunks
at once, later only where a text's own path breaks off, so that the result is exact and the work stays linear.

Defined cases: null text is empty (0 bytes, 0 tokens); repeated rows and null ids count alike; an empty table gives an empty
result. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, slices

CHUNK = 512
BACK = 64
WIDENED = 12
CELLS = 30_000_000
PAIRS = 200_000
#: New states that one step of all chunks may make: one per chunk, of which a batch has this many at most.
ROOM = 20_000
LIMIT = 1024
# Code points of white space, and the endings that the pattern splits off after an apostrophe.
SPACES = frozenset([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
ENDS_PIECE = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.")


class Merges:
    """The merges of a tokenizers .json file on bytes."""

    def __init__(self, spec: dict):
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError("only byte-level BPE with the usual pattern, without normalizer and prefix space, can be compiled")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = plain + [b for b in range(256) if b not in set(plain)]
        byte = {chr(b if b in set(plain) else 256 + i - len(plain)): b for i, b in enumerate(shown)}
        to_bytes = lambda t: bytes(byte[c] for c in t)
        special = {x["content"] for x in spec.get("added_tokens") or []}
        self.special = [x.encode() for x in sorted(special, key=len, reverse=True)]
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items() if t not in special}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = map(to_bytes, m if isinstance(m, list) else m.split(" "))
            self.rank[self.ids[a], self.ids[b]] = r, self.ids[a + b]
        self.known: dict[bytes, int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # rank, left and right part of the merge that makes a token; rank -1: a byte
        for t, i in self.ids.items():
            ids, last = self.contracted(t)
            if ids == [i]:
                self.known[t] = i
                self.made[i] = last
        whole = {i: r for i, (r, _, _) in self.made.items()}
        #: Whether every merge comes after those that make its parts: then tokens grow in the order of ranks.
        self.ordered = all(r > max(whole[x], whole[y]) for (x, y), (r, _) in self.rank.items() if x in whole and y in whole)
        self.begins = {t[:k] for t in self.known for k in range(len(t))}
        self.follows: dict[tuple[int, int], bool] = {}

    def contracted(self, piece: bytes) -> tuple[list[int], tuple[int, int, int]]:
        """Plain contraction, for short pieces, and its last merge."""
        tokens, last = [self.ids[piece[i : i + 1]] for i in range(len(piece))], (-1, 0, 0)
        while len(tokens) > 1:
            best = min(((*self.rank[p], i) for i, p in enumerate(zip(tokens, tokens[1:], strict=False)) if p in self.rank), default=None, key=lambda x: (x[0], x[2]))
            if best is None:
                break
            last = best[0], *tokens[best[2] : best[2] + 2]
            tokens[best[2] : best[2] + 2] = [best[1]]
        return tokens, last

    def encode(self, piece: bytes) -> list[int]:
        return self.contracted(piece)[0]

    def stays_apart(self, a: int, b: int) -> bool:
        """Whether no merge joins the end of a with the start of b while these grow. Their parts at the border are met from the
        last merge backwards; two that are there at the same time would merge if the rank is below those of the merges that take
        them away, of which an equal one to the left comes first."""
        until_a = until_b = float("inf")
        while True:
            hit = self.rank.get((a, b))
            if hit is not None and hit[0] < until_a and hit[0] <= until_b:
                return False
            (rank_a, _, end), (rank_b, start, _) = self.made[a], self.made[b]
            if rank_a > rank_b:
                a, until_a = end, rank_a
            elif rank_b >= 0:
                b, until_b = start, rank_b
            else:
                return True

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the two encode to themselves. a, b: known tokens."""
        if self.ordered:
            return self.stays_apart(a, b)
        found = self.follows.get((a, b))
        if found is None:
            if len(self.follows) >= PAIRS:
                self.follows.clear()
            found = self.follows[a, b] = self.encode(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found


#: A state inside a piece: the suffix that may go on as a token; the last token (-1: the piece's start) and the count
#: relative to now, at each position of the suffix.
Inner = tuple[bytes, tuple[int, ...], tuple[int, ...]]
FRESH: Inner = (b"", (-1,), (0,))


class Machine:
    """The transducer. State keys are (kind, inner state or None, waiting bytes); kinds: B at a piece's start, W in
    white space whose last character waits, L letters, N digits, O other signs, A a lone apostrophe at a piece's
    start, E an apostrophe and the waiting first letter of a two-letter ending, U inside a character (with the state
    before it)."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.columns = np.zeros(256, np.uint8)
        self.seen = np.zeros(256, bool)
        self.reset()

    def reset(self) -> None:
        self.keys: list[tuple] = []
        self.index: dict[tuple, int] = {}
        width = min(256, int(self.seen.sum()) // 16 * 16 + 32)
        self.table = np.empty((CELLS // width, width), np.int32)  # memory is used from a row's first use on
        self.final: list[int] = []
        self.state(("B", None, b""))

    def state(self, key: tuple) -> int:
        i = self.index.get(key)
        if i is None:
            i = self.index[key] = len(self.keys)
            self.keys.append(key)
            self.final.append(self.end(key))
            self.table[i] = -1
        return i

    # the merges

    def step(self, at: Inner, byte: int) -> tuple[Inner, int]:
        suffix, last, count = at
        suffix += bytes((byte,))
        m = self.merges
        for k in range(len(suffix)):
            token = m.known.get(suffix[k:])
            if token is not None and (last[k] < 0 or m.may_follow(last[k], token)):
                break
        else:
            raise ValueError(f"no token ends {suffix!r}")
        change = count[k] + 1
        last, count = (*last, token), (*(c - change for c in count), 0)
        k = 0
        while suffix[k:] not in m.begins:
            k += 1
        return (suffix[k:], last[k:], count[k:]), change

    def feed(self, at: Inner | None, data: bytes) -> tuple[Inner, int]:
        at, total = at or FRESH, 0
        for b in data:
            at, change = self.step(at, b)
            total += change
        return at, total

    # the pattern

    def end(self, key: tuple) -> int:
        kind, at, wait = key
        if kind == "W":
            return self.feed(at, wait)[1]
        return self.feed(None, wait)[1] if kind == "E" else 0

    def character(self, key: tuple, data: bytes) -> tuple[tuple, int]:
        """The state after one more character, and the change of the count."""
        kind, at, wait = key
        c = data.decode()
        o = ord(c)
        sort = "W" if o in SPACES else {"L": "L", "N": "N"}.get(unicodedata.category(c)[0], "O")
        if kind == "B":
            if sort == "W":
                return ("W", None, data), 0
            at, change = self.feed(None, data)
            return ("A" if c == "'" else sort, at, b""), change
        if kind == "W":
            if sort == "W":
                at, change = self.feed(at, wait)
                return ("W", at, data), change
            if wait == b" ":
                at, change = self.feed(None, wait + data)
                return (sort, at, b""), change
            alone = self.feed(None, wait)[1]
            key, change = self.character(("B", None, b""), data)
            return key, alone + change
        if kind == "A":
            if c in ENDINGS:
                return ("B", None, b""), self.feed(at, data)[1]
            if any(x[0] == c for x in ENDINGS):
                return ("E", at, data), 0
            kind = "O"
        if kind == "E":
            if wait.decode() + c in ENDINGS:
                return ("B", None, b""), self.feed(at, wait + data)[1]
            at, before = self.feed(None, wait)
            key, change = self.character(("L", at, b""), data)
            return key, before + change
        if kind == sort:
            at, change = self.feed(at, data)
            return (kind, at, b""), change
        return self.character(("B", None, b""), data)

    def byte(self, key: tuple, byte: int) -> tuple[tuple, int]:
        if key[0] == "U":
            before, data = key[1], key[2] + bytes((byte,))
        else:
            before, data = key, bytes((byte,))
        lead = data[0]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return (("U", before, data), 0) if len(data) < size else self.character(before, data)

    def learn(self, state: int, byte: int) -> None:
        key, change = self.byte(self.keys[state], byte)
        if not -512 <= change < 512:
            raise OverflowError("a transition changes the count too much")
        to = self.state(key)
        self.table[state, self.columns[byte]] = to << 10 | change + 512

    def run(self, chunks: list[bytes], starts: list[tuple]) -> tuple[list[tuple], np.ndarray]:
        """State and count at the end of each chunk, all in step, from the states given."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        raw = np.frombuffer(b"".join([chunks[i] for i in order]), np.uint8)
        new = (np.bincount(raw, minlength=256) > 0) & ~self.seen
        self.columns[new] = self.seen.sum() + np.arange(new.sum())
        self.seen |= new
        if self.seen.sum() > self.table.shape[1] or len(self.keys) + 2 * ROOM > len(self.table):
            self.reset()
        symbols = self.columns[raw]
        at = np.cumsum(sizes) - sizes
        state = np.fromiter((self.state(starts[i]) for i in order), np.int64, len(chunks))
        count = np.zeros(len(chunks), np.int64)
        ends: list = [None] * len(chunks)
        live = known = len(sizes)  # lanes from `known` on have their end state named
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[live - 1] <= t:
                live -= 1
            here = at[:live] + t
            cell = state[:live] * self.table.shape[1] + symbols[here]
            got = self.table.ravel().take(cell)
            if got.min() < 0:
                miss = np.flatnonzero(got < 0)
                for c, i in zip(*np.unique(cell[miss], return_index=True), strict=True):
                    self.learn(int(c) // self.table.shape[1], int(raw[here[miss[i]]]))
                got = self.table.ravel().take(cell)
            state[:live] = got >> 10
            count[:live] += (got & 1023) - 512
            if len(self.keys) + ROOM > len(self.table):
                ends[live:known] = [self.keys[s] for s in state[live:known]]
                known = live
                keys = [self.keys[s] for s in state[:live]]
                self.reset()
                state[:live] = [self.state(k) for k in keys]
        ends[:known] = [self.keys[s] for s in state[:known]]
        out, counts = [None] * len(chunks), np.empty(len(chunks), np.int64)
        counts[order] = count
        for i, k in enumerate(order):
            out[k] = ends[i]
        return out, counts


def cut(part: bytes) -> list[int]:
    """Borders of chunks of CHUNK bytes, moved back to the start of a character."""
    borders = [0]
    for at in range(CHUNK, len(part), CHUNK):
        while part[at] & 0xC0 == 0x80:
            at -= 1
        borders.append(at)
    return [*borders, len(part)]


def window(part: bytes, at: int) -> bytes:
    """What is run to guess the state at a border: the bytes since the last space that surely begins a piece, BACK at most."""
    low = max(0, at - BACK)
    k = part.rfind(b" ", low, at)
    while k > low and part[k - 1] not in ENDS_PIECE:
        k = part.rfind(b" ", low, k)
    if k > low:
        return part[k:at]
    while low and part[low] & 0xC0 == 0x80:
        low -= 1
    return part[low:at]


class Counter:
    BEGIN = ("B", None, b"")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(json.load(f))
        self.machine = Machine(self.merges)
        self.special = re.compile(b"|".join(map(re.escape, self.merges.special))) if self.merges.special else None

    def _run(self, chunks: list[bytes], starts: list[tuple]) -> tuple[list[tuple], np.ndarray]:
        ends, counts = [], [np.zeros(0, np.int64)]
        for i in range(0, len(chunks), ROOM):
            e, c = self.machine.run(chunks[i : i + ROOM], starts[i : i + ROOM])
            ends += e
            counts.append(c)
        return ends, np.concatenate(counts)

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        chunks: list[bytes] = []  # of all parts, one after the other
        windows: list[bytes] = []
        first: list[int] = []  # a part's first chunk
        owner: list[int] = []  # a part's text
        for i, text in enumerate(texts):
            parts = self.special.split(text) if self.special else [text]
            out[i] = len(parts) - 1
            for part in filter(None, parts):
                borders = cut(part)
                first.append(len(chunks))
                owner.append(i)
                chunks += [part[a:b] for a, b in zip(borders, borders[1:], strict=False)]
                windows += [b""] + [window(part, at) for at in borders[1:-1]]
        if not chunks:
            return out
        last = np.zeros(len(chunks), bool)
        last[np.array([*first[1:], len(chunks)]) - 1] = True
        content: dict[bytes, int] = {}
        same = np.fromiter((content.setdefault(c, len(content)) for c in chunks), np.int64, len(chunks))
        distinct = list(content)
        names: dict[tuple, int] = {}
        name = lambda key: names.setdefault(key, len(names))
        guessed, _ = self._run(windows, [self.BEGIN] * len(windows))
        nodes = {(k, name(key)) for k, key in enumerate(guessed)}  # a chunk and one of its live states
        lanes: dict[tuple[int, int], int] = {}  # distinct chunk and start state
        ends, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        rounds = 0
        while True:
            missing = list(dict.fromkeys(x for k, s in nodes if (x := (int(same[k]), s)) not in lanes))
            lanes.update(zip(missing, range(len(lanes), len(lanes) + len(missing)), strict=True))
            keys = list(names)
            e, c = self._run([distinct[x] for x, _ in missing], [keys[s] for _, s in missing])
            ends, counts = np.append(ends, [name(x) for x in e]).astype(np.int64), np.append(counts, c)
            at = np.array(sorted(nodes), np.int64)
            lane = np.fromiter((lanes[int(same[k]), s] for k, s in at.tolist()), np.int64, len(at))
            tail, total = last[at[:, 0]], counts[lane].copy()
            wide = len(names) + 1
            index = at[:, 0] * wide + at[:, 1]
            want = (at[:, 0] + 1) * wide + ends[lane]
            to = np.minimum(np.searchsorted(index, want), len(at) - 1)
            open_ = ~tail & (index[to] != want)
            to = np.where(tail | open_, len(at), to)  # the next map, or none
            stop = np.arange(len(at))  # the last chunk that a map spans
            while len(on := np.flatnonzero(to < len(at))):  # the scan: a map and the one that follows it become one
                next_ = to[on]
                total[on], stop[on], to[on] = total[on] + total[next_], stop[next_], to[next_]
            roots = np.searchsorted(index, np.array([f * wide + names[self.BEGIN] for f in first]))
            stops = stop[roots]
            broken = stops[~tail[stops]]
            if not len(broken):
                break
            rounds += 1
            grown = np.flatnonzero(open_) if rounds <= WIDENED else np.unique(broken)
            nodes.update(zip((at[grown, 0] + 1).tolist(), ends[lane[grown]].tolist(), strict=True))
        keys = list(names)
        closing = [self.machine.end(keys[int(ends[lane[s]])]) for s in stops]
        np.add.at(out, np.array(owner), total[roots] + np.array(closing, np.int64))
        return out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's own counter; its machine grows over batches."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch, texts in slices(batches, most=4 << 20):
            data = [(t or "").encode() for t in texts]
            n = own.count(data)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(map(len, data)), pa.int64()), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
