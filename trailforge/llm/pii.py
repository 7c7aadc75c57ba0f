"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base entities (email, ip, card, phone) come from regular expressions, leftmost and non-overlapping per kind, and checks
of each match. Their places are running sums of lengths: split() gives the text between matches, regexp_extract_all() the
matches; a sum doubles its reach in each of log2(n) rounds, so that n matches cost n log n.
The expressions are the contract's, with possessive loops and guards against starting inside a run, so that Java's
matcher neither recurses nor scans a run twice; they match the same spans.

Bootstrapping. Identifier-like strings (numbers with separators, tokens with a digit or an at sign; a label glued to one by
: = or # is cut off) are candidate instances. Their lexical patterns are the word before, the two words before, the word
after, the words on both sides (digits read as 0, earlier candidates included) and the instance's own shape, which only seeds teach. An instance could be of the
kinds whose plain form it has: an at sign between letters or digits; four numbers up to 255; 12 to 19 digits that pass Luhn; 7
to 15 digits with signs of telephone numbers.

Pattern-instance edges are counted once each and scored per kind. In every round, of a pattern with at least MIN_KNOWN
distinct known instances of a kind (seeds at first), the confidence for it is (known + PRIOR) / (known + 2 PRIOR + known as
another kind + wrong + UNSEEN * possible): unknown instances that could be of the kind are what is looked for, so they hardly
count against it; those that could not are evidence that the pattern is wrong. Unknown instances that could be of the kind of a pattern
that reaches MIN_CONFIDENCE become known, each for one minus the product of its doubts, and teach their other contexts in the next round. After ROUNDS rounds, occurrences of confident patterns that could be of the kind and
touch no base span become spans, of the most confident kind. held_out() hides a share of the seeds and counts how many are found again.

Patterns and instances are tables throughout: aggregates with partial sums over distinct edges, so that a common
pattern is no hot task, and joins that Spark may split; candidates meet base spans in blocks of the text; nothing is collected.

Defined cases: null text is empty (no spans); ties between kinds go to the first listed; repeated rows get the same spans
each, rows without doc_id too; an empty table gives an empty result. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, written

KINDS = ("email", "ip", "card", "phone")
# The expressions of the four kinds.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[\x20-]?[0-9]){12})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "phone": "+"}
CANDIDATE = r"""(?<![^\s:=#"'(<\[,;])(?:[+(]?[0-9][\x20().0-9-]*[0-9](?![A-Za-z0-9@])|[^\s0-9@:=#"'(<\[,;]*+[0-9@](?:[^\s"'<>()\[\],;]*[\p{L}0-9])?)"""
ROUNDS = 3
MIN_KNOWN = 5
MIN_CONFIDENCE = 0.9
PRIOR = 0.25
UNSEEN = 0.05
LEAST_DIGITS = 4
CONTEXT = 48
SHAPE = "s "
BLOCK = 256
MOST_BROADCAST = 100_000
SPAN = "array<struct<start:int,kind:int,end:int>>"
ROW = ("doc_id", "text_hash")
OTHER = ("o_id", "o_hash")


def _let(value: Column, f) -> Column:
    """f(value), value being computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _running(values: Column, merge) -> Column:
    """Running sums or maxima: each round merges a place with the one 1, 2, 4, ... before it."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))
    reach = F.transform(rounds, lambda k: F.pow(F.lit(2.0), k).cast("int"))
    return F.aggregate(reach, values, lambda acc, r: F.transform(acc, lambda x, i: F.when(i >= r, merge(x, F.get(acc, i - r))).otherwise(x)))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    d = _digits(x)
    n = F.length(d)
    value = lambda i: F.substring(d, n - i + 1, F.lit(1)).cast("int")
    terms = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(i % 2 == 1, value(i)).when(value(i) * 2 > 9, value(i) * 2 - 9).otherwise(value(i) * 2))
    return F.when(n.between(12, 19), F.aggregate(terms, F.lit(0), lambda a, b: a + b) % 10 == 0).otherwise(False)


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return _luhn(x)
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _places(text: Column, pattern: str, context: bool = False) -> Column:
    """array<struct<start, end, match>> of all matches; with context also before and after, CONTEXT characters of the text
    around, as far as they lie between the match before the last one and the next but one."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("b"))

    def of(p: Column) -> Column:
        def place(ends: Column, m: Column, i: Column) -> Column:
            end = F.get(ends, i)
            known = [(end - F.length(m)).alias("start"), end.alias("end"), m.alias("match")]
            if context:
                known += [
                    F.substring(F.concat_ws("", F.get(p["b"], i - 1), F.get(p["m"], i - 1), F.get(p["b"], i)), -CONTEXT, CONTEXT).alias("before"),
                    F.substring(F.concat_ws("", F.get(p["b"], i + 1), F.get(p["m"], i + 1)), 1, CONTEXT).alias("after"),
                ]
            return F.struct(*known)

        sizes = F.transform(p["m"], lambda m, i: F.length(F.get(p["b"], i)) + F.length(m))
        return _let(_running(sizes, lambda x, y: x + y), lambda ends: F.transform(p["m"], lambda m, i: place(ends, m, i)))

    return _let(both, of)


def base_spans(text: Column) -> Column:
    """Spans (start, kind's number, end) of the base entities, by start, then kind."""
    none = F.from_json(F.lit("[]"), SPAN)

    def of(k: int, kind: str) -> Column:
        places = F.filter(_places(text, PATTERNS[kind]), lambda x: _valid(kind, x["match"]))
        spans = F.transform(places, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end")))
        hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike("[0-9][0-9 -]{10,}[0-9]")
        return F.when(hint, spans).otherwise(none)

    found = [of(k, kind) for k, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def could_be(instance: Column) -> Column:
    """The kinds that an instance has the plain form of."""
    digits = F.length(_digits(instance))
    tests = {
        "email": instance.rlike(r"^[^@]*[\p{L}0-9][^@\p{L}0-9]*@[^@]*[\p{L}0-9][^@]*$"),
        "ip": F.when(instance.rlike(r"^[0-9]{1,3}([.-][0-9]{1,3}){3}$"), _valid("ip", F.translate(instance, "-", "."))).otherwise(False),
        "card": F.when(instance.rlike(r"^[0-9][0-9\x20.-]+$"), _luhn(instance)).otherwise(False),
        "phone": instance.rlike(r"^[+(]?[0-9][\x20().0-9-]*[0-9]$") & digits.between(7, 15),
    }
    return F.array_compact(F.array(*[F.when(tests[kind], F.lit(k)) for k, kind in enumerate(KINDS)]))


def candidates(text: Column) -> Column:
    """Candidate instances with their places and contexts."""
    few = lambda x: F.contains(x["match"], F.lit("@")) | (F.length(_digits(x["match"])) >= LEAST_DIGITS)
    return F.when(text.rlike("[0-9@]"), F.filter(_places(text, CANDIDATE, context=True), few))


def patterns_of(before: Column, after: Column, instance: Column) -> Column:
    """The lexical patterns of an occurrence, those of one word or more."""
    plain = lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), "[0-9]", "0"), r"\s+", " ")
    one, two, right = F.regexp_extract(before, r"(\S+)\s*$", 1), F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1), F.regexp_extract(after, r"^\s*(\S+)", 1)
    shape = F.regexp_replace(F.lower(instance), r"\p{L}+", "a")
    sides = [("l ", one, one != ""), ("l ", two, two != ""), ("r ", right, F.length(right) > 1), ("b ", F.concat(one, F.lit(" _ "), right), (one != "") & (right != "")), (SHAPE, shape, F.lit(True))]
    return F.array_compact(F.array(*[F.when(there, F.concat(F.lit(side), plain(x))) for side, x, there in sides]))


def _other(rows: DataFrame) -> DataFrame:
    """rows with other names for ROW, to be joined on _same()."""
    return rows.withColumnsRenamed(dict(zip(ROW, OTHER, strict=True)))


def _same() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_hash") == F.col("o_hash"))


def occurrences(spans: DataFrame) -> DataFrame:
    """From rows (doc_id, text_hash, base, found): doc_id, text_hash, start, end, instance, pattern (several rows each), kind
    (of the base entity that it touches, or null), could (kinds)."""
    blocks = F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))).alias("block")
    spans = spans.where(F.size("found") > 0).dropDuplicates(ROW)
    each = spans.select(*ROW, F.explode("found").alias("x")).select(*ROW, "x.*")
    base = _other(spans).select(*OTHER, F.explode("base").alias("x")).select(*OTHER, F.col("x.kind").alias("kind"), F.col("x.start").alias("low"), F.col("x.end").alias("high"))
    a = each.select(*ROW, "start", "end", blocks)
    b = base.withColumns({"start": F.col("low"), "end": F.col("high")}).select(*OTHER, "kind", "low", "high", blocks).withColumnRenamed("block", "own_block")
    touched = a.join(b, _same() & (F.col("block") == F.col("own_block")) & (F.col("low") < F.col("end")) & (F.col("high") > F.col("start")))
    touched = touched.groupBy(*ROW, "start").agg(F.min(F.struct("low", "kind")).alias("first"))
    touched = _other(touched).select(*OTHER, F.col("start").alias("at"), "first.kind")
    met = each.join(touched, _same() & (F.col("start") == F.col("at")), "left").select(*ROW, "start", "end", "match", "before", "after", "kind")
    instance = F.lower(F.col("match"))
    met = met.withColumn("could", F.when(F.col("kind").isNull(), could_be(instance)).otherwise(F.array(F.col("kind")))).withColumn("instance", instance)
    return met.select(*ROW, "start", "end", "instance", F.explode(patterns_of(F.col("before"), F.col("after"), F.col("instance"))).alias("pattern"), "kind", "could")


def confident_patterns(found: DataFrame, rounds: int = ROUNDS, min_known: int = MIN_KNOWN, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """pattern, kind, confidence of the patterns that hold after the rounds. found: a written table of occurrences()."""
    edges = written(found.groupBy("pattern", "instance").agg(F.min("kind").alias("kind"), F.min("could").alias("could")), "pii-edges")
    known = written(edges.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("known"), F.lit(1.0).alias("sure"), F.lit(True).alias("seed")), "pii-known")
    patterns = None
    for _ in range(rounds):
        linked = edges.join(known, "instance", "left")
        taught = F.col("seed") | ~F.startswith("pattern", F.lit(SHAPE))
        linked = linked.withColumns({c: F.when(taught, F.col(c)) for c in ("known", "sure")})
        own = lambda k: F.col("known") == k
        sums = [F.count("*").alias("n"), F.count("known").alias("hits"), F.coalesce(F.sum("sure"), F.lit(0.0)).alias("sure")]
        for k in range(len(KINDS)):
            sums += [F.count(F.when(own(k), 1)).alias(f"hits_{k}"), F.coalesce(F.sum(F.when(own(k), F.col("sure"))), F.lit(0.0)).alias(f"sure_{k}")]
            sums += [F.count(F.when(F.col("known").isNull() & F.array_contains("could", k), 1)).alias(f"may_{k}")]
        scored = linked.groupBy("pattern").agg(*sums)

        def scores(k: int) -> Column:
            wrong = F.col("sure") - F.col(f"sure_{k}") + F.col("n") - F.col("hits") - F.col(f"may_{k}")
            confidence = F.round((F.col(f"sure_{k}") + PRIOR) / (F.col(f"sure_{k}") + 2 * PRIOR + wrong + UNSEEN * F.col(f"may_{k}")), 9)
            return F.when(F.col(f"hits_{k}") >= min_known, F.struct(confidence.alias("confidence"), F.lit(-k).alias("first")))

        scored = scored.select("pattern", F.greatest(*[scores(k) for k in range(len(KINDS))]).alias("best"))
        scored = scored.where(F.col("best.confidence") >= min_confidence).select("pattern", (-F.col("best.first")).alias("kind"), "best.confidence")
        patterns = written(scored, "pii-patterns")
        reached = edges.select("pattern", "instance", "could").join(known, "instance", "left_anti").join(patterns, "pattern").where("array_contains(could, kind)")
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-3))))
        new = reached.groupBy("instance").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("top"), doubt.alias("doubt"))
        new = new.select("instance", (-F.col("top.k")).alias("known"), F.round(1 - F.exp("doubt"), 9).alias("sure"), F.lit(False).alias("seed"))
        known = written(known.unionByName(new), "pii-known")
    return patterns


def discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, end, kind of the occurrences that touch no base span and have a confident pattern."""
    new = found.where("kind is null").drop("kind").join(patterns, "pattern").where("array_contains(could, kind)")
    new = new.groupBy(*ROW, "start", "end").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("first"))).alias("best"))
    return new.select(*ROW, "start", "end", (-F.col("best.first")).cast("int").alias("kind"))


def _spans(docs: DataFrame) -> DataFrame:
    """Written: doc_id, text_hash, base, found (candidates) of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), base_spans(text).alias("base"), candidates(text).alias("found"))
    return written(rows, "pii-spans")


def find(docs: DataFrame, text_too: bool = False) -> DataFrame:
    """doc_id, base (spans), spans (base and discovered, sorted) and, if asked for, all columns of docs in a struct `row`.

    With texts, base spans are found anew in each row, so that only discovered ones are joined and no text leaves its task;
    they are broadcast if there are MOST_BROADCAST at most."""
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.keep(_spans(docs))
        found = written(occurrences(rows), "pii-occurrences")
        new = discovered(found, confident_patterns(found))
        new = new.groupBy(*ROW).agg(F.collect_set(F.struct("start", "kind", "end")).alias("new"))
        new = scratch.keep(written(_other(new), "pii-new"))
    if text_too:
        text = F.coalesce(F.col("text"), F.lit(""))
        rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), base_spans(text).alias("base"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    few = (new.agg(F.sum(F.size("new"))).head()[0] or 0) <= MOST_BROADCAST
    met = rows.join(F.broadcast(new) if few else new, _same(), "left")
    spans = F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", F.col("new").cast(SPAN))))
    return met.select("doc_id", "base", spans.alias("spans"), *(["row"] if text_too else []))


def held_out(docs: DataFrame, one_in: int = 5) -> DataFrame:
    """kind, hidden, again, wrong: base instances of which one in `one_in` (by hash) is hidden from learning, those of the hidden that patterns find again
    with their kind, and those that get another kind. A measure of the method; the operator itself hides nothing."""
    with Scratch(docs.sparkSession) as scratch:
        found = written(occurrences(_spans(docs)), "pii-occurrences")
        hide = F.col("kind").isNotNull() & (F.pmod(F.xxhash64("instance"), F.lit(one_in)) == 0)
        blind = written(found.withColumn("could", F.when(hide, could_be(F.col("instance"))).otherwise(F.col("could"))).withColumn("truth", F.when(hide, F.col("kind"))).withColumn("kind", F.when(~hide, F.col("kind"))), "pii-blind")
        again = discovered(blind.drop("truth"), confident_patterns(blind.drop("truth"))).withColumnRenamed("kind", "got")
        truth = blind.where("truth is not null").select(*ROW, "start", "truth").distinct()
        met = truth.join(_other(again).withColumnRenamed("start", "at").drop("end"), _same() & (F.col("start") == F.col("at")), "left")
        names = F.array(*map(F.lit, KINDS))
        counts = met.groupBy(F.element_at(names, F.col("truth") + 1).alias("kind")).agg(F.count("*").alias("hidden"), F.count(F.when(F.col("got") == F.col("truth"), 1)).alias("again"), F.count(F.when(F.col("got") != F.col("truth"), 1)).alias("wrong"))
        return scratch.keep(written(counts, "pii-held-out"))


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by [KIND]; of overlapping spans the first named counts, for all that they cover."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def merged(s: Column, ends: Column) -> Column:
        """Spans that overlap no other: each begins where all before have ended."""
        heads = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["start"] >= F.get(ends, i - 1)))
        last = lambda h, j: F.coalesce(F.get(h, j + 1), F.size(s)) - 1
        return _let(heads, lambda h: F.transform(h, lambda i, j: F.struct(F.get(s, i)["start"].alias("start"), F.get(s, i)["kind"].alias("kind"), F.get(ends, last(h, j)).alias("end"))))

    def rebuilt(m: Column, cut) -> Column:
        begin = lambda i: F.coalesce(F.get(m, i - 1)["end"], F.lit(0))
        parts = F.transform(m, lambda s, i: F.concat(cut(begin(i), s["start"]), F.element_at(names, s["kind"] + 1)))
        return F.concat(F.array_join(parts, ""), cut(F.element_at(m, -1)["end"], F.length(text)))

    def whole(m: Column) -> Column:
        by_text = rebuilt(m, lambda a, b: F.substring(text, a + 1, b - a))
        by_characters = _let(F.split(text, ""), lambda c: rebuilt(m, lambda a, b: F.array_join(F.slice(c, a + 1, b - a), "")))
        return F.when(F.size(m) < 64, by_text).otherwise(by_characters)

    ends = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return F.when(F.size(spans) == 0, text).otherwise(_let(_let(ends, lambda e: merged(spans, e)), whole))


def redact(docs: DataFrame) -> DataFrame:
    """docs with their personal data masked; all columns kept."""
    found = find(docs, text_too=True)
    hidden = F.when(F.col("row.text").isNotNull(), masked(F.col("row.text"), F.col("spans")))
    return found.select(*[hidden.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
