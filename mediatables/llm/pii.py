"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Four kinds are found by fixed patterns. They are the seeds: the words to the
left of a seed become lexical patterns of its kind, and each identifier-like
token that no seed covers is a candidate under the patterns of its own left
context. Patterns and instances form a bipartite graph over the corpus. In
each round, until one adds nothing, a pattern's confidence for a kind is the share of its distinct
instances known as that kind, and the instances of a pattern that is
confident enough, on enough distinct seeds, become known themselves. The
spans of candidates so found are added to the base spans.

Only aggregates by pattern and by instance are shuffled; one value counts
once per pattern, however often it is copied.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

KINDS = ("email", "ip", "card", "phone")
MIN_CONFIDENCE = 0.8
MIN_SUPPORT = 5
CONTEXT = 60

# Fixed patterns. Possessive quantifiers match what the plain ones would and
# never backtrack or recurse, whatever the length of the text.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be worth trying.
_HINTS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
_PREFIX = r"""^((?:[A-Za-z_]++[=:])?+["'(\[<]*+)"""
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def _found(text: Column, pattern: str, rank: int) -> Column:
    """Spans of all matches: the gaps between them give their places."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches,
                       lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def add(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + pair["gap"]
        end = begin + F.length(pair["value"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(pairs, start, add, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (
            F.length(F.regexp_replace(p, "^0+", "")) <= 3)
            & (F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of one kind; a failing match is dropped, not retried."""
    rank = KINDS.index(kind)
    valid = F.filter(_found(text, PATTERNS[kind], rank), lambda s: _valid(kind, s["value"]))
    hint = F.contains(text, F.lit("@")) if kind == "email" else F.rlike(text, F.lit(_HINTS[kind]))
    return F.when(hint, valid).otherwise(F.array().cast(_SPAN))


def _contexts(text: Column, start: Column, prefix: Column) -> Column:
    """Left contexts: the last word, and the last two, with the token's own
    prefix such as ``key=``."""
    left = F.lower(F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT))))
    words = F.filter(F.split(left, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(F.size(words) > 1, F.array(
        F.concat(F.element_at(words, -1), F.lit(" "), prefix),
        F.concat(F.element_at(words, -2), F.lit(" "), F.element_at(words, -1), F.lit(" "), prefix),
    )).when(F.size(words) == 1, F.array(F.concat(F.element_at(words, -1), F.lit(" "), prefix))
            ).otherwise(F.array().cast("array<string>"))


def _seed_contexts(text: Column, start: Column) -> Column:
    """Left contexts of a seed, from before the token it stands in and with
    the prefix that a candidate's token is cut by. A token that begins more
    than the context's width before its seed is taken from that width on."""
    near = F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))
    head = F.regexp_extract(near, r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]*+)$", 1)
    return _contexts(text, start - F.length(head), F.lower(F.regexp_extract(head, _PREFIX, 1)))


def _candidates(text: Column, base: Column) -> Column:
    """Tokens with a digit or an at sign that no base span touches, cut to
    their value: without a leading key or quote and trailing punctuation."""
    tokens = _found(text, _TOKEN, -1)

    def cut(s: Column) -> Column:
        prefix = F.regexp_extract(s["value"], _PREFIX, 1)
        rest = F.regexp_replace(F.substring(s["value"], F.length(prefix) + 1, F.length(s["value"])),
                                r"""[.,;:!?"')\]>]++$""", "")
        begin = s["start"] + F.length(prefix)
        return F.struct(begin.alias("start"), (begin + F.length(rest)).alias("end"), rest.alias("value"),
                        _contexts(text, s["start"], F.lower(prefix)).alias("contexts"))

    free = F.filter(tokens, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    like = F.filter(F.transform(free, cut), lambda c: (F.length(c["value"]) >= 6) & (
        (F.length(_digits(c["value"])) >= 5) | F.contains(c["value"], F.lit("@"))))
    empty = "array<struct<start:int,end:int,value:string,contexts:array<string>>>"
    return F.when(F.rlike(text, F.lit("[0-9@]")), like).otherwise(F.array().cast(empty))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Base spans, seeds and candidates per document, in a written table."""
    narrow = docs.select(F.monotonically_increasing_id().alias("row"),
                         F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    based = narrow.select("*", *[base_spans(F.col("t"), k).alias(k) for k in KINDS])
    based = based.withColumn("base", F.sort_array(F.concat(*[F.col(k) for k in KINDS])))
    seeds = F.transform("base", lambda s: F.struct(
        s["rank"].alias("rank"), s["value"].alias("value"),
        _seed_contexts(F.col("t"), s["start"]).alias("contexts")))
    return written(based.select(
        "row", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.transform("base", lambda s: F.struct(s["start"], s["rank"], s["end"])).alias("base"),
        F.when(F.size("base") > 0, seeds).alias("seeds"),
        _candidates(F.col("t"), F.col("base")).alias("candidates")), "pii-scan")


def induce(scanned: DataFrame, rounds: int | None = None, min_confidence: float = MIN_CONFIDENCE,
           min_support: int = MIN_SUPPORT) -> DataFrame:
    """Confident patterns: (pattern, rank of their kind), after the round
    that changes no known value, or after so many rounds."""
    seeds = (scanned.where("size(seeds) > 0").select(F.explode("seeds").alias("s"))
             .select(F.explode("s.contexts").alias("pattern"), "s.value", "s.rank"))
    found = (scanned.where("size(candidates) > 0").select(F.explode("candidates").alias("c"))
             .select(F.explode("c.contexts").alias("pattern"), "c.value", F.lit(None).cast("int").alias("rank")))
    # One row per pattern and value; a value seeded anywhere is known by its kind.
    edges = written(seeds.union(found).groupBy("pattern", "value").agg(F.max("rank").alias("rank")), "pii-edges")
    known = edges.where("rank IS NOT NULL").groupBy("value").agg(F.min("rank").alias("kind"))
    confident, before = None, None
    for _ in count() if rounds is None else range(rounds):
        scored = edges.join(known, "value", "left")
        totals = scored.groupBy("pattern").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum((F.col("kind") == k).cast("int")).alias(f"k{k}")
                                            for k in range(len(KINDS))])
        best = F.greatest(*[F.struct(F.coalesce(f"k{k}", F.lit(0)).alias("hits"), F.lit(k).alias("rank"))
                            for k in range(len(KINDS))])
        confident = written(
            totals.withColumn("b", best)
            .where((F.col("b.hits") >= min_support) & (F.col("b.hits") >= min_confidence * F.col("n")))
            .select("pattern", F.col("b.rank").alias("rank")), "pii-patterns")
        reached = (edges.where("rank IS NULL").join(confident.withColumnRenamed("rank", "kind"), "pattern")
                   .groupBy("value").agg(F.min("kind").alias("kind")))
        known = written(known.union(reached).groupBy("value").agg(F.min("kind").alias("kind")), "pii-known")
        # Values only join, and a kind only falls, so equal sums mean no change.
        after = tuple(known.agg(F.count(F.lit(1)), F.sum("kind")).first())
        if after == before:
            break
        before = after
    return confident


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, rounds: int | None = None, min_confidence: float = MIN_CONFIDENCE,
             min_support: int = MIN_SUPPORT, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: base counts, all spans and their number.

    Offsets are code points, ends exclusive; spans are ordered by start,
    then kind. Null text reads as empty; null and repeated ids pass through
    row by row; extra columns are ignored; an empty table gives no rows.
    """
    scanned = scan(docs, text_col, id_col)
    patterns = induce(scanned, rounds, min_confidence, min_support)
    added = (scanned.where("size(candidates) > 0").select("row", F.explode("candidates").alias("c"))
             .select("row", "c.start", "c.end", F.explode("c.contexts").alias("pattern"))
             .join(patterns, "pattern").groupBy("row", "start", "end").agg(F.min("rank").alias("rank"))
             .groupBy("row").agg(F.collect_list(F.struct("start", "rank", "end")).alias("added")))
    both = scanned.join(added, "row", "left")
    spans = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,end:int>>"))))
    return both.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                       _joined(spans).alias("spans"), F.coalesce(F.size("added"), F.lit(0)).alias("n_added"))
