"""Spelling variants by finite-state composition.

The words of the documents form a vocabulary with counts. Two words are near
if they differ by exactly one inserted, deleted or replaced code point; the
pairs are those that the composition  V o E1 o V  accepts, where V is the
minimal acyclic acceptor of the vocabulary and E1 a transducer of exactly one
edit.

The composed machine is enumerated per partition of its initial states. Let
the longer word of a pair have L code points: the edit leaves either the
first or the last L // 2 of them alone. So every word enters, for L its own
length and one more, the partition of its first and that of its last L // 2
code points, and only the open middle is read by the machine. A partition of
more than ``limit`` words is halved again by the same rule, as often as
needed; it ends at a middle of one code point, where a partition holds no more
words than the alphabet has letters, and one. A pair that two partitions
accept belongs to the one with the longer shared start: E1 makes its edit at
the first difference of the words, and a partition by a shared end takes only
edits before ``bound``.

Defined results:
- null texts have no words; a null id counts as the empty string in the hash
  that picks occurrences to shorten; repeated rows count as often as they occur
- a run whose deletion leaves fewer than ``min_length`` code points counts for
  nothing
- an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_conf, text_of, written

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TYPO_EVERY = 97
MIN_LENGTH = 5
MIN_COUNT = 3
# Words that one machine reads; larger partitions are split.
PARTITION_WORDS = 20_000


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): lower-cased runs of letters with their occurrences.

    Where ``TYPO_EVERY`` divides the crc32 of ``<id>:<run>``, the run loses
    the code point at that number modulo its length.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(text_of(text_col), UPPER, UPPER.lower()),
                                       F.lit(f"({RUN})"), 1)).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at),
                       F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % TYPO_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row in the partition of a longer shared start and in that of a
    longer shared end."""
    middle = F.col("longest") - F.length("head") - F.length("tail")
    half = F.floor(middle / 2).cast("int")
    start = F.length("head") + half
    size = F.length("word")
    from_start = F.struct(
        F.substring(F.col("word"), F.lit(1), start).alias("head"), F.col("tail"), F.col("bound"))
    from_end = F.struct(
        F.col("head"),
        F.substring(F.col("word"), size - F.length("tail") - half + 1, F.length("tail") + half).alias("tail"),
        F.least("bound", start).alias("bound"))
    return (rows.withColumn("part", F.explode(F.array(from_start, from_end)))
            .select("word", "n", "longest", "part.*")
            # Heads as long as the bound leave no place for an edit.
            .where(F.length("head") < F.col("bound")))


def _key() -> Column:
    return F.xxhash64("longest", "head", "tail", "bound")


def initial_partitions(vocab: DataFrame, limit: int = PARTITION_WORDS) -> DataFrame:
    """(word, n, longest, head, tail, bound, key): words per partition of the
    initial states, each of at most ``limit`` words or a middle of one code
    point; partitions of one word are left out."""
    size = F.length("word")
    open_rows = _halves(vocab.select(
        "word", "n", F.explode(F.array(size, size + 1)).alias("longest"), F.lit("").alias("head"),
        F.lit("").alias("tail")).withColumn("bound", F.col("longest"))).withColumn("key", _key())
    done = None
    while True:
        open_rows = written(open_rows, "variant-partitions")
        sizes = open_rows.groupBy("key").count()
        middle = F.col("longest") - F.length("head") - F.length("tail")
        large = (open_rows.where(middle > 1)
                 .join(sizes.where(F.col("count") > limit).select("key"), "key", "left_semi"))
        if large.isEmpty():
            return open_rows if done is None else done.unionByName(open_rows)
        large = written(large, "variant-large")
        small = open_rows.join(large.select("key").distinct(), "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        open_rows = _halves(large.drop("key")).withColumn("key", _key())


class Acceptor:
    """The minimal acyclic automaton of a sorted list of distinct words, and
    its composition with the one-edit transducer and itself. ``after`` is what
    follows every word; it decides where words of one run first differ."""

    def __init__(self, words: list[str], after: str = "") -> None:
        self._after = after
        self._ids: dict[tuple, int] = {}
        self.states: list[tuple[bool, dict[str, int]]] = []
        self._shared: dict[tuple[int, int], list[str]] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}
        self.start = self._build(words)

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        """The one state with this behaviour."""
        key = (final, tuple(arcs.items()))
        if key not in self._ids:
            self._ids[key] = len(self.states)
            self.states.append((final, arcs))
        return self._ids[key]

    def _build(self, words: list[str]) -> int:
        """States from the ends of the words backwards, along a stack of the
        open path; each is closed when the next word leaves it."""
        path: list[list] = [[False, {}, ""]]  # final, arcs, symbol that leads here

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs, symbol = path.pop()
                path[-1][1][symbol] = self._state(final, arcs)

        before = ""
        for word in words:
            common = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                common += 1
            close(common)
            for symbol in word[common:]:
                path.append([False, {}, symbol])
            path[-1][0] = True
            before = word
        close(0)
        return self._state(path[0][0], path[0][1])

    def language(self, p: int) -> list[str]:
        """Words accepted from a state."""
        return self.shared(p, p)

    def shared(self, p: int, q: int) -> list[str]:
        """Words accepted from both states: the part of the composition after
        the edit, where both sides read the same symbols."""
        pair = (p, q) if p < q else (q, p)
        known = self._shared.get(pair)
        if known is not None:
            return known
        # Follow the symbols as long as they leave no choice.
        read: list[str] = []
        while True:
            (final_p, arcs_p), (final_q, arcs_q) = self.states[p], self.states[q]
            both = [x for x in arcs_p if x in arcs_q]
            final = final_p and final_q
            if final or len(both) != 1:
                break
            read.append(both[0])
            p, q = arcs_p[both[0]], arcs_q[both[0]]
        known = [""] if final else []
        for x in both:
            known.extend([x + rest for rest in self.shared(arcs_p[x], arcs_q[x])])
        if read:
            before = "".join(read)
            known = [before + rest for rest in known]
        self._shared[pair] = known
        return known

    def edits(self, p: int) -> list[tuple[str, str]]:
        """Pairs of words from this state whose first difference is here: a
        replacement, or a code point that only the first word has."""
        known = self._edits.get(p)
        if known is None:
            known = []
            arcs = list(self.states[p][1].items())
            for i, (x, to) in enumerate(arcs):
                for y, other in arcs[i + 1:]:
                    known.extend([(x + rest, y + rest) for rest in self.shared(to, other)])
                known.extend([(x + rest, rest) for rest in self.shared(to, p)
                              if (rest + self._after)[:1] != x])
            self._edits[p] = known
        return known

    def near_pairs(self, deepest: int) -> Iterator[tuple[str, str]]:
        """Every unordered pair once, with its edit at a depth below ``deepest``."""
        open_states = [(self.start, "")]
        while open_states:
            p, read = open_states.pop()
            if len(read) >= deepest:
                continue
            for a, b in self.edits(p):
                yield read + a, read + b
            open_states.extend([(to, read + symbol) for symbol, to in self.states[p][1].items()])


PAIR = "word string, near string, n long, near_n long"
NEAR = "word string, n long, n_near long, form_n long, form string"


def _partition_pairs(rows: list[tuple]) -> Iterator[tuple[tuple[str, int], tuple[str, int]]]:
    """Near pairs of one partition, each word with its count."""
    longest, head, tail, bound = rows[0][2:6]
    lo, hi = len(head), len(tail)
    whole = {row[0][lo:len(row[0]) - hi]: (row[0], row[1]) for row in rows}
    # A pair's longer word has ``longest`` code points; two of the shorter
    # ones belong to another partition.
    middle = longest - lo - hi
    for a, b in Acceptor(sorted(whole), tail[:1]).near_pairs(bound - lo):
        if len(a) == middle or len(b) == middle:
            yield whole[a], whole[b]


def _partitions(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each key, from a stream sorted by key."""
    held: list[tuple] = []
    key = None
    for batch in batches:
        names = ("word", "n", "longest", "head", "tail", "bound", "key")
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            # Unlike partitions may share a hash.
            this = (row[6], *row[2:6])
            if this != key:
                if len(held) > 1:
                    yield held
                held, key = [], this
            held.append(row)
    if len(held) > 1:
        yield held


def _near_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition and word: near words, and the most frequent of them."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()),
                        ("form_n", pa.int64()), ("form", pa.string())])
    out: list[tuple] = []
    for rows in _partitions(batches):
        count: dict[tuple[str, int], int] = defaultdict(int)
        best: dict[tuple[str, int], tuple[int, str]] = {}
        for a, b in _partition_pairs(rows):
            for one, other in ((a, b), (b, a)):
                count[one] += 1
                rank = (-other[1], other[0])
                if one not in best or rank < best[one]:
                    best[one] = rank
        out.extend((word, n, k, -best[word, n][0], best[word, n][1]) for (word, n), k in count.items())
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def _pair_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("n", pa.int64()), ("near_n", pa.int64())])
    for rows in _partitions(batches):
        found = [(*x, *y) for a, b in _partition_pairs(rows) for x, y in ((a, b), (b, a))]
        for k in range(0, len(found), 10_000):
            word, n, near, near_n = zip(*found[k:k + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.string()), pa.array(near, pa.string()),
                 pa.array(n, pa.int64()), pa.array(near_n, pa.int64())], schema=schema)


def _dealt(vocab: DataFrame, limit: int) -> DataFrame:
    return (initial_partitions(vocab, limit).repartition("key")
            .sortWithinPartitions("key", "longest", "head", "tail", "bound"))


def near_pairs(vocab: DataFrame, limit: int = PARTITION_WORDS) -> DataFrame:
    """(word, near, n, near_n): every ordered pair of near words of a
    vocabulary of distinct words with counts."""
    with batch_conf(vocab.sparkSession):
        return written(_dealt(vocab, limit).mapInArrow(_pair_kernel, PAIR), "variant-pairs")


def forms(vocab: DataFrame, limit: int = PARTITION_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n): the most frequent near word, the
    smallest in code-point order of equals, where it is at least twice as
    frequent as the word."""
    with batch_conf(vocab.sparkSession):
        near = written(_dealt(vocab, limit).mapInArrow(_near_kernel, NEAR), "variant-near")
    alone = vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                         F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    ranked = F.when(F.col("form").isNotNull(), F.struct(-F.col("form_n"), F.col("form")))
    best = (alone.unionByName(near).withColumn("rank", ranked).groupBy("word")
            .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("rank").alias("rank"))
            .withColumn("form_n", -F.col("rank.col1")).withColumn("form", F.col("rank.form")))
    wins = F.col("form_n") >= 2 * F.col("n")
    return best.select("word", "n", "n_near", F.when(wins, F.col("form")).alias("form"),
                       F.when(wins, F.col("form_n")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms, by doubling.

    Counts at least double along a chain, so it has no circle, and the rounds
    are logarithmic in its length.
    """
    held = written(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(held.join(further, "root", "left")
                        .select("word", F.coalesce("next", "root").alias("root"),
                                F.col("next").isNotNull().alias("moved")), "variant-roots")
        held = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return held


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      limit: int = PARTITION_WORDS) -> DataFrame:
    """Per word: n, n_near, form, form_n and root (see the module text)."""
    vocab = written(vocabulary(docs, id_col, text_col), "variant-vocabulary")
    found = written(forms(vocab, limit), "variant-forms")
    ends = roots(found.where(F.col("form").isNotNull()))
    return (found.join(ends, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
