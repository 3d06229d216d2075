"""Token links between two tokenizers, scored over the corpus through an
inverted index of pair bitmaps.

A document is read as the bytes of a space and its text. Tokens of vocabulary
A (byte-level BPE) and B (sentencepiece) are linked where their byte ranges
overlap; offsets where tokens of both end cut them into groups.

Index. Documents are numbered within blocks of at most ``BLOCK_DOCS``. Per
(A id, B id) pair and block there is one compressed bitmap of the documents
that hold the pair linked (a sorted array of 16-bit numbers, or the bits
themselves where those are shorter), and one bitmap for each binary digit of
"links less one": the multiplicity planes. What the batches of a block find is
OR-ed into the block's bitmaps. Counting a bitmap's members over all blocks
gives the number of documents of a pair; adding the planes, each times its
power of two, gives its links. The postings then carry the pairs' scores back
to the numbered documents.

Words repeat and both vocabularies cut before a space that stands between two
other characters, so words are encoded and aligned once per worker, all new
ones of a batch together; texts with other spaces are aligned whole.

Defined results:
- null and empty texts, and texts that either vocabulary does not give back
  byte by byte, have no tokens: all numbers are 0, the groups an empty string
- ids are only carried along: null and repeated ones give one row each
- strings of special tokens inside texts are plain text
- an empty table gives an empty result; other columns are ignored
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import batch_conf, text_list, text_of, written
from .tokens import Words, byte_letters, uncut

BLOCK_DOCS = 4096
BLOCK_BYTES = 64 << 20
# From this many members a bitmap is held as plain bits, which its length tells.
DENSE = BLOCK_DOCS // 16
KNOWN_WORDS = 400_000
# Words that are encoded as one text.
JOINED = 2000


class Side:
    """Ids of texts under one vocabulary, and the bytes of each id."""

    spellings: list[bytes]

    def __init__(self) -> None:
        self.lengths = np.array([len(b) for b in self.spellings], np.int64)
        self.names = [str(k) for k in range(len(self.spellings))]

    def ids(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError


class ByteBpe(Side):
    """A: the tokenizers library on a space and the text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        letters = {letter: byte for byte, letter in byte_letters().items()}
        self.spellings = [bytes(letters[c] for c in self._tokenizer.id_to_token(k) or "" if c in letters)
                          for k in range(self._tokenizer.get_vocab_size())]
        super().__init__()

    def ids(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [x.ids for x in found]


class Pieces(Side):
    """B: sentencepiece, which puts the space before a text by itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self._processor = SentencePieceProcessor(model_file=path)
        self.spellings = []
        for k in range(self._processor.get_piece_size()):
            piece = self._processor.id_to_piece(k)
            self.spellings.append(bytes([int(piece[3:5], 16)]) if self._processor.is_byte(k)
                                  else piece.replace("▁", " ").encode())
        super().__init__()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self._processor.encode(texts, num_threads=1)


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each text has."""
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((i for ids in found for i in ids), np.int64, int(sizes.sum()))
    return flat, sizes


def _encoded(texts: list[str], a: Side, b: Side) -> tuple[list, list, np.ndarray]:
    """Ids of each text under both sides, none where its bytes do not come
    back, and whether they do."""
    ids_a, ids_b = a.ids(texts), b.ids(texts)
    ok = np.ones(len(texts), bool)
    for k, text in enumerate(texts):
        want = (" " + text).encode()
        if any(b"".join(map(side.spellings.__getitem__, ids[k])) != want for side, ids in ((a, ids_a), (b, ids_b))):
            ok[k], ids_a[k], ids_b[k] = False, [], []
    return ids_a, ids_b, ok


def _together(words: list[str], side: Side) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of words as one text, and how many each has; None where the text
    does not come back or a token goes over the end of a word."""
    wanted = [(" " + w).encode() for w in words]
    ids = side.ids([" ".join(words[k:k + JOINED]) for k in range(0, len(words), JOINED)])
    flat, _ = _flat(ids)
    if b"".join(map(side.spellings.__getitem__, flat.tolist())) != b"".join(wanted):
        return None
    ends = np.cumsum(side.lengths[flat])
    upto = np.cumsum(np.fromiter(map(len, wanted), np.int64, len(words)))
    at = np.searchsorted(ends, upto)
    return (flat, np.diff(at + 1, prepend=0)) if (ends[at] == upto).all() else None


class Units:
    """Aligned texts (words, or whole texts) by number.

    Of unit u: ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` [u], its groups
    as a string, and its links as pairs in ``pairs[first[u]:first[u] + n_links[u]]``.
    A unit whose bytes do not come back has ``ok`` false and no tokens.
    """

    def __init__(self) -> None:
        self.numbers = Words()  # of the units that are words
        self.groups: list[str] = []
        self.counts = np.empty((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, ok
        self.first = np.empty(0, np.int64)
        self.pairs = np.empty(0, np.int64)

    def add(self, texts: list[str], a: Side, b: Side, words: bool = False) -> None:
        """Align new texts, all in one pass over their joined bytes."""
        both = [_together(texts, side) for side in (a, b)] if words else [None]
        if None in both:
            ids_a, ids_b, ok = _encoded(texts, a, b)
            both = [_flat(ids_a), _flat(ids_b)]
        else:
            ok = np.ones(len(texts), bool)
        (flat_a, size_a), (flat_b, size_b) = both
        end_a, end_b = np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b])
        # Between two neighbouring ends, of either side, one token of A and
        # one of B overlap; and each overlap is one such stretch.
        ends = np.sort(np.concatenate([end_a, end_b]))
        ends = ends[np.flatnonzero(np.diff(ends, append=-1))]
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        pairs = flat_a[at_a] << 16 | flat_b[at_b] if len(ends) else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(texts)), size_a)
        n_links = np.bincount(owner[at_a], minlength=len(texts)) if len(ends) else np.zeros(len(texts), np.int64)
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        upto_a, upto_b = np.searchsorted(end_a, cuts) + 1, np.searchsorted(end_b, cuts) + 1
        n_groups = np.bincount(owner[upto_a - 1], minlength=len(texts)) if len(cuts) else np.zeros(len(texts), np.int64)
        names_a = list(map(a.names.__getitem__, flat_a.tolist()))
        names_b = list(map(b.names.__getitem__, flat_b.tolist()))
        spelled, x, y = [], 0, 0
        for to_x, to_y in zip(upto_a.tolist(), upto_b.tolist()):
            left = names_a[x] if to_x == x + 1 else ",".join(names_a[x:to_x])
            right = names_b[y] if to_y == y + 1 else ",".join(names_b[y:to_y])
            spelled.append(f"{left}|{right}")
            x, y = to_x, to_y
        g = 0
        for n in n_groups.tolist():
            self.groups.append(spelled[g] if n == 1 else ";".join(spelled[g:g + n]))
            g += n
        self.first = np.concatenate([self.first, len(self.pairs) + np.cumsum(n_links) - n_links])
        self.counts = np.concatenate([self.counts, np.stack([size_a, size_b, n_groups, n_links, ok], 1)])
        self.pairs = np.concatenate([self.pairs, pairs])

    def learn(self, a: Side, b: Side) -> None:
        """Units of the words that were numbered since; one that the
        vocabularies may join to the space before it is not ok."""
        words = self.numbers.new
        joined = [k for k, w in enumerate(words) if uncut(w)]
        self.add([w if not uncut(w) else "a" for w in words] if joined else words, a, b, words=True)
        first = len(self.groups) - len(words)
        for k in joined:
            self.counts[first + k, 4] = 0
        self.numbers.new = []

    def cut(self, n: int) -> None:
        """Forget the units after the first n."""
        if n < len(self.groups):
            self.pairs = self.pairs[:self.first[n]]
            self.groups, self.counts, self.first = self.groups[:n], self.counts[:n], self.first[:n]

    def links(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of units, joined, and the place of each pair's unit."""
        sizes = self.counts[units, 3]
        place = np.repeat(np.arange(len(units)), sizes)
        within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.pairs[self.first[units][place] + within], place


class Aligner:
    """Units of texts; those of words are kept between batches."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteBpe(path_a), Pieces(path_b)
        self.known = Units()

    def units(self, texts: list[str]) -> tuple[Units, list[np.ndarray], int]:
        """The units of each text in order, none for a text without tokens;
        and how many units are words, to which the caller cuts them back.

        A text that is not its words joined by single spaces, or whose words
        do not all come back, is one unit.
        """
        if len(self.known.groups) > KNOWN_WORDS:
            self.known = Units()
        known = self.known
        split = [t.split(" ") if t else [] for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(known.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if known.numbers.new:
            known.learn(self.a, self.b)
        found = np.split(numbers, np.cumsum(sizes)[:-1])
        words_only = len(known.groups)
        bad = np.repeat(np.arange(len(split)), sizes)[known.counts[numbers, 4] == 0]
        whole = np.unique(bad).tolist()
        if whole:
            known.add([texts[k] for k in whole], self.a, self.b)
            for u, k in enumerate(whole, words_only):
                found[k] = np.array([u] if known.counts[u, 4] else [], np.int64)
        return known, found, words_only


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker and pair of vocabularies."""
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


# Kind 0: a document's own numbers. Kind 1: a bitmap of a pair in a block;
# plane -1 holds its documents, plane k digit k of "links less one".
ROWS = ("block long, kind int, ordinal int, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, pair long, plane int, members int, bits binary")


def bitmaps(pairs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Compressed bitmaps of sorted, distinct (pair, document) entries: pairs,
    members, and the joined bytes with their offsets."""
    starts = np.flatnonzero(np.diff(pairs, prepend=-1))
    members = np.diff(starts, append=len(pairs))
    dense = members >= DENSE
    sizes = np.where(dense, BLOCK_DOCS // 8, 2 * members)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(offsets[-1]), np.uint8)
    group = np.repeat(np.arange(len(starts)), members)
    sparse = ~dense[group]
    at = offsets[group] + 2 * (np.arange(len(docs)) - starts[group])
    low, high = docs & 255, docs >> 8
    out[at[sparse]] = low[sparse]
    out[at[sparse] + 1] = high[sparse]
    full = dense[group]
    np.bitwise_or.at(out, offsets[group[full]] + (docs[full] >> 3), (1 << (docs[full] & 7)).astype(np.uint8))
    return pairs[starts], members, out, offsets


class _Block:
    """Numbered documents and what their batches add to the bitmaps."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.ids: list[pa.Array] = []
        self.entries: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[str], known: Units, found: list[np.ndarray]) -> None:
        base = len(self.rows)
        for units in found:
            sums = known.counts[units].sum(0).tolist()
            groups = ";".join([known.groups[u] for u in units.tolist()])
            sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
            self.rows.append((*sums[:4], sha))
        self.ids.append(ids)
        self.size += sum(map(len, texts))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        docs = np.repeat(np.arange(base, base + len(found)), sizes)
        # Copies of a unit in a document first, so that few entries are sorted.
        unit_docs, copies = np.unique(
            docs << 40 | (np.concatenate(found) if found else np.empty(0, np.int64)), return_counts=True)
        units = unit_docs & (1 << 40) - 1
        pairs, place = known.links(units)
        keys = pairs << 16 | (unit_docs >> 40)[place]
        order = np.argsort(keys, kind="stable")
        keys, copies = keys[order], copies[place][order]
        if len(keys):
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            self.entries.append((keys[first], np.add.reduceat(copies, first)))

    def batches(self, block: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        n = len(self.rows)
        if not n:
            return
        columns = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), zip(*self.rows)))
        columns |= {"ordinal": np.arange(n), "doc_id": pa.concat_arrays(self.ids)}
        yield _batch(schema, n, block, 0, columns)
        if not self.entries:
            return
        # OR over the batches: sorting brings the members of a pair together.
        keys = np.concatenate([k for k, _ in self.entries])
        extra = np.concatenate([c for _, c in self.entries]) - 1
        order = np.argsort(keys, kind="stable")
        keys, extra = keys[order], extra[order]
        pairs, docs = keys >> 16, keys & 0xFFFF
        yield from _postings(schema, block, -1, pairs, docs)
        for plane in range(int(extra.max()).bit_length()):
            here = extra >> plane & 1 == 1
            yield from _postings(schema, block, plane, pairs[here], docs[here])


def _batch(schema: pa.Schema, n: int, block: int, kind: int, columns: dict) -> pa.RecordBatch:
    columns = columns | {"block": np.full(n, block), "kind": np.full(n, kind)}
    arrays = []
    for field in schema:
        held = columns.get(field.name)
        arrays.append(pa.nulls(n, field.type) if held is None else
                      held if isinstance(held, pa.Array) else pa.array(held, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _postings(schema: pa.Schema, block: int, plane: int, pairs: np.ndarray, docs: np.ndarray
              ) -> Iterator[pa.RecordBatch]:
    if not len(pairs):
        return
    names, members, out, offsets = bitmaps(pairs, docs)
    for k in range(0, len(names), 20_000):
        upto = min(k + 20_000, len(names))
        part = offsets[k:upto + 1]
        bits = pa.BinaryArray.from_buffers(
            pa.binary(), upto - k, [None, pa.py_buffer((part - part[0]).astype(np.int32).tobytes()),
                                    pa.py_buffer(out[part[0]:part[-1]].tobytes())])
        yield _batch(schema, upto - k, block, 1, {
            "pair": names[k:upto], "members": members[k:upto], "bits": bits,
            "plane": np.full(upto - k, plane)})


def _index_kernel(path_a: str, path_b: str, id_type: pa.DataType):
    schema = pa.schema([
        ("block", pa.int64()), ("kind", pa.int32()), ("ordinal", pa.int32()), ("doc_id", id_type),
        ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()), ("members", pa.int32()),
        ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        held = _Block()
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = text_list(part.column("text"))
                if len(held.rows) + len(texts) > BLOCK_DOCS or held.size > BLOCK_BYTES:
                    yield from held.batches(block, schema)
                    block += 1
                    held = _Block()
                known, found, words_only = work.units(texts)
                held.add(part.column("doc_id"), texts, known, found)
                known.cut(words_only)
        yield from held.batches(block, schema)
    return run


def pair_index(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The written index: one row per document (kind 0), and one per pair,
    block and plane (kind 1)."""
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType
    rows = slim.mapInArrow(_index_kernel(path_a, path_b, to_arrow_type(kind)),
                           ROWS.format(id=kind.simpleString()))
    with batch_conf(spark):
        return written(rows, "pair-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, best): documents that hold a pair linked, its
    links, and whether no pair of the same A id is in more documents."""
    weight = F.when(F.col("plane") < 0, F.lit(1)).otherwise(F.pow(F.lit(2), F.col("plane"))).cast("long")
    counts = (index.where("kind = 1").groupBy("pair")
              .agg(F.sum(F.when(F.col("plane") < 0, F.col("members"))).alias("n_docs"),
                   F.sum(F.col("members") * weight).alias("n_links")))
    a = F.shiftright("pair", 16)
    return counts.select(
        "pair", a.alias("a"), F.col("pair").bitwiseAND(0xFFFF).alias("b"), "n_docs", "n_links",
        (F.col("n_docs") == F.max("n_docs").over(Window.partitionBy(a))).alias("best"))


def members(bits: bytes) -> np.ndarray:
    """Document numbers in a compressed bitmap."""
    if len(bits) == BLOCK_DOCS // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    return np.frombuffer(bits, "<u2").astype(np.int64)


SCORES = ("doc_id {id}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


class _Scores:
    """Sums per document of one block, from the postings of its pairs."""

    def __init__(self) -> None:
        self.sums = np.zeros((2, BLOCK_DOCS), np.int64)  # counts, best links
        self.docs: list[pa.RecordBatch] = []

    def add(self, batch: pa.RecordBatch) -> None:
        kind = batch.column("kind").to_numpy()
        n_docs = int((kind == 0).sum())  # sorted by kind
        if n_docs:
            self.docs.append(batch.slice(0, n_docs))
        batch = batch.slice(n_docs)
        if not batch.num_rows:
            return
        times = np.int64(1) << np.maximum(batch.column("plane").to_numpy(), 0).astype(np.int64)
        weights = np.stack([times * batch.column("n_docs").to_numpy(),
                            times * batch.column("best").to_numpy(zero_copy_only=False)])
        bits = batch.column("bits")
        offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset:bits.offset + len(bits) + 1]
        data = np.frombuffer(bits.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        sizes = np.diff(offsets)
        dense = sizes == BLOCK_DOCS // 8
        which = np.repeat(dense, sizes)
        docs = np.ascontiguousarray(data[~which]).view("<u2")
        for sums, weight in zip(self.sums, weights):
            np.add.at(sums, docs, np.repeat(weight[~dense], sizes[~dense] // 2))
        if dense.any():
            held = np.unpackbits(data[which].reshape(-1, BLOCK_DOCS // 8), axis=1, bitorder="little")
            for k, row in zip(np.flatnonzero(dense), held):
                self.sums[:, row.view(bool)] += weights[:, k:k + 1]

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for part in self.docs:
            at = part.column("ordinal").to_numpy()
            extra = {"count_sum": self.sums[0][at], "n_best": self.sums[1][at]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(extra[f.name], f.type) if f.name in extra else part.column(f.name).cast(f.type)
                 for f in schema], schema=schema)


def _score_kernel(id_type: pa.DataType):
    schema = pa.schema([
        ("doc_id", id_type), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
        ("groups_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = _Scores(), None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            starts = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1)).tolist()
            for start, end in zip(starts, [*starts[1:], len(blocks)]):
                if blocks[start] != of:
                    yield from held.batches(schema)
                    held, of = _Scores(), blocks[start]
                held.add(batch.slice(start, end - start))
        yield from held.batches(schema)
    return run


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best (links whose pair is
    in as many documents as any of its A id), count_sum (their documents,
    summed over links) and groups_sha256."""
    spark = docs.sparkSession
    index = pair_index(docs, path_a, path_b, id_col, text_col)
    scored = (index.where("kind = 1").select("block", "kind", "plane", "bits", "pair")
              .join(pair_counts(index).select("pair", "n_docs", "best"), "pair").drop("pair"))
    own = index.where("kind = 0").select(
        "block", "kind", "ordinal", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    by_block = (own.unionByName(scored, allowMissingColumns=True)
                .repartition("block").sortWithinPartitions("block", "kind"))
    kind = index.schema["doc_id"].dataType
    scores = by_block.mapInArrow(_score_kernel(to_arrow_type(kind)), SCORES.format(id=kind.simpleString()))
    with batch_conf(spark):
        return written(scores, "pair-scores")
