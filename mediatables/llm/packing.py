"""Packing documents into training sequences.

Documents are dealt into groups by a seeded hash. Within a group each
document's ids fill whole sequences first; what is left over is placed by
first-fit decreasing, where a tournament tree over the bins' free room finds
the first bin that fits in logarithmic time. The group's emptiest bins are
then cut up to fill the gaps of the others, and the one bin that stays short
is cut at powers of two, so no sequence needs padding.

A group holds a bounded number of left-overs; whole sequences leave the task
at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_list, text_of
from .tokens import encoder

SEQUENCE = 1024
END_ID = 0
GROUP_DOCS = 8192
SEED = 20
SPREAD = 1024

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])

# A piece: (document, start, length).
Piece = tuple[int, int, int]


class Tournament:
    """Free room of bins in a winner tree; the first bin that fits."""

    def __init__(self, bins: int, room: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def place(self, need: int) -> int:
        """Take room in the first bin that has it; -1 if none has."""
        best, at = self.best, 1
        if best[1] < need:
            return -1
        while at < self.leaves:
            at *= 2
            if best[at] < need:
                at += 1
        found = at - self.leaves
        best[at] -= need
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return found


def first_fit_decreasing(pieces: list[Piece], size: int) -> list[list[Piece]]:
    """Bins of pieces, longest first, ties in document order."""
    tree = Tournament(len(pieces), size)
    bins: list[list[Piece]] = []
    for piece in sorted(pieces, key=lambda p: (-p[2], p[0], p[1])):
        at = tree.place(piece[2])
        if at == len(bins):
            bins.append([])
        bins[at].append(piece)
    return bins


def close_gaps(bins: list[list[Piece]], size: int) -> list[list[Piece]]:
    """Cut up the emptiest bins to fill the others, and the last at powers of two."""
    filled = [(sum(p[2] for p in b), b) for b in bins]
    done = [b for fill, b in filled if fill == size]
    short = sorted(((fill, k, list(b)) for k, (fill, b) in enumerate(filled) if fill < size), reverse=True)
    front, back = 0, len(short) - 1
    while front < back:
        fill, k, pieces = short[front]
        room = size - fill
        donor_fill, donor_k, donor = short[back]
        doc, start, length = donor.pop()
        take = min(room, length)
        pieces.append((doc, start, take))
        if take < length:
            donor.append((doc, start + take, length - take))
        short[front] = fill + take, k, pieces
        short[back] = donor_fill - take, donor_k, donor
        if fill + take == size:
            done.append(pieces)
            front += 1
        if donor_fill == take:
            back -= 1
    if front == back:
        fill, _, pieces = short[front]
        pieces.reverse()
        while fill:
            want = 1 << (fill.bit_length() - 1)
            fill -= want
            part = []
            while want:
                doc, start, length = pieces.pop()
                take = min(want, length)
                part.append((doc, start, take))
                if take < length:
                    pieces.append((doc, start + take, length - take))
                want -= take
            done.append(part)
    return done


def _pack(path: str, size: int, end_id: int, group_docs: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        rest: list[Piece] = []
        held: dict[int, tuple] = {}  # document: its id, tokens, and the ids left over
        number = 0

        def add(doc_id, total, base, ids, parts: list[tuple[int, int, int, int]]) -> None:
            for start, length, seq, offset in parts:
                rows.append((doc_id, start, length, total, seq, offset,
                             ids[start - base:start - base + length].astype("<u4").tobytes()))

        def flush() -> None:
            nonlocal sequence, rest
            for pieces in close_gaps(first_fit_decreasing(rest, size), size):
                offset = 0
                for doc, start, length in pieces:
                    doc_id, total, base, ids = held[doc]
                    add(doc_id, total, base, ids, [(start, length, sequence, offset)])
                    offset += length
                sequence += 1
            rest = []
            held.clear()

        def batch_out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            types = [pa.int64()] * 6 + [pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=SCHEMA.names)

        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), tokens.encode(text_list(batch.column(1)))):
                ids = np.append(found, found.dtype.type(end_id))
                total = len(ids)
                whole = total // size
                add(doc_id, total, 0, ids, [(k * size, size, sequence + k, 0) for k in range(whole)])
                sequence += whole
                if total % size:
                    base = whole * size
                    held[number] = doc_id, total, base, ids[base:].copy()
                    rest.append((number, base, total - base))
                    number += 1
                if len(rest) >= group_docs:
                    flush()
                if len(rows) >= 2000:
                    yield batch_out()
        if rest:
            flush()
        if rows:
            yield batch_out()

    return run


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID,
         group_docs: int = GROUP_DOCS, seed: int = SEED,
         text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece: document, its place in it, sequence, offset, ids
    (little-endian unsigned 32-bit).

    Null text reads as empty and packs as the end id alone. Rows with null or
    repeated ids are documents of their own; extra columns are ignored; an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    # Rows equal in id and text are dealt out by their place in the input.
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))
    dealt = (narrow.withColumn("deal", F.xxhash64("doc_id", F.xxhash64("text"), F.lit(seed), spread))
             .repartition("deal").sortWithinPartitions("doc_id", F.xxhash64("text")).select("doc_id", "text"))
    return dealt.mapInArrow(_pack(tokenizer_path, size, end_id, group_docs), SCHEMA)
