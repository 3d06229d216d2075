"""Token ids in Re-Pair compressed blocks.

Documents are range-partitioned by id into shards. A shard's tokens are cut
into blocks of whole documents, and each block is compressed on its own: in
every round the block's most frequent adjacent pairs become nonterminals,
all replaced at once wherever they do not overlap a more frequent one. A
block stores its rules, the expansion length of each and the start of every
document, so any slice of a document is decoded from the symbols it touches.

Blocks are binary values in Parquet files that Spark commits, so a file is
whole or absent and any task may be run again.

Block layout, little-endian: magic ``RPB1``; five u32: documents, rules,
symbols, vocabulary size, bytes per symbol; then documents + 1 u32 first
symbols, documents u32 token counts, rules x 2 u32 right-hand sides, rules
u32 expansion lengths, and the symbols.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_list, text_of
from .tokens import encoder, gather

MAGIC = b"RPB1"
BLOCK_IDS = 1 << 18
ROUNDS = 3
PAIRS_PER_ROUND = 4096
MIN_COUNT = 8
SLOTS = 1 << 17
END_ID = 0
# Memory of the encoder, see there.
ROOM = 2

BLOCKS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("start_in_shard", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType()),
])


def _slot(keys: np.ndarray) -> np.ndarray:
    kind, bits = keys.dtype.type, 8 * keys.itemsize
    return (keys * kind(0x9E3779B97F4A7C15 >> (64 - bits) | 1)) >> kind(bits - SLOTS.bit_length() + 1)


def replace_pairs(symbols: np.ndarray, ends: np.ndarray, first_new: int,
                  most: int = PAIRS_PER_ROUND, min_count: int = MIN_COUNT):
    """One round: the rules made, the shorter sequence and its document ends.

    ``ends`` marks the last symbol of each document; no pair crosses one.
    """
    none = np.empty((0, 2), np.uint32)
    if len(symbols) < 2:
        return none, symbols, ends
    # Symbols of two bytes make narrow keys, which are sorted in half the time.
    kind, half = (np.uint32, 16) if first_new < 1 << 16 else (np.uint64, 32)
    keys = symbols[:-1].astype(kind) << kind(half) | symbols[1:]
    # Across the end of a document stands a key that no pair has.
    across = np.flatnonzero(ends[:-1])
    keys[across] = np.iinfo(kind).max
    ordered = np.sort(keys)[:len(keys) - len(across)]
    if not len(ordered):
        return none, symbols, ends
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(heads, len(ordered)))
    frequent = np.flatnonzero(counts >= min_count)
    if not len(frequent):
        return none, symbols, ends
    by_count = frequent[np.argsort(-counts[frequent], kind="stable")][:most]
    # Ranks by a direct-mapped table; of pairs that fall into one slot the most
    # frequent has it, and the others wait for the next round.
    picked = ordered[heads[by_count]]
    table = np.zeros(SLOTS, np.int32)
    table[_slot(picked)[::-1]] = np.arange(len(picked), dtype=np.int32)[::-1]
    picked = picked[table[_slot(picked)] == np.arange(len(picked))]
    never = len(picked)
    table[:] = 0
    table[_slot(picked)] = np.arange(never, dtype=np.int32)
    rank = table[_slot(keys)]
    rank[picked[rank] != keys] = never
    chosen = rank < never
    chosen[1:] &= rank[1:] < rank[:-1]
    chosen[:-1] &= rank[:-1] <= rank[1:]
    at = np.flatnonzero(chosen)
    out = symbols.copy()
    out[at] = first_new + rank[at]
    kept = np.ones(len(symbols), bool)
    kept[at + 1] = False
    new_ends = ends.copy()
    new_ends[at] = ends[at + 1]
    rules = np.stack([picked >> kind(half), picked & kind((1 << half) - 1)], 1).astype(np.uint32)
    return rules, out[kept], new_ends[kept]


def compress(docs: list[np.ndarray], vocabulary: int, rounds: int = ROUNDS) -> bytes:
    """A block of documents' ids."""
    lengths = np.fromiter(map(len, docs), np.uint32, len(docs))
    symbols = np.concatenate(docs).astype(np.uint32) if docs else np.empty(0, np.uint32)
    ends = np.zeros(len(symbols), bool)
    ends[np.cumsum(lengths, dtype=np.int64) - 1] = True
    rules = np.empty((0, 2), np.uint32)
    expansion = np.ones(vocabulary, np.uint32)
    for _ in range(rounds):
        made, shorter, ends = replace_pairs(symbols, ends, vocabulary + len(rules))
        rules = np.concatenate([rules, made])
        expansion = np.concatenate([expansion, expansion[made].sum(1, dtype=np.uint32)])
        stop = len(symbols) - len(shorter) < len(symbols) // 100
        symbols = shorter
        if stop:
            break
    first = np.concatenate(([0], np.flatnonzero(ends) + 1)).astype("<u4")
    width = 2 if vocabulary + len(rules) <= 1 << 16 else 4
    return b"".join([
        MAGIC, struct.pack("<5I", len(docs), len(rules), len(symbols), vocabulary, width),
        first.tobytes(), lengths.astype("<u4").tobytes(), rules.astype("<u4").tobytes(),
        expansion[vocabulary:].astype("<u4").tobytes(), symbols.astype(f"<u{width}").tobytes()])


class Block:
    """A compressed block, opened for reading."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a token block")
        n_docs, n_rules, n_symbols, self.vocabulary, width = struct.unpack_from("<5I", data, 4)
        at = 24

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, kind, count, at)
            at += part.nbytes
            return part

        self.first = take(n_docs + 1, "<u4")
        self.lengths = take(n_docs, "<u4")
        self.rules = take(2 * n_rules, "<u4").reshape(-1, 2)
        self.expansion = take(n_rules, "<u4")
        self.symbols = take(n_symbols, f"<u{width}")

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        out = symbols.astype(np.uint32)
        while (compound := out >= self.vocabulary).any():
            sizes = 1 + compound
            lefts = np.cumsum(sizes) - sizes
            pairs = self.rules[out[compound] - self.vocabulary]
            longer = np.repeat(out, sizes)
            longer[lefts[compound]] = pairs[:, 0]
            longer[lefts[compound] + 1] = pairs[:, 1]
            out = longer
        return out

    def documents(self) -> list[np.ndarray]:
        """The ids of every document."""
        # Each rule is spelled out once, and every symbol's ids are gathered.
        kinds = np.arange(self.vocabulary + len(self.rules), dtype=np.uint32)
        pool = np.concatenate([kinds[:self.vocabulary], self._expand(kinds[self.vocabulary:])])
        sizes = np.concatenate([np.ones(self.vocabulary, np.int64), self.expansion])
        ids, _ = gather(pool, (np.cumsum(sizes) - sizes)[self.symbols], sizes[self.symbols])
        return np.split(ids, np.cumsum(self.lengths, dtype=np.int64)[:-1]) if len(self.lengths) else []

    def slice(self, doc: int, start: int, stop: int) -> np.ndarray:
        """ids[start:stop] of one document, decoding only what it touches."""
        own = self.symbols[self.first[doc]:self.first[doc + 1]].astype(np.int64)
        sizes = np.ones(len(own), np.int64)
        compound = own >= self.vocabulary
        sizes[compound] = self.expansion[own[compound] - self.vocabulary]
        reach = np.cumsum(sizes)
        stop = min(stop, int(reach[-1]) if len(reach) else 0)
        if start >= stop:
            return np.empty(0, np.uint32)
        low = int(np.searchsorted(reach, start, side="right"))
        high = int(np.searchsorted(reach, stop, side="left")) + 1
        skip = start - (int(reach[low - 1]) if low else 0)
        return self._expand(own[low:high])[skip:skip + stop - start]


def _encode(path: str, end_id: int, block_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, ROOM)
        vocabulary = tokens.size
        shard = TaskContext.get().partitionId()
        names: list[int | None] = []
        held: list[np.ndarray] = []
        count = start = block = 0

        def close() -> pa.RecordBatch:
            nonlocal count, start, block
            out = pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                pa.array([count], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                pa.array([compress(held, vocabulary)], pa.binary())], names=BLOCKS.names)
            start, block, count = start + count, block + 1, 0
            names.clear()
            held.clear()
            return out

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(text_list(batch.column(1)))):
                names.append(doc_id)
                held.append(np.append(ids, ids.dtype.type(end_id)))
                count += len(ids) + 1
                if count >= block_ids:
                    yield close()
        if held:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                 block_ids: int = BLOCK_IDS, text_col: str = "text", id_col: str = "doc_id") -> None:
    """Write ``docs`` as token files under ``path``, in ascending id order.

    Null text reads as empty and holds the end id alone; a null id comes
    first; rows with the same id follow each other; extra columns are
    ignored; an empty table writes files without blocks.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    # Rows equal in id and text are told apart by their place in the input, so
    # that many of them fill several ranges.
    tie = ["doc_id", F.xxhash64("text"), "place"]
    ordered = (narrow.withColumn("place", F.monotonically_increasing_id())
               .repartitionByRange(*tie).sortWithinPartitions(*tie).drop("place"))
    ordered.mapInArrow(_encode(tokenizer_path, end_id, block_ids), BLOCKS).write.parquet(path)


DOCUMENTS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("doc_id", T.LongType()),
    T.StructField("start_in_shard", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, start, names, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
            found = Block(data).documents()
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(found), shard, np.int32)), pa.array(names, pa.int64()),
                pa.array(start + np.cumsum(lengths) - lengths), pa.array(lengths),
                pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in found], pa.int64()),
            ], names=DOCUMENTS.names)


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document of the files: its global start, token count and checksum."""
    small_batches(blocks.sparkSession)
    rows = blocks.select("shard", "start_in_shard", "doc_ids", "data").mapInArrow(_digest, DOCUMENTS)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row per shard, so the one-task window sees no more rows than there are tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    return rows.join(offsets, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")
