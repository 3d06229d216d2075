"""Exact deduplication by grace hashing.

Every scan task first groups the rows of one bounded chunk in an
open-addressing table that compares complete contents, so a text that makes
up a third of the corpus leaves each chunk as one partial row. The partials
are shuffled by content hash. A task whose partials do not fit its memory
budget partitions them into spill files, and a file again under another hash
seed, until the distinct contents of each fit one table. Spill files live in
the task's own temporary folder and go with the task; a lost task is simply
run again.

Texts are equal when their bytes agree after lower-casing A-Z; null reads as
empty. The row with the largest id stays; a null id is less than any other,
and of rows with the same text and the same id exactly one stays.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bytes_list, chunked, small_batches, text_of, written

CHUNK_BYTES = 16 << 20
CHUNK_ROWS = 20_000
TABLE_BYTES = 48 << 20
FANOUT = 16


class ContentTable:
    """Open addressing with linear probing; a hit needs equal content."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.hashes)

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        slots = [-1] * (mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = entry
        self.slots = slots

    def entry(self, h: int, content: bytes) -> int:
        """The number of this content's entry, added if new."""
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (found := slots[at]) >= 0:
            if self.hashes[found] == h and self.contents[found] == content:
                return found
            at = (at + 1) & mask
        slots[at] = new = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content)
        if 5 * len(self.hashes) > 3 * len(slots):
            self._grow()
        return new


def _hash(content: bytes, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(content, seed)


def _larger(a: int | None, b: int | None) -> bool:
    return a is not None and (b is None or a > b)


def _local(schema: pa.Schema, names: list[str], id_at: int, text_at: int):
    """Task body: chunks of rows to one partial per distinct text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TaskContext.get().partitionId() << 33
        for chunk in chunked(batches, CHUNK_BYTES, CHUNK_ROWS):
            table = ContentTable()
            best: list[int] = []
            at_member: list[int] = []
            members: list[list[int | None]] = []
            ids = chunk.column(id_at).to_pylist()
            for row, text in enumerate(bytes_list(chunk.column(text_at))):
                content = text.lower()
                e = table.entry(_hash(content), content)
                if e == len(best):
                    best.append(row)
                    at_member.append(0)
                    members.append([ids[row]])
                    continue
                if _larger(ids[row], ids[best[e]]):
                    best[e], at_member[e] = row, len(members[e])
                members[e].append(ids[row])
            rows = chunk.take(best).combine_chunks()
            n = len(best)
            columns = [c.combine_chunks() for c in rows.columns]
            yield pa.RecordBatch.from_arrays([
                pa.StructArray.from_arrays(columns, fields=list(schema.field("row").type)),
                pa.array(range(counter, counter + n), pa.int64()),
                pa.array([h - (1 << 64) if h >> 63 else h for h in table.hashes], pa.int64()),
                pa.array([ids[b] for b in best], pa.int64()),
                pa.array(members, pa.list_(pa.int64())),
                pa.array(at_member, pa.int32()),
            ], schema=schema)
            counter += n

    return run


def local_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Partials of each scan task: the largest-id row of every distinct text
    in a chunk as ``row``, its partial id, hash, id, all member ids and the
    keeper's place among them."""
    small_batches(docs.sparkSession)
    out = T.StructType([
        T.StructField("row", docs.schema, True),
        T.StructField("pid", T.LongType()), T.StructField("h", T.LongType()),
        T.StructField("max_id", T.LongType()),
        T.StructField("members", T.ArrayType(T.LongType())), T.StructField("at_member", T.IntegerType()),
    ])
    arrow = to_arrow_schema(out)
    fn = _local(arrow, docs.columns, docs.columns.index(id_col), docs.columns.index(text_col))
    return docs.mapInArrow(fn, out)


def _spill(source: Iterable[pa.RecordBatch], folder: str, level: int, text_at: int) -> list[str]:
    """Partition batches into FANOUT files by a hash seeded with the level."""
    writers: dict[int, tuple[str, pa.RecordBatchStreamWriter]] = {}
    for batch in source:
        buckets: dict[int, list[int]] = {}
        for row, text in enumerate(bytes_list(batch.column(text_at))):
            buckets.setdefault(_hash(text.lower(), level + 1) % FANOUT, []).append(row)
        for bucket, rows in buckets.items():
            if bucket not in writers:
                path = os.path.join(folder, f"{level}-{bucket}-{len(os.listdir(folder))}.arrow")
                writers[bucket] = path, pa.ipc.new_stream(path, batch.schema)
            writers[bucket][1].write_batch(batch.take(pa.array(rows)))
    for _, writer in writers.values():
        writer.close()
    return [path for path, _ in writers.values()]


def _read(path: str) -> Iterator[pa.RecordBatch]:
    with pa.OSFile(path) as file, pa.ipc.open_stream(file) as reader:
        yield from reader


def _grace(schema: pa.Schema, carry: bool, text_at: int, id_at: int, pid_at: int, budget: int):
    """Task body: partials of one shuffle partition to verdicts."""

    def emit(bucket: Iterable[pa.RecordBatch], table: ContentTable, entries: list[int],
             best: list[tuple[int | None, int]], sizes: list[int]) -> Iterator[pa.RecordBatch]:
        digests = [None if carry else hashlib.sha256(c).hexdigest() for c in table.contents]
        at = 0
        for batch in bucket:
            own = entries[at:at + batch.num_rows]
            at += batch.num_rows
            pids = batch.column(pid_at).to_pylist()
            keeper = [best[e][1] == p for e, p in zip(own, pids)]
            if carry:
                kept = batch.filter(pa.array(keeper))
                if kept.num_rows:
                    yield pa.RecordBatch.from_arrays(kept.columns[:len(schema)], schema=schema)
                continue
            yield pa.RecordBatch.from_arrays([
                pa.array(pids, pa.int64()), pa.array([best[e][0] for e in own], pa.int64()),
                pa.array([sizes[e] for e in own], pa.int64()), pa.array(keeper, pa.bool_()),
                pa.array([digests[e] for e in own], pa.string()),
            ], schema=schema)

    def solve(bucket, folder: str, level: int) -> Iterator[pa.RecordBatch]:
        """``bucket()`` streams the partials anew on each call."""
        table = ContentTable()
        entries: list[int] = []
        best: list[tuple[int | None, int]] = []
        sizes: list[int] = []
        for batch in bucket():
            ids, pids = batch.column(id_at).to_pylist(), batch.column(pid_at).to_pylist()
            counts = batch.column(pid_at + 1).to_pylist()
            for row, text in enumerate(bytes_list(batch.column(text_at))):
                content = text.lower()
                e = table.entry(_hash(content), content)
                entries.append(e)
                if e == len(best):
                    best.append((ids[row], pids[row]))
                    sizes.append(counts[row])
                    continue
                sizes[e] += counts[row]
                top, holder = best[e]
                if _larger(ids[row], top) or (ids[row] == top and pids[row] < holder):
                    best[e] = ids[row], pids[row]
            if table.bytes > budget and len(table) > 1:
                break
        else:
            yield from emit(bucket(), table, entries, best, sizes)
            return
        del table, entries, best, sizes
        for path in _spill(bucket(), folder, level, text_at):
            yield from solve(lambda path=path: _read(path), folder, level + 1)
            os.unlink(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        source = iter(batches)
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            for batch in source:
                held.append(batch)
                size += batch.nbytes
                if size > budget:
                    break
            else:
                yield from solve(lambda: held, folder, 0)
                return

            def rest() -> Iterator[pa.RecordBatch]:
                while held:
                    yield held.pop(0)
                yield from source

            for path in _spill(rest(), folder, 0, text_at):
                yield from solve(lambda path=path: _read(path), folder, 1)
                os.unlink(path)

    return run


def _solve(partials: DataFrame, out: T.StructType, carry: bool, text_at: int, budget: int) -> DataFrame:
    width = len(partials.columns)
    fn = _grace(to_arrow_schema(out), carry, text_at, width - 4, width - 3, budget)
    return partials.repartition("h").mapInArrow(fn, out)


def exact_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: its id, the id that stays, the group's size,
    whether this row stays and the SHA-256 of the normalised text.

    Empty input gives no rows. Extra columns are ignored.
    """
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    partials = written(local_groups(narrow), "exact-partials")
    out = T.StructType([
        T.StructField("pid", T.LongType()), T.StructField("keep_id", T.LongType()),
        T.StructField("group_size", T.LongType()), T.StructField("keeper", T.BooleanType()),
        T.StructField("text_sha256", T.StringType()),
    ])
    keyed = partials.select("row.text", "max_id", "pid", F.size("members").cast("long").alias("n"), "h")
    verdicts = _solve(keyed, out, False, 0, table_bytes)
    rows = partials.select("pid", "at_member", F.posexplode("members").alias("at", "doc_id"))
    return rows.join(verdicts, "pid").select(
        "doc_id", "keep_id", "group_size",
        (F.col("keeper") & (F.col("at") == F.col("at_member"))).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                      table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Ids may be of any type; the largest that is a whole number stays, and of
    rows without such an id any one. Columns may have any names.
    """
    # The text stands beside the other columns, as it is what tables hold.
    others = [c for c in docs.columns if c != text_col]
    framed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"),
                         F.expr(f"try_cast(`{id_col}` AS bigint)").alias("doc_id"),
                         F.col(f"`{text_col}`").alias("text"))
    partials = local_groups(framed)
    flat = partials.select("row.rest", "row.text", "max_id", "pid", F.size("members").cast("long").alias("n"), "h")
    out = T.StructType([framed.schema["rest"], framed.schema["text"]])
    kept = _solve(flat, out, True, 1, table_bytes)
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in docs.columns])
