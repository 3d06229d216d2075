"""Skew-safe scans over the rows of a key in order.

``row_number`` or ``lag`` over ``PARTITION BY key ORDER BY ...`` sends every
row of a key to one task: a key holding a third of the rows becomes a third of
the job on one core. A *segmented scan* does without that funnel, and with one
exchange of the rows:

1. rows are range-partitioned on ``(key, order...)`` and sorted inside the
   partitions; the range bounds split a hot key across many partitions;
2. every key but the first and the last of a partition is whole there, so it is
   finished in the same task;
3. the first and the last key may go on in a neighbour. Their values are written
   as chunks, and one small row per chunk - its count and last value - gives, by
   a window over at most two keys a partition, where each chunk begins in its
   key, how many values the key has, and the value before the chunk. Chunks meet
   these small rows in a join, for which Spark need not move the chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path

CHUNK = 1 << 16

# A finisher gets the values of a key (or a part of it), the place of the first
# one in the key, the number of the key's values and the value before the first
# (None: there is none), and returns equally long columns.
Finisher = Callable[[np.ndarray, int, int, float | None], dict[str, np.ndarray]]


def _runs(keys: pa.Array) -> list[tuple[int, int]]:
    """Stretches of equal keys."""
    codes = pc.dictionary_encode(keys, null_encoding="encode").indices.to_numpy()
    starts = np.flatnonzero(np.diff(codes, prepend=-1)).tolist()
    return list(zip(starts, [*starts[1:], len(codes)]))


def _scan_kernel(finish: Finisher, key_type: pa.DataType, out: list[tuple[str, pa.DataType]]):
    schema = pa.schema([("key", key_type), *out, ("pid", pa.int64()), ("start", pa.int64()), ("count", pa.int64()),
                        ("before", pa.float64()), ("last", pa.float64()), ("values", pa.list_(pa.float64()))])

    def rows(n: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, f.type) if columns.get(f.name) is None else
             columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
             for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        key, held, first = None, [], True
        start, before = 0, None  # of the chunk that is open

        def chunk() -> Iterator[pa.RecordBatch]:
            nonlocal start, before, held
            values = np.concatenate(held or [np.empty(0)])
            for lo in range(0, len(values), CHUNK):
                part = values[lo:lo + CHUNK]
                yield rows(1, {"key": pa.array([key.as_py()], key_type), "pid": [pid], "start": [start],
                               "count": [len(part)], "before": [before], "last": [float(part[-1])],
                               "values": pa.array([part], pa.list_(pa.float64()))})
                start, before = start + len(part), float(part[-1])
            held = []

        def finished() -> pa.RecordBatch:
            values = np.concatenate(held)
            columns = finish(values, 0, len(values), None)
            n = len(next(iter(columns.values())))
            return rows(n, columns | {"key": pa.array([key.as_py()] * n, key_type)})

        for batch in batches:
            keys, values = batch.column("key"), batch.column("x").to_numpy()
            for lo, hi in _runs(keys):
                if key is None or not keys[lo].equals(key):
                    if key is not None:
                        if first:
                            yield from chunk()
                        else:
                            yield finished()
                        first = False
                    key, held, start, before = keys[lo], [], 0, None
                held.append(values[lo:hi])
                if first and sum(map(len, held)) >= CHUNK:
                    yield from chunk()
        if held:
            yield from chunk()
    return run


def _chunk_kernel(finish: Finisher, key_type: pa.DataType, out: list[tuple[str, pa.DataType]]):
    schema = pa.schema([("key", key_type), *out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = {c: batch.column(c) for c in ("at", "n", "before", "values")}
            for i in range(batch.num_rows):
                values = held["values"][i].values.to_numpy()
                columns = finish(values, held["at"][i].as_py(), held["n"][i].as_py(), held["before"][i].as_py())
                n = len(next(iter(columns.values())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("key")[i].as_py()] * n, key_type),
                     *(pa.array(columns[name], t) for name, t in out)], schema=schema)
    return run


def segmented_scan(df: DataFrame, key: str, order_cols: Sequence[str], value: str, finish: Finisher,
                   out: dict[str, str], partitions: int | None = None) -> DataFrame:
    """``key`` and the columns ``out`` that ``finish`` returns for the values of
    each key in order; for a key over several partitions or chunks, once each.

    ``order_cols`` must make rows unique within a key; values must not be null.
    """
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shape = spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in out.items())).schema
    arrow = [(f.name, to_arrow_type(f.dataType)) for f in shape]
    kind = df.schema[key].dataType
    key_type = to_arrow_type(kind)
    ranged = (df.select(F.col(key).alias("key"), *order_cols, F.col(value).cast("double").alias("x"))
              .repartitionByRange(p, "key", *order_cols).sortWithinPartitions("key", *order_cols)
              .select("key", "x"))
    columns = f"key {kind.simpleString()}, " + ", ".join(f"`{c}` {t}" for c, t in out.items())
    path = scratch_path(spark, "segments")
    (ranged.mapInArrow(_scan_kernel(finish, key_type, arrow),
                       columns + ", pid long, start long, count long, before double, last double, values array<double>")
     .write.parquet(path))
    held = spark.read.parquet(path)
    done = held.where("pid IS NULL").select("key", *out)
    chunks = held.where("pid IS NOT NULL")
    order = Window.partitionBy("key").orderBy("pid", "start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.select(
        "key", "pid", "start", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("at"),
        F.sum("count").over(Window.partitionBy("key")).alias("n"), F.lag("last").over(order).alias("before"))
    # One row per chunk, of at least CHUNK values or one of two a partition.
    met = (chunks.select("key", "pid", "start", "values").alias("c")
           .join(places.alias("p"), F.col("c.pid").eqNullSafe(F.col("p.pid"))
                 & F.col("c.start").eqNullSafe(F.col("p.start")) & F.col("c.key").eqNullSafe(F.col("p.key")))
           .select("c.key", "at", "n", "before", "values"))
    return done.unionByName(met.mapInArrow(_chunk_kernel(finish, key_type, arrow), columns))
