"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import BATCH_CONF, scratch_path, session_conf

WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)


def batch_conf(spark: SparkSession):
    """The same settings while the block runs."""
    return session_conf(spark, BATCH_CONF)


def text_of(column: str = "text"):
    """The text column as a string, null read as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back.

    Fixes rows whose later use must agree between stages, and cuts lineage
    in files that outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunked(batches: Iterable[pa.RecordBatch], max_bytes: int, max_rows: int) -> Iterator[pa.Table]:
    """Group a task's Arrow batches into tables of bounded size."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        rows += batch.num_rows
        if size >= max_bytes or rows >= max_rows:
            yield pa.Table.from_batches(held)
            held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def text_list(column: pa.ChunkedArray | pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def bytes_list(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
