"""Sinks and write-time checks.

Asset tables are Parquet directories partitioned by ``ingest_date`` (the UTC
date of ``ingest_time``). They are only ever appended to; deletion is a
separate maintenance job (see ``operators.maintenance``).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import STATUS_OK


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def table_write_mode(spark: SparkSession, path: str) -> str:
    """``append`` when the table exists, ``create`` when it does not.

    Only "does not exist" maps to ``create``; any other failure (permissions,
    unreachable store) propagates instead of silently starting a new table.
    """
    return "append" if path_exists(spark, path) else "create"


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, overwrite, keeping null fields.

    With Spark's default (``ignoreNullFields=true``) an all-null column would
    vanish from the files and change the schema seen by the next reader.
    """
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_staging(df: DataFrame, path: str) -> None:
    """Parquet staging table, overwrite (holds vector columns)."""
    df.write.mode("overwrite").parquet(path)


def validate_output_mode(out_path: str, embed: bool) -> None:
    """Embeddings need a table sink; a JSON sink cannot hold vectors."""
    low = out_path.rstrip("/").lower()
    is_json = low.endswith((".jsonl", ".ndjson", ".json"))
    if embed and is_json:
        raise ValueError(f"--embed writes a Parquet staging table; got a JSON path: {out_path}")
    if not embed and low.endswith(".parquet"):
        raise ValueError(f"a .parquet output requires embed=True (use a .jsonl path): {out_path}")


def output_mode_ok(out_path: Column, embed: Column) -> Column:
    """P15 for a table of planned outputs: whether a path takes the rows."""
    low = F.lower(F.regexp_replace(out_path, "/+$", ""))
    is_json = low.rlike(r"\.(jsonl|ndjson|json)$")
    return ~((embed & is_json) | (~embed & low.endswith(".parquet")))


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give every declared column its canonical type.

    Columns missing from the input come back as typed NULLs; columns the
    schema does not know are kept as they are.
    """
    cols = []
    for field in schema.fields:
        if field.name in df.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    extra = [F.col(c) for c in df.columns if c not in schema.names]
    return df.select(*cols, *extra)


def vector_columns(schema: T.StructType) -> set[str]:
    """Columns that hold vectors."""
    return {f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType)
            and isinstance(f.dataType.elementType, (T.FloatType, T.DoubleType))}


def check_vector_columns(spark: SparkSession, table: str, batch: DataFrame) -> None:
    """A batch for an existing table has the table's vector columns, no
    more and no fewer; all that differ are named."""
    if table_write_mode(spark, table) != "append":
        return
    stored = vector_columns(table_schema(spark, table) or spark.read.parquet(table).schema)
    given = vector_columns(batch.schema)
    if stored != given:
        raise ValueError(f"{table}: vector columns differ; only in the table: {sorted(stored - given)}, "
                         f"only in the batch: {sorted(given - stored)}")


def append_asset(df: DataFrame, table: str) -> None:
    """Append partitioned by ``ingest_date``; never overwrites.

    No shuffle: every task writes its own files. One ingest run stamps a
    single ``ingest_time``, so each file's min/max statistics are exact and
    act as a zone map for time-range filters; repartitioning by date would
    instead funnel a whole run into one task.
    """
    out = df.withColumn("ingest_date", F.to_date("ingest_time"))
    record_schema(out.sparkSession, table, out.schema)
    out.write.mode("append").partitionBy("ingest_date").parquet(table)


SCHEMA_DIR = "_schema"


def table_schema(spark: SparkSession, table: str) -> T.StructType | None:
    """The declared schema of an asset table (None for tables without one)."""
    if not path_exists(spark, f"{table.rstrip('/')}/{SCHEMA_DIR}"):
        return None
    text = spark.read.text(f"{table.rstrip('/')}/{SCHEMA_DIR}").first()[0]
    return T.StructType.fromJson(json.loads(text))


def record_schema(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Keep ``<table>/_schema`` = union of every appended batch's columns.

    Readers pass it explicitly, so an emptied table still reads (as empty)
    and files written before a column existed read it as NULL.
    """
    old = table_schema(spark, table)
    merged = list(old.fields) if old else []
    names = {f.name for f in merged}
    merged += [f for f in schema.fields if f.name not in names]
    new = T.StructType(merged)
    if old is not None and old == new:
        return
    spark.createDataFrame([(new.json(),)], "s string").coalesce(1) \
        .write.mode("overwrite").text(f"{table.rstrip('/')}/{SCHEMA_DIR}")


def validate_blob_column(df: DataFrame, blob_column: str, status_col: str | None = "status") -> DataFrame:
    """The blob column must be binary, and no ok row may lack its bytes.

    Returns a one-row audit frame (rows, ok_without_blob); raises on a schema
    problem. The count is a distributed aggregate, not a driver loop.
    """
    if blob_column not in df.columns:
        raise ValueError(f"{blob_column} column missing")
    if not isinstance(df.schema[blob_column].dataType, T.BinaryType):
        raise ValueError(f"{blob_column} must be binary, got {df.schema[blob_column].dataType.simpleString()}")
    if status_col and status_col in df.columns:
        bad = F.count_if((F.col(status_col) == STATUS_OK) & F.col(blob_column).isNull())
    else:
        bad = F.lit(0).cast("long")
    return df.agg(F.count(F.lit(1)).alias("rows"), bad.alias("ok_without_blob"))
