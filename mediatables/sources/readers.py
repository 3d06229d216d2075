"""Readers: manifests, analysis outputs, description tables, globs.

Readers always pass a declared schema where the layout is known, so column
types never depend on the data in one batch, and they project to the columns
the caller needs so Parquet scans prune everything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MANIFEST_SCHEMA

_JSON_SUFFIXES = (".jsonl", ".ndjson")


def _suffix_of(uri: str) -> str:
    return uri.rstrip("/").lower()


def read_asset(spark: SparkSession, table: str) -> DataFrame:
    """An asset table with its declared schema (see ``sinks.record_schema``)."""
    from .sinks import table_schema
    schema = table_schema(spark, table)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table)


def read_manifest(spark: SparkSession, uri: str) -> DataFrame:
    """Parquet / JSON lines / CSV manifest -> (doc_id, s3_url).

    Dispatch is on the case-insensitive suffix; extra columns are dropped;
    anything else (``.json`` included) is rejected.
    """
    low = uri.lower()
    if low.endswith(".parquet"):
        df = spark.read.parquet(uri)
        return df.select(*[df[c].cast("string").alias(c) for c in MANIFEST_SCHEMA.names])
    if low.endswith(_JSON_SUFFIXES):
        return spark.read.json(uri, schema=MANIFEST_SCHEMA).select(*MANIFEST_SCHEMA.names)
    if low.endswith(".csv"):
        return read_csv(spark, uri).select(*MANIFEST_SCHEMA.names)
    raise ValueError(f"Unsupported manifest format: {uri}. Use parquet/jsonl/csv.")


CORRUPT_COL = "_corrupt"


def read_csv(spark: SparkSession, pattern: str, schema: T.StructType | None = None,
             multi_line: bool = False, strict: bool = True) -> DataFrame:
    """CSV files with a header, as splits of any size.

    Without ``schema`` every column is a string; names come from the header and
    no data are read for it. A row of too few or too many fields, or with a
    value that is not of its declared type, fails the job with its text; with
    ``strict=False`` it stays, its text in ``_corrupt``. Files whose quoted
    values hold line breaks need ``multi_line``, which reads each in one task.
    """
    if schema is None:
        names = spark.read.csv(pattern, header=True, escape='"', multiLine=multi_line).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])
    df = (spark.read.schema(kept).option("header", True).option("enforceSchema", False).option("escape", '"')
          .option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT_COL)
          # Else fields that nobody asks for are not counted.
          .option("columnPruning", False).csv(pattern))
    if not strict:
        return df
    bad = F.raise_error(F.concat(F.lit(f"{pattern}: not a row of its header: "), F.col(CORRUPT_COL)))
    return df.select(*[F.when(F.col(CORRUPT_COL).isNotNull(), bad.cast(f.dataType)).otherwise(F.col(f"`{f.name}`"))
                       .alias(f.name) for f in schema.fields])


def _is_parquet_table(spark: SparkSession, path: str) -> bool:
    """Whether a directory holds Parquet part files, in partitions or not."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place) or not fs.getFileStatus(place).isDirectory():
        return False
    files = fs.listFiles(place, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def read_analysis_output(spark: SparkSession, path: str,
                         schema: T.StructType | None = None) -> DataFrame:
    """JSON(-lines) output or a Parquet staging table.

    JSON suffixes are unambiguous; ``.parquet`` is a table; any other directory
    is a table when it holds Parquet files and JSON otherwise. JSON is read with the declared schema so an
    all-null column keeps its type (absent fields come back as typed nulls).
    """
    low = _suffix_of(path)
    if low.endswith(_JSON_SUFFIXES + (".json",)):
        return _read_json(spark, path, schema)
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.parquet(path) if _is_parquet_table(spark, path) else _read_json(spark, path, schema)


def _read_json(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


DESC_SCHEMA = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("description", T.StringType())])


def read_desc_table(spark: SparkSession, uri: str) -> DataFrame:
    """S3: any table with (doc_id, description). JSON and CSV hold both as
    strings; a Parquet table keeps its types."""
    low = _suffix_of(uri)
    if low.endswith(_JSON_SUFFIXES + (".json",)):
        return spark.read.schema(DESC_SCHEMA).json(uri)
    if low.endswith(".csv"):
        # Descriptions may hold line breaks.
        return read_csv(spark, uri, multi_line=True).select(*DESC_SCHEMA.names)
    return spark.read.parquet(uri).select(*DESC_SCHEMA.names)


def read_parquet_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Every Parquet file matching a glob."""
    return spark.read.parquet(pattern)


def read_csv_glob(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """Every CSV file (with header) matching a glob."""
    return read_csv(spark, pattern, schema)


def list_files(spark: SparkSession, root: str, pattern: str | None = None,
               recursive: bool = True) -> DataFrame:
    """File listing as rows (path, length, modificationTime).

    Only metadata columns are selected, so the ``binaryFile`` scan never reads
    file contents.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length", "modificationTime")


def from_rows(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """In-memory rows with a declared schema."""
    return spark.createDataFrame(rows, schema=schema)
