"""Manifests from listings, virtual fileset paths, object-store config."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AUDIO_SUFFIXES, IMAGE_SUFFIXES
from ..functions.tagging import file_name

# ---------------------------------------------------------------------------
# Virtual path layout of the file catalog.
#   <scheme>://fileset/{catalog}/{schema}/{fileset}[/sub/path]
# ---------------------------------------------------------------------------
VIRTUAL_SCHEME = "gvfs"
VIRTUAL_PATH_PATTERN = r"^([a-z0-9]+)://fileset/([^/]+)/([^/]+)/([^/]+)(/.*)?$"


def build_manifest(spark: SparkSession, directory: str, media: str = "image",
                   suffixes: list[str] | None = None) -> DataFrame:
    """Non-recursive listing of media files -> (doc_id, s3_url), sorted.

    ``doc_id`` is the file name, ``s3_url`` its location. Suffixes match
    case-insensitively. An empty result raises, like the reference's exit 1.
    The listing is Spark's file scan, which skips zero-byte files (they
    cannot hold media).
    """
    if suffixes is None:
        if media == "audio":
            suffixes = AUDIO_SUFFIXES
        elif media == "image":
            suffixes = IMAGE_SUFFIXES
        else:
            raise ValueError(f"unknown media {media!r}; use audio or image")
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", False)
               .load(directory).select("path"))
    pattern = r"(?i)\.(" + "|".join(suffixes) + r")$"
    manifest = (listing
                .select(file_name(F.col("path")).alias("doc_id"), F.col("path").alias("s3_url"))
                .where(F.col("doc_id").rlike(pattern))
                .orderBy("doc_id"))
    if manifest.isEmpty():
        raise ValueError(f"no {media} files found under {directory}")
    return manifest


def split_virtual_path(col: Column) -> Column:
    """Parse a virtual path into (catalog, schema, fileset, sub_path)."""
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(col, VIRTUAL_PATH_PATTERN, i), F.lit(""))
    sub = F.regexp_replace(F.coalesce(part(5), F.lit("")), r"^/+", "")
    return F.struct(part(2).alias("catalog"), part(3).alias("schema"),
                    part(4).alias("fileset"), sub.alias("sub_path"))


def to_virtual_path(catalog: Column, schema: Column, fileset: Column, sub_path: Column,
                    scheme: str = VIRTUAL_SCHEME) -> Column:
    sub = F.regexp_replace(F.coalesce(sub_path, F.lit("")), r"^/+", "")
    base = F.concat_ws("/", F.lit(f"{scheme}://fileset"), catalog, schema, fileset)
    return F.when(sub == "", base).otherwise(F.concat(base, F.lit("/"), sub))


def resolve_fileset_uri(df: DataFrame, registry: DataFrame, path_col: str = "path",
                        out_col: str = "location") -> DataFrame:
    """Virtual path -> physical location via a registry table.

    ``registry`` has (catalog, schema, fileset, location). It is metadata -
    one row per fileset - and is broadcast after a size check (a sort-merge
    join otherwise); unknown filesets give NULL.
    ``s3a://`` locations are reported as ``s3://``.
    """
    parsed = df.withColumn("_vp", split_virtual_path(F.col(path_col)))
    reg = registry.select(
        F.col("catalog").alias("_cat"), F.col("schema").alias("_sch"),
        F.col("fileset").alias("_fs"),
        F.regexp_replace(F.regexp_replace(F.col("location"), r"^s3a://", "s3://"), r"/+$", "")
        .alias("_loc"))
    joined = parsed.join(
        reg,
        (F.col("_vp.catalog") == F.col("_cat")) & (F.col("_vp.schema") == F.col("_sch"))
        & (F.col("_vp.fileset") == F.col("_fs")),
        "left")
    location = F.when(F.col("_loc").isNull(), F.lit(None).cast("string")).when(
        F.col("_vp.sub_path") == "", F.col("_loc")).otherwise(
        F.concat(F.col("_loc"), F.lit("/"), F.col("_vp.sub_path")))
    return joined.withColumn(out_col, location).drop("_vp", "_cat", "_sch", "_fs", "_loc")


def object_store_conf(endpoint: str | None = None, access_key: str | None = None,
                      secret_key: str | None = None, region: str | None = None,
                      use_ssl: bool = True, path_style: bool = True) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store."""
    conf = {
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(use_ssl).lower(),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    if region:
        conf["spark.hadoop.fs.s3a.endpoint.region"] = region
    return conf


def resolve_path(registry: DataFrame, path: str) -> str:
    """One virtual path -> physical location (driver side; one registry row is read).

    Raises for an unknown fileset; non-virtual paths are returned unchanged.
    """
    import re
    m = re.match(VIRTUAL_PATH_PATTERN, path)
    if not m:
        return path
    catalog, schema, fs_name, sub = m.group(2), m.group(3), m.group(4), (m.group(5) or "").lstrip("/")
    row = (registry.where((F.col("catalog") == catalog) & (F.col("schema") == schema)
                          & (F.col("fileset") == fs_name))
           .select("location").limit(1).collect())
    if not row:
        raise ValueError(f"unknown fileset {catalog}.{schema}.{fs_name}")
    base = re.sub(r"/+$", "", re.sub(r"^s3a://", "s3://", row[0]["location"]))
    return f"{base}/{sub}" if sub else base


def _physical(path: str) -> str:
    """``s3://`` locations are read through Hadoop's ``s3a`` connector."""
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path


def read_fileset(spark: SparkSession, registry: DataFrame, path: str, fmt: str = "parquet",
                 **options) -> DataFrame:
    """S5/S6 through a virtual path: resolve, then read (globs allowed)."""
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(_physical(resolve_path(registry, path)))


def write_fileset(df: DataFrame, registry: DataFrame, path: str, fmt: str = "parquet",
                  mode: str = "overwrite") -> str:
    """S14 through a virtual path; returns the physical location written."""
    target = _physical(resolve_path(registry, path))
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(target)
    return target
