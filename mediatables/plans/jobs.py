"""Batch jobs: analyze, ingest, index, manage, manifest.

Stage boundaries are files: the analysis output is written once, which also
stops model calls from being recomputed by later stages or task retries.
Models are injected as picklable factories (see ``operators.models``).

Content fetch: each task reads the objects of its own rows. ``roots`` keeps
the job to known prefixes, ``fetcher`` replaces the reader.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules, tagging
from ..functions.redact import redact_pii
from ..operators import ivf, maintenance
from ..operators.media import ImageQuality, WavInfo, WavSignalEmbedder, image_measures
from ..operators.models import batch_udf, call_model, guarded_embedding
from ..operators.signal import duration_seconds
from ..schemas import (
    ASR_STRUCT,
    AUDIO_ANALYSIS_SCHEMA,
    AUDIO_OUTPUT_COLUMNS,
    IMAGE_ANALYSIS_SCHEMA,
    IMAGE_OUTPUT_COLUMNS,
    IMAGE_QUALITY_STRUCT,
    AudioConfig,
    ImageConfig,
    IndexConfig,
    with_embedding,
)
from ..session import MEDIA_BATCH_CONF, scratch_path, session_conf
from ..sources import fetch, fileset, readers, sinks


def run_instant(now: str | dt.datetime | None = None) -> str:
    """The run's UTC instant as text (fixed once, reused by every step)."""
    if now is None:
        now = dt.datetime.now(dt.timezone.utc)
    if isinstance(now, dt.datetime):
        if now.tzinfo is not None:
            now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
        now = now.isoformat(sep=" ")
    return now


def ingest_time_literal(now: str | dt.datetime | None = None) -> Column:
    """One UTC instant per run, stamped on every row as a timestamp."""
    return F.lit(run_instant(now)).cast("timestamp")


def this_run(table_df: DataFrame, now: str) -> DataFrame:
    """Rows appended by the run stamped ``now``: the date partition and the
    file statistics on ``ingest_time`` prune everything else."""
    t = F.lit(now).cast("timestamp")
    return table_df.where((F.col("ingest_date") == F.to_date(t)) & (F.col("ingest_time") == t))


def with_content(df: DataFrame, out_col: str, roots: Sequence[str] | None = None,
                 fetcher: Callable[[str], bytes | None] | None = None) -> DataFrame:
    """Add the bytes behind ``s3_url`` (NULL when missing)."""
    return fetch.fetch_content(df, fetcher, content_col=out_col, roots=roots)


# ---------------------------------------------------------------------------
# Audio (C1, C2)
# ---------------------------------------------------------------------------

def build_audio_analysis(spark: SparkSession, manifest: str, asr_factory: Callable[[], Any],
                         llm_factory: Callable[[], Any] | None = None, embed: bool = False,
                         roots: Sequence[str] | None = None, fetcher=None,
                         cfg: AudioConfig = AudioConfig(),
                         info_factory: Callable[[], Any] = WavInfo,
                         embedder_factory: Callable[[], Any] = WavSignalEmbedder,
                         asr_output: str = "row") -> DataFrame:
    """Lazy audio analysis frame (C1 without the sink).

    download -> drop missing -> duration gate -> ASR -> redact -> prompt ->
    LLM JSON (or NULL) -> typed fields with defaults [-> embedding].
    Only the redacted transcript is kept.

    ``asr_output="row"``: the speech model returns (transcript,
    acoustic_emotion) per file. ``"segments"``: it returns the file's
    segments (text, raw-with-tags); transcript and dominant emotion are then
    computed per row by Spark (A5/A4 array forms).
    """
    df = readers.read_manifest(spark, manifest)
    df = with_content(df, "audio_bytes", roots, fetcher)
    df = df.where(F.col("audio_bytes").isNotNull())
    info = batch_udf(info_factory, T.StructType([T.StructField("frames", T.LongType()),
                                                 T.StructField("rate", T.LongType())]))
    df = df.withColumn("_info", info(F.col("audio_bytes")))
    df = df.withColumn("duration_s", duration_seconds(F.col("_info.frames"), F.col("_info.rate")))
    df = df.where(F.col("duration_s").between(cfg.min_duration_s, cfg.max_duration_s))
    if asr_output == "segments":
        asr = batch_udf(asr_factory, tagging.SEGMENTS_TYPE)
        df = df.withColumn("_seg", asr(F.col("audio_bytes"), tagging.file_suffix(F.col("doc_id"))))
        df = df.withColumn("_asr", F.struct(tagging.concat_segments(F.col("_seg")).alias("transcript"),
                                            tagging.segment_emotion(F.col("_seg")).alias("acoustic_emotion")))
    else:
        asr = batch_udf(asr_factory, ASR_STRUCT)
        df = df.withColumn("_asr", asr(F.col("audio_bytes"), tagging.file_suffix(F.col("doc_id"))))
    df = df.withColumn("transcript", redact_pii(F.col("_asr.transcript"))) \
           .withColumn("acoustic_emotion", F.col("_asr.acoustic_emotion"))
    df = df.withColumn("prompt", tagging.build_prompt(F.col("transcript"), F.col("acoustic_emotion")))
    cols = list(AUDIO_OUTPUT_COLUMNS)
    if embed:
        emb = batch_udf(embedder_factory, T.ArrayType(T.FloatType()))
        df = df.withColumn("audio_embedding", emb(F.col("audio_bytes")))
        cols.append("audio_embedding")
    # Only slim rows cross into the chat-model worker: the bytes are dropped
    # before it (mapInPandas ships every column of its input).
    keep = ["doc_id", "s3_url", "duration_s", "transcript", "acoustic_emotion", "prompt",
            *(["audio_embedding"] if embed else [])]
    df = df.select(*keep)
    if llm_factory is not None:
        df = call_model(df, "prompt", llm_factory, out_col="analysis_json")
    else:
        df = df.withColumn("analysis_json", F.lit(None).cast("string"))
    parsed = tagging.parse_analysis_json(F.col("analysis_json"))
    df = df.withColumn("_a", parsed).select("*", *tagging.analysis_fields_with_defaults(F.col("_a")))
    return df.select(*cols)


def analyze_audio(spark: SparkSession, manifest: str, out_path: str, embed: bool = False,
                  **kwargs) -> None:
    """Analysis -> JSON lines (no embedding) or a Parquet staging table."""
    df = build_audio_analysis(spark, manifest, embed=embed, **kwargs)
    with session_conf(spark, MEDIA_BATCH_CONF):
        if embed:
            sinks.write_staging(df, out_path)
        else:
            sinks.write_json(df, out_path)


def ingest_audio(spark: SparkSession, analysis_path: str, table: str, now=None,
                 roots: Sequence[str] | None = None, fetcher=None) -> int:
    """Fetch the audio again, drop rows without bytes, stamp, append."""
    now = run_instant(now)
    df = readers.read_analysis_output(spark, analysis_path, AUDIO_ANALYSIS_SCHEMA)
    df = with_content(df, "audio_blob", roots, fetcher)
    df = df.where(F.col("audio_blob").isNotNull())
    df = df.withColumn("ingest_time", ingest_time_literal(now))
    sinks.append_asset(df, table)
    sinks.validate_blob_column(readers.read_asset(spark, table), "audio_blob", None)   # schema check
    return readers.read_asset(spark, table).count()                                    # footer counts


# ---------------------------------------------------------------------------
# Images (C4, C5)
# ---------------------------------------------------------------------------

def decoded_images(spark: SparkSession, folder: str) -> DataFrame:
    """Spark's ``image`` source over a folder (BGR; undecodable -> height -1)."""
    imgs = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(folder)
    return imgs.select(F.element_at(F.split("image.origin", "/"), -1).alias("_object"),
                       F.col("image.height").alias("_h"), F.col("image.width").alias("_w"),
                       F.col("image.nChannels").alias("_c"), F.col("image.data").alias("_data"))


def build_image_analysis(spark: SparkSession, manifest: str | DataFrame, roots: Sequence[str],
                         embed: bool = False,
                         quality_factory: Callable[[], Any] = ImageQuality,
                         embedder_factory: Callable[[], Any] | None = None,
                         cfg: ImageConfig = ImageConfig(), fetcher=None) -> DataFrame:
    """Lazy image analysis frame (C4 without the sink): one row per manifest row.

    Each object of the manifest is read once, whatever else its folder holds.
    Its bytes are embedded by the task that read them and laid into the shared
    scratch folder under the hash of its URL, from where Spark's image source
    decodes them; names that the source skips at their own place, such as
    ``_a.png``, make no difference. Embeddings are kept only for ``ok`` rows
    (the embedder itself returns NULL for bytes it cannot decode).
    """
    m = readers.read_manifest(spark, manifest) if isinstance(manifest, str) else manifest
    m = m.select("doc_id", "s3_url")
    if embed and embedder_factory is None:
        raise ValueError("embed=True needs an embedder_factory")
    found = [F.when(F.col("_bytes").isNotNull(), F.lit(True)).alias("_fetched"), "_object"]
    if embed:
        found.append(guarded_embedding(embedder_factory, F.col("_bytes"), F.lit(True), cfg.embed_dim,
                                       method="embed_image_batch").alias("_vec"))
    folder, table = scratch_path(spark, "objects"), scratch_path(spark, "fetched")
    named = (m.select("s3_url").where(F.col("s3_url").isNotNull()).distinct()
             .withColumn("_object", F.concat(F.lit("o-"), F.sha2(F.col("s3_url").cast("binary"), 256))))
    with session_conf(spark, MEDIA_BATCH_CONF):
        laid = fetch.lay_objects(with_content(named, "_bytes", roots, fetcher), "_object", "_bytes", folder)
        laid.select("s3_url", *found).write.parquet(table)
    objects = spark.read.parquet(table)
    measures = image_measures(decoded_images(spark, folder), quality_factory, ["_object"])
    df = m.join(objects.join(measures, "_object", "left"), "s3_url", "left")
    blur = F.when(F.col("_fetched"), F.col("blur_score"))
    df = df.withColumn("status", rules.image_status(F.col("_fetched"), blur))
    kept = [F.when(F.col("status") == "ok", F.col(f)).alias(f) for f in IMAGE_QUALITY_STRUCT.names]
    if embed:
        kept.append(F.when(F.col("status") == "ok", F.col("_vec")).alias("image_embedding"))
    df = rules.add_rule_columns(df.select("doc_id", "s3_url", "status", *kept), cfg)
    return df.select(*IMAGE_OUTPUT_COLUMNS, *(["image_embedding"] if embed else []))


def analyze_images(spark: SparkSession, manifest: str, out_path: str, roots: Sequence[str],
                   embed: bool = False, **kwargs) -> None:
    """C4: P15 check, analysis, then JSON lines or a Parquet staging table."""
    sinks.validate_output_mode(out_path, embed)
    df = build_image_analysis(spark, manifest, roots, embed=embed, **kwargs)
    with session_conf(spark, MEDIA_BATCH_CONF):
        if embed:
            sinks.write_staging(df, out_path)
        else:
            sinks.write_json(df, out_path)


def ingest_images(spark: SparkSession, analysis_path: str, table: str, now=None,
                  roots: Sequence[str] | None = None, fetcher=None) -> int:
    """Typed read (P13), embedding consistency (P14), blob fetch, status
    downgrade (P11), stamp (P12), append (S12), blob audit (P16), count (A3)."""
    now = run_instant(now)
    low = analysis_path.rstrip("/").lower()
    schema = None if low.endswith(".parquet") else IMAGE_ANALYSIS_SCHEMA
    df = readers.read_analysis_output(spark, analysis_path, schema)
    df = sinks.cast_to_schema(df, with_embedding(IMAGE_ANALYSIS_SCHEMA, "image_embedding")
                              if "image_embedding" in df.columns else IMAGE_ANALYSIS_SCHEMA)
    sinks.check_vector_columns(spark, table, df)
    df = with_content(df, "image_blob", roots, fetcher)
    df = df.withColumn("status", rules.downgrade_missing_blob(F.col("status"), F.col("image_blob")))
    df = df.withColumn("ingest_time", ingest_time_literal(now))
    sinks.append_asset(df, table)
    audit = sinks.validate_blob_column(this_run(readers.read_asset(spark, table), now), "image_blob").first()
    if audit["ok_without_blob"]:
        raise ValueError(f"{audit['ok_without_blob']} ok rows without image_blob in {table}")
    return readers.read_asset(spark, table).count()


# ---------------------------------------------------------------------------
# Index, manage, manifest
# ---------------------------------------------------------------------------

def index_path(table: str, column: str) -> str:
    from .query import index_location
    return index_location(table, column)


def build_indexes(spark: SparkSession, table: str, embedding: bool = True, time: bool = True,
                  embedding_column: str = "audio_embedding",
                  num_partitions: int = IndexConfig.num_partitions,
                  num_sub_vectors: int = IndexConfig.num_sub_vectors,
                  sample_rate: int = IndexConfig.sample_rate,
                  index_type: str = IndexConfig.index_type) -> dict:
    """Vector index (V6-V8) and/or a zone map on ingest_time.

    Index data lives under ``<table>/_index`` (ignored by table readers).
    """
    df = readers.read_asset(spark, table)
    out: dict = {}
    if embedding:
        out["vector"] = ivf.build_index(spark, df, embedding_column, index_path(table, embedding_column),
                                        index_type=index_type, num_partitions=num_partitions,
                                        num_sub_vectors=num_sub_vectors, sample_rate=sample_rate)
    if time:
        path = index_path(table, "ingest_time")
        maintenance.zone_map(df).write.mode("overwrite").parquet(path)
        out["zonemap"] = path
    return out


def manage(spark: SparkSession, table: str, before=None, after=None) -> maintenance.DeleteReport:
    """Delete by date (strict bounds, ANDed) and clean up.

    Indexes built before the delete would still list removed rows, so they
    are dropped first; vector queries fall back to exact search until C7 rebuilds.
    """
    maintenance.drop_indexes(spark, table)
    return maintenance.delete_by_date(spark, table, before, after)


def init_manifest(spark: SparkSession, directory: str, out_path: str, media: str = "image") -> int:
    """List media files into a Parquet manifest (doc_id, s3_url)."""
    manifest = fileset.build_manifest(spark, directory, media)
    manifest.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path).count()
