"""Declared schemas, thresholds and vocabularies.

Every stage reads and writes with an explicit ``StructType`` so an all-null
batch can never change a column's type, and the asset tables keep one schema
across appends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# PII patterns (mainland resident ID, then mobile number) and replacements.
ID_CARD_PATTERN = r"\d{17}[\dXx]"
PHONE_PATTERN = r"1[3-9]\d{9}"
ID_REPLACEMENT = "[ID_REDACTED]"
PHONE_REPLACEMENT = "[PHONE_REDACTED]"

# Prompt vocabularies for the call-tagging model.
PRIMARY_REASONS = ["价格敏感", "套餐不匹配", "服务体验差", "竞品影响", "账户或设备变化", "非本人办理", "其他"]
TEXT_EMOTIONS = ["平静", "不满", "焦急", "愤怒", "投诉倾向", "未知"]

# Acoustic emotion tags emitted inline by the speech model as <|TAG|>;
# NEUTRAL and EMO_UNKNOWN are noise when picking the dominant emotion.
EMOTION_TAGS = ["HAPPY", "SAD", "ANGRY", "NEUTRAL", "FEARFUL", "DISGUSTED", "SURPRISED", "EMO_UNKNOWN"]
EMOTION_NOISE = ["NEUTRAL", "EMO_UNKNOWN"]
DEFAULT_EMOTION = "NEUTRAL"

# Defaults applied field by field when the model's JSON is missing/malformed.
ANALYSIS_DEFAULTS = {
    "downgrade_related": False,
    "primary_reason": "其他",
    "secondary_reason": "",
    "summary": "",
    "confidence": 0.0,
    "text_emotion": "未知",
    "bad_tone": False,
    "emotion_score": 0.0,
}

# Image statuses, in pipeline order.
STATUS_OK = "ok"
STATUS_DOWNLOAD_FAILED = "download_failed"
STATUS_DECODE_FAILED = "decode_failed"
STATUS_BLOB_DOWNLOAD_FAILED = "blob_download_failed"
IMAGE_STATUSES = [STATUS_OK, STATUS_DOWNLOAD_FAILED, STATUS_DECODE_FAILED, STATUS_BLOB_DOWNLOAD_FAILED]

# Manifest media suffixes (matched case-insensitively).
AUDIO_SUFFIXES = ["wav", "mp3", "m4a", "flac", "ogg"]
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "bmp", "webp"]

# Default query columns (blob and embedding are never returned by default).
AUDIO_DEFAULT_COLUMNS = [
    "doc_id", "ingest_time", "text_emotion", "bad_tone", "emotion_score",
    "downgrade_related", "primary_reason", "secondary_reason",
]
IMAGE_DEFAULT_COLUMNS = [
    "doc_id", "ingest_time", "status", "width", "height", "face_count", "face_score",
    "blur_score", "face_blur_score", "has_face", "is_blurry", "is_face_blurry",
]

# Column orders of the analysis outputs.
AUDIO_OUTPUT_COLUMNS = [
    "doc_id", "s3_url", "duration_s", "transcript", "acoustic_emotion", "downgrade_related",
    "primary_reason", "secondary_reason", "summary", "confidence", "text_emotion", "bad_tone",
    "emotion_score",
]
IMAGE_OUTPUT_COLUMNS = [
    "doc_id", "s3_url", "status", "width", "height", "face_count", "face_score", "face_area_ratio",
    "blur_score", "face_blur_score", "has_face", "is_blurry", "is_face_blurry",
]


@dataclass(frozen=True)
class AudioConfig:
    min_duration_s: float = 0.0
    max_duration_s: float = 1800.0
    embed_dim: int = 128


@dataclass(frozen=True)
class ImageConfig:
    face_det_thresh: float = 0.3
    face_det_size: int = 640
    long_edge: int = 1024
    face_score_min: float = 0.5
    min_face_ratio: float = 0.01
    blur_threshold: float = 100.0
    face_blur_threshold: float = 80.0
    embed_dim: int = 512


@dataclass(frozen=True)
class IndexConfig:
    num_partitions: int = 16
    num_sub_vectors: int = 16
    sample_rate: int = 256
    index_type: str = "IVF_PQ"


# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

MANIFEST_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("s3_url", T.StringType()),
])

ANALYSIS_STRUCT = T.StructType([
    T.StructField("downgrade_related", T.BooleanType()),
    T.StructField("primary_reason", T.StringType()),
    T.StructField("secondary_reason", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("text_emotion", T.StringType()),
    T.StructField("bad_tone", T.BooleanType()),
    T.StructField("emotion_score", T.DoubleType()),
])

ASR_STRUCT = T.StructType([
    T.StructField("transcript", T.StringType()),
    T.StructField("acoustic_emotion", T.StringType()),
])

IMAGE_QUALITY_STRUCT = T.StructType([
    T.StructField("width", T.LongType()),
    T.StructField("height", T.LongType()),
    T.StructField("face_count", T.LongType()),
    T.StructField("face_score", T.DoubleType()),
    T.StructField("face_area_ratio", T.DoubleType()),
    T.StructField("blur_score", T.DoubleType()),
    T.StructField("face_blur_score", T.DoubleType()),
])

EMBEDDING_TYPE = T.ArrayType(T.FloatType())

AUDIO_ANALYSIS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("s3_url", T.StringType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("transcript", T.StringType()),
    T.StructField("acoustic_emotion", T.StringType()),
    *ANALYSIS_STRUCT.fields,
])

IMAGE_ANALYSIS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("s3_url", T.StringType()),
    T.StructField("status", T.StringType()),
    *IMAGE_QUALITY_STRUCT.fields,
    T.StructField("has_face", T.BooleanType()),
    T.StructField("is_blurry", T.BooleanType()),
    T.StructField("is_face_blurry", T.BooleanType()),
])


def with_embedding(schema: T.StructType, column: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(column, EMBEDDING_TYPE)])
