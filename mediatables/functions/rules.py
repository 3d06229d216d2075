"""Three-valued image verdicts and status columns.

Only rows whose status is ``ok`` get a verdict; every other row gets NULL,
because "could not judge" must stay distinct from "judged no". Inside an ok
row a missing signal counts as "no" (``coalesce(pred, false)``). There is no
``otherwise`` on the outer ``when`` and no ``fillna`` afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    STATUS_BLOB_DOWNLOAD_FAILED,
    STATUS_DECODE_FAILED,
    STATUS_DOWNLOAD_FAILED,
    STATUS_OK,
    ImageConfig,
)


def image_status(content: Column, blur_score: Column) -> Column:
    """Analyze-stage status: no bytes, no decode, or ok."""
    return (F.when(content.isNull(), F.lit(STATUS_DOWNLOAD_FAILED))
            .when(blur_score.isNull(), F.lit(STATUS_DECODE_FAILED))
            .otherwise(F.lit(STATUS_OK)))


def downgrade_missing_blob(status: Column, blob: Column) -> Column:
    """Ingest-stage status: an ok row whose blob cannot be fetched again."""
    return (F.when((status == STATUS_OK) & blob.isNull(), F.lit(STATUS_BLOB_DOWNLOAD_FAILED))
            .otherwise(status))


def add_rule_columns(df: DataFrame, cfg: ImageConfig = ImageConfig()) -> DataFrame:
    ok = F.col("status") == STATUS_OK
    face = ((F.col("face_count") > 0)
            & (F.col("face_score") >= cfg.face_score_min)
            & (F.col("face_area_ratio") >= cfg.min_face_ratio))
    has_face = F.when(ok, F.coalesce(face, F.lit(False)))
    is_blurry = F.when(ok, F.coalesce(F.col("blur_score") < cfg.blur_threshold, F.lit(False)))
    is_face_blurry = F.when(
        ok, F.coalesce(has_face & (F.col("face_blur_score") < cfg.face_blur_threshold), F.lit(False)))
    return df.withColumns({"has_face": has_face, "is_blurry": is_blurry,
                           "is_face_blurry": is_face_blurry})
