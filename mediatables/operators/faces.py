"""Largest-face selection over a (image, face) table.

Detector output is one row per face. The image's face columns all come from
the face with the largest box area; ties keep detector order (the sort is
stable), so the earlier face wins. Images without faces get score 0.0, ratio
0.0 and a NULL face blur. This is a single hash aggregation with map-side
partial aggregation (``max_by`` + ``count``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def largest_face(faces: DataFrame, keys: Sequence[str], face_order: str | Sequence[str], area: str,
                 payload: Sequence[str], images: DataFrame | None = None,
                 no_face: dict | None = None) -> DataFrame:
    """Per image: ``face_count`` and the payload columns of the largest face.

    ``face_order`` is the detector order (columns, unique per image); among
    equal areas the face that comes first wins. ``images`` (optional) lists
    every image so that faceless ones appear with count 0; their payload is
    NULL except for the columns given in ``no_face`` (e.g. score 0.0,
    ratio 0.0 while the face blur stays NULL).
    """
    keys = list(keys)
    order_cols = [face_order] if isinstance(face_order, str) else list(face_order)
    rank = F.struct((-F.col(area)).alias("neg_area"), *[F.col(c) for c in order_cols])
    best = F.min_by(F.struct(*[F.col(c) for c in payload]), rank)
    agg = faces.groupBy(*keys).agg(F.count(F.lit(1)).alias("face_count"), best.alias("_best"))
    out = agg.select(*keys, "face_count", *[F.col("_best")[c].alias(c) for c in payload])
    if images is not None:
        faceless = F.col("face_count").isNull()
        fills = {c: F.when(faceless, F.lit(v)).otherwise(F.col(c)) for c, v in (no_face or {}).items()}
        out = (images.select(*keys).join(out, keys, "left")
               .withColumns(fills)
               .withColumn("face_count", F.coalesce(F.col("face_count"), F.lit(0).cast("long"))))
    return out


def largest_in_array(faces: Column) -> Column:
    """The face of largest box area in one image's array of faces, the first
    of equals; NULL where there is none."""
    ranked = F.transform(faces, lambda face, i: F.struct(
        (-(face["x2"] - face["x1"]) * (face["y2"] - face["y1"])).alias("neg_area"), i.alias("i"), face.alias("face")))
    return F.array_min(ranked)["face"]
