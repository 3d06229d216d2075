"""Segment-level aggregation of speech output.

* ``dominant_tag`` (A4): the most frequent tag per key, ignoring noise tags;
  ties go to the tag seen first; keys with no meaningful tag get a default.
  ``mode()`` is not used because its tie order is not by position.
* ``ordered_concat`` (A5): segment texts joined in segment order.

Both are hash aggregations with map-side partial aggregation, so a key that
holds a large share of the rows is pre-reduced on every mapper before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tagging import emotion_tags
from ..schemas import DEFAULT_EMOTION, EMOTION_NOISE


def explode_tags(df: DataFrame, raw_col: str, keep: Sequence[str], tag_col: str = "tag",
                 pos_col: str = "tag_pos") -> DataFrame:
    """one row per ``<|TAG|>`` marker with its position in the text."""
    return df.select(*keep, F.posexplode(emotion_tags(F.col(raw_col))).alias(pos_col, tag_col))


def dominant_tag(tags: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                 tag_col: str = "tag", out_col: str = "dominant",
                 noise: Sequence[str] = tuple(EMOTION_NOISE),
                 default: str = DEFAULT_EMOTION,
                 all_keys: DataFrame | None = None) -> DataFrame:
    """A4 over long-form (keys..., order..., tag) rows.

    ``order_cols`` give the order in which tags were seen (unique per key).
    ``all_keys`` (optional) lists keys that must appear even without tags.
    """
    keys = list(keys)
    first_seen = F.min(F.struct(*[F.col(c) for c in order_cols])).alias("first_seen")
    per_tag = (tags.where(F.col(tag_col).isNotNull())
               .groupBy(*keys, tag_col)
               .agg(F.count(F.lit(1)).alias("n"), first_seen))
    is_noise = F.col(tag_col).isin(list(noise))
    # Smallest rank wins: meaningful before noise, then count desc, then first seen.
    rank = F.struct(is_noise.alias("noise"), (-F.col("n")).alias("neg_n"), F.col("first_seen"))
    per_key = per_tag.groupBy(*keys).agg(
        F.min_by(F.col(tag_col), rank).alias("_best"),
        F.max((~is_noise).cast("int")).alias("_meaningful"))
    result = per_key.select(
        *keys,
        F.when(F.col("_meaningful") == 1, F.col("_best")).otherwise(F.lit(default)).alias(out_col))
    if all_keys is not None:
        result = (all_keys.select(*keys).distinct()
                  .join(result, keys, "left")
                  .select(*keys, F.coalesce(F.col(out_col), F.lit(default)).alias(out_col)))
    return result


def ordered_concat(df: DataFrame, keys: Sequence[str], order_col: str, text_col: str,
                   out_col: str = "text", sep: str = "", chunk: int | None = 1024) -> DataFrame:
    """A5: join ``text_col`` per key in ``order_col`` order (nulls skipped).

    With an integer ``order_col`` and ``chunk``, runs of ``chunk`` consecutive
    positions are concatenated first, so one very long key is spread over many
    tasks and the final step only joins ``n / chunk`` pieces.
    """
    keys = list(keys)

    def joined(order: str, text: str):
        items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
        return F.array_join(F.transform(items, lambda x: x["t"]), sep)

    integral = isinstance(df.schema[order_col].dataType, T.IntegralType)
    # Chunks need integer positions; a chunk of only NULL texts would add a
    # stray separator, so chunking is also limited to sep == "".
    if chunk and sep == "" and integral:
        pieces = (df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk)))
                  .groupBy(*keys, "_chunk")
                  .agg(joined(order_col, text_col).alias("_piece")))
        return pieces.groupBy(*keys).agg(joined("_chunk", "_piece").alias(out_col))
    return df.groupBy(*keys).agg(joined(order_col, text_col).alias(out_col))
