"""Audio signal features as table operations.

Samples are rows ``(key, order..., value)``. The acoustic embedding is
``RMS[64] ++ ZCR[64]`` over ``ntile``-style buckets of the peak-normalised
mono signal, L2-normalised:

* bucket sizes follow ``numpy.array_split``: the first ``n mod B`` buckets get
  one extra sample; with fewer than ``B`` samples the tail buckets are empty
  and contribute 0.
* RMS = sqrt(mean(x^2)); ZCR = mean |signbit(x_i) - signbit(x_{i-1})| over
  consecutive pairs inside a bucket (0 for buckets with < 2 samples).
  ``-0.0`` has its sign bit set, as in numpy.

Values are computed in double (the reference uses float32), so results agree
to ~1e-6.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize
from .positions import segmented_scan


def duration_seconds(frames: Column, rate: Column) -> Column:
    """frames / rate; NULL input or a zero/NULL rate gives 0.0."""
    return F.coalesce(F.try_divide(frames.cast("double"), F.nullif(rate.cast("double"), F.lit(0.0))),
                      F.lit(0.0))


def signbit(x: Column) -> Column:
    """IEEE sign bit as 0/1, including ``-0.0`` (``atan2(-0.0, -1) < 0``)."""
    return F.when((x < 0) | ((x == 0) & (F.atan2(x, F.lit(-1.0)) < 0)), F.lit(1)).otherwise(F.lit(0))


def bucket_of(i: Column, n: Column, buckets: int) -> Column:
    """Bucket index of 0-based position ``i`` among ``n`` (array_split / ntile)."""
    q = (n / F.lit(buckets)).cast("long")
    r = n - q * buckets
    big = r * (q + 1)                      # samples held by the larger buckets
    return F.when(i < big, (i / (q + 1)).cast("long")).otherwise(
        r + ((i - big) / F.nullif(q, F.lit(0))).cast("long"))


def mix_to_mono(samples: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                value: str = "value") -> DataFrame:
    """A10: average the channels of each sample position."""
    return samples.groupBy(*keys, *order_cols).agg(F.avg(value).alias(value))


def bucket_moments(buckets: int):
    """Per bucket of a stretch of samples: size, sum of squares, sign changes
    and peak; sums of these over stretches are those of the whole signal."""
    def finish(x: np.ndarray, at: int, n: int, before: float | None) -> dict[str, np.ndarray]:
        q, r = divmod(n, buckets)
        i = np.arange(at, at + len(x))
        big = r * (q + 1)
        bucket = np.where(i < big, i // (q + 1), r + (i - big) // max(q, 1))
        sign = np.signbit(x).astype(np.int64)
        change = np.abs(np.diff(sign, prepend=sign[:1]))
        change[1:][bucket[1:] != bucket[:-1]] = 0
        # The first sample changes against the one before it in its bucket.
        first_of = at == 0 or _bucket(at - 1, q, r, buckets) != bucket[0]
        change[0] = 0 if first_of or before is None else abs(int(sign[0]) - int(np.signbit(before)))
        names, where = np.unique(bucket, return_inverse=True)
        return {"bucket": names, "size": np.bincount(where), "squares": np.bincount(where, weights=x * x),
                "flips": np.bincount(where, weights=change).astype(np.int64),
                "peak": np.full(len(names), np.abs(x).max())}

    return finish


def _bucket(i: int, q: int, r: int, buckets: int) -> int:
    big = r * (q + 1)
    return i // (q + 1) if i < big else r + (i - big) // max(q, 1)


def bucket_stats(samples: DataFrame, key: str, order_cols: Sequence[str],
                 value: str = "value", buckets: int = 64) -> DataFrame:
    """A6 + A7 + A9 per key: ``(key, rms array[B], zcr array[B])``.

    A segmented scan (``operators.positions``) reads the samples in order with
    one exchange; no task ever holds a hot key. What it returns are ``keys x B``
    partial sums, and a few more for keys that span partitions.
    """
    base = samples.where(F.col(value).isNotNull())
    parts = segmented_scan(base, key, order_cols, value, bucket_moments(buckets),
                           {"bucket": "long", "size": "long", "squares": "double", "flips": "long", "peak": "double"})
    per_bucket = parts.groupBy("key", "bucket").agg(
        F.sum("size").alias("size"), F.sum("squares").alias("squares"), F.sum("flips").alias("flips"),
        F.max("peak").alias("peak"))
    zcr = F.when(F.col("size") > 1, F.col("flips") / (F.col("size") - 1)).otherwise(F.lit(0.0))
    # A bucket row carries the peak of its stretch; the signal's is the largest.
    per_key = (per_bucket.groupBy("key").agg(
        F.max("peak").alias("peak"),
        F.map_from_entries(F.collect_list(F.struct(
            "bucket", F.struct(F.sqrt(F.col("squares") / F.col("size")).alias("rms"), zcr.alias("zcr"))))).alias("m")))
    slots = F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))
    scale = F.when(F.col("peak") > 0, F.col("peak")).otherwise(F.lit(1.0))
    return per_key.select(
        F.col("key").alias(key),
        F.transform(slots, lambda i: F.coalesce(F.col("m")[i]["rms"] / scale, F.lit(0.0))).alias("rms"),
        F.transform(slots, lambda i: F.coalesce(F.col("m")[i]["zcr"], F.lit(0.0))).alias("zcr"))


def signal_features(samples: DataFrame, key: str, order_cols: Sequence[str],
                    value: str = "value", buckets: int = 64) -> DataFrame:
    """Long form ``(key, bucket, rms, zcr)`` with every bucket (empty -> 0)."""
    stats = bucket_stats(samples, key, order_cols, value, buckets)
    return stats.select(key, F.posexplode(F.arrays_zip("rms", "zcr")).alias("bucket", "v")).select(
        key, F.col("bucket").cast("long").alias("bucket"), F.col("v.rms").alias("rms"),
        F.col("v.zcr").alias("zcr"))


def signal_embedding(stats: DataFrame, key: str, out_col: str = "embedding") -> DataFrame:
    """``RMS ++ ZCR`` per key from :func:`bucket_stats`, L2-normalised."""
    return stats.select(key, l2_normalize(F.concat("rms", "zcr")).alias(out_col))


def embedding_long(emb: DataFrame, key: str, col: str = "embedding") -> DataFrame:
    """(key, dim, value) rows of an array column."""
    return emb.select(key, F.posexplode(col).alias("dim", "value"))
