"""Default per-file helpers used by the analysis jobs (U1/U2 implementations).

They run inside Arrow-batched pandas UDFs, one batch at a time:

* ``WavInfo``      - (frames, rate) from a WAV header (stdlib ``wave``);
  anything undecodable gives NULLs, which F14 turns into a 0.0 duration.
* ``WavSignalEmbedder`` - the 128-d RMS/ZCR acoustic embedding of a WAV file,
  same definition as the table operator in ``operators.signal``.
* ``image_measures`` - size, largest face and blur of decoded images (rows of
  Spark's ``image`` source) as columns. The face detector is a caller-supplied
  model; the default finds no faces.

Codecs other than PCM WAV and real detector/ASR networks are outside this
library; callers plug their own models in through the same factories.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.imaging import clamp_box, face_area_ratio, gray, laplacian_variance, pixels, resized_dims, shrink
from .faces import largest_in_array


def wav_samples(blob: bytes) -> tuple[np.ndarray, int]:
    """PCM WAV -> (samples x channels float array in [-1, 1], rate)."""
    with wave.open(io.BytesIO(blob)) as w:
        channels, width, rate = w.getnchannels(), w.getsampwidth(), w.getframerate()
        raw = w.readframes(w.getnframes())
    # float32, as the reference decodes: a 30-minute 16 kHz file stays ~115 MB.
    if width == 1:
        data = (np.frombuffer(raw, dtype=np.uint8).astype(np.float32) - 128.0) / 128.0
    elif width == 2:
        data = np.frombuffer(raw, dtype="<i2").astype(np.float32) / 32768.0
    elif width == 4:
        data = (np.frombuffer(raw, dtype="<i4").astype(np.float64) / 2147483648.0).astype(np.float32)
    else:
        raise ValueError(f"unsupported sample width {width}")
    return data.reshape(-1, channels), rate


class WavInfo:
    """Batch model: bytes -> DataFrame(frames, rate)."""

    def __call__(self, blobs: pd.Series) -> pd.DataFrame:
        frames, rates = [], []
        for b in blobs:
            try:
                with wave.open(io.BytesIO(b)) as w:
                    frames.append(w.getnframes())
                    rates.append(w.getframerate())
            except Exception:  # noqa: BLE001 - undecodable -> unknown
                frames.append(None)
                rates.append(None)
        return pd.DataFrame({"frames": pd.array(frames, dtype="Int64"),
                             "rate": pd.array(rates, dtype="Int64")})


def rms_zcr_embedding(mono: np.ndarray, buckets: int = 64) -> list[float] | None:
    """RMS[B] ++ ZCR[B] over array_split buckets of the peak-normalised signal."""
    n = mono.size
    if n == 0:
        return None
    peak = np.abs(mono).max()
    x = mono / peak if peak > 0 else mono
    q, r = divmod(n, buckets)
    i = np.arange(n)
    big = r * (q + 1)
    bucket = np.where(i < big, i // (q + 1), r + (i - big) // max(q, 1))
    size = np.bincount(bucket, minlength=buckets).astype(np.float64)
    energy = np.bincount(bucket, weights=x * x, minlength=buckets)
    rms = np.sqrt(np.divide(energy, size, out=np.zeros(buckets), where=size > 0))
    sign = np.signbit(x).astype(np.int64)
    same = bucket[1:] == bucket[:-1]
    flips = np.bincount(bucket[1:][same], weights=np.abs(np.diff(sign))[same], minlength=buckets)
    zcr = np.divide(flips, size - 1, out=np.zeros(buckets), where=size > 1)
    vec = np.concatenate([rms, zcr])
    norm = np.linalg.norm(vec)
    return (vec / norm if norm > 0 else vec).astype(np.float32).tolist()


class WavSignalEmbedder:
    """Batch model: WAV bytes -> 128-d float vector (NULL for empty/no bytes).

    Undecodable bytes fail the batch by default, as the reference audio
    embedder does; ``strict=False`` turns them into NULL instead.
    """

    dim = 128

    def __init__(self, strict: bool = True):
        self.strict = strict

    def __call__(self, blobs: pd.Series) -> pd.Series:
        out = []
        for b in blobs:
            if b is None or len(b) == 0:
                out.append(None)
                continue
            try:
                samples, _ = wav_samples(bytes(b))
            except Exception:  # noqa: BLE001
                if self.strict:
                    raise
                out.append(None)
                continue
            out.append(rms_zcr_embedding(samples.mean(axis=1, dtype=np.float64), self.dim // 2))
        return pd.Series(out, dtype=object)


class NoFaceDetector:
    """Default detector: finds nothing (plug a real model in via a factory)."""

    def detect(self, img: np.ndarray) -> list[dict]:
        return []


class ImageQuality:
    """What image analysis needs from a caller: a face detector, and the long
    edge to which images are shrunk before anything is measured."""

    def __init__(self, detector=None, long_edge: int = 1024):
        self.detector = detector or NoFaceDetector()
        self.long_edge = long_edge


FACE = "x1 double, y1 double, x2 double, y2 double, score double"


def image_udf(quality_factory):
    """(height, width, channels, data, new height, new width) -> faces of the
    shrunk image in the detector's order, its Laplacian variance, and its
    pixels if it has faces; NULL stays NULL. All of it in one worker, so a task
    holds one and pixels cross to it once."""
    @F.pandas_udf(f"faces array<struct<{FACE.replace(' double', ': double')}>>, blur double, small binary")
    def _image(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        detector = quality_factory().detector

        def measures(h, w, c, data, to_h, to_w):
            if data is None:
                return None, None, None
            image = shrink(pixels(int(h), int(w), int(c), data), int(to_h), int(to_w))
            faces = [{**dict(zip(("x1", "y1", "x2", "y2"), map(float, face["bbox"]))), "score": float(face["score"])}
                     for face in detector.detect(image)]
            return faces, laplacian_variance(gray(image)), image.tobytes() if faces else None

        for columns in batches:
            rows = [measures(*row) for row in zip(*columns)]
            faces, blur, small = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"faces": pd.Series(faces, dtype=object), "blur": pd.Series(blur, dtype="Float64"),
                                "small": pd.Series(small, dtype=object)})

    return _image.asNondeterministic()


def blur_udf():
    """(height, width, channels, pixels, box) -> Laplacian variance in the box;
    NULL for an empty box."""
    @F.pandas_udf("double")
    def _blur(h: pd.Series, w: pd.Series, c: pd.Series, data: pd.Series, box: pd.DataFrame) -> pd.Series:
        out = []
        for a, b, n, d, x1, y1, x2, y2 in zip(h, w, c, data, *(box[k] for k in ("x1", "y1", "x2", "y2"))):
            if d is None or not x2 > x1:
                out.append(None)
                continue
            image = pixels(int(a), int(b), int(n), d)
            out.append(laplacian_variance(gray(image[int(y1):int(y2), int(x1):int(x2)])))
        return pd.Series(out, dtype="Float64")

    return _blur


def image_measures(images: DataFrame, quality_factory, keep: Sequence[str]) -> DataFrame:
    """Width, height, blur and the largest face of decoded images (``_h``,
    ``_w``, ``_c``, ``_data``); NULL measures where there are no pixels.

    Sizes, the choice of the face, its share of the image and the clamped box
    are column expressions; UDFs see pixels only to shrink, detect and measure.
    """
    there = F.col("_h") > 0
    new_h, new_w, _ = resized_dims(F.col("_h"), F.col("_w"), quality_factory().long_edge)
    at = ["_sh", "_sw", "_sc"]
    small = images.select(
        *keep, F.when(there, F.col("_w").cast("long")).alias("width"), F.when(there, F.col("_h").cast("long")).alias("height"),
        new_h.alias("_sh"), new_w.alias("_sw"), F.least(F.col("_c"), F.lit(3)).alias("_sc"),
        image_udf(quality_factory)("_h", "_w", "_c", F.when(there, F.col("_data")), new_h, new_w).alias("_image"))
    found = small.select("*", F.col("_image.faces").alias("_faces"), F.col("_image.blur").alias("_blur"),
                         F.col("_image.small").alias("_small"))
    face = largest_in_array(F.col("_faces"))
    box = clamp_box(face["x1"], face["y1"], face["x2"], face["y2"], F.col("_sw"), F.col("_sh"))
    empty = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])
    none = F.size("_faces") == 0
    ratio = face_area_ratio(face["x1"], face["y1"], face["x2"], face["y2"], F.col("_sw"), F.col("_sh"))
    return found.select(
        *keep, "width", "height", F.when(F.col("_faces").isNotNull(), F.size("_faces").cast("long")).alias("face_count"),
        F.when(none, F.lit(0.0)).otherwise(face["score"]).alias("face_score"),
        F.when(none, F.lit(0.0)).otherwise(ratio).alias("face_area_ratio"),
        F.col("_blur").alias("blur_score"),
        blur_udf()(*at, "_small", F.coalesce(box, empty)).alias("face_blur_score"))

