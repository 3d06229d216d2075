"""Image geometry and pixel measures.

Geometry (resize dimensions, face-area ratio, box clamping) is plain column
arithmetic, and decides which face and which part of an image are measured.
Pixels are touched only by the numpy kernels below, which run inside
Arrow-batched pandas UDFs over rows decoded by Spark's ``image`` source.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# Column expressions
# ---------------------------------------------------------------------------

def resized_dims(height: Column, width: Column, long_edge: int = 1024) -> tuple[Column, Column, Column]:
    """shrink-only resize to ``long_edge``; dims round half to even, min 1.

    Returns (new_height, new_width, scale).
    """
    edge = F.greatest(height, width).cast("double")
    scale = F.when(edge <= long_edge, F.lit(1.0)).otherwise(F.lit(float(long_edge)) / edge)

    def dim(d: Column) -> Column:
        scaled = F.greatest(F.lit(1), F.bround(d.cast("double") * scale, 0).cast("long"))
        return F.when(edge <= long_edge, d.cast("long")).otherwise(scaled)

    return dim(height), dim(width), scale


def face_area_ratio(x1: Column, y1: Column, x2: Column, y2: Column,
                    img_w: Column, img_h: Column) -> Column:
    """``max(0, w*h) / (img_w*img_h)`` of a detector box."""
    area = (x2 - x1) * (y2 - y1)
    return F.greatest(F.lit(0.0), area.cast("double")) / (img_w * img_h).cast("double")


def clamp_box(x1: Column, y1: Column, x2: Column, y2: Column,
              img_w: Column, img_h: Column) -> Column:
    """F16: truncate to int, clamp to the image; empty or NULL box -> NULL struct."""
    cx1 = F.greatest(F.lit(0), x1.cast("long"))
    cy1 = F.greatest(F.lit(0), y1.cast("long"))
    cx2 = F.least(img_w.cast("long"), x2.cast("long"))
    cy2 = F.least(img_h.cast("long"), y2.cast("long"))
    box = F.struct(cx1.alias("x1"), cy1.alias("y1"), cx2.alias("x2"), cy2.alias("y2"))
    # greatest and least pass over NULLs.
    known = (x1 + y1 + x2 + y2).isNotNull()
    return F.when(known & (cx2 > cx1) & (cy2 > cy1), box)


def grid_laplacian_variance(v: Column, rows: int, cols: int) -> Column:
    """A8 over a row-major ``rows x cols`` grid stored as one array.

    3x3 Laplacian (4-neighbour, centre -4) with mirrored borders that skip the
    edge pixel (index -1 -> 1, n -> n-2), then population variance. Each image
    is one row, so this is a narrow per-row expression: no shuffle, no window.
    """
    def at(r: Column, c: Column) -> Column:
        return F.element_at(v, r * cols + c + 1).cast("double")

    def refl(i: Column, n: int) -> Column:
        return (F.when(i < 0, -i).when(i >= n, 2 * (n - 1) - i).otherwise(i)) if n > 1 else F.lit(0)

    def lap(p: Column) -> Column:
        r = (p / cols).cast("int")
        c = p - r * cols
        return (at(refl(r - 1, rows), c) + at(refl(r + 1, rows), c)
                + at(r, refl(c - 1, cols)) + at(r, refl(c + 1, cols)) - 4 * at(r, c))

    return population_variance(F.transform(F.sequence(F.lit(0), F.lit(rows * cols - 1)), lap))


def population_variance(values: Column) -> Column:
    """Variance of an array by running moments (count, mean, M2), which lose
    nothing where the mean is far from 0. NULL for an empty array."""
    def step(m, x):
        n = m["n"] + 1
        delta = x - m["mean"]
        mean = m["mean"] + delta / n
        return F.struct(n.alias("n"), mean.alias("mean"), (m["m2"] + delta * (x - mean)).alias("m2"))

    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(values, start, step, lambda m: F.when(m["n"] > 0, m["m2"] / m["n"]))


# ---------------------------------------------------------------------------
# numpy kernels (run inside pandas UDFs, one image at a time)
# ---------------------------------------------------------------------------

def pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """Rows x columns x channels of an image row (BGR, row-major); an alpha
    channel is left out."""
    flat = np.frombuffer(data, dtype=np.uint8)
    return flat.reshape(height, width, channels)[:, :, :3]


def gray(image: np.ndarray) -> np.ndarray:
    """Gray levels: BT.601 weights, rounded; one channel as it is."""
    if image.shape[2] == 1:
        return image[:, :, 0].astype(np.float64)
    return np.rint(image @ np.array([0.114, 0.587, 0.299]))


def laplacian_variance(levels: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian, mirrored borders."""
    out = -4.0 * levels
    for axis in (0, 1):
        n = levels.shape[axis]
        at = np.arange(n)
        before, after = np.abs(at - 1), n - 1 - np.abs(n - 2 - at)
        if n == 1:
            before = after = at
        out += levels.take(before, axis) + levels.take(after, axis)
    return float(out.var())


def _mean_bands(values: np.ndarray, n: int) -> np.ndarray:
    """Means over ``n`` equal bands of the first axis; a value that a border
    cuts counts in each band by its share."""
    size = len(values)
    total = np.concatenate([np.zeros_like(values[:1]), np.cumsum(values, axis=0)])
    cut = np.arange(n + 1) * size / n
    whole = np.minimum(cut.astype(np.int64), size - 1)
    share = (cut - whole).reshape(-1, *[1] * (values.ndim - 1))
    upto = total[whole] + share * values[whole]
    return np.diff(upto, axis=0) * n / size


def shrink(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area-weighted shrink to the given size."""
    if image.shape[:2] == (height, width):
        return image
    rows = _mean_bands(image.astype(np.float64), height)
    both = _mean_bands(rows.swapaxes(0, 1), width).swapaxes(0, 1)
    return np.rint(both).astype(image.dtype)
