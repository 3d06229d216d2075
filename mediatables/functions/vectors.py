"""Vector expressions: distances, L2 normalisation, size checks.

Distances are computed in double. The default metric is squared L2; both
embedders L2-normalise, so L2, squared L2 and cosine order rows identically and
only numeric distance bounds depend on the choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "cosine", "dot")


def _q_literal(q: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in q])


def squared_l2(v: Column, q: Sequence[float] | Column) -> Column:
    qc = q if isinstance(q, Column) else _q_literal(q)
    diffs = F.zip_with(v, qc, lambda a, b: F.pow(a.cast("double") - b.cast("double"), 2))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


def dot(v: Column, q: Sequence[float] | Column) -> Column:
    qc = q if isinstance(q, Column) else _q_literal(q)
    prods = F.zip_with(v, qc, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def distance(v: Column, q: Sequence[float] | Column, metric: str = "l2") -> Column:
    """Distance for ``metric``: squared L2, cosine distance, or negative dot."""
    if metric == "l2":
        return squared_l2(v, q)
    if metric == "dot":
        return -dot(v, q)
    if metric == "cosine":
        qc = q if isinstance(q, Column) else _q_literal(q)
        return F.lit(1.0) - dot(v, qc) / (l2_norm(v) * l2_norm(qc))
    raise ValueError(f"unsupported metric {metric!r}; use one of {METRICS}")


def l2_normalize(v: Column) -> Column:
    """Unit-length copy in double; a zero vector is returned unchanged.

    The squared norm is bound once by ``aggregate``'s finish function; writing
    ``transform(v, x -> x / norm(v))`` would recompute the norm per element.
    """
    def finish(sq: Column) -> Column:
        return F.when(sq > 0, F.transform(v, lambda x: x.cast("double") / F.sqrt(sq))).otherwise(
            F.transform(v, lambda x: x.cast("double")))

    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"), finish)


def checked_size(v: Column, dim: int, name: str = "embedding") -> Column:
    """Raise at runtime if a non-null vector does not have ``dim`` elements."""
    return F.when(v.isNull() | (F.size(v) == dim), v).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} dimension mismatch: expected {dim}, got "),
                               F.size(v).cast("string"))))


def l2_normalize_checked(v: Column, dim: int) -> Column:
    """dimension check, then L2 normalise, stored as float."""
    return F.transform(l2_normalize(checked_size(v, dim)), lambda x: x.cast("float"))
