"""Exact nearest-neighbour search (V1-V5).

Brute force is one narrow scan: the prefilter and the distance are evaluated
per row, and ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject`` - a
bounded heap per partition and a merge of ``k x partitions`` rows - so no
vectors are shuffled. Rows with a NULL vector never match.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import distance

DIST_COL = "_distance"


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None:
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)


def arrow_distance(q: Sequence[float], metric: str = "l2"):
    """Pandas UDF computing the distance to ``q`` for a batch of vectors.

    One numpy pass per Arrow batch; used where lambda expressions over wide
    vectors would be the hot spot.
    """
    qv = np.asarray(q, dtype=np.float64)

    @F.pandas_udf(T.DoubleType())
    def _dist(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), np.nan)
        mask = vectors.notna().to_numpy()
        if mask.any():
            mat = np.stack([np.asarray(v, dtype=np.float64) for v in vectors[mask]])
            if metric == "l2":
                d = ((mat - qv) ** 2).sum(axis=1)
            elif metric == "dot":
                d = -(mat @ qv)
            else:
                d = 1.0 - (mat @ qv) / (np.linalg.norm(mat, axis=1) * np.linalg.norm(qv))
            out[mask] = d
        return pd.Series(out).where(pd.Series(mask), None)

    return _dist


def with_distance(df: DataFrame, column: str, q: Sequence[float], metric: str = "l2",
                  dist_col: str = DIST_COL, method: str = "expr") -> DataFrame:
    d = distance(F.col(column), list(q), metric) if method == "expr" else \
        arrow_distance(q, metric)(F.col(column))
    return df.withColumn(dist_col, d)


def knn(df: DataFrame, column: str, q: Sequence[float], k: int = 10,
        where: str | Column | None = None,
        distance_range: tuple[float, float] | None = None,
        metric: str = "l2", tie_breakers: Sequence[str] = (),
        dist_col: str = DIST_COL, method: str = "expr") -> DataFrame:
    """V1-V3: top-``k`` rows nearest to ``q``.

    ``where`` is a prefilter (applied before ranking). ``distance_range`` keeps
    ``lo <= distance < hi``. The result keeps ``dist_col``; callers drop it
    when the distance should not be shown.
    """
    if distance_range is not None:
        if len(distance_range) != 2 or None in distance_range:
            raise ValueError("distance_range needs both a minimum and a maximum")
    cand = _where(df.where(F.col(column).isNotNull()), where)
    cand = with_distance(cand, column, q, metric, dist_col, method)
    if distance_range is not None:
        lo, hi = distance_range
        cand = cand.where((F.col(dist_col) >= F.lit(float(lo))) & (F.col(dist_col) < F.lit(float(hi))))
    return cand.orderBy(F.col(dist_col), *[F.col(c) for c in tie_breakers]).limit(k)


def vector_of(df: DataFrame, id_col: str, id_value: Any, column: str) -> list[float]:
    """V4: the stored vector of one row (one bounded row reaches the driver)."""
    rows = df.where(F.col(id_col) == F.lit(id_value)).select(column).limit(1).collect()
    if not rows or rows[0][0] is None:
        raise ValueError(f"query id not found or has null {column}: {id_value}")
    return [float(x) for x in rows[0][0]]


def knn_by_row(df: DataFrame, id_col: str, id_value: Any, column: str, k: int = 10,
               **kwargs) -> DataFrame:
    """V4: neighbours of a stored row; the row itself is a legal hit."""
    return knn(df, column, vector_of(df, id_col, id_value, column), k, **kwargs)


def knn_by_embedder(df: DataFrame, column: str, embed: Callable[[Any], Sequence[float] | None],
                    query: Any, k: int = 10, **kwargs) -> DataFrame:
    """V5: embed a text / image on the driver, then V1."""
    q = embed(query)
    if q is None or len(q) == 0:
        raise ValueError("query cannot be embedded")
    return knn(df, column, list(q), k, **kwargs)


def join_after_topk(topk: DataFrame, desc: DataFrame, key: str, dist_col: str = DIST_COL,
                    tie_breakers: Sequence[str] = ()) -> DataFrame:
    """J1 on a top-k result: pre-reduce the description side, then re-sort.

    ``topk`` holds at most k rows - a proven bound - so its keys are broadcast
    to semi-join the (possibly large) description table before the left join.
    """
    ids = topk.select(key).distinct()
    small_desc = desc.join(F.broadcast(ids), key, "left_semi")
    # Duplicate description keys make the reduced side unbounded in theory, so
    # no hint here; AQE switches to a broadcast join when it is small at run time.
    return (topk.join(small_desc, key, "left")
            .orderBy(F.col(dist_col), *[F.col(c) for c in tie_breakers]))
