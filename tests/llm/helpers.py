"""Shared tables of the operator tests."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SF001 = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    # Names that operators use for their own columns.
    T.StructField("kept", T.StringType()), T.StructField("rid", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("tokens", T.LongType()),
])


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def corpus() -> list[tuple]:
    """Nulls, empty and long texts, copies in other case, near copies,
    shared passages, repeated rows and repeated ids."""
    shared = prose(1, 60)
    near = prose(2, 120).split()
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "two words"), (None, prose(3, 40)),
            (None, prose(3, 40)), (None, None), (7, prose(4, 30_000)), (8, "a" * 50_000), (9, "é ü \U0001F600 #*$"),
            (10, prose(5, 30)), (10, prose(5, 30)), (10, prose(6, 30))]
    rows += [(20 + k, prose(7, 50) if k % 2 else prose(7, 50).upper()) for k in range(5)]
    rows += [(30 + k, " ".join(near[:k] + ["x%d" % k] + near[k + 1:])) for k in range(6)]
    rows += [(40 + k, prose(50 + k, 80) + " " + shared + " " + prose(70 + k, 80)) for k in range(4)]
    rows += [(60, "line here\n" * 30), (61, " ".join(["same"] * 40)), (62, prose(8, 12) + "\n" + prose(9, 200))]
    langs, sources = ["en", "de", None], ["src0", "src5", "src11", None]
    return [(i, t, langs[k % 3], sources[k % 4], "k", "r", k, k) for k, (i, t) in enumerate(rows)]


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, DOCS)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
