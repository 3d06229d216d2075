"""Property tests: Spark expressions vs independent Python formulations."""

from collections import Counter
from pathlib import PurePosixPath

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mediatables.functions.tagging import dominant_in_array, file_suffix
from mediatables.operators.signal import bucket_of

paths = st.lists(st.text(alphabet="ab./", max_size=12), min_size=20, max_size=120)


@settings(max_examples=5, deadline=None)
@given(paths)
def test_file_suffix_matches_posix_path(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p string")
    got = [r.s for r in df.orderBy("i").select(file_suffix(F.col("p")).alias("s")).collect()]
    assert got == [PurePosixPath(v).suffix or ".wav" for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=400), min_size=5, max_size=20))
def test_bucket_formula_matches_array_split(spark, sizes):
    rows = [(n, i) for n in sizes for i in range(n)]
    df = spark.createDataFrame(rows, "n long, i long")
    got = df.select("n", bucket_of(F.col("i"), F.col("n"), 64).alias("b")).groupBy("n", "b").count().collect()
    by_n = {}
    for r in got:
        by_n.setdefault(r.n, {})[r.b] = r["count"]
    for n in set(sizes):
        expect = [len(c) for c in np.array_split(np.arange(n), 64)]
        repeats = sizes.count(n)          # equal sizes share the same buckets
        assert [by_n[n].get(b, 0) // repeats for b in range(64)] == expect


def reference_mode(tags):
    meaningful = [t for t in tags if t not in ("NEUTRAL", "EMO_UNKNOWN")]
    if not meaningful:
        return "NEUTRAL"
    return Counter(meaningful).most_common(1)[0][0]      # ties: first inserted wins


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["HAPPY", "SAD", "ANGRY", "NEUTRAL", "EMO_UNKNOWN"]),
                         max_size=10), min_size=10, max_size=60))
def test_dominant_in_array_matches_counter(spark, seqs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, t array<string>")
    got = [r.d for r in df.orderBy("i").select(dominant_in_array(F.col("t")).alias("d")).collect()]
    assert got == [reference_mode(s) for s in seqs]


def reference_redact(text):
    import re
    from mediatables.schemas import ID_CARD_PATTERN, ID_REPLACEMENT, PHONE_PATTERN, PHONE_REPLACEMENT
    text = re.sub(ID_CARD_PATTERN, ID_REPLACEMENT, text, flags=re.ASCII)
    return re.sub(PHONE_PATTERN, PHONE_REPLACEMENT, text, flags=re.ASCII)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789Xx 号１３", min_size=0, max_size=40), min_size=20, max_size=80))
def test_redaction_matches_python_ascii_regex(spark, texts):
    from mediatables.functions.redact import redact_pii
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.r for r in df.orderBy("i").select(redact_pii(F.col("t")).alias("r")).collect()]
    assert got == [reference_redact(t) for t in texts]


def reference_resize(h, w, long_edge=1024):
    edge = max(h, w)
    if edge <= long_edge:
        return h, w
    scale = long_edge / edge
    return max(1, round(h * scale)), max(1, round(w * scale))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5000), st.integers(1, 5000)), min_size=20, max_size=80))
def test_resize_dims_match_python_round(spark, dims):
    from mediatables.functions.imaging import resized_dims
    df = spark.createDataFrame([(i, h, w) for i, (h, w) in enumerate(dims)], "i int, h bigint, w bigint")
    nh, nw, _ = resized_dims(F.col("h"), F.col("w"), 1024)
    got = [(r.a, r.b) for r in df.orderBy("i").select(nh.alias("a"), nw.alias("b")).collect()]
    assert got == [reference_resize(h, w) for h, w in dims]


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.integers(min_value=1, max_value=40))
def test_vector_expressions_match_numpy(spark, seed, dim):
    from mediatables.functions.vectors import dot, l2_normalize, squared_l2
    rng = np.random.default_rng(seed)
    vecs = rng.standard_normal((25, dim))
    vecs[0] = 0.0                                     # zero vector stays as is
    q = rng.standard_normal(dim).tolist()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "i int, v array<double>")
    rows = df.orderBy("i").select(squared_l2(F.col("v"), q).alias("d"), dot(F.col("v"), q).alias("p"),
                                  l2_normalize(F.col("v")).alias("n")).collect()
    qv = np.asarray(q)
    for v, r in zip(vecs, rows):
        assert np.isclose(r.d, ((v - qv) ** 2).sum()) and np.isclose(r.p, v @ qv)
        norm = np.linalg.norm(v)
        assert np.allclose(r.n, v / norm if norm > 0 else v)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=30)),
                          st.one_of(st.none(), st.sampled_from(["", "ANGRY", "NEUTRAL", "SAD"]))),
                min_size=10, max_size=40))
def test_prompt_expression_matches_python_twin(spark, pairs):
    from mediatables.functions.tagging import build_prompt, build_prompt_text
    df = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(pairs)], "i int, t string, e string")
    got = [r.p for r in df.orderBy("i").select(build_prompt(F.col("t"), F.col("e")).alias("p")).collect()]
    assert got == [build_prompt_text(t, e) for t, e in pairs]
