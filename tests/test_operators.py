from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediatables.functions import imaging, vectors
from mediatables.operators import emotion, faces
from tests.media_fixtures import box_blur, checkerboard


def test_dominant_tag_ties_and_noise(spark):
    rows = [("a", 0, "SAD"), ("a", 1, "HAPPY"), ("a", 2, "HAPPY"), ("a", 3, "SAD"),     # tie -> SAD first
            ("b", 0, "NEUTRAL"), ("b", 1, "EMO_UNKNOWN"),                              # noise only
            ("c", 0, "NEUTRAL"), ("c", 1, "ANGRY"), ("c", 2, "NEUTRAL")]
    tags = spark.createDataFrame(rows, "k string, pos int, tag string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    got = {r.k: r.dominant for r in emotion.dominant_tag(tags, ["k"], ["pos"], all_keys=keys).collect()}
    assert got == {"a": "SAD", "b": "NEUTRAL", "c": "ANGRY", "d": "NEUTRAL"}


def test_ordered_concat_chunks(spark):
    rows = [(1, t, f"s{t};") for t in range(2500)] + [(2, 1, "b"), (2, 0, "a"), (2, 2, None)]
    df = spark.createDataFrame(rows, "k int, t int, text string")
    got = {r.k: r.text for r in emotion.ordered_concat(df, ["k"], "t", "text", chunk=1000).collect()}
    assert got[1] == "".join(f"s{t};" for t in range(2500))
    assert got[2] == "ab"


def test_largest_face_tie_keeps_detector_order(spark):
    rows = [("img", 0, 10.0, 0.7), ("img", 1, 20.0, 0.8), ("img", 2, 20.0, 0.9), ("img2", 0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "k string, idx int, area double, score double")
    out = {r.k: (r.face_count, r.score) for r in faces.largest_face(df, ["k"], "idx", "area", ["score"]).collect()}
    assert out == {"img": (3, 0.8), "img2": (1, 0.5)}
    images = spark.createDataFrame([("img",), ("img2",), ("empty",)], "k string")
    full = faces.largest_face(df.withColumn("blur", F.lit(1.0)), ["k"], "idx", "area", ["score", "blur"],
                              images=images, no_face={"score": 0.0})
    got = {r.k: (r.face_count, r.score, r.blur) for r in full.collect()}
    assert got["empty"] == (0, 0.0, None) and got["img"] == (3, 0.8, 1.0)


def test_grid_laplacian_matches_numpy(spark):
    rng = np.random.default_rng(0)
    grids = [rng.standard_normal(64).tolist() for _ in range(5)]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(grids)], "i int, v array<double>")
    got = [r.x for r in df.orderBy("i").select(imaging.grid_laplacian_variance(F.col("v"), 8, 8).alias("x")).collect()]
    ref = [imaging.laplacian_variance(np.asarray(g).reshape(8, 8)) for g in grids]
    assert np.allclose(got, ref, rtol=1e-9)


def test_sharp_beats_blurred():
    sharp = imaging.gray(checkerboard())
    blurred = imaging.gray(box_blur(checkerboard()))
    assert imaging.laplacian_variance(sharp) > imaging.laplacian_variance(blurred)


def _area_means(values, n):
    """Means over n equal bands, in exact fractions."""
    size, out = len(values), []
    for k in range(n):
        low, high = Fraction(k * size, n), Fraction((k + 1) * size, n)
        cover = [max(Fraction(0), min(high, i + 1) - max(low, i)) for i in range(size)]
        out.append(sum(c * v for c, v in zip(cover, values)) / (high - low))
    return out


@pytest.mark.parametrize(("shape", "to"), [((7, 5), (3, 2)), ((11, 4), (4, 4)), ((6, 9), (6, 4)), ((5, 5), (1, 1))])
def test_shrink_weighs_pixels_by_their_cover(shape, to):
    image = np.random.default_rng(2).integers(0, 256, (*shape, 3)).astype(np.uint8)
    got = imaging.shrink(image, *to)
    for channel in range(3):
        rows = [_area_means([Fraction(int(x)) for x in col], to[0]) for col in image[:, :, channel].T]
        want = [_area_means(list(row), to[1]) for row in zip(*rows)]
        assert np.abs(got[:, :, channel] - np.array([[float(x) for x in r] for r in want])).max() <= 0.5 + 1e-9


def test_sizes_and_boxes_are_column_expressions(spark):
    df = spark.createDataFrame([(500, 2000), (100, 200)], "h int, w int")
    high, wide, scale = imaging.resized_dims(F.col("h"), F.col("w"), 1000)
    assert [tuple(r) for r in df.select(high, wide, scale).collect()] == [(250, 1000, 0.5), (100, 200, 1.0)]
    boxes = [(-10.0, -10.0, 50.0, 200.0), (50.0, 50.0, 50.0, 60.0), (200.0, 200.0, 300.0, 300.0)]
    df = spark.createDataFrame(boxes, "x1 double, y1 double, x2 double, y2 double")
    box = imaging.clamp_box(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.lit(100), F.lit(100))
    got = [r.b and (r.b.x2 - r.b.x1, r.b.y2 - r.b.y1) for r in df.select(box.alias("b")).collect()]
    assert got == [(50, 100), None, None]
    faces_of = spark.createDataFrame([([(0.0, 0.0, 2.0, 2.0, 0.1), (1.0, 1.0, 3.0, 3.0, 0.2), (0.0, 0.0, 1.0, 1.0, 0.9)],),
                                      ([],), (None,)], "f array<struct<x1:double,y1:double,x2:double,y2:double,score:double>>")
    assert [r[0] for r in faces_of.select(faces.largest_in_array(F.col("f"))["score"]).collect()] == [0.1, None, None]


def test_variance_far_from_zero(spark):
    values = np.random.default_rng(1).standard_normal(500)
    df = spark.createDataFrame([((values + 1e6).tolist(),), ([],)], "v array<double>")
    got = [r[0] for r in df.select(imaging.population_variance(F.col("v"))).collect()]
    assert got[0] == pytest.approx(values.var(), rel=1e-9) and got[1] is None



def test_resize_and_clamp_expressions(spark):
    df = spark.createDataFrame([(500, 2000), (100, 200), (1025, 3)], "h bigint, w bigint")
    nh, nw, _ = imaging.resized_dims(F.col("h"), F.col("w"), 1000)
    assert [(r.a, r.b) for r in df.select(nh.alias("a"), nw.alias("b")).collect()] == [(250, 1000), (100, 200), (1000, 3)]
    box = spark.createDataFrame([(-10.0, -10.0, 50.0, 200.0), (50.0, 50.0, 50.0, 60.0)], "x1 double, y1 double, x2 double, y2 double")
    c = box.select(imaging.clamp_box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.lit(100), F.lit(100)).alias("b")).collect()
    assert tuple(c[0].b) == (0, 0, 50, 100) and c[1].b is None


def test_l2_normalize_checked(spark):
    good = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0])], "i int, v array<double>")
    ok = good.orderBy("i").select(vectors.l2_normalize_checked(F.col("v"), 2).alias("n")).collect()
    assert np.allclose(ok[0].n, [0.6, 0.8]) and ok[1].n == [0.0, 0.0]
    with pytest.raises(Exception, match="dimension mismatch"):
        bad = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
        bad.select(vectors.l2_normalize_checked(F.col("v"), 2).alias("n")).collect()


def _bucket_features(values, buckets):
    x = np.array(values)
    x = x / np.abs(x).max() if len(x) and np.abs(x).max() > 0 else x
    parts = np.array_split(x, buckets)
    rms = [float(np.sqrt((p * p).mean())) if len(p) else 0.0 for p in parts]
    zcr = [float(np.abs(np.diff(np.signbit(p).astype(int))).mean()) if len(p) > 1 else 0.0 for p in parts]
    return rms, zcr


@pytest.mark.parametrize(("partitions", "chunk"), [("1", 1 << 16), ("8", 1 << 16), ("8", 50)])
def test_segmented_scan_matches_numpy_on_skewed_keys(spark, monkeypatch, partitions, chunk):
    from mediatables.operators import positions
    from mediatables.operators.signal import bucket_stats
    from mediatables.session import session_conf
    monkeypatch.setattr(positions, "CHUNK", chunk)
    rng = np.random.default_rng(11)
    rows = [(0, i, float(v)) for i, v in enumerate(rng.standard_normal(3000))]            # hot key
    rows += [(k, i, float(rng.standard_normal())) for k in range(1, 40) for i in range(k * 3)]
    rows += [(40, 0, -0.0), (40, 1, 0.0), (41, 0, 0.0), (None, 0, 2.0), (None, 1, -1.0), (42, 0, None)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    a = {k: _bucket_features([v for kk, _, v in rows if kk == k], 64) for k in {r[0] for r in rows} - {42}}
    with session_conf(spark, {"spark.sql.shuffle.partitions": partitions}):
        stats = bucket_stats(df.repartition(3), "k", ["t"], "v", 64)
        b = {r.k: (r.rms, r.zcr) for r in stats.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k][0], b[k][0], atol=1e-12) and np.allclose(a[k][1], b[k][1], atol=1e-12), k


def test_segmented_scan_of_no_rows(spark):
    from mediatables.operators.signal import bucket_stats
    assert bucket_stats(spark.createDataFrame([], "k int, t int, v double"), "k", ["t"], "v").collect() == []


def test_mix_to_mono_then_features(spark):
    from mediatables.operators.signal import bucket_stats, mix_to_mono
    rows = [("r", i, ch, float(v)) for i in range(100) for ch, v in ((0, np.sin(i)), (1, np.cos(i)))]
    stereo = spark.createDataFrame(rows, "k string, i int, ch int, value double")
    mono = mix_to_mono(stereo, ["k"], ["i"])
    got = {r.i: r.value for r in mono.collect()}
    assert np.isclose(got[3], (np.sin(3) + np.cos(3)) / 2)
    stats = bucket_stats(mono, "k", ["i"], "value", 64).first()
    assert len(stats.rms) == 64 and len(stats.zcr) == 64


def test_array_forms_match_table_forms(spark):
    from mediatables.functions.tagging import concat_segments, dominant_in_array, segment_emotion
    rng = np.random.default_rng(21)
    vocab = ["HAPPY", "SAD", "ANGRY", "NEUTRAL", "EMO_UNKNOWN"]
    seqs = [[str(t) for t in rng.choice(vocab, size=int(rng.integers(0, 9)))] for _ in range(60)]
    rows = [(k, i, t) for k, seq in enumerate(seqs) for i, t in enumerate(seq)]
    tags = spark.createDataFrame(rows, "k int, pos int, tag string")
    keys = spark.createDataFrame([(k,) for k in range(len(seqs))], "k int")
    table = {r.k: r.dominant for r in emotion.dominant_tag(tags, ["k"], ["pos"], all_keys=keys).collect()}
    arr = spark.createDataFrame([(k, s) for k, s in enumerate(seqs)], "k int, tags array<string>")
    per_row = {r.k: r.d for r in arr.select("k", dominant_in_array(F.col("tags")).alias("d")).collect()}
    assert per_row == table
    segs = spark.createDataFrame([([("你好", "<|HAPPY|>你好"), ("，再见", "<|SAD|>，再见<|SAD|>")],), ([],)],
                                 "s array<struct<text:string,raw:string>>")
    out = segs.select(concat_segments(F.col("s")).alias("t"), segment_emotion(F.col("s")).alias("e")).collect()
    assert (out[0].t, out[0].e) == ("你好，再见", "SAD") and (out[1].t, out[1].e) == ("", "NEUTRAL")


def test_ordered_concat_timestamp_order(spark):
    import datetime as dt
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0, i), f"s{i}") for i in (3, 1, 2)]
    df = spark.createDataFrame(rows, "k int, t timestamp, text string")
    assert emotion.ordered_concat(df, ["k"], "t", "text").first().text == "s1s2s3"


@pytest.mark.parametrize("n_centers", [1, 10, 64, 65, 256])
def test_nearest_center_matches_summed_distances(n_centers):
    from mediatables.operators.ivf import nearest_rows
    rng = np.random.default_rng(n_centers)
    centers = rng.integers(-2, 3, (n_centers, 3)) / 10 + 100
    rows = np.concatenate([rng.integers(-4, 5, (3000, 3)) / 20 + 100, centers])
    direct = ((rows[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    assert (nearest_rows(rows, centers) == direct.argmin(axis=1)).all()
    assert len(nearest_rows(rows[:0], centers)) == 0
