"""What a Python worker and a scan hold, at any size of the table."""

import gc
import math
import weakref

import numpy as np
from pyspark.sql import functions as F

from mediatables.operators import ivf, vector_search
from mediatables.operators.media import ImageQuality, image_measures
from mediatables.operators.models import swept
from mediatables.plans import jobs, standins
from mediatables.session import BATCH_CONF, MEDIA_BATCH_CONF, session_conf
from mediatables.sources import fetch


class Own:
    def __init__(self):
        self.own = self


def test_batches_that_hold_themselves_are_freed():
    seen = []

    def batches():
        for _ in range(30):
            one = Own()
            seen.append(weakref.ref(one))
            yield one

    gc.disable()
    try:
        for _ in swept(batches()):
            assert sum(r() is not None for r in seen) <= 3
    finally:
        gc.enable()
        gc.unfreeze()


def test_every_session_bounds_arrow_batches(spark):
    assert all(spark.conf.get(k) == v for k, v in BATCH_CONF.items())


class OneFace:
    def detect(self, image):
        return [{"bbox": (0, 0, 4, 3), "score": 0.5}] if image[0, 0, 0] > 100 else []


def quality():
    return ImageQuality(OneFace(), long_edge=8)


def test_images_are_measured_by_few_workers(spark):
    rnd = np.random.default_rng(4)
    rows = [(k, 6, 5, 3, bytearray([200 * (k % 2)]) + bytearray(rnd.integers(0, 256, 89, np.uint8).tobytes())) for k in range(6)]
    rows += [(6, -1, -1, -1, bytearray()), (7, 16, 16, 4, bytearray(bytes(range(256)) * 4))]
    images = spark.createDataFrame(rows, "_object long, _h int, _w int, _c int, _data binary")
    measured = image_measures(images, quality, ["_object"])
    plan = measured._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") <= 2
    got = {r._object: r for r in measured.collect()}
    assert [got[k].face_count for k in range(8)] == [0, 1, 0, 1, 0, 1, None, 0]
    for k, _, _, _, data in rows[:6]:
        levels = np.rint(np.frombuffer(bytes(data), np.uint8).reshape(6, 5, 3) @ np.array([0.114, 0.587, 0.299]))
        from mediatables.functions.imaging import laplacian_variance
        assert math.isclose(got[k].blur_score, laplacian_variance(levels))
        assert (got[k].face_blur_score is None) == (k % 2 == 0)
        if k % 2:
            assert math.isclose(got[k].face_blur_score, laplacian_variance(levels[:3, :4]))
    assert got[6].blur_score is None and got[7].blur_score is not None and got[7].width == 16


def test_small_objects_share_tasks_and_folders(spark, tmp):
    header = bytes.fromhex(standins.BMP_HEADER)
    df = spark.range(300).select(F.concat(F.lit("o-"), F.col("id").cast("string")).alias("name"),
                                 F.lit(bytearray(header + bytes(192))).alias("content"))
    assert fetch.lay_objects(df, "name", "content", f"{tmp}/laid").count() == 300
    with session_conf(spark, MEDIA_BATCH_CONF):
        images = jobs.decoded_images(spark, f"{tmp}/laid")
        assert images.rdd.getNumPartitions() <= 5
        found = images.collect()
    assert {r._object for r in found} == {f"o-{k}" for k in range(300)} and all(r._h == 8 for r in found)
    assert 32 < len(list((__import__("pathlib").Path(tmp) / "laid").iterdir())) <= fetch.FOLDERS


def test_codes_and_their_error_come_from_one_worker(spark):
    rnd = np.random.default_rng(8)
    books = rnd.normal(size=(2, 256, 4))
    index = ivf.IvfIndex("", "v", "IVF_PQ", 8, 1, codebooks=books.tolist())
    df = spark.createDataFrame([(k, rnd.normal(size=8).tolist() if k else None) for k in range(40)], "k long, v array<double>")
    both = df.select("k", "v", ivf.pq_code_udf(index)("v").alias("s")).where("v IS NOT NULL") \
        .select("k", "s.*", ivf.pq_encode_udf(books)("v").alias("c")).withColumn("n", F.size("codes")).collect()
    apart = {r.k: r.e for r in df.where("v IS NOT NULL").withColumn("c", ivf.pq_encode_udf(books)("v"))
             .select("k", ivf.code_error_udf(index)("v", "c").alias("e")).collect()}
    assert len(both) == 39
    for r in both:
        assert list(r.codes) == list(r.c) and math.isclose(r.error, apart[r.k])


def test_a_cell_holds_a_bounded_number_of_distances(monkeypatch, spark, tmp):
    sizes = []
    plain = vector_search.best_rows

    def counted(mat, queries, k):
        sizes.append(len(mat) * len(queries))
        return plain(mat, queries, k)

    monkeypatch.setattr(vector_search, "best_rows", counted)
    import pyarrow as pa
    index = ivf.IvfIndex("", "v", "IVF_FLAT", 2, 1)
    kernel = vector_search._cell_kernel(index, 3, [("query_id", pa.int64()), ("vec_id", pa.int64()), ("centroid_id", pa.int32()),
                                                   ("distance", pa.float64())])
    n, m = 20_000, 200
    rnd = np.random.default_rng(9)
    v = pa.array(rnd.normal(size=(n + m, 2)).tolist(), pa.list_(pa.float64()))
    ids = np.arange(n + m)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n + m, np.int32)), pa.array(np.zeros(n + m, np.int32)), pa.array((ids >= n).astype(np.int32)),
         pa.array(ids), pa.array(ids), v], names=["centroid_id", "cell", "kind", "vec_id", "query_id", "v"])
    found = pa.Table.from_batches(list(kernel([batch]))).to_pylist()
    assert len(found) == 3 * m and max(sizes) <= vector_search.PRODUCT_CELLS
    points = np.array(v.to_pylist())
    for f in found[:30]:
        d = ((points[:n] - points[f["query_id"]]) ** 2).sum(axis=1)
        assert f["vec_id"] in np.argsort(d)[:3]
