import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediatables.operators import ivf, knn, maintenance
from mediatables.plans import jobs

DATES = [dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1), dt.datetime(2024, 12, 1)]


def _table(spark, tmp, with_embedding=True, n=300, dim=16):
    rng = np.random.default_rng(7)
    vecs = rng.standard_normal((n, dim)).astype(np.float32)
    rows = [(f"doc_{i:04d}", DATES[i % 3], vecs[i].tolist() if with_embedding else None) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id string, ingest_time timestamp, audio_embedding array<float>")
    if not with_embedding:
        df = df.drop("audio_embedding")
    path = f"{tmp}/asset"
    from mediatables.sources.sinks import append_asset
    append_asset(df, path)
    return path, vecs


def test_delete_before_after_window(spark, tmp):
    for kwargs, expect_months in [({"before": "2024-03-01"}, {6, 12}), ({"after": "2024-09-01"}, {1, 6}),
                                  ({"before": "2024-09-01", "after": "2024-03-01"}, {1, 12})]:
        path, _ = _table(spark, f"{tmp}/{len(kwargs)}{sorted(kwargs)[0]}", with_embedding=False)
        report = jobs.manage(spark, path, **kwargs)
        rows = spark.read.parquet(path)
        assert rows.count() == 200
        assert {r.m for r in rows.select(F.month("ingest_time").alias("m")).distinct().collect()} == expect_months
        assert report.dropped and not report.rewritten


def test_delete_needs_a_bound(spark, tmp):
    path, _ = _table(spark, tmp, with_embedding=False)
    with pytest.raises(ValueError):
        jobs.manage(spark, path)


def test_boundary_day_rewritten_and_nulls_kept(spark, tmp):
    from mediatables.sources.sinks import append_asset
    rows = [(i, dt.datetime(2024, 1, 1, i)) for i in range(10)] + [(99, None)]
    path = f"{tmp}/t"
    append_asset(spark.createDataFrame(rows, "id int, ingest_time timestamp"), path)
    report = maintenance.delete_by_date(spark, path, before="2024-01-01T05:00:00")
    assert report.rewritten == ["2024-01-01"]
    kept = sorted(r.id for r in spark.read.parquet(path).collect())
    assert kept == [5, 6, 7, 8, 9, 99]
    assert maintenance.cleanup(spark, path, 0) == []


def test_cleanup_leaves_running_deletes_alone(spark, tmp):
    import os
    path, _ = _table(spark, tmp, with_embedding=False)
    os.makedirs(f"{path}/_rewrite-abc/ingest_date=2030-01-01")
    assert maintenance.cleanup(spark, path) == [] and os.path.isdir(f"{path}/_rewrite-abc")
    assert len(maintenance.cleanup(spark, path, -10)) == 1 and not os.path.isdir(f"{path}/_rewrite-abc")


def test_zone_map_and_prune(spark, tmp):
    path, _ = _table(spark, tmp, with_embedding=False)
    out = jobs.build_indexes(spark, path, embedding=False, time=True)
    zones = spark.read.parquet(out["zonemap"])
    assert zones.agg(F.sum("rows")).first()[0] == 300
    df = spark.read.parquet(path)
    direct = maintenance.scan_time_range(df, "2024-05-01", "2024-07-01")
    plan = direct._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "PushedFilters: [IsNotNull(ingest_time)" in plan
    assert direct.count() == 100


def test_index_requires_column(spark, tmp):
    path, _ = _table(spark, tmp, with_embedding=False)
    with pytest.raises(ValueError, match="not found"):
        jobs.build_indexes(spark, path, embedding=True, time=False, index_type="IVF_FLAT")


@pytest.mark.parametrize("index_type", ["IVF_FLAT", "IVF_SQ"])
def test_all_probes_equal_brute_force_and_recall(spark, tmp, index_type):
    path, vecs = _table(spark, tmp)
    built = jobs.build_indexes(spark, path, time=False, num_partitions=4, sample_rate=64,
                               index_type=index_type)["vector"]
    df = spark.read.parquet(path)
    q = vecs[5].tolist()
    exact = [r.doc_id for r in knn.knn(df, "audio_embedding", q, 10, tie_breakers=["doc_id"]).collect()]
    full = ivf.ivf_search(spark, built.path, q, 10, nprobes=4, refine_factor=50, tie_breakers=["doc_id"])
    assert [r.doc_id for r in full.collect()] == exact
    bounded = ivf.ivf_search(spark, built.path, q, 10, nprobes=1, tie_breakers=["doc_id"], complete=True)
    assert [r.doc_id for r in bounded.collect()] == exact
    assert exact[0] == "doc_0005"


def test_pq_index_and_fresh_rows(spark, tmp):
    path, vecs = _table(spark, tmp, n=600)
    built = jobs.build_indexes(spark, path, time=False, num_partitions=2, num_sub_vectors=4, sample_rate=256,
                               index_type="IVF_PQ")["vector"]
    assert len(built.codebooks) == 4
    df = spark.read.parquet(path)
    fresh = spark.createDataFrame([("doc_new", dt.datetime(2025, 1, 1), vecs[3].tolist())],
                                  "doc_id string, ingest_time timestamp, audio_embedding array<float>")
    res = ivf.ivf_search(spark, built.path, vecs[3].tolist(), 5, nprobes=2, refine_factor=20,
                         tie_breakers=["doc_id"], unindexed=fresh.withColumn("ingest_date", F.to_date("ingest_time")))
    ids = [r.doc_id for r in res.collect()]
    assert set(ids[:2]) == {"doc_0003", "doc_new"}


def test_pq_small_table_rule(spark, tmp):
    path, _ = _table(spark, tmp, n=300)
    with pytest.raises(ValueError, match="4096"):
        jobs.build_indexes(spark, path, time=False, num_partitions=16, index_type="IVF_PQ")


def test_metrics_order_normalised_vectors_alike(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((50, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v[i].astype(float).tolist()) for i in range(50)], "i int, e array<double>")
    q = v[7].tolist()
    orders = [[r.i for r in knn.knn(df, "e", q, 10, metric=m, tie_breakers=["i"]).collect()]
              for m in ("l2", "cosine", "dot")]
    assert orders[0] == orders[1] == orders[2] and orders[0][0] == 7
    arrow = [r.i for r in knn.knn(df, "e", q, 10, method="arrow", tie_breakers=["i"]).collect()]
    assert arrow == orders[0]


def test_sq_codes_decode_close(spark):
    rng = np.random.default_rng(9)
    v = rng.uniform(-1, 1, (20, 6))
    df = spark.createDataFrame([(i, v[i].tolist()) for i in range(20)], "i int, e array<double>")
    lo, hi = v.min(axis=0).tolist(), v.max(axis=0).tolist()
    codes = df.select("i", ivf.sq_codes(F.col("e"), lo, hi).alias("c"))
    dec = codes.select("i", ivf.sq_decode(F.col("c"), lo, hi).alias("d")).orderBy("i").collect()
    err = np.abs(np.array([r.d for r in dec]) - v).max()
    assert err <= max(h - l for l, h in zip(lo, hi)) / 256 + 1e-9
    assert all(0 <= c <= 255 for r in codes.collect() for c in r.c)


def test_query_uses_index_merges_fresh_rows_and_delete_invalidates(spark, tmp):
    from mediatables.plans import query
    from mediatables.sources.sinks import append_asset
    path, vecs = _table(spark, tmp)
    jobs.build_indexes(spark, path, time=False, num_partitions=4, sample_rate=64, index_type="IVF_FLAT")
    exact = [r.doc_id for r in knn.knn(spark.read.parquet(path), "audio_embedding", vecs[9].tolist(), 5,
                                       tie_breakers=["doc_id"]).collect()]
    via_index = [r.doc_id for r in query.query_audio(spark, path, query_doc_id="doc_0009", top_k=5).collect()]
    assert via_index == exact                     # 4 partitions <= nprobes: exact
    fresh = spark.createDataFrame([("doc_new", dt.datetime(2025, 1, 1), vecs[9].tolist())],
                                  "doc_id string, ingest_time timestamp, audio_embedding array<float>")
    append_asset(fresh, path)
    got = [r.doc_id for r in query.query_audio(spark, path, query_doc_id="doc_0009", top_k=2).collect()]
    assert set(got) == {"doc_0009", "doc_new"}
    jobs.manage(spark, path, before="2024-03-01")
    assert not ivf.index_exists(spark, jobs.index_path(path, "audio_embedding"))
    after = [r.doc_id for r in query.query_audio(spark, path, query_doc_id="doc_new", top_k=3).collect()]
    assert "doc_0009" not in after                # doc_0009 was in January, now deleted


def test_nearest_rows_large_codebook_matches_loop():
    rng = np.random.default_rng(3)
    mat = rng.standard_normal((5000, 8))
    centers = rng.standard_normal((256, 8))
    fast = ivf.nearest_rows(mat, centers)
    exact = ((mat[:, None, :] - centers[None, :, :]) ** 2).sum(-1).argmin(axis=1)
    assert (fast == exact).mean() > 0.999


def test_writers_follow_centroid_sizes():
    w = ivf.writers_per_centroid(np.array([3e9, 1e6, 0.0]), 3, 512, 4)
    assert w[0] > 1000 * w[1] and w[2] == 1
    assert ivf.writers_per_centroid(None, 3, 512, 4) == [4, 4, 4]


def test_rewrite_keeps_columns_of_later_appends(spark, tmp):
    from mediatables.sources.readers import read_asset
    from mediatables.sources.sinks import append_asset
    path, day = f"{tmp}/mixed", [dt.datetime(2024, 5, 1, h) for h in (1, 2, 3)]
    append_asset(spark.createDataFrame([("a", day[0])], "doc_id string, ingest_time timestamp"), path)
    append_asset(spark.createDataFrame([("b", day[1], "x"), ("c", day[2], "y")],
                                       "doc_id string, ingest_time timestamp, extra string"), path)
    maintenance.delete_by_date(spark, path, after="2024-05-01 02:30:00")
    rows = {r.doc_id: r.extra for r in read_asset(spark, path).collect()}
    assert rows == {"a": None, "b": "x"}


@pytest.mark.parametrize(("index_type", "options"), [("IVF_FLAT", {}), ("IVF_SQ", {}),
                                                     ("IVF_PQ", {"num_sub_vectors": 4, "sample_rate": 256})])
def test_range_and_prefilter_through_an_index(spark, tmp, index_type, options):
    path, vecs = _table(spark, tmp, n=600)
    built = jobs.build_indexes(spark, path, time=False, num_partitions=2, index_type=index_type,
                               **options)["vector"]
    df, query = spark.read.parquet(path), vecs[5].tolist()
    every = [r.asDict() for r in knn.knn(df, "audio_embedding", query, 600).collect()]
    low, high = every[300][knn.DIST_COL], every[304][knn.DIST_COL]
    got = ivf.ivf_search(spark, built.path, query, 10, nprobes=1, distance_range=(low, high))
    assert {r.doc_id for r in got.collect()} == {r["doc_id"] for r in every[300:304]}
    where = "doc_id IN ('doc_0011', 'doc_0222', 'doc_0333', 'doc_0444')"
    assert ivf.ivf_search(spark, built.path, query, 4, nprobes=1, where=where).count() == 4


def test_index_leaves_out_rows_without_vectors(spark, tmp):
    from mediatables.sources.sinks import append_asset
    path, _ = _table(spark, tmp)
    append_asset(spark.createDataFrame([(f"null_{k}", DATES[0], None) for k in range(50)],
                                       "doc_id string, ingest_time timestamp, audio_embedding array<float>"), path)
    built = jobs.build_indexes(spark, path, time=False, num_partitions=2, sample_rate=64,
                               index_type="IVF_FLAT")["vector"]
    assert spark.read.parquet(built.data_path).count() == 300


def test_index_holds_no_other_columns(spark, tmp):
    from mediatables.sources.readers import read_asset
    from mediatables.sources.sinks import append_asset
    vecs = np.random.default_rng(7).standard_normal((40, 4))
    rows = [(f"d{i}", DATES[0], vecs[i].tolist(), bytes(5000), "note") for i in range(40)]
    path = f"{tmp}/blobs"
    append_asset(spark.createDataFrame(rows, "doc_id string, ingest_time timestamp, audio_embedding array<float>, "
                                             "audio_blob binary, note string"), path)
    built = jobs.build_indexes(spark, path, time=False, num_partitions=2, index_type="IVF_FLAT")["vector"]
    assert set(spark.read.parquet(built.data_path).columns) == {
        "doc_id", "_file", "_row", "audio_embedding", "_spread", "centroid_id"}
    got = ivf.ivf_search(spark, built.path, vecs[3].tolist(), 3, nprobes=2, table=read_asset(spark, path))
    assert got.first().note == "note" and got.first().doc_id == "d3" and got.count() == 3


def test_back_dated_and_removed_files(spark, tmp):
    """Rows appended after the build with earlier times are found; rows of
    files that are gone are not, and repeated keys stay apart."""
    import glob
    import os

    from mediatables.sources.readers import read_asset
    from mediatables.sources.sinks import append_asset
    path, vecs = _table(spark, tmp, n=60)
    built = jobs.build_indexes(spark, path, time=False, num_partitions=3, index_type="IVF_FLAT")["vector"]
    q = vecs[5].tolist()
    shape = "doc_id string, ingest_time timestamp, audio_embedding array<float>"
    append_asset(spark.createDataFrame([("old", dt.datetime(2020, 1, 1), q), ("doc_0005", dt.datetime(2020, 1, 1), q)],
                                       shape), path)
    def ids():
        found = ivf.ivf_search(spark, built.path, q, 4, nprobes=3, tie_breakers=["doc_id"],
                               table=read_asset(spark, path))
        return [r.doc_id for r in found.collect()]
    assert ids()[:3] == ["doc_0005", "doc_0005", "old"]
    for name in glob.glob(f"{path}/ingest_date=2020-01-01/*.parquet"):
        os.remove(name)
    assert ids()[0] == "doc_0005" and "old" not in ids()
    kept = ids()
    day = read_asset(spark, path).where("doc_id = 'doc_0005'").first().ingest_date
    for name in glob.glob(f"{path}/ingest_date={day}/*.parquet"):
        os.remove(name)
    left = read_asset(spark, path)
    assert "doc_0005" in kept and "doc_0005" not in ids()
    assert ids() == [r.doc_id for r in knn.knn(left, "audio_embedding", q, 4, tie_breakers=["doc_id"]).collect()]


@pytest.mark.parametrize("index_type", ["IVF_FLAT", "IVF_SQ", "IVF_PQ"])
def test_many_queries_in_small_cells(spark, tmp, index_type):
    from mediatables.operators.vector_search import search_many, tune_probes
    path, vecs = _table(spark, tmp, n=600)
    built = jobs.build_indexes(spark, path, time=False, num_partitions=2, num_sub_vectors=4, index_type=index_type)
    df = spark.read.parquet(path)
    asked = df.where("doc_id LIKE '%0'").select(F.col("doc_id").alias("query_id"), "audio_embedding")
    nulls = spark.createDataFrame([("none", None)], asked.schema)
    got = search_many(spark, built["vector"], asked.unionByName(nulls), 5, nprobes=2, refine_factor=20, cell_rows=37)
    want = {}
    for r in asked.collect():
        d = ((vecs - np.asarray(r.audio_embedding)) ** 2).sum(1)
        want[r.query_id] = [f"doc_{i:04d}" for i in np.lexsort((np.arange(len(d)), d))[:5]]
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.doc_id)
    assert set(found) == set(want)
    hits = sum(len(set(found[i]) & set(want[i])) for i in want)
    assert found == want if index_type != "IVF_PQ" else hits >= 0.9 * 5 * len(want)
    assert 1 <= tune_probes(spark, built["vector"], asked, 5, target=0.9) <= 2


@pytest.mark.parametrize("index_type", ["IVF_FLAT", "IVF_SQ", "IVF_PQ"])
def test_complete_search_leaves_partitions_unread(spark, tmp, index_type):
    """Far clusters: the bound keeps their partitions out of the plan."""
    from mediatables.operators import vector_search
    rng = np.random.default_rng(1)
    vecs = np.concatenate([rng.standard_normal((300, 8)) * 0.1 + 10 * k for k in range(4)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, e array<float>")
    built = ivf.build_index(spark, df, "e", f"{tmp}/i", index_type=index_type, num_partitions=4, num_sub_vectors=4)
    assert built.identity == ["vec_id"]
    got = vector_search.ivf_search(spark, built, vecs[7].tolist(), 5, complete=True, tie_breakers=["vec_id"])
    exact = knn.knn(df, "e", vecs[7].tolist(), 5, tie_breakers=["vec_id"])
    assert [r.vec_id for r in got.collect()] == [r.vec_id for r in exact.collect()]
    reach = vector_search._reach(built, vector_search._centroid_distances(built, vecs[7]), 3.0)
    assert str(reach).count("centroid_id") == 1
