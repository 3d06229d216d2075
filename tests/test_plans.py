"""Physical-plan properties the design relies on at scale."""

import os
import re

import numpy as np

import __spark_entry__ as contract
from mediatables.operators.ivf import build_index, ivf_search
from mediatables.plans import jobs
from mediatables.plans.standins import QVEC
from mediatables.session import scratch_path
from tests.conftest import SF01
from tests.media_fixtures import png_bytes, write_jsonl

Q = contract.queries()


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_knn_is_one_narrow_scan(spark):
    plan = final_plan(Q["knn_prefilter"](spark, SF01))
    assert "TakeOrderedAndProject" in plan
    assert "Exchange" not in plan                 # no vector ever shuffled
    assert "PushedFilters: [IsNotNull(embedding), In(label, [1,3,5])" in plan


def test_filters_and_projection_reach_the_scan(spark):
    plan = Q["range_gate"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in plan
    assert "GreaterThanOrEqual(n_chars,100)" in plan and "LessThanOrEqual(n_chars,5000)" in plan


def test_listing_never_reads_contents(spark):
    plan = Q["file_listing"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "content" not in read and "path" in read


def test_ivf_probe_is_a_partition_filter(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    idx = build_index(spark, emb, "embedding", scratch_path(spark, "plan-ivf"), index_type="IVF_FLAT",
                      num_partitions=8, sample_rate=64)
    plan = final_plan(ivf_search(spark, idx, QVEC, 10, nprobes=2))
    assert re.search(r"PartitionFilters: \[[^\]]*centroid_id#\d+ IN \(", plan)


def test_pixels_stay_in_their_scan_task(spark, tmp):
    d = os.path.join(tmp, "m")
    os.makedirs(d)
    for n in ("a.png", "b.png"):
        with open(os.path.join(d, n), "wb") as fp:
            fp.write(png_bytes(np.full((8, 8, 3), 9, np.uint8)))
    manifest = os.path.join(tmp, "m.jsonl")
    write_jsonl(manifest, [{"doc_id": "a.png", "s3_url": f"{d}/a.png"}])
    plan = final_plan(jobs.build_image_analysis(spark, manifest, [d]))
    # From the image scan up to the quality UDF there is no exchange.
    lines = plan.splitlines()
    scan = next(i for i, l in enumerate(lines) if "FileScan image" in l)
    udf = max(i for i in range(scan) if "ArrowEvalPython" in lines[i])
    between = lines[udf:scan]
    assert not any("Exchange" in l and "BroadcastExchange" not in l for l in between)


def test_append_does_not_shuffle(spark, tmp):
    from mediatables.sources.sinks import append_asset
    df = spark.read.parquet(f"{SF01}/events.parquet").withColumnRenamed("ts", "ingest_time")
    spark.sparkContext.setJobGroup("append-check", "append")
    try:
        append_asset(df, os.path.join(tmp, "t"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    jobs_ = status.getJobIdsForGroup("append-check")
    stages = [s for j in jobs_ for s in (status.getJobInfo(j).stageIds if status.getJobInfo(j) else [])]
    assert len(stages) == len(jobs_)             # one stage per job: no shuffle boundary
