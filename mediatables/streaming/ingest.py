"""Incremental ingest with Structured Streaming.

The reference runs its stages as one-off batches over a manifest. The same
analyze -> ingest path can run incrementally: manifest files dropped into a
directory are picked up by a file stream, and every micro-batch goes through
the batch operators inside ``foreachBatch`` before being appended to the asset
table. The stream's checkpoint (under the session's checkpoint folder unless
given) records which manifest files were processed, so a restarted query
skips none. A batch's ingest time is written beside the checkpoint before the
batch is appended, so a batch that is run again has the same time, and is left
out if the table has rows of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators.media import ImageQuality
from ..plans.jobs import build_image_analysis, ingest_time_literal, run_instant, this_run
from ..schemas import MANIFEST_SCHEMA, ImageConfig
from ..session import scratch_path
from ..sources import fetch, readers, sinks


def analyze_image_batch(spark: SparkSession, manifest: DataFrame, roots: Sequence[str],
                        quality_factory: Callable[[], Any] = ImageQuality,
                        cfg: ImageConfig = ImageConfig()) -> DataFrame:
    """Analysis of one manifest batch (the batch job's plan) plus the blob."""
    rows = build_image_analysis(spark, manifest, roots, quality_factory=quality_factory, cfg=cfg)
    return fetch.fetch_content(rows, content_col="image_blob", roots=roots)


def batch_instant(spark: SparkSession, folder: str, epoch_id: int) -> str:
    """The ingest time of a micro-batch, the same however often it runs."""
    path = f"{folder.rstrip('/')}/{epoch_id}"
    if not sinks.path_exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(run_instant(),)], "t string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()[0]


def start_image_ingest(spark: SparkSession, manifest_dir: str, table: str, roots: Sequence[str],
                       checkpoint: str | None = None, fmt: str = "json",
                       quality_factory: Callable[[], Any] = ImageQuality,
                       trigger: dict | None = None):
    """Start a stream: new manifest files -> analysis -> append to ``table``.

    ``trigger`` defaults to ``{"availableNow": True}`` (process what is there,
    then stop); pass e.g. ``{"processingTime": "1 minute"}`` to keep running.
    """
    checkpoint = checkpoint or scratch_path(spark, "stream-ingest")
    stream = spark.readStream.schema(MANIFEST_SCHEMA).format(fmt).load(manifest_dir)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        now = batch_instant(spark, f"{checkpoint}-instants", epoch_id)
        if sinks.path_exists(spark, table) and not this_run(readers.read_asset(spark, table), now).isEmpty():
            return
        rows = analyze_image_batch(spark, batch, roots, quality_factory)
        rows = rows.withColumn("status", rules.downgrade_missing_blob(F.col("status"), F.col("image_blob")))
        rows = rows.withColumn("ingest_time", ingest_time_literal(now))
        sinks.append_asset(rows, table)

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
