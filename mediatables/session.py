"""Session helpers: one place for the settings every job relies on.

Timestamps are UTC end to end (asset tables stamp ``ingest_time`` in UTC and
delete bounds are parsed as UTC), so the session time zone is pinned here.
Scratch data (index tables, round-trip files) goes under the cluster's
``spark.checkpoint.dir``; a local directory is chosen only when the session
has none, which is the situation in tests and in local runs.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Rows and bytes in one Arrow batch; keeps a Python worker's memory flat
# whatever the table's size and the length of the texts.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "mediatables") -> SparkSession:
    """A session with the settings the library assumes.

    ``shuffle_partitions`` is set only if given, or to 8 in a local session;
    on a cluster its own setting holds.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and master and is_local(master):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Checkpoints (skew-safe ranks) are removed once nothing references them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("MEDIATABLES_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Settings that must hold on any session the library runs in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    ship_package(spark)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``mediatables`` importable by Python workers.

    UDFs defined in this package are pickled by reference. In local mode the
    package directory is put on the workers' PYTHONPATH; on a cluster a zip
    of the package is distributed once per context with ``addPyFile``
    (an installed wheel or ``--py-files`` makes this a no-op).
    """
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.master.startswith("local"):
        parts = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in parts:
            sc.environment["PYTHONPATH"] = os.pathsep.join([root, *parts])
    else:
        import shutil
        base = tempfile.mkdtemp(prefix="mediatables-pkg-")
        archive = shutil.make_archive(os.path.join(base, "mediatables"), "zip", root, "mediatables")
        sc.addPyFile(archive)
    _SHIPPED.add(id(sc))


def is_local(master: str) -> bool:
    """One process: only then is a folder of this machine seen by every task."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; created locally only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif is_local(sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="mediatables-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/mediatables/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Temporarily set SQL confs for the actions run inside the block."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Media rows are large (bytes, decoded pixels): small Arrow batches keep a
# Python worker's memory at a few hundred MB whatever the file sizes are.
# An object counts as 256 KB besides its bytes where scans are split, so a task
# reads hundreds of small ones, not 32.
MEDIA_BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "64",
                    "spark.sql.files.openCostInBytes": str(256 << 10)}


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes``.

    Scan splits and shuffle partitions are sized so one task handles about
    ``target_partition_bytes``; AQE then coalesces small post-shuffle
    partitions and splits skewed ones.
    """
    parts = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
