"""Asset-table maintenance: zone maps, date-bounded delete.

Asset tables are Hive-style Parquet directories partitioned by ``ingest_date``.

* Zone maps (T1): physically, every file of an ingest run carries one
  ``ingest_time`` and files are grouped by date, so partition pruning plus
  Parquet min/max statistics skip whole files for time-range filters.
  ``scan_time_range`` states the bounds that make Spark do so; ``zone_map``
  also gives the statistics as a side table.
* Delete (T2): ``ingest_time < before AND ingest_time > after`` (strict, ANDed:
  rows inside the window go). NULL times are never deleted. Partitions whose
  whole day is covered are dropped without reading them; at most the two
  boundary days are rewritten. A rewrite writes the kept rows to a staging
  directory first (``_``-prefixed, invisible to readers) and only then swaps
  it in, so the data being read is never overwritten in place.
* Cleanup (T3) removes staging leftovers of interrupted deletes.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_COL = "ingest_date"
TIME_COL = "ingest_time"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


# ---------------------------------------------------------------------------
# Zone maps
# ---------------------------------------------------------------------------

def zone_map(df: DataFrame, time_col: str = TIME_COL, zone: Column | None = None) -> DataFrame:
    """(zone, min_time, max_time, rows) per zone; default zone = data file."""
    z = F.input_file_name() if zone is None else zone
    return df.groupBy(z.alias("zone")).agg(
        F.min(time_col).alias("min_time"), F.max(time_col).alias("max_time"),
        F.count(F.lit(1)).alias("rows"))


def scan_time_range(df: DataFrame, lo, hi, time_col: str = TIME_COL) -> DataFrame:
    """Rows with lo <= time <= hi; the partition column and the files'
    statistics say what is not read."""
    return df.where(time_window(lo, hi, time_col, PARTITION_COL if PARTITION_COL in df.columns else None))


def time_window(lo, hi, time_col: str = TIME_COL, date_col: str | None = PARTITION_COL) -> Column:
    """``lo <= time <= hi`` plus the implied bounds on the date partition.

    Spark prunes directories only on the partition column, so the date bounds
    are stated explicitly; the time bounds go to the Parquet reader, whose
    min/max statistics skip files and row groups inside the kept days.
    """
    cond = F.lit(True)
    if lo is not None:
        t = F.lit(lo).cast("timestamp")
        cond = cond & (F.col(time_col) >= t)
        if date_col:
            cond = cond & (F.col(date_col) >= F.to_date(t))
    if hi is not None:
        t = F.lit(hi).cast("timestamp")
        cond = cond & (F.col(time_col) <= t)
        if date_col:
            cond = cond & (F.col(date_col) <= F.to_date(t))
    return cond


# ---------------------------------------------------------------------------
# Delete by date
# ---------------------------------------------------------------------------

def _ts(value: str | dt.datetime | None) -> dt.datetime | None:
    """ISO date or datetime (UTC, naive)."""
    if value is None or value == "":
        return None
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    text = value.strip().replace("Z", "")
    parsed = dt.datetime.fromisoformat(text)
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return parsed


def delete_condition(before=None, after=None, time_col: str = TIME_COL) -> Column:
    """F21 + T2: the rows to delete; at least one bound is required."""
    b, a = _ts(before), _ts(after)
    if b is None and a is None:
        raise ValueError("Provide at least one of: before or after")
    def lit_ts(x: dt.datetime) -> Column:   # parsed in the session time zone (UTC)
        return F.lit(x.isoformat(sep=" ")).cast("timestamp")

    clauses = []
    if b is not None:
        clauses.append(F.col(time_col) < lit_ts(b))
    if a is not None:
        clauses.append(F.col(time_col) > lit_ts(a))
    cond = clauses[0]
    for c in clauses[1:]:
        cond = cond & c
    return cond


def keep_condition(before=None, after=None, time_col: str = TIME_COL) -> Column:
    """Rows that survive a delete: ``time IS NULL OR NOT cond``.

    Same truth table as ``NOT coalesce(cond, false)`` (the bounds are
    literals, so ``cond`` is NULL only for a NULL time), but in a form Catalyst
    simplifies to range comparisons that reach the Parquet reader.
    """
    return F.col(time_col).isNull() | ~delete_condition(before, after, time_col)


def keep_after_delete(df: DataFrame, before=None, after=None, time_col: str = TIME_COL) -> DataFrame:
    """Rows that survive ``delete_by_date`` (NULL times always survive)."""
    return df.where(keep_condition(before, after, time_col))


def _day_class(day: dt.date, b: dt.datetime | None, a: dt.datetime | None) -> str:
    """'drop' if every instant of the day is deleted, 'keep' if none, else 'rewrite'."""
    start = dt.datetime.combine(day, dt.time())
    end = start + dt.timedelta(days=1)          # exclusive
    covered, untouched = True, False
    if b is not None:
        covered &= end <= b
        untouched |= start >= b
    if a is not None:
        covered &= start > a
        untouched |= end <= a
    if untouched:
        return "keep"
    return "drop" if covered else "rewrite"


@dataclass
class DeleteReport:
    dropped: list = field(default_factory=list)
    rewritten: list = field(default_factory=list)
    kept: list = field(default_factory=list)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_partitions(spark: SparkSession, table: str) -> dict[str, str]:
    """{partition value: directory} - a metadata listing, no data read."""
    fs, root, _ = _fs(spark, table)
    out = {}
    if not fs.exists(root):
        return out
    prefix = f"{PARTITION_COL}="
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            out[name[len(prefix):]] = status.getPath().toString()
    return out


def _rewrite_partition(spark: SparkSession, table: str, value: str, keep: Column) -> None:
    """Staged rewrite of one partition: write kept rows aside, then swap."""
    fs, root, jvm = _fs(spark, table)
    part_dir = f"{table.rstrip('/')}/{PARTITION_COL}={value}"
    staging = f"{table.rstrip('/')}/_rewrite-{uuid.uuid4().hex[:12]}"
    # One file's schema may lack columns that a later append brought.
    from ..sources.sinks import table_schema
    reader = spark.read.option("basePath", table)
    declared = table_schema(spark, table)
    rows = (reader.schema(declared) if declared is not None else reader.option("mergeSchema", "true")).parquet(part_dir)
    rows.where(keep).write.mode("overwrite").partitionBy(PARTITION_COL).parquet(staging)
    new_dir = jvm.org.apache.hadoop.fs.Path(f"{staging}/{PARTITION_COL}={value}")
    old_dir = jvm.org.apache.hadoop.fs.Path(part_dir)
    # The old rows move aside and go last, so a copy exists at every step.
    aside = jvm.org.apache.hadoop.fs.Path(f"{staging}/_old")
    if not fs.rename(old_dir, aside):
        raise OSError(f"cannot move {part_dir} aside; the table is unchanged")
    if fs.exists(new_dir) and not fs.rename(new_dir, old_dir):
        if not fs.rename(aside, old_dir):
            raise OSError(f"cannot restore {part_dir}; its rows are in {staging}/_old")
        raise OSError(f"cannot replace {part_dir}; the table is unchanged")
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)


def delete_by_date(spark: SparkSession, table: str, before=None, after=None) -> DeleteReport:
    """T2 on a table: drop covered days, rewrite boundary days, keep the rest."""
    b, a = _ts(before), _ts(after)
    keep = keep_condition(b, a)              # validates the bounds
    report = DeleteReport()
    fs, _, jvm = _fs(spark, table)
    for value, path in sorted(list_partitions(spark, table).items()):
        if value == NULL_PARTITION:
            report.kept.append(value)
            continue
        kind = _day_class(dt.date.fromisoformat(value), b, a)
        if kind == "drop":
            fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
            report.dropped.append(value)
        elif kind == "rewrite":
            _rewrite_partition(spark, table, value, keep)
            report.rewritten.append(value)
        else:
            report.kept.append(value)
    return report


def cleanup(spark: SparkSession, table: str, older_than_s: int = 24 * 3600) -> list[str]:
    """Remove staging directories left by interrupted rewrites.

    Younger ones may belong to a running delete and stay. A staging directory whose partition was not swapped in yet (the original
    is gone) is moved into place first, so an interrupted delete never loses
    the kept rows.
    """
    fs, root, jvm = _fs(spark, table)
    removed = []
    if not fs.exists(root):
        return removed
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not (status.isDirectory() and name.startswith("_rewrite-")):
            continue
        if status.getModificationTime() / 1000 > time.time() - older_than_s:
            continue
        for part in fs.listStatus(status.getPath()):
            pname = part.getPath().getName()
            if part.isDirectory() and pname.startswith(f"{PARTITION_COL}="):
                target = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{pname}")
                if not fs.exists(target):
                    fs.rename(part.getPath(), target)
        fs.delete(status.getPath(), True)
        removed.append(status.getPath().toString())
    return removed


def drop_indexes(spark: SparkSession, table: str) -> bool:
    """Remove ``<table>/_index`` (vector indexes and zone maps)."""
    fs, _, jvm = _fs(spark, table)
    path = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/_index")
    return bool(fs.exists(path) and fs.delete(path, True))
