"""Fetching media content for manifest rows.

The rows are spread over the tasks and every task reads the objects of its own
rows, so exactly the manifest's objects are read, no folder is listed, and no
bytes cross a shuffle before they are used. Each row stays, with NULL where
there is nothing to read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Content held by a task before it is handed on; one object may exceed it.
BATCH_BYTES = 32 << 20
FOLDERS = 64

# Scheme of a URL -> scheme of the file system that reads it.
SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3",
           "hdfs": "hdfs", "viewfs": "viewfs", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def normalize_path(col: Column) -> Column:
    """Canonical form for joining: ``file:`` stripped, ``s3a``/``s3n`` -> ``s3``."""
    c = F.regexp_replace(col, r"^file:(//)?", "")
    c = F.regexp_replace(c, r"^s3[an]://", "s3://")
    return F.regexp_replace(c, r"/{2,}", "/")


class ObjectReader:
    """Bytes behind a URL, or None where there is no readable object.

    An unsupported scheme raises ValueError. So does any failure of the store
    itself raise, and the task is tried again. ``s3`` holds arguments of
    ``pyarrow.fs.S3FileSystem``; without them the environment's are taken.
    """

    def __init__(self, s3: dict | None = None) -> None:
        self.s3 = dict(s3 or {})
        self._stores: dict[tuple[str, str], fs.FileSystem] = {}

    def __getstate__(self):
        return {"s3": self.s3, "_stores": {}}

    def locate(self, url: str) -> tuple[fs.FileSystem, str]:
        head, mark, rest = url.partition("://")
        if not mark:
            head, rest = ("file", url[5:]) if url.startswith("file:") else ("", url)
        scheme = SCHEMES.get(head.lower())
        if scheme is None:
            raise ValueError(f"cannot fetch {url!r}: unsupported scheme {head!r}")
        if scheme == "file":
            key, path = ("file", ""), rest
        else:
            host, _, below = rest.partition("/")
            key, path = (scheme, host), rest if scheme in ("s3", "gs") else "/" + below
        if key not in self._stores:
            if scheme == "file":
                store = fs.LocalFileSystem()
            elif scheme == "s3" and self.s3:
                store = fs.S3FileSystem(**self.s3)
            else:
                store, _ = fs.FileSystem.from_uri(f"{scheme}://{key[1]}/")
            self._stores[key] = store
        return self._stores[key], path

    def __call__(self, url: str) -> bytes | None:
        store, path = self.locate(url)
        try:
            with store.open_input_stream(path, compression=None) as source:
                return source.read()
        except (FileNotFoundError, PermissionError):
            return None
        except OSError:
            if store.get_file_info(path).type == fs.FileType.File:
                raise
            return None


def s3_options(df: DataFrame) -> dict:
    """The session's ``fs.s3a`` settings as arguments of the S3 reader."""
    conf = df.sparkSession.conf
    names = {"endpoint": "endpoint_override", "access.key": "access_key", "secret.key": "secret_key",
             "endpoint.region": "region"}
    out = {arg: conf.get(f"spark.hadoop.fs.s3a.{name}", None) for name, arg in names.items()}
    out = {arg: value for arg, value in out.items() if value}
    if out and conf.get("spark.hadoop.fs.s3a.connection.ssl.enabled", "true").lower() == "false":
        out["scheme"] = "http"
    return out


def fetch_content(df: DataFrame, fetcher: Callable[[str], bytes | None] | None = None,
                  url_col: str = "s3_url", content_col: str = "content",
                  roots: Sequence[str] | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``df`` with the bytes behind ``url_col``.

    A null URL, a missing object and, if ``roots`` are given, a URL outside
    all of them give NULL. A caller's ``fetcher`` replaces the reader; any
    error of its own means NULL.
    """
    out_schema = T.StructType([*df.schema.fields, T.StructField(content_col, T.BinaryType())])
    allowed = F.lit(True)
    if roots:
        below = [normalize_path(F.lit(r.rstrip("/") + "/")) for r in roots]
        path = normalize_path(F.col(f"`{url_col}`"))
        allowed = F.lit(False)
        for root in below:
            allowed = allowed | path.startswith(root)
    reader = fetcher or ObjectReader(s3_options(df))
    lenient = fetcher is not None

    def read(url: str | None) -> bytes | None:
        if url is None:
            return None
        try:
            return reader(url)
        except Exception:
            if lenient:
                return None
            raise

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1]))
            urls = batch.column(batch.num_columns - 1).to_pylist()
            start, held, size = 0, [], 0
            for at, url in enumerate(urls):
                held.append(read(url))
                size += len(held[-1] or b"")
                if size >= batch_bytes or at + 1 == len(urls):
                    part = rows.slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())],
                                                     names=out_schema.names)
                    start, held, size = at + 1, [], 0

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = F.when(allowed, F.col(f"`{url_col}`")).alias("__url")
    return df.repartition(tasks).select("*", wanted).mapInArrow(run, out_schema)


def lay_objects(df: DataFrame, name_col: str, content_col: str, folder: str) -> DataFrame:
    """``df`` unchanged, each row's bytes written to ``folder/<part>/<name>`` on
    the way, in ``FOLDERS`` parts, which Spark lists side by side; rows without
    bytes write nothing. A repeated task writes the same file again, under a
    name of its own first."""
    jvm = df.sparkSession.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
    options = s3_options(df)
    root = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, made = ObjectReader(options), set()
        for batch in batches:
            for name, data in zip(batch.column(name_col).to_pylist(), batch.column(content_col)):
                if data.is_valid:
                    store, path = reader.locate(f"{root}/{zlib.crc32(name.encode()) % FOLDERS:02d}/{name}")
                    below = path.rpartition("/")[0]
                    if below not in made:
                        store.create_dir(below, recursive=True)
                        made.add(below)
                    draft = f"{below}/.{name}-{uuid.uuid4().hex}"
                    with store.open_output_stream(draft) as out:
                        out.write(data.as_buffer())
                    store.move(draft, path)
            yield batch

    return df.mapInArrow(run, df.schema)
