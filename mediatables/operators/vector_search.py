"""Searches through an inverted-file index (V2, V3, V6-V9).

One query:
- plain: the ``nprobes`` partitions with the nearest centroids, exact distances
  of all their rows, or of the ``k * refine_factor`` best by code.
- complete: with a distance range or a prefilter, and on request. A partition of
  radius r around a centroid at distance d holds nothing nearer than d - r; so a
  range reads exactly the partitions that can reach into it, and a top-k search
  reads the nearest ones first and then those whose bound is below its k-th
  best. Within a partition the stored distance to the centroid bounds each row
  the same way (a Parquet filter), and a code's stored error bounds what is
  gained by its exact distance. The result equals a scan of the whole table.

Many queries: queries meet the cells of their ``nprobes`` nearest partitions. A
cell is a bounded share of a partition's rows, so neither a large partition nor
many queries of one come into one task's memory: a task holds one cell and
streams the queries past it in Arrow batches. Each keeps its best k per cell,
and a ranked window (which Spark limits before the shuffle) merges them.

Index rows are slim; hits are joined back to the table by key, or by the file
and place of their rows. Files of the table that the index does not list are
searched by brute force, and index rows of files that are gone are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.vectors import squared_l2
from . import ivf
from . import knn as knn_ops
from .ivf import ERROR_COL, FILE_COL, ROUNDING, ROW_COL, SPREAD_COL, IvfIndex

CELL_ROWS = 50_000
# Distances that a task holds at once.
PRODUCT_CELLS = 1 << 20
# Sums in another order differ in their last digits; bounds are this much wider.
SLACK = 1e-6


def _file_key(uri: str) -> str:
    """One spelling for a local file with one or three slashes."""
    return re.sub(r"^file:/+", "file:/", uri)


def stale_and_fresh(spark: SparkSession, index: IvfIndex, table: DataFrame) -> tuple[set[str], set[str]]:
    """V9: files that the index lists and the table has not, and the reverse.

    Both lists are names only, of which the driver holds the table's already.
    """
    listed = {_file_key(r[0]) for r in spark.read.parquet(index.files_path).select(FILE_COL).toLocalIterator()}
    current = {_file_key(f) for f in table.inputFiles()}
    return listed - current, current - listed


def _in_files(files: set[str]) -> Column:
    return F.col("_metadata.file_path").isin(sorted(files))


def fresh_rows(spark: SparkSession, index: IvfIndex, table: DataFrame) -> DataFrame | None:
    """Rows of files written after the index, whatever their times; only
    those files are read. None: there are none."""
    if not index.has_files:
        return None
    _, fresh = stale_and_fresh(spark, index, table)
    return ivf.with_row_identity(table.where(_in_files(fresh))) if fresh else None


def _members(spark: SparkSession, index: IvfIndex, table: DataFrame | None) -> DataFrame:
    """Index rows of files that the table still has."""
    rows = spark.read.parquet(index.data_path)
    if table is None or not index.has_files:
        return rows
    stale, _ = stale_and_fresh(spark, index, table)
    return rows.where(~F.col(FILE_COL).isin(sorted(stale))) if stale else rows


def _centroid_distances(index: IvfIndex, q: Sequence[float]) -> np.ndarray:
    centers = np.asarray(index.centroids, dtype=np.float64)
    return np.sqrt(((centers - np.asarray(q, dtype=np.float64)) ** 2).sum(axis=1))


def _reach(index: IvfIndex, distances: np.ndarray, within: float, beyond: float = 0.0) -> Column | None:
    """Rows that may lie at a distance of ``beyond`` to ``within`` of the
    query, by partition and distance to its centroid; None where none may."""
    parts = None
    within, beyond = within * (1 + SLACK) + SLACK, max(0.0, beyond * (1 - SLACK) - SLACK)
    for c, (d, r, n) in enumerate(zip(distances, index.radii, index.sizes)):
        if not n or d - r > within or d + r < beyond:
            continue
        cond = F.col("centroid_id") == c
        if np.isfinite(within):
            cond = cond & F.col(SPREAD_COL).between(float(d - within), float(d + within))
        if beyond > d:
            cond = cond & (F.col(SPREAD_COL) >= float(beyond - d))
        parts = cond if parts is None else parts | cond
    return parts


def _approximate(index: IvfIndex, q: Sequence[float]) -> Column:
    """Squared distance of a row's code to the query; exact without codes."""
    if index.index_type == "IVF_PQ":
        return ivf.pq_distance(F.col("pq_codes"), ivf.pq_lut(index, q))
    if index.index_type == "IVF_SQ":
        return squared_l2(ivf.sq_decode(F.col("sq_codes"), index.sq_lo, index.sq_hi), list(q))
    return squared_l2(F.col(index.column), list(q))


def _eligible(rows: DataFrame, index: IvfIndex, table: DataFrame | None, where) -> DataFrame:
    """Index rows whose table rows pass a prefilter: a semi join by identity,
    for which the table gives the filter's columns only."""
    if where is None:
        return rows
    if table is None:  # the filter then names columns of the index
        return knn_ops._where(rows, where)
    if index.has_files:
        passed = ivf.with_row_identity(knn_ops._where(table, where)).select(*index.identity)
    else:
        passed = knn_ops._where(table, where).select(*index.identity)
    return rows.join(passed, index.identity, "left_semi")


def _complete_rows(index: IvfIndex, rows: DataFrame, q: Sequence[float], k: int, nprobes: int,
                   distance_range: tuple[float, float] | None) -> DataFrame:
    """Rows among which the true result is."""
    distances = _centroid_distances(index, q)
    error = F.col(ERROR_COL) if index.codes_col else F.lit(0.0)
    rows = rows.withColumn("_code_distance", F.sqrt(F.greatest(F.lit(0.0), _approximate(index, q))))
    if distance_range is not None:
        low, high = (np.sqrt(max(0.0, float(x))) for x in distance_range)
        reach = _reach(index, distances, high, low)
        if reach is None:
            return rows.where(F.lit(False))
        return rows.where(reach).where(F.col("_code_distance") - error <= high * (1 + SLACK) + SLACK)
    order = [int(c) for c in np.lexsort((np.arange(len(distances)), distances))]
    probes = max(1, nprobes)
    while True:
        # k numbers: upper bounds of the true distances.
        upper = (rows.where(F.col("centroid_id").isin(order[:probes]))
                 .select((F.col("_code_distance") + error).alias("u")).orderBy("u").limit(k).collect())
        if len(upper) == k or probes >= len(order):
            break
        probes = min(len(order), 4 * probes)
    worst = upper[-1]["u"] if len(upper) == k else float("inf")
    reach = _reach(index, distances, worst)
    if reach is None:
        return rows.where(F.lit(False))
    return rows.where(reach).where(F.col("_code_distance") - error <= worst * (1 + SLACK) + SLACK)


def _with_columns(spark: SparkSession, index: IvfIndex, hits: DataFrame, table: DataFrame | None,
                  k: int, tie_breakers: Sequence[str]) -> DataFrame:
    """Hits with the columns of their table rows. There are at most k, so
    their files, or keys, go into the scan's filter."""
    if table is None:
        return hits.drop(*[c for c in (FILE_COL, ROW_COL) if c in hits.columns])
    found = hits.select(*index.identity, knn_ops.DIST_COL).limit(k).collect()
    small = spark.createDataFrame(found, hits.select(*index.identity, knn_ops.DIST_COL).schema)
    if index.has_files:
        rows = table.where(_in_files({r[FILE_COL] for r in found}) if found else F.lit(False))
        rows = ivf.with_row_identity(rows)
        rows = rows.where(F.col(ROW_COL).isin([r[ROW_COL] for r in found]))
    else:
        first = index.identity[0]
        rows = table.where(F.col(first).isin([r[first] for r in found]))
    out = rows.join(F.broadcast(small), index.identity)  # k rows
    return (out.drop(*[c for c in (FILE_COL, ROW_COL) if c in out.columns])
            .orderBy(knn_ops.DIST_COL, *tie_breakers))


def ivf_search(spark: SparkSession, index: IvfIndex | str, q: Sequence[float], k: int = 10,
               nprobes: int = 1, where: str | Column | None = None,
               distance_range: tuple[float, float] | None = None, refine_factor: int = 10,
               tie_breakers: Sequence[str] = (), unindexed: DataFrame | None = None,
               table: DataFrame | None = None, complete: bool = False) -> DataFrame:
    """Top-k through the index; exact with a prefilter, a range or ``complete``.

    With ``table`` the hits carry its columns, and files written after the
    build are searched as well; without, they have the key, the vector and the
    distance, and ``where`` may name these alone. ``unindexed`` adds rows to be
    searched by brute force. Tie breakers must be columns of the index (its
    key) unless no rows can tie.
    """
    if isinstance(index, str):
        index = ivf.load_index(spark, index)
    if len(q) != index.dim:
        raise ValueError(f"query has {len(q)} dimensions, index has {index.dim}")
    rows = _eligible(_members(spark, index, table), index, table, where)
    complete = complete or where is not None or distance_range is not None
    if complete:
        cand = _complete_rows(index, rows, q, k, nprobes, distance_range)
    else:
        cand = rows.where(F.col("centroid_id").isin(ivf.probe_ids(index, q, nprobes)))
        if index.codes_col:
            cand = (cand.withColumn("_approx", _approximate(index, q))
                    .orderBy("_approx", *tie_breakers).limit(k * max(1, refine_factor)))
    held = [*dict.fromkeys([*index.key, *index.identity]), index.column]
    cand = cand.select(*held)
    tail = fresh_rows(spark, index, table) if table is not None else None
    if tail is not None:
        cand = cand.unionByName(knn_ops._where(tail, where).select(*held))
    if unindexed is not None:
        extra = knn_ops._where(unindexed, where).select(*index.key, index.column)
        cand = cand.unionByName(extra, allowMissingColumns=True)
    hits = knn_ops.knn(cand, index.column, list(q), k, distance_range=distance_range,
                       tie_breakers=[t for t in tie_breakers if t in cand.columns])
    return _with_columns(spark, index, hits, table, k, tie_breakers)


# ---------------------------------------------------------------------------
# Many queries
# ---------------------------------------------------------------------------

def _probe_kernel(centroids: list, nprobes: int, cells: list[int], dim: int, id_type: pa.DataType):
    """Each query once for every cell of its nearest partitions."""
    centers = np.asarray(centroids, dtype=np.float64)
    counts = np.asarray(cells, dtype=np.int64)
    c2 = (centers * centers).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                mat = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                d = c2 - 2.0 * (mat.astype(np.float64) @ centers.T)
                near = np.argsort(d, axis=1, kind="stable")[:, :nprobes]
                query = np.repeat(np.arange(len(mat)), near.shape[1])
                part_of = near.ravel()
                times = counts[part_of]
                query, part_of = np.repeat(query, times), np.repeat(part_of, times)
                cell = np.arange(len(query)) - np.repeat(np.cumsum(times) - times, times)
                for lo in range(0, len(query), 1000):
                    hi = min(lo + 1000, len(query))
                    take = pa.array(query[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part_of[lo:hi], pa.int32()), pa.array(cell[lo:hi], pa.int32()),
                         part.column("query_id").take(take), part.column("v").take(take)],
                        schema=pa.schema([("centroid_id", pa.int32()), ("cell", pa.int32()),
                                          ("query_id", id_type), ("v", pa.list_(pa.float32()))]))
    return run


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def best_rows(mat: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, squared distance) of the k nearest rows of each query, the
    first rows of equals; products choose, plain sums decide."""
    r2, q2 = (mat * mat).sum(axis=1), (queries * queries).sum(axis=1)
    d = r2[None, :] - 2.0 * (queries @ mat.T)
    out_q, out_r, out_d = [], [], []
    k = min(k, len(mat))
    kth = np.partition(d, k - 1, axis=1)[:, k - 1]
    close = d <= (kth + ROUNDING * (q2 + r2.max()))[:, None]
    for i in range(len(queries)):
        at = np.flatnonzero(close[i])
        exact = ((mat[at] - queries[i]) ** 2).sum(axis=1)
        order = np.argsort(exact, kind="stable")[:k]
        out_q.append(np.full(len(order), i))
        out_r.append(at[order])
        out_d.append(exact[order])
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_d)


def _cell_kernel(index: IvfIndex, k: int, fields: list[tuple[str, pa.DataType]]):
    """Best k rows of a cell for each query that comes to it."""
    schema = pa.schema(fields)
    carried = [name for name, _ in fields if name not in ("query_id", "distance")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, rows, mat = None, [], None
        for batch in batches:
            place = batch.column("centroid_id").to_numpy().astype(np.int64) << 32 | \
                batch.column("cell").to_numpy().astype(np.int64)
            kind = batch.column("kind").to_numpy()
            change = np.flatnonzero((np.diff(place, prepend=place[:1] - 1) != 0)
                                    | (np.diff(kind, prepend=kind[:1]) != 0)).tolist()
            for lo, hi in zip(change, [*change[1:], batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                if place[lo] != of:
                    of, rows, mat = place[lo], [], None
                if kind[lo] == 0:
                    rows.append(part)
                    continue
                if not rows:
                    continue
                if mat is None:
                    held = pa.Table.from_batches(rows).combine_chunks()
                    if index.codes_col:
                        codes = held.column("codes").combine_chunks()
                        mat = ivf.decode_codes(index, _matrix(codes, len(codes[0])).astype(np.int64))
                    else:
                        mat = _matrix(held.column("v").combine_chunks(), index.dim).astype(np.float64)
                queries = _matrix(part.column("v"), index.dim).astype(np.float64)
                step = max(1, PRODUCT_CELLS // len(mat))
                for at in range(0, len(queries), step):
                    q, r, d = best_rows(mat, queries[at:at + step], k)
                    columns = {"query_id": part.column("query_id").take(pa.array(q + at)), "distance": pa.array(d)}
                    for name in carried:
                        columns[name] = held.column(name).combine_chunks().take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)
    return run


def _ranked(found: DataFrame, k: int, key: Sequence[str]) -> DataFrame:
    """The k nearest of each query; Spark limits each task's before the shuffle."""
    order = Window.partitionBy("query_id").orderBy("distance", *key)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_many(spark: SparkSession, index: IvfIndex | str, queries: DataFrame, k: int = 10,
                nprobes: int = 1, refine_factor: int = 10, cell_rows: int = CELL_ROWS,
                query_id: str = "query_id", query_vector: str | None = None) -> DataFrame:
    """(query_id, key columns, distance, rank, centroid_id): the top-k of every
    query. Queries without a vector have no result; ids should be distinct."""
    if isinstance(index, str):
        index = ivf.load_index(spark, index)
    vector = query_vector or index.column
    asked = (queries.where(F.col(vector).isNotNull())
             .select(F.col(query_id).alias("query_id"), F.col(vector).cast("array<float>").alias("v")))
    cells = [max(1, -(-n // cell_rows)) for n in index.sizes]
    per_part = F.element_at(F.array(*[F.lit(c) for c in cells]), F.col("centroid_id") + 1)
    kept = [*dict.fromkeys([*index.key, *index.identity])]
    rows = spark.read.parquet(index.data_path).withColumn(
        "cell", F.pmod(F.xxhash64(*index.identity), per_part).cast("int"))
    payload = F.col(index.codes_col).alias("codes") if index.codes_col else \
        F.col(index.column).cast("array<float>").alias("v")
    data = rows.select(F.col("centroid_id").cast("int").alias("centroid_id"), "cell", F.lit(0).alias("kind"),
                       *kept, payload)
    id_field = asked.schema["query_id"].dataType
    probes = asked.mapInArrow(
        _probe_kernel(index.centroids, min(nprobes, len(index.centroids)), cells, index.dim, to_arrow_type(id_field)),
        f"centroid_id int, cell int, query_id {id_field.simpleString()}, v array<float>")
    met = (data.unionByName(probes.withColumn("kind", F.lit(1)), allowMissingColumns=True)
           .repartition("centroid_id", "cell").sortWithinPartitions("centroid_id", "cell", "kind", *index.key))
    types = {c: rows.schema[c].dataType for c in kept}
    fields = [("query_id", id_field), *types.items()]
    arrow = [(n, to_arrow_type(t)) for n, t in fields] + [("centroid_id", pa.int32()), ("distance", pa.float64())]
    shape = ", ".join([*(f"`{n}` {t.simpleString()}" for n, t in fields), "centroid_id int", "distance double"])
    take = k * max(1, refine_factor) if index.codes_col else k
    found = _ranked(met.mapInArrow(_cell_kernel(index, take, arrow), shape), take, index.key)
    if index.codes_col:
        # Exact distances of the best by code; vectors come by identity.
        exact = rows.select(*index.identity, F.col(index.column).alias("_vector"))
        found = (found.drop("rank", "distance").join(exact, index.identity)
                 .join(asked.withColumnRenamed("v", "_query"), "query_id")
                 .withColumn("distance", squared_l2(F.col("_vector"), F.col("_query")))
                 .drop("_vector", "_query"))
        found = _ranked(found, k, index.key)
    return found.select("query_id", *index.key, "distance", F.col("rank").cast("long").alias("rank"), "centroid_id")


def recall(found: DataFrame, truth: DataFrame, key: Sequence[str]) -> DataFrame:
    """(query_id, n_true, n_found): how many of each query's true neighbours
    a search has found."""
    pairs = ["query_id", *key]
    hit = found.select(*pairs).withColumn("_hit", F.lit(1))
    return (truth.select(*pairs).join(hit, pairs, "left").groupBy("query_id")
            .agg(F.count(F.lit(1)).alias("n_true"), F.count("_hit").alias("n_found")))


def tune_probes(spark: SparkSession, index: IvfIndex, queries: DataFrame, k: int = 10, target: float = 0.95,
                sample: int = 256, seed: int = 7, **names) -> int:
    """The fewest partitions that hold a share of ``target`` of the true
    neighbours of at most about ``sample`` queries.

    One exact search of the sample says in which partition each true neighbour
    is; its place in the query's order of partitions is what counts.
    """
    n = queries.count()
    some = queries.sample(min(1.0, sample / max(1, n)), seed=seed) if n > sample else queries
    query_id = names.get("query_id", "query_id")
    vector = names.get("query_vector") or index.column
    flat = IvfIndex(**{**index.__dict__, "index_type": "IVF_FLAT"})
    found = search_many(spark, flat, some, k, nprobes=len(index.centroids), **names)
    asked = some.select(F.col(query_id).alias("query_id"), F.col(vector).alias("_v"))
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in index.centroids])
    by_distance = F.array_sort(F.transform(centers, lambda c, i: F.struct(
        squared_l2(F.col("_v"), c).alias("d"), i.cast("int").alias("i"))))
    order = asked.withColumn("_order", F.transform(by_distance, lambda s: s["i"])).drop("_v")
    places = (found.join(order, "query_id")
              .groupBy(F.array_position("_order", F.col("centroid_id")).alias("place")).count()
              .orderBy("place").collect())
    total, reached = sum(r["count"] for r in places), 0
    for r in places:
        reached += r["count"]
        if reached >= target * total:
            return int(r["place"])
    return len(index.centroids)
