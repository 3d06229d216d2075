"""Jaccard self-join of word shingles by chosen paths.

Documents with the same shingle set form one class, and the join runs on
classes. In each of several independent runs a class with set x follows
every token whose hash, seeded by the run, falls below 1 / (threshold * |x|);
classes on the same path meet in a bucket. A large bucket is split again by
newly sampled tokens as long as that costs fewer comparisons than comparing
the bucket itself. Small buckets, and large ones that do not split (groups of
near copies), are compared by brute force, the latter in square cells of
bounded side. The number of runs follows from the target recall.

A pair that meets in several buckets counts in the first of them only, so
link counts are exact sums over buckets, and no pair is ever emitted: a cell
gives each of its classes the number of its partners and one partner to
join components by.

Before sets are fetched, and again before they are compared, every bucket of up
to ``CELL`` classes is read with short sketches (one byte for the least hash in
each of 64 bins): a class stays in it only if some other class there has half
of its bytes in common, and before comparing only if the two have not met in an
earlier bucket. A pair at the threshold has that but for a chance of about
1e-8; sets too small to fill most bins always stay.

Tokens are 32-bit hashes of shingles, so two unrelated sets of n shingles
share about n * n / 2**32 of them by chance. Texts without words have no
links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import session_conf
from .common import small_batches, text_list, text_of, written
from .shingles import Shingler, mix

WIDTH = 5
THRESHOLD = Fraction(4, 5)
RECALL = 0.999
BRANCH = 4
MAX_DEPTH = 3
SMALL = 16
BINS = 64
CELL = 1024
COLUMNS = 4096
_TOKEN = np.dtype("<u4")
# Runtime filters for scans of any size; Spark's own bound on a filter stays.
BLOOM_CONF = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
              "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


def runs_for(recall: float, branch: int = BRANCH, depth: int = MAX_DEPTH) -> int:
    """Runs after which a pair at the threshold has met with this chance,
    even if each of its buckets is split to the full depth."""
    below = 1.0
    for _ in range(depth):
        below = 1 - math.exp(-branch * below)
    return math.ceil(math.log(1 - recall) / math.log(math.exp(-below)))


def chosen(tokens: np.ndarray, paths: np.ndarray, threshold: float, branch: float) -> list[np.ndarray]:
    """For each path, the paths that the set follows from there."""
    if not len(tokens):
        return [np.empty(0, np.uint64)] * len(paths)
    below = np.uint64(min(2.0 ** 64 - 2048, branch * 2.0 ** 64 / (threshold * len(tokens))))
    wide = tokens.astype(np.uint64)
    out = []
    for path in paths:
        drawn = mix(wide ^ mix(path[None])[0])
        out.append(mix(drawn[drawn < below] + path))
    return out


def token_set(shingler: Shingler, text: str) -> tuple[bytes, np.ndarray]:
    """The class of a text (a digest of its shingle set) and its tokens."""
    full = np.unique(shingler.sequence(text))
    return xxhash.xxh3_128_digest(full.tobytes()), np.unique((full >> np.uint64(32)).astype(_TOKEN))


def sketch(tokens: np.ndarray) -> bytes:
    """Per bin of the scrambled tokens the low byte of the least, and 0 for an
    empty bin."""
    drawn = np.sort(mix(tokens.astype(np.uint64)))
    bins, first = np.unique((drawn >> np.uint64(58)).astype(np.int64), return_index=True)
    out = np.zeros(BINS, np.uint8)
    out[bins] = (drawn[first] & np.uint64(255)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def alike(sketches: np.ndarray) -> np.ndarray:
    """Pairs of rows that may be near. They are, unless they agree in fewer
    than half of the bins that either fills, and those are 32 or more."""
    filled = (sketches > 0).astype(np.float32)
    n = filled.sum(axis=1)
    either = n[:, None] + n[None, :] - filled @ filled.T
    same = np.zeros((len(sketches),) * 2, np.int16)
    for k in range(BINS):
        column = sketches[:, k]
        same += (column[:, None] == column[None, :]) & (column > 0)
    near = (2 * same >= either) | (either < 32)
    np.fill_diagonal(near, False)
    return near


SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("key", T.LongType()), T.StructField("rid", T.BinaryType()),
    T.StructField("size", T.IntegerType()), T.StructField("paths", T.ArrayType(T.LongType())),
    T.StructField("sketch", T.BinaryType()),
])


def _sign(width: int, threshold: float, runs: int):
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            found = [token_set(shingler, t) for t in text_list(batch.column(2))]
            paths = [np.concatenate(chosen(t, roots, threshold, 1.0)).view(np.int64) for _, t in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([r for r, _ in found], pa.binary()),
                pa.array([len(t) for _, t in found], pa.int32()), pa.array(paths, pa.list_(pa.int64())),
                pa.array([sketch(t) for _, t in found], pa.binary()),
            ], names=SIGNED.names)

    return run


SETS = T.StructType([
    T.StructField("rid", T.BinaryType()), T.StructField("weight", T.LongType()),
    T.StructField("tokens", T.BinaryType()),
])


def _load(width: int):
    """Token sets of the classes' representatives, from rows in which those of
    a class are neighbours; equal rows give one set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        before = None
        for batch in batches:
            kept = []
            for text, rid, weight in zip(text_list(batch.column(0)), *(batch.column(k).to_pylist() for k in (1, 2))):
                if rid == before:
                    continue
                own, tokens = token_set(shingler, text)
                # Another row may share the 64 bits of the key.
                if own == rid:
                    kept.append((rid, weight, tokens.tobytes()))
                    before = rid
            columns = zip(*kept) if kept else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.binary()))], names=SETS.names)

    return run


CHILDREN = T.StructType([
    T.StructField("rid", T.BinaryType()), T.StructField("parent", T.LongType()),
    T.StructField("path", T.LongType()),
])


def _split(threshold: float, branch: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, parents, paths = [], [], []
            for rid, data, at in zip(*(batch.column(k).to_pylist() for k in range(3))):
                origin = np.array(at, np.int64)
                for parent, below in zip(at, chosen(np.frombuffer(data, _TOKEN), origin.view(np.uint64),
                                                    threshold, branch)):
                    rids += [rid] * len(below)
                    parents += [parent] * len(below)
                    paths += below.view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.binary()), pa.array(parents, pa.int64()), pa.array(paths, pa.int64())],
                names=CHILDREN.names)

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of bounded column blocks."""
    m = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, m)
    owner = np.repeat(np.arange(m), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = counts > 1
    number = np.cumsum(common) - 1
    kept = common[column]
    owner, column = owner[kept], number[column[kept]]
    total = int(common.sum())
    out = np.zeros((m, m), np.float64 if total >= 1 << 24 else np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        block = np.zeros((m, min(COLUMNS, total - low)), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        out += block @ block.T
    return out


def compare(rows: list[tuple], path: int, threshold: Fraction) -> Iterator[tuple[bytes, bytes, int]]:
    """Partners of each class in a cell: (class, a class of its component,
    documents linked). Rows are (block, class, documents, tokens, paths)."""
    m = len(rows)
    sets = [np.frombuffer(r[3], _TOKEN) for r in rows]
    sizes = np.fromiter(map(len, sets), np.int64, m)
    top, base = threshold.numerator, threshold.denominator
    if m == 2:
        low, high = sorted(sizes.tolist())
        if base * low < top * high:
            return
    need = top * (sizes[:, None] + sizes[None, :])
    linked = (top + base) * shared_counts(sets) >= need
    np.fill_diagonal(linked, False)
    blocks = np.array([r[0] for r in rows])
    if blocks.min() != blocks.max():
        linked &= blocks[:, None] != blocks[None, :]
    if not linked.any():
        return
    earlier = [np.array([p for p in r[4] if p < path], np.int64) for r in rows]
    if any(map(len, earlier)):
        linked &= shared_counts(earlier) == 0
    weights = np.array([r[2] for r in rows], np.int64)
    label = np.arange(m)
    while True:
        near = np.where(linked, label[None, :], m).min(axis=1)
        lower = np.minimum(label, near)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    for k in np.flatnonzero(linked.any(axis=1)):
        yield rows[k][1], rows[label[k]][1], int(weights[linked[k]].sum())


LINKS = T.StructType([
    T.StructField("rid", T.BinaryType()), T.StructField("other", T.BinaryType()),
    T.StructField("links", T.LongType()),
])


def _compare_cells(threshold: Fraction):
    """Task body over rows sorted by cell (path, row block, column block)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(cell, rows) -> Iterator[pa.RecordBatch]:
            distinct = list({(r[0], r[1]): r for r in rows}.values())
            found = list(compare(distinct, cell[0], threshold)) if len(distinct) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.binary(), pa.binary(), pa.int64()))],
                    names=LINKS.names)

        now, rows = None, []
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                cell = values[:3]
                if cell != now:
                    if rows:
                        yield from solved(now, rows)
                    now, rows = cell, []
                rows.append(values[3:])
        if rows:
            yield from solved(now, rows)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the least node.

    Alternates large-star and small-star until nothing changes; each round
    is written, so no lineage grows.
    """
    def checked(frame: DataFrame, name: str):
        table = written(frame.where("u != v").distinct(), name)
        row = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return table, tuple(row)

    now, before = checked(edges, "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        rest = least.select("u", F.col("m").alias("v"))
        now, after = checked(small.union(rest), "edges")
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


KEPT = T.StructType([T.StructField("path", T.LongType()), T.StructField("rid", T.BinaryType())])


def _prefilter(first_only: bool):
    """Classes that may have a partner in their bucket, from rows sorted by it;
    with ``first_only`` one that they meet there first, by their paths."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def solved() -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            near = alike(np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, BINS))
            if first_only and near.any():
                earlier = [np.array([p for p in r[2] if p < now], np.int64) for r in rows]
                if any(map(len, earlier)):
                    near &= shared_counts(earlier) == 0
            kept = [r[0] for r, stays in zip(rows, near.any(axis=1)) if stays]
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([now] * len(kept), pa.int64()), pa.array(kept, pa.binary())], names=KEPT.names)

        for batch in batches:
            for path, *row in zip(*(batch.column(c).to_pylist() for c in ("path", "rid", "sketch", "paths"))):
                if path != now:
                    yield from solved()
                    now, rows = path, []
                rows.append(row)
        yield from solved()

    return run


def _likely(buckets: DataFrame, classes: DataFrame, cell: int, first_only: bool) -> DataFrame:
    """(rid, path, n) of buckets: those of up to ``cell`` classes without the
    classes that have no likely partner there."""
    inside = F.col("n") <= cell
    if first_only:
        paths = buckets.groupBy("rid").agg(F.collect_list("path").alias("paths"))
    else:
        paths = buckets.select("rid").distinct().withColumn("paths", F.lit(None).cast("array<long>"))
    info = classes.select("rid", "sketch").join(paths, "rid")
    # Few bytes, much work: not to be merged into few tasks.
    tasks = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = (buckets.where(inside).select("rid", "path").join(info, "rid").repartition(tasks, "path")
            .sortWithinPartitions("path").mapInArrow(_prefilter(first_only), KEPT).distinct())
    counts = kept.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    return kept.join(counts, "path").select("rid", "path", "n").union(
        buckets.where(~inside).select("rid", "path", "n"))


def _row_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(f"`{id_col}`"), text_of(text_col))


def near_classes(docs: DataFrame, threshold: Fraction = THRESHOLD, width: int = WIDTH, recall: float = RECALL,
                 small: int = SMALL, cell: int = CELL, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: its class (the least id among the documents it
    is linked to, directly or through others) and its number of links.

    Null text reads as empty; a text without words is a class of its own. A
    null id takes part but never names a class unless all ids there are null.
    Repeated rows are documents of their own, linked to each other. Extra
    columns are ignored; an empty table gives no rows.
    """
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                         _row_key(id_col, text_col).alias("key"))
    found = _classes(narrow, threshold, width, recall, small, cell)
    return found.select("doc_id", F.col("first.doc_id").alias("class_id"), "n_links")


def _classes(narrow: DataFrame, threshold: Fraction = THRESHOLD, width: int = WIDTH, recall: float = RECALL,
             small: int = SMALL, cell: int = CELL) -> DataFrame:
    """(doc_id, key, first, n_links) of rows (doc_id, text, key): ``first`` is
    the row of the class with the least id, and among those of the least key."""
    small_batches(narrow.sparkSession)
    limit = float(threshold)
    signed = written(narrow.select("doc_id", "key", "text")
                     .mapInArrow(_sign(width, limit, runs_for(recall)), SIGNED), "near-signed")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    classes = signed.where("size > 0").groupBy("rid").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("weight"), F.any_value("paths").alias("paths"),
        F.any_value("sketch").alias("sketch"))
    classes = written(classes, "near-classes")

    # Buckets of two classes or more, in the first level of every run.
    members = classes.select("rid", F.explode("paths").alias("path")).distinct()
    sizes = members.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(members.join(sizes, "path").select("rid", "path", "n"), "near-buckets")
    members = written(_likely(members, classes, cell, False), "near-likely")
    wanted = (members.select("rid").distinct().join(
        classes.select("rid", F.col("first.key").alias("key"), "weight").where("weight > 0"), "rid"))
    wanted = written(wanted, "near-wanted")
    # Where the wanted keys are few enough, Spark sends a filter of them to the
    # scan of the texts; their number decides, not ours.
    with session_conf(narrow.sparkSession, BLOOM_CONF):
        sets = (narrow.join(wanted.where("weight > 0"), "key").select("text", "rid", "weight")
                .mapInArrow(_load(width), SETS))
        sets = written(sets, "near-sets")

    final = members.where(F.col("n") <= small).select("rid", "path", "n")
    large = members.where(F.col("n") > small).select("rid", "path", "n")
    for _ in range(MAX_DEPTH):
        if large.isEmpty():
            break
        grouped = large.groupBy("rid").agg(F.collect_list("path").alias("paths"))
        below = written(sets.select("rid", "tokens").join(grouped, "rid").select("rid", "tokens", "paths")
                        .mapInArrow(_split(limit, BRANCH), CHILDREN).distinct(), "near-children")
        counted = below.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        cost = counted.groupBy("parent").agg(F.sum(F.col("n") * F.col("n")).alias("cost"))
        whole = large.select("path", "n").distinct().join(cost.withColumnRenamed("parent", "path"), "path", "left")
        dense = whole.where(F.col("cost") >= F.col("n") * F.col("n")).select("path")
        final = final.union(large.join(dense, "path", "left_semi").select("rid", "path", "n"))
        kept = counted.join(dense.withColumnRenamed("path", "parent"), "parent", "left_anti")
        below = written(below.join(kept, ["parent", "path"]).select("rid", "path", "n").distinct(), "near-buckets")
        final = final.union(below.where(F.col("n") <= small))
        large = below.where(F.col("n") > small)
    final = written(final.union(large), "near-final")
    final = written(_likely(final, classes, cell, True), "near-cells")

    side = F.ceil(F.col("n") / cell).cast("int")
    block = F.pmod(F.xxhash64("rid"), F.col("side")).cast("int")
    placed = (final.withColumn("side", side).withColumn("block", block)
              .groupBy("rid").agg(F.collect_list(F.struct("path", "side", "block")).alias("places")))
    cells = (sets.join(placed, "rid")
             .select("rid", "weight", "tokens", F.sort_array(F.col("places.path")).alias("paths"),
                     F.explode("places").alias("p"))
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("p.side") - 1)))
             .select(F.col("p.path").alias("path"), F.least("p.block", "k").alias("i"),
                     F.greatest("p.block", "k").alias("j"), F.col("p.block").alias("block"),
                     "rid", "weight", "tokens", "paths"))
    cells = cells.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")
    links = written(cells.mapInArrow(_compare_cells(threshold), LINKS), "near-links")

    degrees = links.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("rid").alias("u"), F.col("other").alias("v")))
    rooted = classes.select("rid", "first", "weight").join(
        roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    named = rooted.groupBy("root").agg(F.min("first").alias("least"))
    info = (rooted.join(named, "root").join(degrees, "rid", "left")
            .select("rid", F.col("least").alias("first"),
                    (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    found = signed.where("size > 0").select("doc_id", "key", "rid").join(info, "rid")
    return found.select("doc_id", "key", "first", "n_links").union(signed.where("size = 0").select(
        "doc_id", "key", first.alias("first"), F.lit(0).cast("long").alias("n_links")))


def drop_near_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the least-id document of each class; all columns kept.

    Rows are known by id and text together, so ids may repeat or be null, and
    of any type (ids that are no numbers count as null when the least is
    chosen); rows equal in both stay or go together.
    """
    narrow = docs.select(F.expr(f"try_cast(`{id_col}` AS bigint)").alias("doc_id"), text_of(text_col).alias("text"),
                         _row_key(id_col, text_col).alias("key"))
    gone = _classes(narrow, **options).where(F.col("key") != F.col("first.key")).select("key").distinct()
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       _row_key(id_col, text_col).alias("key"))
    return held.join(gone, "key", "left_anti").select("row.*")
