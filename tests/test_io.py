import os
import tempfile

import pytest

from mediatables.sources import fileset, readers, sinks
from tests.media_fixtures import write_jsonl

ROWS = [("a.jpg", "s3://bkt/a.jpg", 1), ("b.jpg", "s3://bkt/b.jpg", 2)]


def test_manifest_formats_drop_extra(spark, tmp):
    df = spark.createDataFrame(ROWS, "doc_id string, s3_url string, extra bigint")
    pq = os.path.join(tmp, "manifest.parquet")
    df.write.parquet(pq)
    js = os.path.join(tmp, "manifest.JSONL")
    write_jsonl(js, [{"doc_id": a, "s3_url": b, "extra": c} for a, b, c in ROWS])
    nd = os.path.join(tmp, "manifest.ndjson")
    write_jsonl(nd, [{"doc_id": a, "s3_url": b} for a, b, _ in ROWS])
    csv = os.path.join(tmp, "manifest.csv")
    with open(csv, "w") as fp:
        fp.write("doc_id,s3_url,extra\n" + "".join(f"{a},{b},{c}\n" for a, b, c in ROWS))
    for path in (pq, js, nd, csv):
        got = readers.read_manifest(spark, path)
        assert got.columns == ["doc_id", "s3_url"]
        assert sorted(tuple(r) for r in got.collect()) == [r[:2] for r in ROWS]
    for bad in ("manifest.xlsx", "manifest.json"):
        with pytest.raises(ValueError, match="Unsupported manifest format"):
            readers.read_manifest(spark, os.path.join(tmp, bad))


def test_table_write_mode(spark, tmp):
    path = os.path.join(tmp, "t")
    assert sinks.table_write_mode(spark, path) == "create"
    spark.range(3).write.parquet(path)
    assert sinks.table_write_mode(spark, path) == "append"


def test_analysis_output_dispatch(spark, tmp):
    df = spark.createDataFrame([("a", None)], "doc_id string, face_blur_score double")
    js = os.path.join(tmp, "out.jsonl")
    sinks.write_json(df, js)
    back = readers.read_analysis_output(spark, js, df.schema)
    assert back.dtypes == [("doc_id", "string"), ("face_blur_score", "double")]
    plain = spark.read.json(js)
    assert "face_blur_score" in plain.columns             # null fields were kept on write
    tab = os.path.join(tmp, "staging")                    # no suffix, local Parquet dir -> table
    sinks.write_staging(df, tab)
    assert readers.read_analysis_output(spark, tab).count() == 1
    jdir = os.path.join(tmp, "jsondir")                   # no suffix, JSON files -> JSON
    sinks.write_json(df, jdir)
    assert readers.read_analysis_output(spark, jdir, df.schema).count() == 1


def test_output_mode_validation():
    with pytest.raises(ValueError):
        sinks.validate_output_mode("out.jsonl", embed=True)
    with pytest.raises(ValueError):
        sinks.validate_output_mode("out.parquet", embed=False)
    sinks.validate_output_mode("out.jsonl", embed=False)
    sinks.validate_output_mode("out.parquet", embed=True)


def test_blob_validation(spark):
    df = spark.createDataFrame([("ok", b"x"), ("ok", None), ("decode_failed", None)], "status string, blob binary")
    audit = sinks.validate_blob_column(df, "blob").first()
    assert (audit.rows, audit.ok_without_blob) == (3, 1)
    with pytest.raises(ValueError):
        sinks.validate_blob_column(df.selectExpr("status", "cast(blob as string) as blob"), "blob")


def test_virtual_paths_and_registry(spark):
    df = spark.createDataFrame([("gvfs://fileset/cat/sch/imgs/a/b.jpg",), ("gvfs://fileset/cat/sch/imgs",),
                                ("gvfs://fileset/cat/sch/other/x",)], "path string")
    reg = spark.createDataFrame([("cat", "sch", "imgs", "s3a://bucket/images/")],
                                "catalog string, schema string, fileset string, location string")
    got = [r.location for r in fileset.resolve_fileset_uri(df, reg).collect()]
    assert got == ["s3://bucket/images/a/b.jpg", "s3://bucket/images", None]


def test_object_store_conf():
    conf = fileset.object_store_conf("http://minio:9000", "k", "s", "us-east-1", use_ssl=False)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://minio:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_globs_and_listing(spark, tmp):
    for i in range(3):
        spark.createDataFrame([(i, f"n{i}", i * 1.5)], "id bigint, name string, score double") \
            .write.parquet(os.path.join(tmp, "data", f"part{i}.parquet"))
        spark.createDataFrame([(i, f"n{i}")], "id bigint, name string").write.option("header", True) \
            .csv(os.path.join(tmp, "csv", f"f{i}"))
    assert readers.read_parquet_glob(spark, os.path.join(tmp, "data", "*.parquet")).count() == 3
    assert readers.read_csv_glob(spark, os.path.join(tmp, "csv", "*")).count() == 3
    listing = readers.list_files(spark, os.path.join(tmp, "data"))
    assert listing.columns == ["path", "length", "modificationTime"]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1][:200]


def test_session_conf_restores_and_scale_conf(spark):
    from mediatables.session import scale_conf, session_conf
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "7"
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    conf = scale_conf(100 * 2**40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600


def test_catalog_samples_through_virtual_paths(spark, tmp):
    """(id, name, score) written and read as parquet / CSV / JSON via virtual paths."""
    reg = spark.createDataFrame([("cat", "sch", "samples", "file://" + tmp + "/samples/")],
                                "catalog string, schema string, fileset string, location string")
    rows = [(1, "alice", 90.5), (2, "bob", 85.0), (3, "carol", 77.25), (4, "dave", 60.0), (5, "eve", 99.9)]
    df = spark.createDataFrame(rows, "id bigint, name string, score double")
    for fmt in ("parquet", "csv", "json"):
        fileset.write_fileset(df, reg, f"gvfs://fileset/cat/sch/samples/{fmt}/data", fmt)
        back = fileset.read_fileset(spark, reg, f"gvfs://fileset/cat/sch/samples/{fmt}/*", fmt,
                                    **({"inferSchema": True} if fmt == "csv" else {}))
        assert sorted((int(r.id), r.name, float(r.score)) for r in back.collect()) == rows
    with pytest.raises(ValueError):
        fileset.resolve_path(reg, "gvfs://fileset/cat/sch/nope/x")
    assert fileset.resolve_path(reg, "/plain/path") == "/plain/path"


def test_per_row_fetch_and_desc_formats(spark, tmp):
    from mediatables.sources import fetch
    good = os.path.join(tmp, "a.bin")
    with open(good, "wb") as fp:
        fp.write(b"abc")
    m = spark.createDataFrame([("a", good), ("b", os.path.join(tmp, "gone.bin")), ("c", None)],
                              "doc_id string, s3_url string")
    got = {r.doc_id: r.content for r in fetch.fetch_content(m).collect()}
    assert got == {"a": bytearray(b"abc"), "b": None, "c": None}
    js = os.path.join(tmp, "desc.jsonl")
    write_jsonl(js, [{"doc_id": "a", "description": "x", "extra": 1}])
    csv = os.path.join(tmp, "desc.csv")
    with open(csv, "w") as fp:
        fp.write('doc_id,description\na,"multi\nline"\n')
    assert [tuple(r) for r in readers.read_desc_table(spark, js).collect()] == [("a", "x")]
    assert [tuple(r) for r in readers.read_desc_table(spark, csv).collect()] == [("a", "multi\nline")]


def test_fetch_reads_the_objects_of_the_manifest_alone(spark, tmp):
    from mediatables.sources import fetch
    data = {"a.bin": b"abc", "_under.bin": b"hidden", ".dot": b"x", "empty.bin": b""}
    for name, content in (data | {"unlisted.bin": b"never read"}).items():
        with open(os.path.join(tmp, name), "wb") as fp:
            fp.write(content)
    other = tempfile.mkdtemp()
    with open(os.path.join(other, "outside.bin"), "wb") as fp:
        fp.write(b"other")
    urls = [f"file://{tmp}/a.bin", f"file:{tmp}/_under.bin", f"{tmp}/.dot", f"{tmp}/empty.bin",
            f"{tmp}/gone.bin", f"{other}/outside.bin", tmp, None, f"{tmp}/empty.bin"]
    m = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "k int, s3_url string")
    want = [b"abc", b"hidden", b"x", b"", None, b"other", None, None, b""]
    for size in (1, 1 << 20):
        df = fetch.fetch_content(m, batch_bytes=size)
        got = {r.k: None if r.content is None else bytes(r.content) for r in df.collect()}
        assert got == dict(enumerate(want))
    assert "FileScan" not in df._jdf.queryExecution().toString()
    inside = {r.k: r.content for r in fetch.fetch_content(m, roots=[f"{tmp}/"]).collect()}
    assert inside[5] is None and inside[1] == bytearray(b"hidden")
    read = spark.sparkContext.accumulator(0)

    def counted(url):
        content = fetch.ObjectReader()(url)
        read.add(len(content or b""))
        return content

    fetch.fetch_content(m, counted).collect()
    assert read.value == sum(map(len, filter(None, want)))
    assert fetch.fetch_content(m.limit(0)).collect() == []


def test_fetch_of_an_unsupported_scheme_fails(spark):
    from mediatables.sources import fetch
    m = spark.createDataFrame([("a", "ftp://host/x")], "doc_id string, s3_url string")
    with pytest.raises(Exception, match="unsupported scheme"):
        fetch.fetch_content(m).collect()


def test_csv_of_several_splits(spark, tmp):
    from mediatables.session import session_conf
    path = f"{tmp}/many.csv"
    with open(path, "w") as fp:
        fp.write("extra,s3_url,doc_id\n" + "".join(f'"a ""q"", {k}",s3://b/{k},d{k}\n' for k in range(5000)))
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "20000"}):
        df = readers.read_manifest(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert {tuple(r) for r in df.collect()} == {(f"d{k}", f"s3://b/{k}") for k in range(5000)}


def test_csv_rows_that_do_not_fit(spark, tmp):
    from pyspark.sql import types as T
    path = f"{tmp}/bad.csv"
    with open(path, "w") as fp:
        fp.write("doc_id,s3_url\na,b\nc\nd,e,f\n")
    with pytest.raises(Exception, match="not a row of its header"):
        readers.read_manifest(spark, path).collect()
    loose = readers.read_csv(spark, path, strict=False)
    assert {r.doc_id: r[readers.CORRUPT_COL] for r in loose.collect()} == {"a": None, "c": "c", "d": "d,e,f"}
    typed = T.StructType([T.StructField("doc_id", T.IntegerType()), T.StructField("s3_url", T.StringType())])
    with pytest.raises(Exception, match="not a row of its header"):
        readers.read_csv_glob(spark, path, typed).collect()


def test_description_tables_have_declared_types(spark, tmp):
    for suffix, text in {"jsonl": '{"doc_id": 7, "description": "x"}\n{"doc_id": "a"}\n',
                         "csv": 'description,doc_id\n"x, y",7\n'}.items():
        path = f"{tmp}/desc.{suffix}"
        with open(path, "w") as fp:
            fp.write(text)
        df = readers.read_desc_table(spark, path)
        assert df.dtypes == [("doc_id", "string"), ("description", "string")] and df.first().doc_id == "7"
