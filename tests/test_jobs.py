import os

import numpy as np
import pandas as pd
import pytest

from mediatables.operators.media import ImageQuality, rms_zcr_embedding
from mediatables.plans import jobs, query
from tests.media_fixtures import box_blur, checkerboard, png_bytes, wav_bytes, write_jsonl


class MarkerDetector:
    """Finds one face in images whose top-left pixel is pure red."""

    def detect(self, img):
        if img[0, 0, 2] == 255 and img[0, 0, 0] == 0:
            h, w = img.shape[:2]
            return [{"bbox": (w * 0.25, h * 0.25, w * 0.75, h * 0.75), "score": 0.9},
                    {"bbox": (0, 0, 4, 4), "score": 0.99}]
        return []


def quality_with_marker():
    return ImageQuality(MarkerDetector())


class FakeImageEmbedder:
    def embed_image_batch(self, blobs):
        return [[float(len(b) % 7), 1.0] + [0.0] * 510 for b in blobs]


def _media(tmp):
    d = os.path.join(tmp, "media")
    os.makedirs(d)
    sharp = checkerboard()
    sharp[0, 0] = [255, 0, 0]
    blurred = box_blur(checkerboard())
    blurred[0, 0] = [255, 0, 0]
    for name, img in [("face_sharp.png", sharp), ("face_blurred.png", blurred),
                      ("no_face.png", np.full((32, 32, 3), 255, np.uint8))]:
        with open(os.path.join(d, name), "wb") as fp:
            fp.write(png_bytes(img))
    with open(os.path.join(d, "corrupt.png"), "wb") as fp:
        fp.write(b"this is not an image")
    return d


def test_image_pipeline_end_to_end(spark, tmp):
    media = _media(tmp)
    manifest = os.path.join(tmp, "manifest.parquet")
    names = ["face_sharp.png", "face_blurred.png", "no_face.png", "corrupt.png", "missing.png"]
    spark.createDataFrame([(n, f"file://{media}/{n}") for n in names], "doc_id string, s3_url string") \
        .write.parquet(manifest)
    out = os.path.join(tmp, "analysis.jsonl")
    jobs.analyze_images(spark, manifest, out, roots=[media], quality_factory=quality_with_marker)
    rows = {r.doc_id: r for r in spark.read.json(out).collect()}
    assert len(rows) == 5
    assert {k: v.status for k, v in rows.items()} == {
        "face_sharp.png": "ok", "face_blurred.png": "ok", "no_face.png": "ok",
        "corrupt.png": "decode_failed", "missing.png": "download_failed"}
    assert rows["face_sharp.png"].blur_score > rows["face_blurred.png"].blur_score
    assert rows["face_sharp.png"].face_count == 2 and rows["face_sharp.png"].has_face is True
    assert rows["face_sharp.png"].face_score == pytest.approx(0.9)      # largest face, not highest score
    assert rows["no_face.png"].has_face is False and rows["no_face.png"].face_blur_score is None
    for bad in ("corrupt.png", "missing.png"):
        assert rows[bad].has_face is None and rows[bad].is_blurry is None and rows[bad].is_face_blurry is None
    assert rows["face_sharp.png"].width == 256

    table = os.path.join(tmp, "images")
    assert jobs.ingest_images(spark, out, table, roots=[media], now="2024-06-01T00:00:00") == 5
    assert jobs.ingest_images(spark, out, table, roots=[media], now="2024-12-01T00:00:00") == 10
    res = query.query_images(spark, table, where="has_face AND NOT is_blurry", top_k=100).collect()
    expected = {k for k, v in rows.items() if v.has_face and not v.is_blurry}
    assert "face_sharp.png" in expected
    assert {r.doc_id for r in res} == expected
    jobs.manage(spark, table, before="2024-07-01")
    assert spark.read.parquet(table).count() == 5


def test_image_embedding_staging_and_consistency(spark, tmp):
    media = _media(tmp)
    manifest = os.path.join(tmp, "m.jsonl")
    write_jsonl(manifest, [{"doc_id": n, "s3_url": f"{media}/{n}"} for n in ["no_face.png", "corrupt.png"]])
    with pytest.raises(ValueError):
        jobs.analyze_images(spark, manifest, os.path.join(tmp, "x.jsonl"), roots=[media], embed=True,
                            embedder_factory=FakeImageEmbedder)
    with pytest.raises(ValueError):
        jobs.analyze_images(spark, manifest, os.path.join(tmp, "x.parquet"), roots=[media], embed=False)
    staged = os.path.join(tmp, "staged.parquet")
    jobs.analyze_images(spark, manifest, staged, roots=[media], embed=True, embedder_factory=FakeImageEmbedder)
    emb = {r.doc_id: r.image_embedding for r in spark.read.parquet(staged).collect()}
    assert emb["corrupt.png"] is None and len(emb["no_face.png"]) == 512
    table = os.path.join(tmp, "t")
    jobs.ingest_images(spark, staged, table, roots=[media])
    plain = os.path.join(tmp, "plain.jsonl")
    jobs.analyze_images(spark, manifest, plain, roots=[media])
    with pytest.raises(ValueError, match="image_embedding"):
        jobs.ingest_images(spark, plain, table, roots=[media])


def test_ingest_statuses_and_all_null_batch(spark, tmp):
    media = _media(tmp)
    ok_row = {"doc_id": "no_face.png", "s3_url": f"{media}/no_face.png", "status": "ok", "width": 32,
              "height": 32, "face_count": 0, "face_score": 0.0, "face_area_ratio": 0.0, "blur_score": 12.5,
              "face_blur_score": None, "has_face": False, "is_blurry": True, "is_face_blurry": False}
    gone = dict(ok_row, doc_id="gone.png", s3_url=f"{media}/gone.png")
    failed = {"doc_id": "x.png", "s3_url": f"{media}/x.png", "status": "download_failed"}
    table = os.path.join(tmp, "t")
    first = os.path.join(tmp, "first.jsonl")
    write_jsonl(first, [failed])                      # every score column absent / null
    assert jobs.ingest_images(spark, first, table, roots=[media]) == 1
    second = os.path.join(tmp, "second.jsonl")
    write_jsonl(second, [ok_row, gone])
    assert jobs.ingest_images(spark, second, table, roots=[media]) == 3
    got = {r.doc_id: r for r in spark.read.parquet(table).collect()}
    assert got["no_face.png"].status == "ok" and got["no_face.png"].image_blob is not None
    assert got["gone.png"].status == "blob_download_failed" and got["gone.png"].is_blurry is True
    assert got["x.png"].status == "download_failed"
    types = dict(spark.read.parquet(table).dtypes)
    assert types["width"] == "bigint" and types["face_blur_score"] == "double" and types["has_face"] == "boolean"


class StubAsr:
    def __call__(self, blobs, suffixes):
        out = []
        for b, s in zip(blobs, suffixes):
            out.append({"transcript": f"我的身份证是11010119900307123X，手机13912345678，格式{s}",
                        "acoustic_emotion": "ANGRY" if len(b) % 2 else ""})
        return pd.DataFrame(out)


def lenient_embedder():
    from mediatables.operators.media import WavSignalEmbedder
    return WavSignalEmbedder(strict=False)


class StubLlm:
    def complete(self, prompt):
        if "13912345678" in prompt or "11010119900307123X" in prompt:
            raise RuntimeError("raw PII reached the model")
        return '{"downgrade_related": true, "primary_reason": "价格敏感", "bad_tone": true}'


def test_audio_pipeline_end_to_end(spark, tmp):
    d = os.path.join(tmp, "audio")
    os.makedirs(d)
    t = np.arange(16000 * 2) / 16000.0
    files = {"tone.wav": wav_bytes(0.5 * np.sin(2 * np.pi * 440 * t)),
             "short.wav": wav_bytes(np.zeros(800)), "broken.wav": b"RIFF junk"}
    for name, data in files.items():
        with open(os.path.join(d, name), "wb") as fp:
            fp.write(data)
    manifest = os.path.join(tmp, "m.csv")
    pd.DataFrame({"doc_id": list(files) + ["gone.wav"], "s3_url": [f"{d}/{n}" for n in list(files) + ["gone.wav"]],
                  "extra": range(4)}).to_csv(manifest, index=False)
    out = os.path.join(tmp, "calls.parquet")
    with pytest.raises(Exception):          # undecodable audio fails the embedding batch
        jobs.analyze_audio(spark, manifest, out, embed=True, asr_factory=StubAsr, llm_factory=StubLlm, roots=[d])
    jobs.analyze_audio(spark, manifest, out, embed=True, asr_factory=StubAsr, llm_factory=StubLlm, roots=[d],
                       embedder_factory=lenient_embedder)
    rows = {r.doc_id: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"tone.wav", "short.wav", "broken.wav"}          # missing bytes dropped
    assert rows["tone.wav"].duration_s == pytest.approx(2.0)
    assert rows["broken.wav"].duration_s == 0.0                           # undecodable passes the gate
    tr = rows["tone.wav"].transcript
    assert "[ID_REDACTED]" in tr and "[PHONE_REDACTED]" in tr and ".wav" in tr
    assert rows["tone.wav"].primary_reason == "价格敏感" and rows["tone.wav"].text_emotion == "未知"
    emb = rows["tone.wav"].audio_embedding
    assert len(emb) == 128 and abs(np.linalg.norm(emb) - 1) < 1e-5
    table = os.path.join(tmp, "calls_table")
    assert jobs.ingest_audio(spark, out, table, roots=[d]) == 3
    hits = query.query_audio(spark, table, query_doc_id="tone.wav", top_k=2).collect()
    assert hits[0].doc_id == "tone.wav"


def test_audio_without_llm_defaults(spark, tmp):
    d = os.path.join(tmp, "a")
    os.makedirs(d)
    with open(os.path.join(d, "x.wav"), "wb") as fp:
        fp.write(wav_bytes(np.zeros(1600)))
    manifest = os.path.join(tmp, "m.jsonl")
    write_jsonl(manifest, [{"doc_id": "x.wav", "s3_url": f"{d}/x.wav"}])
    out = os.path.join(tmp, "o.jsonl")
    jobs.analyze_audio(spark, manifest, out, asr_factory=StubAsr, roots=[d])
    r = spark.read.json(out).first()
    assert (r.downgrade_related, r.primary_reason, r.secondary_reason, r.summary, r.confidence,
            r.text_emotion, r.bad_tone, r.emotion_score) == (False, "其他", "", "", 0.0, "未知", False, 0.0)


def test_manifest_from_directory(spark, tmp):
    media = _media(tmp)
    open(os.path.join(media, "notes.txt"), "w").close()
    with open(os.path.join(media, "UPPER.JPG"), "wb") as fp:   # zero-byte files are not listed
        fp.write(b"\xff\xd8")
    out = os.path.join(tmp, "manifest.parquet")
    assert jobs.init_manifest(spark, media, out, "image") == 5
    names = [r.doc_id for r in spark.read.parquet(out).orderBy("doc_id").collect()]
    assert names == sorted(["UPPER.JPG", "corrupt.png", "face_blurred.png", "face_sharp.png", "no_face.png"])
    empty = os.path.join(tmp, "empty")
    os.makedirs(empty)
    open(os.path.join(empty, "a.txt"), "w").close()
    with pytest.raises(ValueError):
        jobs.init_manifest(spark, empty, os.path.join(tmp, "m2.parquet"), "audio")


def test_numpy_embedding_matches_table_operator(spark):
    from mediatables.operators.signal import bucket_stats, signal_embedding
    rng = np.random.default_rng(3)
    for n in (1000, 130, 64, 20):
        x = rng.standard_normal(n)
        x[::17] = 0.0
        ref = np.asarray(rms_zcr_embedding(x))
        df = spark.createDataFrame([(0, i, float(v)) for i, v in enumerate(x)], "k int, i int, v double")
        got = signal_embedding(bucket_stats(df, "k", ["i"], "v", 64), "k").first().embedding
        assert np.allclose(got, ref, atol=1e-6), n


def test_each_model_udf_runs_once_in_the_plan(spark, tmp):
    d = os.path.join(tmp, "a")
    os.makedirs(d)
    with open(os.path.join(d, "x.wav"), "wb") as fp:
        fp.write(wav_bytes(np.zeros(1600)))
    manifest = os.path.join(tmp, "m.jsonl")
    write_jsonl(manifest, [{"doc_id": "x.wav", "s3_url": f"{d}/x.wav"}])
    df = jobs.build_audio_analysis(spark, manifest, StubAsr, llm_factory=StubLlm, embed=True, roots=[d])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # WAV info (filtered by the duration gate), ASR (two struct fields read), embedding:
    # one ArrowEvalPython each; the chat model is one MapInPandas.
    assert plan.count("ArrowEvalPython") == 3, plan
    assert plan.count("MapInPandas") == 1, plan


class SegmentAsr:
    def __call__(self, blobs, suffixes):
        return pd.Series([[{"text": "你好", "raw": "<|HAPPY|>你好"},
                           {"text": "，号码13912345678", "raw": "<|ANGRY|>，号码<|ANGRY|>13912345678"}]
                          for _ in blobs])


def test_audio_segments_mode(spark, tmp):
    d = os.path.join(tmp, "a")
    os.makedirs(d)
    with open(os.path.join(d, "x.wav"), "wb") as fp:
        fp.write(wav_bytes(np.zeros(1600)))
    manifest = os.path.join(tmp, "m.jsonl")
    write_jsonl(manifest, [{"doc_id": "x.wav", "s3_url": f"{d}/x.wav"}])
    r = jobs.build_audio_analysis(spark, manifest, SegmentAsr, roots=[d], asr_output="segments").first()
    assert r.transcript == "你好，号码[PHONE_REDACTED]" and r.acoustic_emotion == "ANGRY"


def test_image_analysis_keeps_pixels_in_their_scan_task(spark, tmp):
    media = _media(tmp)
    manifest = os.path.join(tmp, "m.jsonl")
    names = ["face_sharp.png", "no_face.png", "corrupt.png", "missing.png"]
    write_jsonl(manifest, [{"doc_id": n, "s3_url": f"{media}/{n}"} for n in names])
    b_df = jobs.build_image_analysis(spark, manifest, [media], quality_factory=quality_with_marker, embed=True,
                                     embedder_factory=FakeImageEmbedder)
    b = {r.doc_id: tuple(r) for r in b_df.collect()}
    assert len(b) == 4
    assert b["corrupt.png"][-1] is None and b["missing.png"][-1] is None and b["no_face.png"][-1] is not None
    plan = b_df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    scan = next(i for i, l in enumerate(lines) if "FileScan image" in l)
    udf = max(i for i in range(scan) if "ArrowEvalPython" in lines[i])
    assert not any("Exchange" in l for l in lines[udf:scan])     # still no pixel shuffle


def test_an_existing_empty_image_is_undecodable_not_missing(spark, tmp):
    media = _media(tmp)
    open(os.path.join(media, "empty.png"), "wb").close()
    manifest = os.path.join(tmp, "m.jsonl")
    write_jsonl(manifest, [{"doc_id": n, "s3_url": f"{media}/{n}"} for n in ["empty.png", "no_face.png", "gone.png"]])
    rows = jobs.build_image_analysis(spark, manifest, [media], quality_factory=quality_with_marker).collect()
    assert {r.doc_id: r.status for r in rows} == {
        "empty.png": "decode_failed", "no_face.png": "ok", "gone.png": "download_failed"}


def test_only_the_manifest_is_read_and_decoded(spark, tmp):
    """Objects that the folder holds besides are never read; names that the
    image source skips and empty files have their own status."""
    media = _media(tmp)
    for name in ("_hidden.png", ".dot.png"):
        with open(os.path.join(media, name), "wb") as fp:
            fp.write(png_bytes(checkerboard(16, 4)))
    open(os.path.join(media, "empty.png"), "w").close()
    names = ["_hidden.png", ".dot.png", "empty.png", "no_face.png", "no_face.png", "corrupt.png", "absent.png"]
    rows = [(f"{k}", f"{media}/{n}") for k, n in enumerate(names)] + [("null", None)]
    seen = os.path.join(tmp, "seen")
    os.makedirs(seen)

    def reader(url):
        import uuid
        with open(url, "rb") as source, open(os.path.join(seen, f"{os.path.basename(url)}-{uuid.uuid4().hex}"), "w"):
            return source.read()
    df = jobs.build_image_analysis(spark, spark.createDataFrame(rows, "doc_id string, s3_url string"), [media],
                                   fetcher=reader)
    got = {r.doc_id: (r.status, r.width) for r in df.collect()}
    assert got == {"0": ("ok", 16), "1": ("ok", 16), "2": ("decode_failed", None), "3": ("ok", 32), "4": ("ok", 32),
                   "5": ("decode_failed", None), "6": ("download_failed", None), "null": ("download_failed", None)}
    assert sorted(f.rsplit("-", 1)[0] for f in os.listdir(seen)) == sorted(
        ["_hidden.png", ".dot.png", "empty.png", "no_face.png", "corrupt.png"])


def test_shrunk_images_are_measured(spark, tmp):
    media = os.path.join(tmp, "m")
    os.makedirs(media)
    big = np.kron(checkerboard(64, 8), np.ones((20, 20, 1), np.uint8))
    with open(os.path.join(media, "big.png"), "wb") as fp:
        fp.write(png_bytes(big))
    row = jobs.build_image_analysis(spark, spark.createDataFrame([("b", f"{media}/big.png")], "doc_id string, s3_url string"),
                                    [media]).first()
    from mediatables.functions import imaging
    want = imaging.laplacian_variance(imaging.gray(imaging.shrink(big, 1024, 1024)))
    assert (row.width, row.height) == (1280, 1280) and row.blur_score == pytest.approx(want)
