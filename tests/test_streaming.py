import os

from mediatables.streaming.ingest import start_image_ingest
from tests.media_fixtures import png_bytes, write_jsonl
import numpy as np


def test_stream_ingest_picks_up_new_manifests(spark, tmp):
    media = os.path.join(tmp, "media")
    os.makedirs(media)
    for name in ("a.png", "b.png"):
        with open(os.path.join(media, name), "wb") as fp:
            fp.write(png_bytes(np.full((16, 16, 3), 200, np.uint8)))
    inbox = os.path.join(tmp, "inbox")
    os.makedirs(inbox)
    table = os.path.join(tmp, "images")
    ckpt = os.path.join(tmp, "ckpt")
    write_jsonl(os.path.join(inbox, "m1.json"), [{"doc_id": "a.png", "s3_url": f"{media}/a.png"}])
    q = start_image_ingest(spark, inbox, table, [media], checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 1
    write_jsonl(os.path.join(inbox, "m2.json"), [{"doc_id": "b.png", "s3_url": f"{media}/b.png"},
                                                {"doc_id": "c.png", "s3_url": f"{media}/c.png"}])
    q = start_image_ingest(spark, inbox, table, [media], checkpoint=ckpt)
    q.awaitTermination(120)
    rows = {r.doc_id: r.status for r in spark.read.parquet(table).collect()}
    assert rows == {"a.png": "ok", "b.png": "ok", "c.png": "download_failed"}


def test_a_batch_that_runs_again_appends_nothing(spark, tmp):
    """The checkpoint loses its last commit, as if the query died after the append."""
    import shutil
    media, inbox, table, ckpt = (os.path.join(tmp, x) for x in ("media", "inbox", "images", "ckpt"))
    os.makedirs(media)
    os.makedirs(inbox)
    with open(os.path.join(media, "a.png"), "wb") as fp:
        fp.write(png_bytes(np.full((16, 16, 3), 200, np.uint8)))
    write_jsonl(os.path.join(inbox, "m.json"), [{"doc_id": "a.png", "s3_url": f"{media}/a.png"}])
    for _ in range(2):
        start_image_ingest(spark, inbox, table, [media], checkpoint=ckpt).awaitTermination(120)
        shutil.rmtree(os.path.join(ckpt, "commits"))
    assert spark.read.parquet(table).count() == 1
