import json
import os

import numpy as np

from mediatables import cli
from tests.media_fixtures import png_bytes


def test_cli_image_flow(spark, tmp, capsys):
    media = os.path.join(tmp, "media")
    os.makedirs(media)
    for name, v in (("a.png", 255), ("b.png", 0)):
        with open(os.path.join(media, name), "wb") as fp:
            fp.write(png_bytes(np.full((16, 16, 3), v, np.uint8)))
    manifest, out, table = (os.path.join(tmp, x) for x in ("m.parquet", "a.jsonl", "t"))
    assert cli.main(["manifest", "--dir", media, "--out", manifest], spark) == 0
    cli.main(["analyze-images", "--manifest", manifest, "--out", out, "--root", media], spark)
    cli.main(["ingest-images", "--analysis", out, "--table", table, "--root", media], spark)
    capsys.readouterr()
    cli.main(["query-images", "--table", table, "--where", "status = 'ok'", "--top-k", "5"], spark)
    rows = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert sorted(r["doc_id"] for r in rows) == ["a.png", "b.png"]
    cli.main(["query-images", "--table", table, "--sql", "SELECT count(*) AS n FROM images"], spark)
    assert json.loads(capsys.readouterr().out.strip())["n"] == 2
    strict = os.path.join(tmp, "strict.jsonl")
    cli.main(["analyze-images", "--manifest", manifest, "--out", strict, "--root", media, "--blur-threshold", "-1"], spark)
    assert {r.is_blurry for r in spark.read.json(strict).collect()} == {False}
    assert {r.is_blurry for r in spark.read.json(out).collect()} == {True}
    capsys.readouterr()
    cli.main(["manage", "--table", table, "--after", "2000-01-01"], spark)
    from mediatables.sources.readers import read_asset
    emptied = read_asset(spark, table)            # declared schema: still readable
    assert emptied.count() == 0 and "image_blob" in emptied.columns
