from mediatables.functions import rules

ROWS = [
    ("clear_face", "ok", 1, 0.9, 0.2, 500.0, 200.0, (True, False, False)),
    ("low_score", "ok", 1, 0.3, 0.2, 500.0, 200.0, (False, False, False)),
    ("tiny_face", "ok", 1, 0.9, 0.001, 500.0, 200.0, (False, False, False)),
    ("no_face", "ok", 0, 0.0, 0.0, 50.0, None, (False, True, False)),
    ("blurry_face", "ok", 1, 0.9, 0.2, 500.0, 30.0, (True, False, True)),
    ("bad_download", "download_failed", None, None, None, None, None, (None, None, None)),
    ("bad_image", "decode_failed", None, None, None, None, None, (None, None, None)),
]


def test_three_valued_rules(spark):
    df = spark.createDataFrame([r[:-1] for r in ROWS],
                               "doc_id string, status string, face_count bigint, face_score double, "
                               "face_area_ratio double, blur_score double, face_blur_score double")
    out = {r.doc_id: (r.has_face, r.is_blurry, r.is_face_blurry)
           for r in rules.add_rule_columns(df).collect()}
    for row in ROWS:
        assert out[row[0]] == row[-1], row[0]


def test_status_and_downgrade(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(None, None, None), (b"x", None, b"x"), (b"x", 1.0, None), (b"x", 2.0, b"y")],
                               "content binary, blur double, blob binary")
    st = df.select(rules.image_status(F.col("content"), F.col("blur")).alias("s"), "blob")
    out = [r.s for r in st.select(rules.downgrade_missing_blob(F.col("s"), F.col("blob")).alias("s")).collect()]
    assert out == ["download_failed", "decode_failed", "blob_download_failed", "ok"]
