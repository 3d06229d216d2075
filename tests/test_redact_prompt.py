from pyspark.sql import functions as F

from mediatables.functions import tagging
from mediatables.functions.redact import redact_pii
from mediatables.schemas import PRIMARY_REASONS, TEXT_EMOTIONS


def test_id_redacted_before_phone(spark):
    rows = [("身份证11010119900307123X电话13912345678",), ("号码 139123456789012 结束",),
            ("全角１３９１２３４５６７８",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(redact_pii(F.col("t")).alias("r"))
    out = [r.r for r in df.collect()]
    assert out[0] == "身份证[ID_REDACTED]电话[PHONE_REDACTED]"
    assert out[1] == "号码 [PHONE_REDACTED]9012 结束"      # no word boundary
    assert out[2] == "全角１３９１２３４５６７８"             # full-width digits untouched
    assert out[3] is None


def test_prompt_contains_text_emotion_and_enums(spark):
    rows = [("客户想改成小套餐", "ANGRY"), ("你好", "NEUTRAL"), ("", ""), (None, None)]
    df = spark.createDataFrame(rows, "t string, e string")
    out = [r.p for r in df.select(tagging.build_prompt(F.col("t"), F.col("e")).alias("p")).collect()]
    assert "客户想改成小套餐" in out[0] and "ANGRY" in out[0]
    for value in PRIMARY_REASONS + TEXT_EMOTIONS:
        assert value in out[1]
    assert out[2].endswith("通话转写：\n") and "NEUTRAL" in out[2]
    assert out[3] == out[2]
    assert out[0] == tagging.build_prompt_text("客户想改成小套餐", "ANGRY")


def test_json_defaults_per_field(spark):
    rows = [('{"bad_tone": true, "confidence": "high", "primary_reason": "竞品影响"}',),
            ('{"bad_tone": tru',), (None,), ("",)]
    df = spark.createDataFrame(rows, "j string")
    a = tagging.parse_analysis_json(F.col("j"))
    out = df.select(*tagging.analysis_fields_with_defaults(a)).collect()
    assert out[0].bad_tone is True and out[0].confidence == 0.0 and out[0].primary_reason == "竞品影响"
    for r in out[1:]:
        assert (r.downgrade_related, r.primary_reason, r.secondary_reason, r.summary, r.confidence,
                r.text_emotion, r.bad_tone, r.emotion_score) == (False, "其他", "", "", 0.0, "未知", False, 0.0)


def test_file_suffix(spark):
    rows = [("a/b/c.WAV",), ("x.tar.gz",), ("noext",), (".hidden",), ("dir/",), ("a.",), (None,), ("/",), ("",)]
    df = spark.createDataFrame(rows, "p string")
    out = [r.s for r in df.select(tagging.file_suffix(F.col("p")).alias("s")).collect()]
    assert out == [".WAV", ".gz", ".wav", ".wav", ".wav", ".wav", ".wav", ".wav", ".wav"]


def test_emotion_tags_extracted_in_order(spark):
    df = spark.createDataFrame([("<|HAPPY|>a<|SAD|>b<|EMO_UNKNOWN|><|BOGUS|>",)], "t string")
    assert df.select(tagging.emotion_tags(F.col("t")).alias("x")).first().x == ["HAPPY", "SAD", "EMO_UNKNOWN"]
