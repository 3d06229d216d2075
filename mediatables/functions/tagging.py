"""Model-output parsing and prompt building as native expressions.

* ``parse_analysis_json`` (F7 + F4): ``from_json`` in PERMISSIVE mode never
  fails a batch. Malformed text yields a struct of nulls (not a null struct)
  and a wrongly typed field nulls only that field, so defaults are applied per
  field, never by testing the struct for null.
* ``build_prompt`` (F8): the instruction text is a fixed template; only the
  emotion and transcript vary, so it is one ``concat_ws`` - no Python UDF.
* ``emotion_tags`` (F9) and ``file_suffix`` (F10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (
    ANALYSIS_DEFAULTS,
    ANALYSIS_STRUCT,
    DEFAULT_EMOTION,
    EMOTION_NOISE,
    EMOTION_TAGS,
    PRIMARY_REASONS,
    TEXT_EMOTIONS,
)

# ---------------------------------------------------------------------------
# Prompt template lines (must equal the reference's text).
# ---------------------------------------------------------------------------
PROMPT_HEAD = [
    "你是电信客服通话质检分析助手。请只输出严格 JSON，不要解释。",
    "",
    "字段：",
    "- downgrade_related(bool): 是否在谈套餐降档/降费/改小套餐",
    "- primary_reason(str): 一级原因，必须从以下枚举选择：{reasons}",
    "- secondary_reason(str): 二级原因，可为空",
    "- summary(str): 一句话摘要",
    "- confidence(float): 0 到 1",
    "- text_emotion(str): 客户情绪，必须从以下枚举选择：{emotions}",
    "- bad_tone(bool): 是否存在不满、焦急、愤怒、投诉倾向或服务风险",
    "- emotion_score(float): 0 到 1，越高越负面",
    "",
]
PROMPT_EMOTION_PREFIX = "SenseVoice 声学情绪标签："
PROMPT_TRANSCRIPT_HEADER = ["", "通话转写："]
ENUM_SEPARATOR = "、"

EMOTION_TAG_PATTERN = r"<\|(" + "|".join(EMOTION_TAGS) + r")\|>"


def prompt_head_lines() -> list[str]:
    reasons = ENUM_SEPARATOR.join(PRIMARY_REASONS)
    emotions = ENUM_SEPARATOR.join(TEXT_EMOTIONS)
    return [line.format(reasons=reasons, emotions=emotions) for line in PROMPT_HEAD]


def build_prompt_text(transcript: str | None, acoustic_emotion: str | None) -> str:
    """Driver/worker-side twin of :func:`build_prompt` (used by stubs and tests)."""
    lines = [*prompt_head_lines(), PROMPT_EMOTION_PREFIX + (acoustic_emotion or DEFAULT_EMOTION),
             *PROMPT_TRANSCRIPT_HEADER, transcript or ""]
    return "\n".join(lines)


def build_prompt(transcript: Column, acoustic_emotion: Column) -> Column:
    emotion = F.coalesce(F.nullif(acoustic_emotion, F.lit("")), F.lit(DEFAULT_EMOTION))
    parts = [F.lit(x) for x in prompt_head_lines()]
    parts.append(F.concat(F.lit(PROMPT_EMOTION_PREFIX), emotion))
    parts.extend(F.lit(x) for x in PROMPT_TRANSCRIPT_HEADER)
    parts.append(F.coalesce(transcript, F.lit("")))
    return F.concat_ws("\n", *parts)


def parse_analysis_json(json_col: Column, schema: T.StructType = ANALYSIS_STRUCT) -> Column:
    """PERMISSIVE ``from_json``; malformed or null text never raises."""
    return F.from_json(json_col, schema, {"mode": "PERMISSIVE"})


def analysis_fields_with_defaults(struct_col: Column,
                                  defaults: dict | None = None) -> list[Column]:
    """One column per analysis field, each defaulted on its own."""
    defaults = ANALYSIS_DEFAULTS if defaults is None else defaults
    return [F.coalesce(struct_col.getField(name), F.lit(value)).alias(name)
            for name, value in defaults.items()]


def emotion_tags(raw_text: Column) -> Column:
    """All ``<|TAG|>`` emotion markers in order of appearance (array<string>)."""
    return F.regexp_extract_all(raw_text, F.lit(EMOTION_TAG_PATTERN), 1)


def file_name(path: Column) -> Column:
    """Last non-empty path component, as a POSIX path would report it."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    return F.try_element_at(parts, F.lit(-1))   # NULL (not an ANSI error) for "" or "/"


def file_suffix(path: Column, default: str = ".wav") -> Column:
    """Suffix of the final path component incl. the dot; ``default`` if none.

    A leading dot (hidden file) or a trailing dot is not a suffix.
    """
    suffix = F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)
    return F.coalesce(F.nullif(suffix, F.lit("")), F.lit(default))


# ---------------------------------------------------------------------------
# Per-file forms of A4/A5: when a speech model returns one file's segments as
# an array, the transcript and the dominant emotion are narrow per-row
# expressions (no shuffle); the table forms live in operators.emotion.
# ---------------------------------------------------------------------------

SEGMENTS_TYPE = T.ArrayType(T.StructType([T.StructField("text", T.StringType()),
                                          T.StructField("raw", T.StringType())]))


def concat_segments(segments: Column, field: str = "text") -> Column:
    """A5 per row: segment texts joined in order with no separator ('' if none)."""
    return F.coalesce(F.array_join(F.transform(segments, lambda s: s[field]), ""), F.lit(""))


def dominant_in_array(tags: Column, noise=tuple(EMOTION_NOISE), default: str = DEFAULT_EMOTION) -> Column:
    """A4 per row: most frequent non-noise tag; ties -> first seen; none -> default."""
    meaningful = F.filter(tags, lambda t: ~t.isin(list(noise)))
    uniq = F.array_distinct(meaningful)            # keeps first-occurrence order
    counted = F.transform(uniq, lambda u: F.struct(
        F.size(F.filter(meaningful, lambda t: t == u)).alias("n"), u.alias("tag")))
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("tag"))
    best = F.aggregate(counted, start, lambda acc, x: F.when(x["n"] > acc["n"], x).otherwise(acc))
    return F.coalesce(best["tag"], F.lit(default))


def segment_emotion(segments: Column, field: str = "raw") -> Column:
    """Dominant acoustic emotion over the tags of all segments of a file."""
    return dominant_in_array(F.flatten(F.transform(segments, lambda s: emotion_tags(s[field]))))
