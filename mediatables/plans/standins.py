"""Library operators exercised on the shared test tables.

Media files are not part of the test data, so each operator runs on a
stand-in column of the given tables (documents as transcripts/images,
embeddings as vectors, events as audio samples, ...). Every query reads whole
tables; a limit appears only where ranking is the feature.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame`` and ``ORACLES``
maps the same names to DuckDB SQL over the same tables. Doubles are rounded
to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules, tagging
from ..functions.redact import redact_pii
from ..operators import emotion
from ..plans import query as q
from ..schemas import (
    ANALYSIS_DEFAULTS,
    ANALYSIS_STRUCT,
    EMOTION_NOISE,
    ID_CARD_PATTERN,
    ID_REPLACEMENT,
    PHONE_PATTERN,
    PHONE_REPLACEMENT,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

R = 6  # decimals kept for doubles in compared outputs


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rnd(c, name: str | None = None):
    col = F.round(F.col(c) if isinstance(c, str) else c, R)
    return col.alias(name or c) if isinstance(c, str) or name else col


def sql_str(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------------------
# Scans, filters, projections
# ---------------------------------------------------------------------------

@register("scan_project_filter", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE lang = 'en' AND text IS NOT NULL
""")
def scan_project_filter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return (q.apply_where(docs, "lang = 'en'")
            .where(F.col("text").isNotNull())
            .select("doc_id", "lang", "source", "n_chars"))


@register("range_gate", """
SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN 100 AND 5000
""")
def range_gate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.where(F.col("n_chars").between(100, 5000)).select("doc_id", "n_chars")


INJECTED_ID = " 11010119900307123X"


@register("pii_redact", f"""
SELECT doc_id,
       regexp_replace(regexp_replace(text || '{INJECTED_ID}', '{ID_CARD_PATTERN}', '{ID_REPLACEMENT}', 'g'),
                      '{PHONE_PATTERN}', '{PHONE_REPLACEMENT}', 'g') AS transcript
FROM documents
""")
def pii_redact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    raw = F.concat(F.col("text"), F.lit(INJECTED_ID))
    return docs.select("doc_id", redact_pii(raw).alias("transcript"))


# ---------------------------------------------------------------------------
# Model-output parsing and prompts
# ---------------------------------------------------------------------------

def _props_variant(props, event_type, value):
    """Model-like JSON per event type: partial, full, wrongly typed, malformed."""
    body = F.expr("substr(props, 1, length(props) - 1)")
    val = value.cast("string")
    return (F.when(event_type == "error", body)
            .when(event_type == "purchase",
                  F.concat(body, F.lit(', "bad_tone": true, "confidence": '), val,
                           F.lit(', "primary_reason": "价格敏感"}')))
            .when(event_type == "signup",
                  F.concat(body, F.lit(', "downgrade_related": true, "text_emotion": "平静", "summary": "'),
                           event_type, F.lit('"}')))
            .when(event_type == "click",
                  F.concat(F.regexp_replace(body, r'"k": (\d+)', '"k": "$1"'),
                           F.lit(', "emotion_score": '), val, F.lit("}")))
            .otherwise(props))


_PROPS_SQL = """
CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1)
     WHEN event_type = 'purchase' THEN substr(props, 1, length(props) - 1)
          || ', "bad_tone": true, "confidence": ' || CAST(value AS VARCHAR) || ', "primary_reason": "价格敏感"}'
     WHEN event_type = 'signup' THEN substr(props, 1, length(props) - 1)
          || ', "downgrade_related": true, "text_emotion": "平静", "summary": "' || event_type || '"}'
     WHEN event_type = 'click' THEN regexp_replace(substr(props, 1, length(props) - 1), '"k": (\\d+)', '"k": "\\1"')
          || ', "emotion_score": ' || CAST(value AS VARCHAR) || '}'
     ELSE props END
"""


def _json_field_sql(j: str, name: str, kind: str, default) -> str:
    path = f"'$.{name}'"
    if kind == "bool":
        typed = f"CASE WHEN json_type({j}, {path}) = 'BOOLEAN' THEN CAST(json_extract({j}, {path}) AS BOOLEAN) END"
        d = "true" if default else "false"
    elif kind == "double":
        typed = (f"CASE WHEN json_type({j}, {path}) IN ('DOUBLE', 'BIGINT', 'UBIGINT') "
                 f"THEN CAST(json_extract({j}, {path}) AS DOUBLE) END")
        d = repr(float(default))
    elif kind == "long":
        typed = (f"CASE WHEN json_type({j}, {path}) IN ('BIGINT', 'UBIGINT') "
                 f"THEN CAST(json_extract({j}, {path}) AS BIGINT) END")
        d = None
    else:
        typed = f"CASE WHEN json_type({j}, {path}) = 'VARCHAR' THEN json_extract_string({j}, {path}) END"
        d = sql_str(default)
    valid = f"CASE WHEN json_valid({j}) THEN {typed} END"
    if kind == "double":
        valid = f"round({valid}, {R})"
    return f"coalesce({valid}, {d})" if d is not None else valid


_KINDS = {"downgrade_related": "bool", "primary_reason": "str", "secondary_reason": "str",
          "summary": "str", "confidence": "double", "text_emotion": "str", "bad_tone": "bool",
          "emotion_score": "double"}


def _analysis_sql_fields(j: str) -> str:
    return ",\n       ".join(f"{_json_field_sql(j, n, _KINDS[n], ANALYSIS_DEFAULTS[n])} AS {n}"
                             for n in ANALYSIS_DEFAULTS)


@register("json_tag_defaults", f"""
WITH e AS (SELECT event_id, event_type, {_PROPS_SQL} AS j FROM events)
SELECT event_id, event_type, {_json_field_sql('j', 'k', 'long', None)} AS k,
       {_analysis_sql_fields('j')}
FROM e
""")
def json_tag_defaults(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    schema = T.StructType([*ANALYSIS_STRUCT.fields, T.StructField("k", T.LongType())])
    j = _props_variant(F.col("props"), F.col("event_type"), F.col("value"))
    parsed = ev.select("event_id", "event_type", tagging.parse_analysis_json(j, schema).alias("a"))
    fields = tagging.analysis_fields_with_defaults(F.col("a"))
    out = parsed.select("event_id", "event_type", F.col("a.k").alias("k"), *fields)
    return out.withColumns({c: F.round(c, R) for c in ("confidence", "emotion_score")})


def _prompt_sql(transcript: str, emotion_expr: str) -> str:
    head = ", ".join(sql_str(x) for x in tagging.prompt_head_lines())
    tail = ", ".join(sql_str(x) for x in tagging.PROMPT_TRANSCRIPT_HEADER)
    return (f"concat_ws(chr(10), {head}, {sql_str(tagging.PROMPT_EMOTION_PREFIX)} || "
            f"coalesce(nullif({emotion_expr}, ''), 'NEUTRAL'), {tail}, coalesce({transcript}, ''))")


_ROLE_EMOTION_SQL = "CASE role WHEN 'user' THEN 'ANGRY' WHEN 'assistant' THEN '' END"


def _role_emotion():
    return (F.when(F.col("role") == "user", F.lit("ANGRY"))
            .when(F.col("role") == "assistant", F.lit("")))


@register("prompt_build", f"""
SELECT conv_id, turn, {_prompt_sql('text', _ROLE_EMOTION_SQL)} AS prompt FROM conversations
""")
def prompt_build(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn",
                       tagging.build_prompt(F.col("text"), _role_emotion()).alias("prompt"))


@register("transcript_concat", """
SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn), '') AS transcript
FROM conversations GROUP BY conv_id
""")
def transcript_concat(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return emotion.ordered_concat(conv, ["conv_id"], "turn", "text", out_col="transcript")


# event_type -> emotion tag used as the stand-in speech-model output
EVENT_EMOTION = {"click": "HAPPY", "purchase": "SAD", "signup": "ANGRY",
                 "view": "NEUTRAL", "error": "EMO_UNKNOWN"}


def _event_tag_sql() -> str:
    whens = " ".join(f"WHEN {sql_str(k)} THEN {sql_str(v)}" for k, v in EVENT_EMOTION.items())
    return f"CASE event_type {whens} END"


_NOISE_SQL = ", ".join(sql_str(x) for x in EMOTION_NOISE)


@register("emotion_mode", f"""
WITH t AS (
  SELECT user_id, {_event_tag_sql()} AS tag,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
  FROM events),
m AS (SELECT user_id, tag, count(*) AS n, min(pos) AS first_pos FROM t
      WHERE tag NOT IN ({_NOISE_SQL}) GROUP BY user_id, tag),
r AS (SELECT user_id, tag,
             row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first_pos) AS rn FROM m)
SELECT u.user_id, coalesce(r.tag, 'NEUTRAL') AS dominant
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r ON u.user_id = r.user_id AND r.rn = 1
""")
def emotion_mode(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    tag = F.create_map(*[F.lit(x) for kv in EVENT_EMOTION.items() for x in kv])[F.col("event_type")]
    raw = ev.select("user_id", "ts", "event_id",
                    F.concat(F.lit("<|"), tag, F.lit("|>"), F.col("event_type")).alias("raw"))
    tags = emotion.explode_tags(raw, "raw", ["user_id", "ts", "event_id"])
    return emotion.dominant_tag(tags, ["user_id"], ["ts", "event_id", "tag_pos"], out_col="dominant", all_keys=ev)


@register("emotion_mode_untagged", f"""
WITH t AS (
  SELECT user_id, {_event_tag_sql()} AS tag,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
  FROM events WHERE user_id % 5 <> 0),
m AS (SELECT user_id, tag, count(*) AS n, min(pos) AS first_pos FROM t
      WHERE tag NOT IN ({_NOISE_SQL}) GROUP BY user_id, tag),
r AS (SELECT user_id, tag,
             row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first_pos) AS rn FROM m)
SELECT u.user_id, coalesce(r.tag, 'NEUTRAL') AS dominant
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r ON u.user_id = r.user_id AND r.rn = 1
""")
def emotion_mode_untagged(spark, sf_dir):
    """A4 where the events of every fifth user carry no tag."""
    ev = table(spark, sf_dir, "events")
    tag = F.create_map(*[F.lit(x) for kv in EVENT_EMOTION.items() for x in kv])[F.col("event_type")]
    marker = F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("<|"), tag, F.lit("|>"))).otherwise(F.lit(""))
    raw = ev.select("user_id", "ts", "event_id", F.concat(marker, "event_type").alias("raw"))
    tags = emotion.explode_tags(raw, "raw", ["user_id", "ts", "event_id"])
    return emotion.dominant_tag(tags, ["user_id"], ["ts", "event_id", "tag_pos"], out_col="dominant", all_keys=ev)


@register("faces_of_all_images", f"""
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1.0 - l_discount AS score, l_quantity AS area
           FROM lineitem WHERE l_quantity > 40),
b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY area DESC, l_linenumber, l_partkey, l_suppkey) AS rn,
             count(*) OVER (PARTITION BY l_orderkey) AS n FROM f)
SELECT o_orderkey AS l_orderkey, coalesce(n, 0) AS face_count, round(coalesce(score, 0.0), {R}) AS face_score,
       round(area, {R}) AS face_area
FROM orders LEFT JOIN b ON o_orderkey = l_orderkey AND rn = 1
""")
def faces_of_all_images(spark, sf_dir):
    """A11 with faceless images: count and score 0, no area."""
    from ..operators.faces import largest_face
    faces = table(spark, sf_dir, "lineitem").where("l_quantity > 40").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.lit(1.0) - F.col("l_discount")).alias("score"), F.col("l_quantity").alias("area"))
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    best = largest_face(faces, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "area",
                        ["score", "area"], images=images, no_face={"score": 0.0})
    return best.select("l_orderkey", "face_count", F.round("score", R).alias("face_score"),
                       F.round("area", R).alias("face_area"))


@register("channel_mean", f"""
SELECT l_suppkey, l_partkey, round(avg(l_discount), {R}) AS value FROM lineitem GROUP BY l_suppkey, l_partkey
""")
def channel_mean(spark, sf_dir):
    """A10: the mean over the channels of each sample position."""
    from ..operators.signal import mix_to_mono
    li = table(spark, sf_dir, "lineitem")
    mono = mix_to_mono(li, ["l_suppkey"], ["l_partkey"], "l_discount")
    return mono.select("l_suppkey", "l_partkey", F.round("l_discount", R).alias("value"))


@register("sql_literals", """
SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'a;b' GROUP BY event_type
""")
def sql_literals(spark, sf_dir):
    """A semicolon in a literal and a trailing comment are plain SELECT text."""
    return q.sql_query(spark, "SELECT event_type, count(*) AS n FROM calls WHERE event_type <> 'a;b' "
                              "GROUP BY event_type -- all types", {"calls": table(spark, sf_dir, "events")}, top_k=None)


@register("suffix_of_name", """
SELECT page_id, url,
       coalesce(nullif(regexp_extract(list_filter(string_split(url, '/'), lambda x: x <> '' AND x <> '.')[-1],
                                      '^.+(\\.[^.]+)$', 1), ''), '.wav') AS suffix
FROM pages
""")
def suffix_of_name(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", tagging.file_suffix(F.col("url")).alias("suffix"))


# ---------------------------------------------------------------------------
# Image status and verdicts
# ---------------------------------------------------------------------------

def image_standin(docs: DataFrame, labels: DataFrame, keep_content: bool = False) -> DataFrame:
    """documents + labels as image analysis rows (raw measures + status).

    No label row -> download failed; toxic -> undecodable; otherwise the text
    provides the measures. ``quality = 0`` means the blob is gone at ingest.
    The measures are computed on the documents side before the join, so only
    small columns cross it; the text itself travels only with
    ``keep_content``.
    """
    faces = (F.size(F.split(F.col("text"), "\n")) - 1).cast("long")
    measured = docs.select(
        "doc_id", F.col("n_chars"), faces.alias("_faces"),
        F.length(F.substring_index(F.col("text"), "\n", 1)).cast("double").alias("_first_line"),
        *([F.col("text")] if keep_content else []))
    j = measured.join(labels, "doc_id", "left")
    fetched = F.col("quality").isNotNull()
    decodable = fetched & (F.col("toxic") == 0)
    nf = F.col("_faces")
    measures = {
        "face_count": F.when(decodable, nf),
        "face_score": F.when(decodable, F.least(F.lit(1.0), F.col("n_chars") / 4000.0)),
        "face_area_ratio": F.when(decodable, F.when(nf > 0, F.lit(1.0) / (nf * nf)).otherwise(F.lit(0.0))),
        "blur_score": F.when(decodable, F.col("n_chars") / 10.0),
        "face_blur_score": F.when(decodable & (nf > 0), F.col("_first_line")),
    }
    content = [F.when(fetched, F.col("text")).alias("content")] if keep_content else []
    out = j.select("doc_id", F.col("quality"), *content, *[v.alias(k) for k, v in measures.items()])
    out = out.withColumn("status", rules.image_status(F.when(fetched, F.lit(True)), F.col("blur_score")))
    return rules.add_rule_columns(out)


_IMAGE_SQL = """
WITH j AS (
  SELECT d.doc_id, d.text, d.n_chars, l.quality, l.toxic,
         (l.doc_id IS NOT NULL AND l.toxic = 0) AS dec,
         CAST(length(d.text) - length(replace(d.text, chr(10), '')) AS BIGINT) AS faces
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (
  SELECT doc_id, quality,
         CASE WHEN quality IS NULL THEN 'download_failed' WHEN NOT dec THEN 'decode_failed' ELSE 'ok' END AS status,
         CASE WHEN dec THEN faces END AS face_count,
         CASE WHEN dec THEN least(1.0, n_chars / 4000.0) END AS face_score,
         CASE WHEN dec THEN CASE WHEN faces > 0 THEN 1.0 / (faces * faces) ELSE 0.0 END END AS face_area_ratio,
         CASE WHEN dec THEN n_chars / 10.0 END AS blur_score,
         CASE WHEN dec AND faces > 0 THEN CAST(length(split_part(text, chr(10), 1)) AS DOUBLE) END AS face_blur_score
  FROM j),
v AS (
  SELECT *,
    CASE WHEN status = 'ok' THEN coalesce(face_count > 0 AND face_score >= 0.5 AND face_area_ratio >= 0.01, false) END AS has_face,
    CASE WHEN status = 'ok' THEN coalesce(blur_score < 100.0, false) END AS is_blurry
  FROM m)
"""


@register("status_rules", _IMAGE_SQL + f"""
SELECT doc_id,
       CASE WHEN status = 'ok' AND quality = 0 THEN 'blob_download_failed' ELSE status END AS status,
       face_count, round(face_score, {R}) AS face_score, round(face_area_ratio, {R}) AS face_area_ratio,
       round(blur_score, {R}) AS blur_score, round(face_blur_score, {R}) AS face_blur_score,
       has_face, is_blurry,
       CASE WHEN status = 'ok' THEN coalesce(has_face AND face_blur_score < 80.0, false) END AS is_face_blurry
FROM v
""")
def status_rules(spark, sf_dir):
    img = image_standin(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    blob_present = F.when(F.col("quality") == 1, F.lit(True))
    img = img.withColumn("status", rules.downgrade_missing_blob(F.col("status"), blob_present))
    return img.select("doc_id", "status", "face_count", rnd("face_score"), rnd("face_area_ratio"),
                      rnd("blur_score"), rnd("face_blur_score"), "has_face", "is_blurry",
                      "is_face_blurry")


@register("desc_left_join", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def desc_left_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    out, cols = q.join_descriptions(docs, labels, ["doc_id", "lang", "n_chars"],
                                    desc_cols=("quality", "toxic"))
    return out.select(*cols)


# ---------------------------------------------------------------------------
# SQL surface
# ---------------------------------------------------------------------------

@register("sql_group_count", """
SELECT event_type, COUNT(*) AS cnt FROM events GROUP BY event_type ORDER BY cnt DESC LIMIT 100
""")
def sql_group_count(spark, sf_dir):
    return q.sql_query(spark,
                       "SELECT event_type, COUNT(*) AS cnt FROM calls GROUP BY event_type ORDER BY cnt DESC",
                       {"calls": table(spark, sf_dir, "events")}, top_k=100)


@register("sql_avg", f"""
SELECT user_id, round(AVG(value), {R}) AS avg_value, COUNT(*) AS cnt FROM events GROUP BY user_id
""")
def sql_avg(spark, sf_dir):
    return q.sql_query(spark,
                       f"SELECT user_id, round(AVG(value), {R}) AS avg_value, COUNT(*) AS cnt "
                       "FROM calls GROUP BY user_id",
                       {"calls": table(spark, sf_dir, "events")}, top_k=None)


@register("sql_order_topk", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def sql_order_topk(spark, sf_dir):
    return q.sql_query(spark,
                       "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
                       "ORDER BY o_totalprice DESC, o_orderkey",
                       {"orders": table(spark, sf_dir, "orders")}, top_k=10)


@register("key_lookup", """
SELECT vec_id, label FROM embeddings WHERE vec_id = 7 LIMIT 1
""")
def key_lookup(spark, sf_dir):
    return q.lookup(table(spark, sf_dir, "embeddings"), "vec_id", 7).select("vec_id", "label")


@register("sql_left_join", """
SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.n_chars > 1000
""")
def sql_left_join(spark, sf_dir):
    return q.sql_query(
        spark,
        "SELECT i.doc_id, i.lang, d.quality FROM images i LEFT JOIN descriptions d ON i.doc_id = d.doc_id "
        "WHERE i.n_chars > 1000",
        {"images": table(spark, sf_dir, "documents"), "descriptions": table(spark, sf_dir, "labels")},
        top_k=None)


@register("limit_rows", """
SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 10
""")
def limit_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return q.scalar_query(docs.orderBy("doc_id"), None, 10, ["doc_id", "lang", "n_chars"])


@register("default_columns", """
SELECT doc_id, lang, n_chars FROM documents
""")
def default_columns_q(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return q.scalar_query(docs, None, None, ["doc_id", "ingest_time", "lang", "n_chars", "image_blob"])


# ---------------------------------------------------------------------------
# Vector search
# ---------------------------------------------------------------------------

def _query_vector(dim: int = 64) -> list[float]:
    """Deterministic unit query vector (a cosine ramp)."""
    import math
    raw = [math.cos(0.7 * i) + 0.25 for i in range(dim)]
    norm = math.sqrt(sum(x * x for x in raw))
    return [x / norm for x in raw]


QVEC = _query_vector()
_QVEC_SQL = "([" + ", ".join(repr(x) for x in QVEC) + "]::DOUBLE[])"


def _dist_sql(emb: str, qv: str) -> str:
    return f"list_sum(list_transform(range(1, len({emb}) + 1), lambda i: ({emb}[i]::DOUBLE - {qv}[i]) ** 2))"


def _knn_sql(where: str = "", qv: str = _QVEC_SQL, extra_from: str = "", lo_hi=None, k: int = 10) -> str:
    rng = f" WHERE d >= {lo_hi[0]} AND d < {lo_hi[1]}" if lo_hi else ""
    return (f"SELECT vec_id, label, round(d, {R}) AS dist FROM ("
            f"SELECT vec_id, label, {_dist_sql('embedding', qv)} AS d FROM embeddings{extra_from} "
            f"WHERE embedding IS NOT NULL{(' AND ' + where) if where else ''}){rng} "
            f"ORDER BY d, vec_id LIMIT {k}")


def _knn_out(df: DataFrame) -> DataFrame:
    from ..operators.knn import DIST_COL
    return df.select("vec_id", "label", F.round(F.col(DIST_COL), R).alias("dist"))


@register("knn_exact", _knn_sql())
def knn_exact(spark, sf_dir):
    from ..operators.knn import knn
    emb = table(spark, sf_dir, "embeddings")
    return _knn_out(knn(emb, "embedding", QVEC, 10, tie_breakers=["vec_id"]))


@register("knn_prefilter", _knn_sql("label IN (1, 3, 5)"))
def knn_prefilter(spark, sf_dir):
    from ..operators.knn import knn
    emb = table(spark, sf_dir, "embeddings")
    return _knn_out(knn(emb, "embedding", QVEC, 10, where="label IN (1, 3, 5)", tie_breakers=["vec_id"]))


@register("knn_range", _knn_sql(lo_hi=(1.0, 1.5)))
def knn_range(spark, sf_dir):
    from ..operators.knn import knn
    emb = table(spark, sf_dir, "embeddings")
    return _knn_out(knn(emb, "embedding", QVEC, 10, distance_range=(1.0, 1.5), tie_breakers=["vec_id"]))


@register("knn_by_row", _knn_sql(qv="q.qv", extra_from=", (SELECT embedding::DOUBLE[] AS qv FROM embeddings "
                                                      "WHERE vec_id = 3 LIMIT 1) q"))
def knn_by_row(spark, sf_dir):
    from ..operators.knn import knn_by_row as by_row
    emb = table(spark, sf_dir, "embeddings")
    return _knn_out(by_row(emb, "vec_id", 3, "embedding", 10, tie_breakers=["vec_id"]))


@register("knn_desc_join", f"""
WITH t AS ({_knn_sql("label IN (1, 3, 5)")})
SELECT t.vec_id, t.label, t.dist, l.quality, l.toxic FROM t LEFT JOIN labels l ON t.vec_id = l.doc_id
""")
def knn_desc_join(spark, sf_dir):
    """Flagship: prefiltered exact kNN, description join on the top-k only."""
    from ..operators.knn import DIST_COL, join_after_topk, knn
    emb = table(spark, sf_dir, "embeddings")
    desc = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "vec_id")
    top = knn(emb, "embedding", QVEC, 10, where="label IN (1, 3, 5)",
              tie_breakers=["vec_id"]).select("vec_id", "label", DIST_COL)
    joined = join_after_topk(top, desc.select("vec_id", "quality", "toxic"), "vec_id",
                             tie_breakers=["vec_id"])
    return joined.select("vec_id", "label", F.round(F.col(DIST_COL), R).alias("dist"), "quality", "toxic")


_UNNEST_EMB = ("SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, "
               "generate_subscripts(embedding, 1) AS i FROM embeddings WHERE embedding IS NOT NULL")


@register("ivf_assign", f"""
WITH u AS ({_UNNEST_EMB}),
c AS (SELECT label AS cid, i, avg(x) AS m FROM u GROUP BY label, i),
d AS (SELECT u.vec_id, c.cid, sum((u.x - c.m) ** 2) AS dist FROM u JOIN c ON u.i = c.i GROUP BY u.vec_id, c.cid),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rn FROM d)
SELECT vec_id, cid AS centroid_id, round(dist, {R}) AS dist FROM r WHERE rn = 1
""")
def ivf_assign(spark, sf_dir):
    """Nearest of the label means: the few means, as one row, meet every vector."""
    from ..functions.vectors import squared_l2
    emb = table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull())
    means = (emb.select("label", F.posexplode("embedding").alias("d", "x"))
             .groupBy("label", "d").agg(F.avg("x").alias("m"))
             .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("d", "m"))).alias("s"))
             .select(F.col("label").alias("centroid_id"), F.transform("s", lambda e: e["m"]).alias("mean")))
    far = means.agg(F.array_sort(F.collect_list(F.struct("centroid_id", "mean"))).alias("means"))
    nearest = F.array_min(F.transform("means", lambda c: F.struct(
        squared_l2(F.col("embedding"), c["mean"]).alias("dist"), c["centroid_id"].alias("centroid_id"))))
    met = emb.withColumn("one", F.lit(1)).join(far.withColumn("one", F.lit(1)), "one")
    return met.select("vec_id", nearest.alias("n")).select(
        "vec_id", F.col("n.centroid_id").alias("centroid_id"), F.round("n.dist", R).alias("dist"))


# Parameters of the registered indexes.
INDEXES = {
    "IVF_FLAT": {"num_partitions": 8, "sample_rate": 256},
    "IVF_SQ": {"num_partitions": 4, "sample_rate": 256},
    "IVF_PQ": {"num_partitions": 1, "num_sub_vectors": 8, "sample_rate": 256},
}
REFINE = 10
EVERY = 50


def _index(spark, sf_dir, index_type, **options):
    from ..operators.ivf import build_index
    from ..session import scratch_path
    emb = table(spark, sf_dir, "embeddings")
    return build_index(spark, emb, "embedding", scratch_path(spark, index_type.lower()), index_type=index_type,
                       **(INDEXES[index_type] | options))


def _asked(spark, sf_dir) -> DataFrame:
    """Every row whose id is divisible by 50, as a query."""
    return table(spark, sf_dir, "embeddings").where((F.col("vec_id") % EVERY == 0) & F.col("embedding").isNotNull()) \
        .select(F.col("vec_id").alias("query_id"), "embedding")


def _search_asked(spark, sf_dir, index_type) -> DataFrame:
    """Top 10 of every query through an index; the number of partitions that
    it probes is tuned on a sample of the queries."""
    from ..operators.vector_search import search_many, tune_probes
    index, asked = _index(spark, sf_dir, index_type), _asked(spark, sf_dir)
    probes = tune_probes(spark, index, asked, 10, target=0.97)
    return search_many(spark, index, asked, 10, nprobes=probes, refine_factor=REFINE)


_KNN_JOIN_SQL = f"""
WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings
           WHERE vec_id % {EVERY} = 0 AND embedding IS NOT NULL),
d AS (SELECT query_id, vec_id, list_sum(list_transform(list_zip(embedding, q),
             lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2)) AS dist
      FROM embeddings, q WHERE embedding IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, vec_id) AS rank FROM d)
SELECT query_id, vec_id, round(dist, {R}) AS dist, rank FROM r WHERE rank <= 10
"""


@register("ivf_search_all_probes", _KNN_JOIN_SQL)
def ivf_search_all_probes(spark, sf_dir):
    """Every partition probed: the exact neighbours of all queries."""
    from ..operators.vector_search import search_many
    index = _index(spark, sf_dir, "IVF_FLAT")
    found = search_many(spark, index, _asked(spark, sf_dir), 10, nprobes=index.num_partitions)
    return found.select("query_id", "vec_id", rnd("distance", "dist"), "rank")


def _found(df: DataFrame) -> DataFrame:
    return df.select("query_id", "vec_id", rnd("distance", "dist"), "rank")


@register("ivf_search")
def ivf_search_q(spark, sf_dir):
    return _found(_search_asked(spark, sf_dir, "IVF_FLAT"))


@register("pq_search")
def pq_search(spark, sf_dir):
    return _found(_search_asked(spark, sf_dir, "IVF_PQ"))


@register("sq_search")
def sq_search(spark, sf_dir):
    return _found(_search_asked(spark, sf_dir, "IVF_SQ"))


@register("index_recall", f"""
WITH q AS (SELECT count(*) AS n_queries FROM embeddings WHERE vec_id % {EVERY} = 0 AND embedding IS NOT NULL),
v AS (SELECT least(10, count(*)) AS k FROM embeddings WHERE embedding IS NOT NULL)
SELECT t.index_type, q.n_queries, q.n_queries * v.k AS n_true, true AS recall_ok
FROM q, v, (VALUES ('IVF_FLAT'), ('IVF_PQ'), ('IVF_SQ')) t(index_type)
""")
def index_recall(spark, sf_dir):
    """Recall of the registered searches against all rows, 0.9 or more."""
    from ..operators.vector_search import recall, search_many
    exact = search_many(spark, _index(spark, sf_dir, "IVF_FLAT"), _asked(spark, sf_dir), 10,
                        nprobes=INDEXES["IVF_FLAT"]["num_partitions"])
    parts = None
    for index_type in INDEXES:
        counts = recall(_search_asked(spark, sf_dir, index_type), exact, ["vec_id"]).agg(
            F.count(F.lit(1)).alias("n_queries"), F.sum("n_true").alias("n_true"),
            (F.sum("n_found") >= 0.9 * F.sum("n_true")).alias("recall_ok"))
        one = counts.select(F.lit(index_type).alias("index_type"), "n_queries", "n_true", "recall_ok")
        parts = one if parts is None else parts.unionByName(one)
    return parts


_RANGE = (1.0, 1.5)


def _bounded(spark, sf_dir, index_type, **options) -> DataFrame:
    from ..operators.vector_search import ivf_search
    index = _index(spark, sf_dir, index_type)
    found = ivf_search(spark, index, QVEC, 10, nprobes=1, tie_breakers=["vec_id"],
                       table=table(spark, sf_dir, "embeddings"), **options)
    return _knn_out(found)


@register("index_range", _knn_sql(lo_hi=_RANGE))
def index_range(spark, sf_dir):
    """A distance range through IVF: only partitions that reach into it."""
    return _bounded(spark, sf_dir, "IVF_FLAT", distance_range=_RANGE)


@register("index_range_sq", _knn_sql(lo_hi=_RANGE))
def index_range_sq(spark, sf_dir):
    return _bounded(spark, sf_dir, "IVF_SQ", distance_range=_RANGE)


@register("index_prefilter", _knn_sql("label IN (1, 3, 5)"))
def index_prefilter(spark, sf_dir):
    """A prefilter on a column that the index does not hold."""
    return _bounded(spark, sf_dir, "IVF_FLAT", where="label IN (1, 3, 5)")


@register("index_prefilter_sq", _knn_sql("label IN (1, 3, 5)"))
def index_prefilter_sq(spark, sf_dir):
    return _bounded(spark, sf_dir, "IVF_SQ", where="label IN (1, 3, 5)")


@register("index_fresh_rows", _knn_sql())
def index_fresh_rows(spark, sf_dir):
    """V9: a table indexed when it held two thirds of its rows; the others come
    later with earlier times, and a search through the index finds them."""
    from ..operators.ivf import build_index
    from ..operators.vector_search import ivf_search
    from ..session import scratch_path
    from ..sources.readers import read_asset
    from ..sources.sinks import append_asset
    emb = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "fresh-rows")
    first = F.col("vec_id") % 3 > 0
    append_asset(emb.where(first).withColumn("ingest_time", F.lit("2024-06-01").cast("timestamp")), path)
    index = build_index(spark, read_asset(spark, path), "embedding", f"{path}/_index/embedding",
                        index_type="IVF_FLAT", **INDEXES["IVF_FLAT"])
    append_asset(emb.where(~first).withColumn("ingest_time", F.lit("2023-01-01").cast("timestamp")), path)
    found = ivf_search(spark, index, QVEC, 10, tie_breakers=["vec_id"], table=read_asset(spark, path), complete=True)
    return _knn_out(found)


@register("sq_codes", """
WITH u AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
           WHERE embedding IS NOT NULL),
b AS (SELECT i, min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM u GROUP BY i),
c AS (SELECT u.vec_id, u.i,
             CASE WHEN hi > lo THEN least(255, greatest(0, floor((x::DOUBLE - lo) / (hi - lo) * 256))) ELSE 0 END AS code
      FROM u JOIN b ON u.i = b.i)
SELECT vec_id, string_agg(CAST(CAST(code AS BIGINT) AS VARCHAR), ',' ORDER BY i) AS codes FROM c GROUP BY vec_id
""")
def sq_codes_q(spark, sf_dir):
    from ..operators.ivf import _sq_bounds, sq_codes
    emb = table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull())
    lo, hi = _sq_bounds(emb, "embedding")
    return emb.select("vec_id", F.array_join(sq_codes(F.col("embedding"), lo, hi), ",").alias("codes"))


@register("l2_normalize", f"""
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 3) AS v FROM embeddings
           WHERE embedding IS NOT NULL),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM s)
SELECT vec_id, generate_subscripts(v, 1) - 1 AS dim,
       round(unnest(list_transform(v, lambda x: CASE WHEN nrm > 0 THEN x / nrm ELSE x END)), {R}) AS value
FROM n
""")
def l2_normalize_q(spark, sf_dir):
    from ..functions.vectors import checked_size, l2_normalize
    emb = table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull())
    tripled = F.transform(F.col("embedding"), lambda x: x.cast("double") * 3)
    norm = emb.select("vec_id", l2_normalize(checked_size(tripled, 64)).alias("v"))
    return norm.select("vec_id", F.posexplode("v").alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("long").alias("dim"), rnd("value"))


# ---------------------------------------------------------------------------
# Audio signal features: events.value minus the user's mean, per user in
# (ts, event_id) order, stand in for one recording's samples.
# ---------------------------------------------------------------------------

def _samples(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("value").isNotNull())
    means = ev.groupBy("user_id").agg(F.avg("value").alias("_mean"))
    return ev.join(means, "user_id").select(
        "user_id", "ts", "event_id", (F.col("value") - F.col("_mean")).alias("x"))


def _features(spark, sf_dir) -> DataFrame:
    from ..operators.signal import signal_features
    return signal_features(_samples(spark, sf_dir), "user_id", ["ts", "event_id"], "x", 64)


_SIGNAL_SQL = """
WITH s AS (SELECT user_id, ts, event_id, value - avg(value) OVER (PARTITION BY user_id) AS x
           FROM events WHERE value IS NOT NULL),
p AS (SELECT user_id, ts, event_id, x,
             max(abs(x)) OVER (PARTITION BY user_id) AS peak,
             ntile(64) OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS bucket
      FROM s),
q AS (SELECT *, CAST(signbit(x) AS INTEGER) AS sb,
             lag(CAST(signbit(x) AS INTEGER)) OVER (PARTITION BY user_id, bucket ORDER BY ts, event_id) AS prev_sb
      FROM p),
agg AS (SELECT user_id, bucket,
               sqrt(avg(power(CASE WHEN peak > 0 THEN x / peak ELSE x END, 2))) AS rms,
               CASE WHEN count(*) > 1 THEN sum(abs(sb - prev_sb)) / (count(*) - 1) ELSE 0.0 END AS zcr
        FROM q GROUP BY user_id, bucket),
allb AS (SELECT u.user_id, CAST(b.bucket AS BIGINT) AS bucket
         FROM (SELECT DISTINCT user_id FROM events WHERE value IS NOT NULL) u, range(64) b(bucket)),
f AS (SELECT allb.user_id, allb.bucket, coalesce(agg.rms, 0.0) AS rms, coalesce(agg.zcr, 0.0) AS zcr
      FROM allb LEFT JOIN agg ON allb.user_id = agg.user_id AND allb.bucket = agg.bucket)
"""


@register("bucket_rms", _SIGNAL_SQL + f"SELECT user_id, bucket, round(rms, {R}) AS rms FROM f")
def bucket_rms(spark, sf_dir):
    return _features(spark, sf_dir).select("user_id", "bucket", rnd("rms"))


@register("bucket_zcr", _SIGNAL_SQL + f"SELECT user_id, bucket, round(zcr, {R}) AS zcr FROM f")
def bucket_zcr(spark, sf_dir):
    return _features(spark, sf_dir).select("user_id", "bucket", rnd("zcr"))


@register("signal_embed", _SIGNAL_SQL + f"""
, v AS (SELECT user_id, bucket AS dim, rms AS val FROM f
        UNION ALL SELECT user_id, bucket + 64 AS dim, zcr AS val FROM f),
n AS (SELECT user_id, sqrt(sum(val * val)) AS nrm FROM v GROUP BY user_id)
SELECT v.user_id, v.dim, round(CASE WHEN n.nrm > 0 THEN v.val / n.nrm ELSE v.val END, {R}) AS value
FROM v JOIN n ON v.user_id = n.user_id
""")
def signal_embed(spark, sf_dir):
    from ..operators.signal import bucket_stats, embedding_long, signal_embedding
    stats = bucket_stats(_samples(spark, sf_dir), "user_id", ["ts", "event_id"], "x", 64)
    emb = signal_embedding(stats, "user_id")
    return embedding_long(emb, "user_id").select(
        "user_id", F.col("dim").cast("long").alias("dim"), rnd("value"))


@register("duration", f"""
SELECT l_orderkey, l_linenumber, round(d, {R}) AS duration_s FROM (
  SELECT l_orderkey, l_linenumber,
         coalesce(l_extendedprice / nullif(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber - 1 END, 0), 0.0) AS d
  FROM lineitem) WHERE d BETWEEN 0 AND 1800
""")
def duration_q(spark, sf_dir):
    from ..operators.signal import duration_seconds
    li = table(spark, sf_dir, "lineitem")
    rate = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_linenumber") - 1)
    d = li.select("l_orderkey", "l_linenumber",
                  duration_seconds(F.col("l_extendedprice"), rate).alias("duration_s"))
    return d.where(F.col("duration_s").between(0.0, 1800.0)).select(
        "l_orderkey", "l_linenumber", rnd("duration_s"))


# ---------------------------------------------------------------------------
# Image measures
# ---------------------------------------------------------------------------

def _refl(e: str, n: int) -> str:
    return f"(CASE WHEN {e} < 0 THEN -({e}) WHEN {e} > {n - 1} THEN {2 * (n - 1)} - ({e}) ELSE {e} END)"


@register("laplacian_var", f"""
WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT vec_id, v, unnest(range(64)) AS p FROM u),
l AS (SELECT vec_id, v, p // 8 AS r, p % 8 AS c FROM p),
lap AS (SELECT vec_id,
          v[{_refl('r - 1', 8)} * 8 + c + 1] + v[{_refl('r + 1', 8)} * 8 + c + 1]
          + v[r * 8 + {_refl('c - 1', 8)} + 1] + v[r * 8 + {_refl('c + 1', 8)} + 1]
          - 4 * v[r * 8 + c + 1] AS lp
        FROM l)
SELECT vec_id, round(var_pop(lp), {R}) AS lap_var FROM lap GROUP BY vec_id
""")
def laplacian_var(spark, sf_dir):
    from ..functions.imaging import grid_laplacian_variance
    emb = table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull())
    return emb.select("vec_id", F.round(grid_laplacian_variance(F.col("embedding"), 8, 8), R).alias("lap_var"))


FACE_IMG_W, FACE_IMG_H = 40, 12
FACE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]  # detector order, unique per order


@register("largest_face", f"""
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1.0 - l_discount AS score,
                  l_tax * 100 - 2 AS x1, l_discount * 100 - 1 AS y1,
                  l_tax * 100 - 2 + l_quantity AS x2, l_discount * 100 - 1 + l_linenumber * 2 AS y2
           FROM lineitem),
g AS (SELECT *, (x2 - x1) * (y2 - y1) AS area,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY (x2 - x1) * (y2 - y1) DESC, l_linenumber, l_partkey, l_suppkey) AS rn,
             count(*) OVER (PARTITION BY l_orderkey) AS n
      FROM f),
b AS (SELECT *, greatest(0, CAST(trunc(x1) AS BIGINT)) AS cx1, greatest(0, CAST(trunc(y1) AS BIGINT)) AS cy1,
             least({FACE_IMG_W}, CAST(trunc(x2) AS BIGINT)) AS cx2, least({FACE_IMG_H}, CAST(trunc(y2) AS BIGINT)) AS cy2
      FROM g WHERE rn = 1)
SELECT l_orderkey, n AS face_count, round(score, {R}) AS face_score,
       round(greatest(0.0, area) / ({FACE_IMG_W} * {FACE_IMG_H}), {R}) AS face_area_ratio,
       CASE WHEN cx2 > cx1 AND cy2 > cy1 THEN cx1 END AS crop_x1,
       CASE WHEN cx2 > cx1 AND cy2 > cy1 THEN cy1 END AS crop_y1,
       CASE WHEN cx2 > cx1 AND cy2 > cy1 THEN cx2 END AS crop_x2,
       CASE WHEN cx2 > cx1 AND cy2 > cy1 THEN cy2 END AS crop_y2,
       CASE WHEN cx2 > cx1 AND cy2 > cy1 THEN CAST((cx2 - cx1) * (cy2 - cy1) AS DOUBLE) END AS face_blur_score
FROM b
""")
def largest_face_q(spark, sf_dir):
    from ..functions.imaging import clamp_box, face_area_ratio
    from ..operators.faces import largest_face
    li = table(spark, sf_dir, "lineitem")
    x1 = F.col("l_tax") * 100 - 2
    y1 = F.col("l_discount") * 100 - 1
    faces = li.select("l_orderkey", *FACE_ORDER, (F.lit(1.0) - F.col("l_discount")).alias("score"),
                      x1.alias("x1"), y1.alias("y1"), (x1 + F.col("l_quantity")).alias("x2"),
                      (y1 + F.col("l_linenumber") * 2).alias("y2"))
    faces = faces.withColumn("area", (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")))
    best = largest_face(faces, ["l_orderkey"], FACE_ORDER, "area", ["score", "x1", "y1", "x2", "y2"])
    w, h = F.lit(FACE_IMG_W), F.lit(FACE_IMG_H)
    box = clamp_box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), w, h)
    out = best.select("l_orderkey", "face_count", F.round("score", R).alias("face_score"),
                      F.round(face_area_ratio(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), w, h), R)
                      .alias("face_area_ratio"), box.alias("box"))
    return out.select("l_orderkey", "face_count", "face_score", "face_area_ratio",
                      F.col("box.x1").alias("crop_x1"), F.col("box.y1").alias("crop_y1"),
                      F.col("box.x2").alias("crop_x2"), F.col("box.y2").alias("crop_y2"),
                      ((F.col("box.x2") - F.col("box.x1")) * (F.col("box.y2") - F.col("box.y1")))
                      .cast("double").alias("face_blur_score"))


@register("resize_dims", f"""
SELECT p_partkey, h, w,
       CASE WHEN greatest(h, w) <= 1024 THEN h ELSE greatest(1, CAST(round_even(h * (1024.0 / greatest(h, w)), 0) AS BIGINT)) END AS new_h,
       CASE WHEN greatest(h, w) <= 1024 THEN w ELSE greatest(1, CAST(round_even(w * (1024.0 / greatest(h, w)), 0) AS BIGINT)) END AS new_w,
       round(CASE WHEN greatest(h, w) <= 1024 THEN 1.0 ELSE 1024.0 / greatest(h, w) END, {R}) AS scale
FROM (SELECT p_partkey, CAST(p_size * 40 AS BIGINT) AS h, CAST(floor(p_retailprice) AS BIGINT) AS w FROM part)
""")
def resize_dims(spark, sf_dir):
    from ..functions.imaging import resized_dims
    part = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") * 40).cast("long").alias("h"),
        F.floor("p_retailprice").cast("long").alias("w"))
    nh, nw, scale = resized_dims(F.col("h"), F.col("w"), 1024)
    return part.select("p_partkey", "h", "w", nh.alias("new_h"), nw.alias("new_w"), F.round(scale, R).alias("scale"))


# ---------------------------------------------------------------------------
# Table maintenance (events.ts stands in for ingest_time)
# ---------------------------------------------------------------------------

ZONE_ROWS = 1000
PRUNE_LO, PRUNE_HI = "2024-01-05 00:00:00", "2024-01-07 12:00:00"


def _zone(col: str = "event_id"):
    return F.floor(F.col(col) / ZONE_ROWS).cast("long")


@register("zonemap", f"""
SELECT CAST(floor(event_id / {ZONE_ROWS}) AS BIGINT) AS zone, min(ts) AS min_time, max(ts) AS max_time,
       count(*) AS rows
FROM events GROUP BY 1
""")
def zonemap_q(spark, sf_dir):
    from ..operators.maintenance import zone_map
    return zone_map(table(spark, sf_dir, "events"), "ts", _zone())


@register("zonemap_prune", f"""
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '{PRUNE_LO}' AND ts <= TIMESTAMP '{PRUNE_HI}'
""")
def zonemap_prune(spark, sf_dir):
    """A time range; files' statistics say which row groups are not read."""
    from ..operators.maintenance import scan_time_range
    return scan_time_range(table(spark, sf_dir, "events"), PRUNE_LO, PRUNE_HI, "ts").select("event_id", "ts")


def _delete_sql(before=None, after=None) -> str:
    clauses = []
    if before:
        clauses.append(f"ts < TIMESTAMP '{before}'")
    if after:
        clauses.append(f"ts > TIMESTAMP '{after}'")
    return f"SELECT event_id, ts FROM events WHERE NOT coalesce({' AND '.join(clauses)}, false)"


@register("delete_before", _delete_sql(before="2024-01-10 00:00:00"))
def delete_before(spark, sf_dir):
    from ..operators.maintenance import keep_after_delete
    ev = table(spark, sf_dir, "events")
    return keep_after_delete(ev, before="2024-01-10", time_col="ts").select("event_id", "ts")


@register("delete_after", _delete_sql(after="2024-01-20 00:00:00"))
def delete_after(spark, sf_dir):
    from ..operators.maintenance import keep_after_delete
    ev = table(spark, sf_dir, "events")
    return keep_after_delete(ev, after="2024-01-20T00:00:00", time_col="ts").select("event_id", "ts")


def _events_asset(spark, sf_dir, name: str) -> str:
    """events written as an asset table (ts as ingest_time), partitioned by date."""
    from ..session import scratch_path
    from ..sources.sinks import append_asset
    path = scratch_path(spark, name)
    ev = table(spark, sf_dir, "events").withColumnRenamed("ts", "ingest_time")
    append_asset(ev, path)
    return path


@register("delete_window", _delete_sql(before="2024-01-20 00:00:00", after="2024-01-10 12:00:00"))
def delete_window(spark, sf_dir):
    """Real table delete: whole days dropped, two boundary days rewritten."""
    from ..operators.maintenance import delete_by_date
    path = _events_asset(spark, sf_dir, "delete-window")
    delete_by_date(spark, path, before="2024-01-20", after="2024-01-10T12:00:00")
    return spark.read.parquet(path).select("event_id", F.col("ingest_time").alias("ts"))


@register("append_union", """
SELECT event_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN value END AS value FROM events
""")
def append_union(spark, sf_dir):
    """Two appends to one table; the second batch lacks ``value``."""
    from ..session import scratch_path
    from ..sources.sinks import append_asset, cast_to_schema
    path = scratch_path(spark, "append-union")
    ev = table(spark, sf_dir, "events").withColumnRenamed("ts", "ingest_time")
    cut = F.col("ingest_time") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    first = ev.where(cut)
    append_asset(first, path)
    schema = spark.read.parquet(path).drop("ingest_date").schema
    second = ev.where(~cut).drop("value")
    append_asset(cast_to_schema(second, schema), path)
    return spark.read.parquet(path).select("event_id", "event_type", "value")


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

# Fixed registry rows: catalog metadata, one row per fileset.
FILESET_REGISTRY = [
    ("cat", "web", "blog", "s3a://media-bucket/blog/"),
    ("cat", "web", "main", "s3://media-bucket/main"),
]


def _virtual_parts():
    host = F.regexp_extract(F.col("url"), r"^[a-z]+://([^/?#]+)", 1)
    path = F.regexp_extract(F.col("url"), r"^[a-z]+://[^/?#]+(/[^?#]*)?", 1)
    fileset = (F.when(host.startswith("blog."), F.lit("blog"))
               .when(host.startswith("m."), F.lit("mobile")).otherwise(F.lit("main")))
    return fileset, path


@register("resolve_uri", """
WITH p AS (
  SELECT page_id,
         CASE WHEN starts_with(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), 'blog.') THEN 'blog'
              WHEN starts_with(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), 'm.') THEN 'mobile'
              ELSE 'main' END AS fileset,
         regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+(/[^?#]*)?', 1), '^/+', '') AS sub
  FROM pages)
SELECT page_id,
       CASE WHEN sub = '' THEN 'gvfs://fileset/cat/web/' || fileset
            ELSE 'gvfs://fileset/cat/web/' || fileset || '/' || sub END AS path,
       CASE WHEN fileset = 'blog' THEN CASE WHEN sub = '' THEN 's3://media-bucket/blog' ELSE 's3://media-bucket/blog/' || sub END
            WHEN fileset = 'main' THEN CASE WHEN sub = '' THEN 's3://media-bucket/main' ELSE 's3://media-bucket/main/' || sub END
       END AS location
FROM p
""")
def resolve_uri(spark, sf_dir):
    from ..sources.fileset import resolve_fileset_uri, to_virtual_path
    pages = table(spark, sf_dir, "pages")
    fileset, path = _virtual_parts()
    virt = pages.select("page_id", to_virtual_path(F.lit("cat"), F.lit("web"), fileset, path).alias("path"))
    registry = spark.createDataFrame(FILESET_REGISTRY, "catalog string, schema string, fileset string, location string")
    return resolve_fileset_uri(virt, registry, "path", "location").select("page_id", "path", "location")


def _stored_pages(spark, sf_dir, suffix: str) -> str:
    """Each page's html as an object; the folder of them."""
    from ..session import scratch_path
    folder = scratch_path(spark, "objects")
    pages = table(spark, sf_dir, "pages").where("length(html) > 0")
    url = F.concat(F.lit(f"{folder}/page-"), F.col("page_id").cast("string"), F.lit(suffix))
    write_objects(pages.repartition("page_id").select(url.alias("url"), F.encode("html", "utf-8").alias("content")))
    return folder


@register("file_listing", """
SELECT 'page-' || page_id || '.html' AS name, CAST(octet_length(encode(html)) AS BIGINT) AS length
FROM pages WHERE length(html) > 0
""")
def file_listing(spark, sf_dir):
    """S7 over the pages as objects: names and sizes, no contents."""
    from ..functions.tagging import file_name
    from ..sources.readers import list_files
    listing = list_files(spark, _stored_pages(spark, sf_dir, ".html"), "page-*.html")
    return listing.select(file_name(F.col("path")).alias("name"), "length")


@register("build_manifest", """
SELECT 'page-' || page_id || '.JPG' AS doc_id, true AS is_location FROM pages WHERE length(html) > 0
""")
def build_manifest_q(spark, sf_dir):
    """S15 over the pages as objects."""
    from ..sources.fileset import build_manifest
    folder = _stored_pages(spark, sf_dir, ".JPG")
    manifest = build_manifest(spark, folder, media="image")
    return manifest.select("doc_id", F.col("s3_url").endswith(F.concat(F.lit("/"), F.col("doc_id"))).alias("is_location"))


@register("glob_scan", "SELECT * FROM nation")
def glob_scan(spark, sf_dir):
    from ..sources.readers import read_parquet_glob
    return read_parquet_glob(spark, f"{sf_dir.rstrip('/')}/natio*.parquet")


_MANIFEST_SQL = "SELECT CAST(page_id AS VARCHAR) AS doc_id, url AS s3_url FROM pages"


def _manifest(spark, sf_dir, kind: str) -> DataFrame:
    """Pages written as a manifest with another column, read back via S1."""
    from ..session import scratch_path
    from ..sources.readers import read_manifest
    path = f"{scratch_path(spark, 'manifest')}.{kind}"
    rows = table(spark, sf_dir, "pages").select(
        F.length("html").alias("n_chars"), F.col("page_id").cast("string").alias("doc_id"), F.col("url").alias("s3_url"))
    if kind == "csv":
        rows.write.option("header", True).option("escape", '"').csv(path)
    elif kind == "jsonl":
        rows.write.json(path)
    else:
        rows.write.parquet(path)
    return read_manifest(spark, path)


@register("csv_manifest", _MANIFEST_SQL)
def csv_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir, "csv")


@register("jsonl_manifest", _MANIFEST_SQL)
def jsonl_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir, "jsonl")


@register("parquet_manifest", _MANIFEST_SQL)
def parquet_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir, "parquet")


@register("csv_glob", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_glob(spark, sf_dir):
    """Orders as CSV files with a declared schema."""
    from ..session import scratch_path
    from ..sources.readers import read_csv_glob
    path = scratch_path(spark, "orders-csv")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_csv_glob(spark, f"{path}/*.csv", rows.schema)


@register("desc_reader_join", """
SELECT l.doc_id, l.quality, d.lang AS description
FROM labels l LEFT JOIN (SELECT doc_id, lang FROM documents WHERE source = 'src0') d ON l.doc_id = d.doc_id
""")
def desc_reader_join(spark, sf_dir):
    """S3: a description table kept as JSON lines, joined to the labels."""
    from ..session import scratch_path
    from ..sources.readers import read_desc_table
    path = scratch_path(spark, "descriptions") + ".jsonl"
    (table(spark, sf_dir, "documents").where("source = 'src0'")
     .select("doc_id", F.col("lang").alias("description")).write.json(path))
    desc = read_desc_table(spark, path).withColumn("doc_id", F.col("doc_id").cast("long"))
    out, cols = q.join_descriptions(table(spark, sf_dir, "labels"), desc, ["doc_id", "quality"])
    return out.select(*cols)


@register("write_modes", """
SELECT 1 AS step, 'create' AS mode, count(*) AS rows FROM events
UNION ALL SELECT 2, 'append', 2 * count(*) FROM events
""")
def write_modes(spark, sf_dir):
    """The mode before each of two appends, and the rows after it."""
    from ..session import scratch_path
    from ..sources.readers import read_asset
    from ..sources.sinks import append_asset, table_write_mode
    path, out = scratch_path(spark, "modes"), None
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "ingest_time")
    for step in (1, 2):
        mode = table_write_mode(spark, path)
        append_asset(events, path)
        # Read now, as the next append adds files.
        rows = read_asset(spark, path).count()
        one = spark.range(1).select(F.lit(step).alias("step"), F.lit(mode).alias("mode"), F.lit(rows).cast("long").alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


@register("vector_column_check", """
SELECT label, count(*) AS rows FROM embeddings GROUP BY label
""")
def vector_column_check(spark, sf_dir):
    """Of three batches the ones without the table's vector column, or
    with another, are refused, and the table keeps the first."""
    from ..session import scratch_path
    from ..sources.readers import read_asset
    from ..sources.sinks import append_asset, check_vector_columns
    path = scratch_path(spark, "vectors")
    emb = table(spark, sf_dir, "embeddings").withColumn("ingest_time", F.lit("2024-01-01").cast("timestamp"))
    for batch in (emb, emb.drop("embedding"), emb.withColumn("second", F.col("embedding"))):
        try:
            check_vector_columns(spark, path, batch)
        except ValueError:
            continue
        append_asset(batch, path)
    return read_asset(spark, path).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


@register("output_mode", """
SELECT doc_id, CASE WHEN lang = 'en' THEN source <> 'src0' ELSE source <> 'src1' END AS accepted
FROM documents
""")
def output_mode(spark, sf_dir):
    """P15 for an output planned per document: src0 goes to JSON lines, src1 to
    a Parquet table, others elsewhere; English documents carry vectors."""
    from ..sources.sinks import output_mode_ok
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("out/"), "doc_id", F.when(F.col("source") == "src0", ".jsonl")
                    .when(F.col("source") == "src1", ".parquet/").otherwise(".table"))
    return docs.select("doc_id", output_mode_ok(path, F.col("lang") == "en").alias("accepted"))


@register("variance_large_mean", """
WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE + 1000000.0 AS x FROM embeddings WHERE embedding IS NOT NULL)
SELECT vec_id, round(var_pop(x), 4) AS variance FROM u GROUP BY vec_id
""")
def variance_large_mean(spark, sf_dir):
    """A8's variance on values with a mean of a million."""
    from ..functions.imaging import population_variance
    emb = table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL")
    shifted = F.transform("embedding", lambda x: x.cast("double") + 1e6)
    return emb.select("vec_id", F.round(population_variance(shifted), 4).alias("variance"))


DESCRIPTIONS = [(1, "清晰正面人像"), (5, "两人合影"), (10**9, "不存在的图")]


@register("literal_rows", """
SELECT l.doc_id, l.quality, d.description
FROM labels l LEFT JOIN (VALUES (1, '清晰正面人像'), (5, '两人合影'), (1000000000, '不存在的图')) d(doc_id, description)
  ON l.doc_id = d.doc_id
""")
def literal_rows(spark, sf_dir):
    from ..sources.readers import from_rows
    desc = from_rows(spark, DESCRIPTIONS, "doc_id bigint, description string")
    labels = table(spark, sf_dir, "labels")
    out, cols = q.join_descriptions(labels, F.broadcast(desc), ["doc_id", "quality"])
    return out.select(*cols)


@register("json_round_trip", """
SELECT d.doc_id, d.text, d.lang, l.quality, CAST(NULL AS DOUBLE) AS face_blur_score, d.n_chars
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def json_round_trip(spark, sf_dir):
    """JSON sink keeps null fields; the typed reader restores an all-null column."""
    from ..session import scratch_path
    from ..sources.readers import read_analysis_output
    from ..sources.sinks import write_json
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("quality", T.IntegerType()),
                           T.StructField("face_blur_score", T.DoubleType()),
                           T.StructField("n_chars", T.LongType())])
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    out = docs.join(labels, "doc_id", "left").select(
        "doc_id", "text", "lang", "quality", F.lit(None).cast("double").alias("face_blur_score"), "n_chars")
    path = scratch_path(spark, "analysis") + ".jsonl"
    write_json(out, path)
    return read_analysis_output(spark, path, schema)


@register("staging_round_trip", f"""
SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim, round(unnest(embedding)::DOUBLE, {R}) AS value
FROM embeddings WHERE embedding IS NOT NULL
""")
def staging_round_trip(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.readers import read_analysis_output
    from ..sources.sinks import write_staging
    path = scratch_path(spark, "staging") + ".parquet"
    write_staging(table(spark, sf_dir, "embeddings"), path)
    back = read_analysis_output(spark, path).where(F.col("embedding").isNotNull())
    return back.select("vec_id", "label", F.posexplode("embedding").alias("dim", "value")).select(
        "vec_id", "label", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), R).alias("value"))


@register("content_join", """
SELECT page_id,
       CASE WHEN page_id % 10 <> 0 THEN CAST(octet_length(encode(html)) AS BIGINT) END AS n_bytes,
       CASE WHEN page_id % 10 <> 0 THEN sha256(html) END AS content_sha256
FROM pages
""")
def content_join(spark, sf_dir):
    """Every page's html as an object of its own, fetched by a manifest of all
    pages in which each tenth object, and that of a null html, is missing."""
    from ..session import scratch_path
    from ..sources.fetch import fetch_content
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "pages")
    stored = pages.where("page_id % 10 <> 0 AND html IS NOT NULL").repartition("page_id")
    write_objects(stored.select(page_object("page_id", folder).alias("url"),
                                F.encode("html", "utf-8").alias("content")))
    manifest = pages.select("page_id", page_object("page_id", folder).alias("s3_url"))
    return fetch_content(manifest).select(
        "page_id", F.length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("content_sha256"))


def page_object(id_col: str, folder: str) -> Column:
    return F.concat(F.lit(f"{folder}/_page-"), F.col(id_col).cast("string"), F.lit(".html"))


def write_objects(rows: DataFrame) -> None:
    """One object per row of (url, bytes), written by the rows' own tasks."""
    def run(batches):
        from ..sources.fetch import ObjectReader
        reader, made = ObjectReader(), set()
        for batch in batches:
            for url, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = reader.locate(url)
                folder = path.rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(path, compression=None) as sink:
                    sink.write(data)
            yield batch.select([0])

    rows.mapInArrow(run, T.StructType(rows.schema.fields[:1])).write.format("noop").mode("overwrite").save()


@register("struct_flatten", """
SELECT doc_id, lang, n_chars, CASE WHEN lang = 'en' THEN n_chars END AS en_chars,
       CAST(n_chars AS DOUBLE) / 1000 AS kchars, text IS NULL AS text_missing
FROM documents
""")
def struct_flatten(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    nested = docs.select(F.struct("doc_id", "lang", "n_chars", "text").alias("s"))
    flat = nested.select("s.*")
    return flat.select("doc_id", "lang", "n_chars",
                       F.when(F.col("lang") == "en", F.col("n_chars")).alias("en_chars"),
                       (F.col("n_chars").cast("double") / 1000).alias("kchars"),
                       F.col("text").isNull().alias("text_missing"))


INGEST_NOW = "2024-06-01 12:00:00"


@register("ingest_stamp", f"""
SELECT doc_id, TIMESTAMP '{INGEST_NOW}' AS ingest_time, DATE '{INGEST_NOW[:10]}' AS ingest_date FROM documents
""")
def ingest_stamp(spark, sf_dir):
    from ..plans.jobs import ingest_time_literal
    docs = table(spark, sf_dir, "documents")
    t = ingest_time_literal(INGEST_NOW)
    # Reported as a wall-clock UTC timestamp, the type the shared tables use.
    return docs.select("doc_id", t.cast("timestamp_ntz").alias("ingest_time"), F.to_date(t).alias("ingest_date"))


@register("blob_audit", _IMAGE_SQL + """
SELECT count(*) AS rows, count(*) FILTER (WHERE status = 'ok' AND quality = 0) AS ok_without_blob FROM v
""")
def blob_audit(spark, sf_dir):
    from ..sources.sinks import validate_blob_column
    img = image_standin(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep_content=True)
    img = img.withColumn("image_blob", F.when(F.col("quality") == 1, F.col("content")).cast("binary"))
    return validate_blob_column(img, "image_blob")


# ---------------------------------------------------------------------------
# Python model seams (stub models, Arrow batches)
# ---------------------------------------------------------------------------

class TextStats:
    """Lengths of whole (text, lang) columns as a struct."""

    def __call__(self, text, lang):
        import pandas as pd
        return pd.DataFrame({"chars": text.str.len().astype("Int64"),
                             "lines": (text.str.count("\n") + 1).astype("Int64"),
                             "lang_len": lang.str.len().astype("Int64")})


@register("udf_batch", """
SELECT doc_id, length(text) AS chars, length(text) - length(replace(text, chr(10), '')) + 1 AS lines,
       length(lang) AS lang_len
FROM documents
""")
def udf_batch(spark, sf_dir):
    from ..operators.models import batch_udf
    rtype = T.StructType([T.StructField("chars", T.LongType()), T.StructField("lines", T.LongType()),
                          T.StructField("lang_len", T.LongType())])
    stats = batch_udf(TextStats, rtype)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", stats(F.col("text"), F.col("lang")).alias("s")).select("doc_id", "s.*")


STUB_CHARS = ["a", "e", "i", "o", "u", " ", "\n"]


class CharProfile:
    """Length and a few character counts of texts, as unit vectors."""

    dim = 1 + len(STUB_CHARS)

    def embed_batch(self, texts):
        import re

        import numpy as np
        counts = [texts.str.len(), *(texts.str.count(re.escape(c)) for c in STUB_CHARS)]
        raw = np.stack([c.to_numpy(dtype=np.float64) for c in counts], axis=1)
        norm = np.sqrt((raw * raw).sum(axis=1, keepdims=True))
        out = pd_series(raw / np.where(norm > 0, norm, 1.0))
        return out.where(texts.str.len().to_numpy() > 0, None)

    def embed_text(self, text):
        import pandas as pd
        return self.embed_batch(pd.Series([text], dtype=object)).iloc[0] if text else None


def pd_series(rows):
    import pandas as pd
    return pd.Series(list(rows), dtype=object)


def _stub_sql(text: str) -> str:
    parts = [f"CAST(length({text}) AS DOUBLE)"] + [
        f"CAST(length({text}) - length(replace({text}, {'chr(10)' if c == chr(10) else sql_str(c)}, '')) AS DOUBLE)"
        for c in STUB_CHARS]
    return "[" + ", ".join(parts) + "]"


_GUARDED_SQL = _IMAGE_SQL + f"""
, g AS (SELECT v.doc_id, {_stub_sql('d.text')} AS raw
        FROM v JOIN documents d ON v.doc_id = d.doc_id WHERE v.status = 'ok'),
e AS (SELECT doc_id, raw, sqrt(list_sum(list_transform(raw, lambda x: x * x))) AS nrm FROM g)
"""


def _guarded(spark, sf_dir) -> DataFrame:
    from ..operators.models import guarded_embedding
    img = image_standin(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep_content=True)
    emb = guarded_embedding(CharProfile, F.col("content"), F.col("status") == "ok", CharProfile.dim)
    return img.select("doc_id", emb.alias("embedding"))


@register("embed_guarded", _GUARDED_SQL + f"""
SELECT doc_id, generate_subscripts(raw, 1) - 1 AS dim,
       round(unnest(list_transform(raw, lambda x: CAST(CAST(x / nrm AS FLOAT) AS DOUBLE))), {R}) AS value
FROM e
""")
def embed_guarded(spark, sf_dir):
    g = _guarded(spark, sf_dir).where(F.col("embedding").isNotNull())
    return g.select("doc_id", F.posexplode("embedding").alias("dim", "value")).select(
        "doc_id", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), R).alias("value"))


QUERY_TEXT = "the quick brown fox jumps over the lazy dog\nagain and again"
_QTEXT_VEC = [float(x) for x in CharProfile().embed_text(QUERY_TEXT)]
_QTEXT_SQL = "([" + ", ".join(repr(x) for x in _QTEXT_VEC) + "]::DOUBLE[])"


@register("text_query_stub", _GUARDED_SQL + f"""
, n AS (SELECT doc_id, list_transform(raw, lambda x: CAST(CAST(x / nrm AS FLOAT) AS DOUBLE)) AS v FROM e),
d AS (SELECT doc_id, {_dist_sql('v', _QTEXT_SQL)} AS dist FROM n)
SELECT doc_id, round(dist, {R}) AS dist FROM d ORDER BY dist, doc_id LIMIT 10
""")
def text_query_stub(spark, sf_dir):
    from ..operators.knn import DIST_COL, knn_by_embedder
    g = _guarded(spark, sf_dir)
    top = knn_by_embedder(g, "embedding", CharProfile().embed_text, QUERY_TEXT, 10, tie_breakers=["doc_id"])
    return top.select("doc_id", F.round(F.col(DIST_COL), R).alias("dist"))


def _answers(prompt: Column) -> Column:
    """A JSON answer per prompt, told by its length; some are malformed."""
    from ..schemas import PRIMARY_REASONS, TEXT_EMOTIONS
    n = F.length(prompt)
    reasons = F.array(*[F.lit(x) for x in PRIMARY_REASONS])
    emotions = F.array(*[F.lit(x) for x in TEXT_EMOTIONS])
    answer = F.to_json(F.struct(
        (n % 2 == 0).alias("downgrade_related"), F.element_at(reasons, n % 7 + 1).alias("primary_reason"),
        F.concat(F.lit("len "), n.cast("string")).alias("summary"), (n % 100 / 100).alias("confidence"),
        F.element_at(emotions, n % 6 + 1).alias("text_emotion"), (n % 3 == 0).alias("bad_tone"),
        (n % 10 / 10).alias("emotion_score")))
    return F.when(n % 5 == 0, F.lit('{"downgrade_related": tru')).otherwise(answer)


def _llm_sql() -> str:
    from ..schemas import PRIMARY_REASONS, TEXT_EMOTIONS
    reasons = "[" + ", ".join(sql_str(x) for x in PRIMARY_REASONS) + "]"
    emotions = "[" + ", ".join(sql_str(x) for x in TEXT_EMOTIONS) + "]"
    return f"""
WITH p AS (SELECT conv_id, turn, length({_prompt_sql('text', _ROLE_EMOTION_SQL)}) AS n FROM conversations)
SELECT conv_id, turn,
       CASE WHEN n % 5 = 0 THEN false ELSE n % 2 = 0 END AS downgrade_related,
       CASE WHEN n % 5 = 0 THEN '其他' ELSE {reasons}[n % 7 + 1] END AS primary_reason,
       '' AS secondary_reason,
       CASE WHEN n % 5 = 0 THEN '' ELSE 'len ' || CAST(n AS VARCHAR) END AS summary,
       CASE WHEN n % 5 = 0 THEN 0.0 ELSE round((n % 100) / 100.0, {R}) END AS confidence,
       CASE WHEN n % 5 = 0 THEN '未知' ELSE {emotions}[n % 6 + 1] END AS text_emotion,
       CASE WHEN n % 5 = 0 THEN false ELSE n % 3 = 0 END AS bad_tone,
       CASE WHEN n % 5 = 0 THEN 0.0 ELSE round((n % 10) / 10.0, {R}) END AS emotion_score
FROM p
"""


@register("llm_tag_stub", _llm_sql())
def llm_tag_stub(spark, sf_dir):
    """U5's way from prompts to typed fields; the answers are made by Spark."""
    conv = table(spark, sf_dir, "conversations")
    prompts = conv.select("conv_id", "turn", tagging.build_prompt(F.col("text"), _role_emotion()).alias("prompt"))
    answered = prompts.withColumn("analysis_json", _answers(F.col("prompt")))
    parsed = answered.select("conv_id", "turn", tagging.parse_analysis_json(F.col("analysis_json")).alias("a"))
    out = parsed.select("conv_id", "turn", *tagging.analysis_fields_with_defaults(F.col("a")))
    return out.withColumns({c: F.round(c, R) for c in ("confidence", "emotion_score")})


# ---------------------------------------------------------------------------
# Whole jobs: analyze, ingest, query (C1-C6) on media made from the tables.
# Embeddings stand in for 8 x 8 images, as BMP files; a tenth of the objects
# are missing and a tenth are no images.
# ---------------------------------------------------------------------------

def _gray_levels(v: Column) -> Column:
    """64 gray levels of a vector."""
    return F.transform(v, lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(
        (x.cast("double") + 1.0) * 127.5))).cast("int"))


def _int_hex(n: int) -> str:
    return n.to_bytes(4, "little").hex()


# Header of an 8 x 8 bitmap of 24 bits, rows from the bottom (fixed values).
BMP_HEADER = ("424d" + _int_hex(54 + 192) + _int_hex(0) + _int_hex(54) + _int_hex(40) + _int_hex(8) + _int_hex(8)
              + "01001800" + _int_hex(0) + _int_hex(192) + _int_hex(0) * 4)


def _bitmap(levels: Column) -> Column:
    rows = F.flatten(F.transform(F.sequence(F.lit(7), F.lit(0), F.lit(-1)), lambda r: F.slice(levels, r * 8 + 1, 8)))
    pixel = F.transform(rows, lambda g: F.repeat(F.lpad(F.hex(g), 2, "0"), 3))
    return F.unhex(F.concat(F.lit(BMP_HEADER), F.array_join(pixel, "")))


_IMAGES_SQL = f"""
WITH u AS (SELECT vec_id, [greatest(0, least(255, floor((x::DOUBLE + 1.0) * 127.5))) for x in embedding]::DOUBLE[] AS v
           FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT vec_id, v, unnest(range(64)) AS p FROM u),
l AS (SELECT vec_id, v, p // 8 AS r, p % 8 AS c FROM p),
lap AS (SELECT vec_id,
          v[{_refl('r - 1', 8)} * 8 + c + 1] + v[{_refl('r + 1', 8)} * 8 + c + 1]
          + v[r * 8 + {_refl('c - 1', 8)} + 1] + v[r * 8 + {_refl('c + 1', 8)} + 1] - 4 * v[r * 8 + c + 1] AS lp
        FROM l),
b AS (SELECT vec_id, var_pop(lp) AS blur FROM lap GROUP BY vec_id),
t AS (
  SELECT CAST(e.vec_id AS VARCHAR) AS doc_id,
         CASE WHEN e.vec_id % 10 = 0 THEN 'download_failed' WHEN e.vec_id % 10 = 1 OR blur IS NULL THEN 'decode_failed'
              ELSE 'ok' END AS status, blur
  FROM embeddings e LEFT JOIN b ON e.vec_id = b.vec_id)
"""


def _image_table(spark, sf_dir) -> str:
    """Objects, manifest, analysis and asset table; its path."""
    from ..session import scratch_path
    from . import jobs
    emb = table(spark, sf_dir, "embeddings")
    folder, base = scratch_path(spark, "images"), scratch_path(spark, "image-jobs")
    url = F.concat(F.lit(f"{folder}/_img-"), F.col("vec_id").cast("string"), F.lit(".bmp"))
    junk = (F.col("vec_id") % 10 == 1) | F.col("embedding").isNull()
    write_objects(emb.where("vec_id % 10 <> 0").repartition("vec_id").select(
        url.alias("url"), F.when(junk, F.encode(F.lit("no image"), "utf-8"))
        .otherwise(_bitmap(_gray_levels(F.col("embedding")))).alias("content")))
    (emb.select(F.col("vec_id").cast("string").alias("doc_id"), url.alias("s3_url"))
     .write.parquet(f"{base}/manifest.parquet"))
    jobs.analyze_images(spark, f"{base}/manifest.parquet", f"{base}/analysis.jsonl", roots=[folder])
    jobs.ingest_images(spark, f"{base}/analysis.jsonl", f"{base}/table", now="2024-06-01T00:00:00", roots=[folder])
    return f"{base}/table"


@register("image_jobs", _IMAGES_SQL + f"""
SELECT doc_id, status, CASE WHEN status = 'ok' THEN CAST(8 AS BIGINT) END AS width,
       CASE WHEN status = 'ok' THEN round(blur, {R}) END AS blur_score,
       CASE WHEN status = 'ok' THEN blur < 100.0 END AS is_blurry,
       CASE WHEN status = 'ok' THEN false END AS has_face
FROM t
""")
def image_jobs(spark, sf_dir):
    """Every image analyzed and ingested, failures with their status."""
    from ..sources.readers import read_asset
    rows = read_asset(spark, _image_table(spark, sf_dir))
    return rows.select("doc_id", "status", "width", rnd("blur_score"), "is_blurry", "has_face")


@register("image_query", _IMAGES_SQL + f"""
SELECT t.doc_id, round(blur, {R}) AS blur_score, d.lang AS description
FROM t LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang FROM documents) d ON t.doc_id = d.doc_id
WHERE status = 'ok' AND blur >= 100.0
""")
def image_query(spark, sf_dir):
    """A filter over the ingested table, with descriptions kept as JSON lines."""
    from ..session import scratch_path
    from .query import query_images
    path = scratch_path(spark, "descriptions") + ".jsonl"
    (table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"),
                                              F.col("lang").alias("description")).write.json(path))
    found = query_images(spark, _image_table(spark, sf_dir), where="status = 'ok' AND NOT is_blurry",
                         top_k=None, desc_table=path)
    return found.select("doc_id", rnd("blur_score"), "description")


class SizeAsr:
    """A speech model's place: the transcript tells the size of the bytes."""

    def __call__(self, blobs, suffixes):
        import pandas as pd
        return pd.DataFrame({"transcript": blobs.str.len().astype(str) + " bytes of " + suffixes.fillna("none"),
                             "acoustic_emotion": "HAPPY"})


@register("audio_jobs", f"""
WITH s AS (SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL AND vec_id % 10 <> 0)
SELECT CAST(vec_id AS VARCHAR) || '.wav' AS doc_id, round(64 / 16000.0, {R}) AS duration_s,
       '172 bytes of .wav' AS transcript, '其他' AS primary_reason, '未知' AS text_emotion, false AS bad_tone
FROM s WHERE vec_id % 3 <> 1
""")
def audio_jobs(spark, sf_dir):
    """Vectors as recordings of 64 samples; missing ones are left
    out, and a query leaves out a third of the ids."""
    from ..session import scratch_path
    from . import jobs
    from .query import query_audio
    emb = table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL")
    folder, base = scratch_path(spark, "recordings"), scratch_path(spark, "audio-jobs")
    url = F.concat(F.lit(f"{folder}/"), F.col("vec_id").cast("string"), F.lit(".wav"))
    # Header of 64 samples of 16 bits, one channel, 16,000 a second (fixed values).
    header = ("52494646" + _int_hex(36 + 128) + "57415645666d7420" + _int_hex(16) + "01000100" + _int_hex(16000)
              + _int_hex(32000) + "02001000" + "64617461" + _int_hex(128))
    sample = F.transform("embedding", lambda x: F.lpad(F.hex(F.floor((x.cast("double") + 1.0) * 16383).cast("int")), 4, "0"))
    swapped = F.transform(sample, lambda h: F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2)))
    write_objects(emb.where("vec_id % 10 <> 0").repartition("vec_id").select(
        url.alias("url"), F.unhex(F.concat(F.lit(header), F.array_join(swapped, ""))).alias("content")))
    (emb.select(F.concat(F.col("vec_id").cast("string"), F.lit(".wav")).alias("doc_id"), url.alias("s3_url"))
     .write.option("header", True).csv(f"{base}/manifest.csv"))
    jobs.analyze_audio(spark, f"{base}/manifest.csv", f"{base}/calls.jsonl", asr_factory=SizeAsr, roots=[folder])
    jobs.ingest_audio(spark, f"{base}/calls.jsonl", f"{base}/table", now="2024-06-01T00:00:00", roots=[folder])
    found = query_audio(spark, f"{base}/table", top_k=None, sql="""
        SELECT doc_id, duration_s, transcript, primary_reason, text_emotion, bad_tone
        FROM calls WHERE cast(split(doc_id, '[.]')[0] AS long) % 3 <> 1""")
    return found.select("doc_id", rnd("duration_s"), "transcript", "primary_reason", "text_emotion", "bad_tone")
