"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import alignment, exact_dedup, mixing, near_join, packing, pii, quality, spelling, substring_dedup, token_files, toxicity, url_filter, wrappers

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_register
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(_table(spark, sf_dir, "pages"))


ORACLES["op4_url_filter"] = """
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
    WHEN regexp_matches(host || path,
         '(?s)casino|free-bets|cheap-pills|adult-x|/wp-login[^/]*$|/cgi-bin/') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""


@_register
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@_register
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


ORACLES["op7_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""


@_register
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


@_register
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return token_files.read_documents(spark.read.schema(token_files.BLOCKS).parquet(path))


@_register
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_table(spark, sf_dir, "documents"))


ORACLES["op10_mixing"] = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN 'web'
              WHEN source IN ('src4', 'src5', 'src6', 'src7', 'src8', 'src9') THEN 'reference'
              ELSE 'forum' END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, 2 * sum(tokens)::HUGEINT AS cap
           FROM d GROUP BY ALL),
root AS (SELECT least(sum(tokens) * 80 // 100, sum(cap))::HUGEINT AS budget FROM leaves),
d0 AS (
  SELECT domain, sum(cap)::HUGEINT AS cap, any_value(budget) AS budget,
         CASE domain WHEN 'web' THEN 50 WHEN 'reference' THEN 30 ELSE 20 END::HUGEINT AS weight
  FROM leaves, root GROUP BY domain),
d1 AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS used,
         sum(weight) OVER (ORDER BY cap / weight, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS left_weight
  FROM d0),
d2 AS (SELECT *, cap * left_weight <= weight * (budget - used) AS is_full FROM d1),
d3 AS (
  SELECT domain, CASE WHEN is_full THEN cap ELSE
    (budget - (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())::HUGEINT) * weight
      // nullif((sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::HUGEINT, 0) END AS budget
  FROM d2),
l0 AS (
  SELECT domain, lang, sum(cap)::HUGEINT AS cap, any_value(d3.budget) AS budget,
         CASE lang WHEN 'en' THEN 60 WHEN 'de' THEN 15 WHEN 'fr' THEN 15 WHEN 'es' THEN 10 ELSE 1 END::HUGEINT AS weight
  FROM leaves JOIN d3 USING (domain) GROUP BY domain, lang),
l1 AS (
  SELECT *, coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS used,
         sum(weight) OVER (PARTITION BY domain ORDER BY cap / weight, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS left_weight
  FROM l0),
l2 AS (SELECT *, cap * left_weight <= weight * (budget - used) AS is_full FROM l1),
l3 AS (
  SELECT domain, lang, CASE WHEN is_full THEN cap ELSE
    (budget - (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY domain))::HUGEINT) * weight
      // nullif((sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain))::HUGEINT, 0) END AS budget
  FROM l2),
s0 AS (SELECT domain, lang, source, tokens, cap, l3.budget, 1::HUGEINT AS weight FROM leaves JOIN l3 USING (domain, lang)),
s1 AS (
  SELECT *, coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS used,
         sum(weight) OVER (PARTITION BY domain, lang ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS left_weight
  FROM s0),
s2 AS (SELECT *, cap * left_weight <= weight * (budget - used) AS is_full FROM s1),
s3 AS (
  SELECT domain, lang, source, tokens AS leaf_tokens, CASE WHEN is_full THEN cap ELSE
    (budget - (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY domain, lang))::HUGEINT) * weight
      // nullif((sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain, lang))::HUGEINT, 0) END AS leaf_budget
  FROM s2),
p AS (
  SELECT d.*, leaf_tokens::BIGINT AS leaf_tokens, leaf_budget::BIGINT AS leaf_budget,
         coalesce(leaf_budget // nullif(leaf_tokens, 0), 0)::BIGINT AS epochs,
         coalesce(leaf_budget % nullif(leaf_tokens, 0), 0)::BIGINT AS rest
  FROM d JOIN s3 USING (domain, lang, source)),
h AS (SELECT *, md5('7:' || epochs || ':' || coalesce(doc_id::VARCHAR, '(none)')) AS h FROM p),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h) AS upto FROM h)
SELECT doc_id, domain, lang, source, tokens, leaf_tokens, leaf_budget,
       epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies
FROM c
"""


@_register
def op2_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_classes(_table(spark, sf_dir, "documents"))


@_register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").withColumn("junk", 1 - F.col("quality"))
    categories = ["junk", "toxic"]
    return toxicity.score(docs, toxicity.train(docs, labels, categories), categories)


@_register
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


@_register
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


@_register
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


@_register
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"),
                           public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


@_register
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_text(_table(spark, sf_dir, "pages"))


# For pages whose content is one plain article element.
ORACLES["op11_html_text"] = """
WITH a AS (
  SELECT page_id, url, string_split_regex(
    regexp_replace(replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1), '<br>', ' '),
                   '</?b>', '', 'g'), '<[^>]*>') AS blocks
  FROM pages),
t AS (
  SELECT page_id, url, list_filter(list_transform(blocks, lambda b: trim(regexp_replace(
    regexp_replace(replace(replace(replace(b, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'),
    '\\s+', ' ', 'g'))), lambda b: b <> '') AS blocks
  FROM a)
SELECT page_id, url, coalesce(array_to_string(blocks, chr(10)), '') AS text,
       length(coalesce(array_to_string(blocks, chr(10)), ''))::BIGINT AS n_chars
FROM t
"""
