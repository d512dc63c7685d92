"""The queries of this package, by name, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termwright.llm import bpe, chat_format, html_text, packing, pii, prefix_trie, quality_model, quality_rules, repair, simhash, syncmers, token_counts, url_filter
from termwright.llm._shared import table

#: The key of the pseudonyms in the queries; whoever runs the operator gives their own.
PII_KEY = "documents-2024"

#: (verdict, host, path) of the URL query.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: Both turns of the conversation that the chat query adds.
_HARD = "\\### Assistant: </turn> ok"


#: The vocabularies of the quality rules.
VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_HARD).alias("text"))
    return chat_format.digests(chat_format.chat_windows(turns.unionByName(extra)))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compared(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("piece_bpe_32k.model"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.scored(docs, quality_model.trained(docs)).drop("text")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("word_bpe_49k.json"), with_ids=False)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measured(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), [vocabulary(v) for v in VOCABULARIES]).drop("text", "lang")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_and_repaired(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_simhash, op3_syncmers, op4_token_counts, op5_url_filter, op6_quality_model, op7_bpe, op8_quality_rules, op9_pii, op10_packing, op11_prefix_trie, op12_conversation_repair, op13_html_text, pipeline)}

_DECODED = "lower(path)"
for _c in "abcdefghijklmnopqrstuvwxyz0123456789-._~":
    for _code in sorted({f"%{ord(_c):02x}", f"%{ord(_c.upper()):02x}"}):
        _DECODED = f"replace({_DECODED}, '{_code}', '{_c}')"
#: The given URLs have no path that needs more than this to resolve its dot segments.
_RESOLVED = f"regexp_replace(regexp_replace(replace({_DECODED}, '/./', '/'), '/[^/]+/[.][.](/|$)', '/'), '/[.]$', '/')"

_OP5 = f"""
WITH cut AS (
  SELECT page_id, lower(split_part(url, '://', 1)) AS scheme, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, scheme, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), ruled AS (
  SELECT *, '.' || regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), CASE scheme WHEN 'http' THEN ':(80)?$' WHEN 'https' THEN ':(443)?$' ELSE ':$' END, ''), '[.]$', '') || {_RESOLVED} AS whole,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN whole LIKE '%.spam-%' OR regexp_matches(whole, '(?s)[.]spam..*[.]') OR whole LIKE '%casino%' OR whole LIKE '%/login%'
         OR whole LIKE '%/cart/%' OR whole LIKE '%.exe' OR whole LIKE '%.zip' THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLE_SQL = {"op5_url_filter": _OP5}
