"""The query of knowledge entries: brands are regions with tables of their parts, nations have mappings, suppliers synonyms, parts matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.operators import entries as E
from termwright.plans import sqltext as S
from termwright.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def regions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    line = F.struct(F.col("p_partkey").alias("k"), F.struct(F.col("p_partkey").cast("string").alias("code"), F.concat("p_name", F.lit(" ")).alias("name"), F.col("p_type").alias("features"), F.when(F.col("p_size") > 25, "m2").alias("unit"), F.lit("").alias("rule"), F.lit("x").alias("work")).alias("row"))
    t = p.groupBy("p_brand", (F.col("p_partkey") % 3).alias("part")).agg(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["row"]).alias("rows"))
    names = F.array_join(F.transform("rows", lambda r: r["name"]), "\n")
    one = F.struct("part", F.struct(F.when(F.col("part") == 0, F.concat(F.lit("表 "), "p_brand")).alias("title"), F.when(F.col("part") < 2, names).alias("raw_text"), "rows").alias("t"))
    own = t.groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["t"]).alias("tables"))
    number = F.regexp_extract("p_brand", "#(.*)", 1).cast("int")
    return own.select(number.alias("region_no"), F.when(number % 5 > 0, F.concat(F.col("p_brand"), F.lit(" > a"))).otherwise("").alias("path"), F.when(number % 3 > 0, F.concat(F.lit(" rule of "), "p_brand", F.lit("\n"))).alias("text"), "tables")


def mappings(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("no"), F.when(F.col("n_nationkey") % 4 > 0, F.col("n_name")).alias("source"), F.lit("std ").alias("selected"), F.array(F.lit("it's"), F.col("n_name")).alias("aliases"), F.lit(0.5).alias("confidence"), F.lit("matched").alias("status"))


def synonyms(spark, sf_dir):
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(key.alias("no"), F.lit("canon").alias("canonical"), F.when(key % 3 > 0, F.col("s_name")).alias("source"), F.when(key % 2 > 0, "std").alias("selected"), F.array(F.lit(" b "), F.col("s_name"), F.lit("b")).alias("sources"), F.lit("n").alias("notes"))


def matches(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_size").cast("string").alias("code"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 > 0, F.col("p_type")).alias("component"), F.lit("doc").alias("document"), F.array("p_brand").alias("rule_hits"), F.lit("m").alias("unit"))


def collect_entries(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return E.collect_entries(regions(spark, sf_dir), mappings(spark, sf_dir), synonyms(spark, sf_dir), matches(spark, sf_dir), p.agg(F.count("*").alias("rows"), F.count_distinct("p_brand").alias("brands")))


QUERIES["collect_entries"] = collect_entries
_id = lambda stage, ref, title: f"'{stage}_' || {S.key(f'{chr(39)}{stage}{chr(39)}', ref, title)}"
_lines = lambda *parts: " || chr(10) || ".join(f"'{label}: ' || {value}" for label, value in parts)
_row = [*[("章节路径", "path"), ("表格标题", "named"), ("项目编码", "p_partkey")], ("项目名称", "p_name"), ("项目特征", "p_type"), ("计量单位", "CASE WHEN p_size > 25 THEN 'm2' ELSE '' END"), ("工程量计算规则", "''"), ("工作内容", "'x'")]
_blank = lambda parts, values: _lines(*[(label, values.get(field, "''")) for label, field in parts])
_sources = "CASE WHEN s_suppkey % 3 > 0 THEN '[''' || s_name || ''', ''b'']' ELSE '['' b '', ''' || s_name || ''', ''b'']' END"
ORACLE_SQL["collect_entries"] = f"""WITH b AS (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '#(.*)', 1) AS INT) AS no FROM part),
r AS (SELECT p_brand, no, CASE WHEN no % 5 > 0 THEN p_brand || ' > a' ELSE '' END AS path, CASE WHEN no % 5 > 0 THEN p_brand ELSE '' END AS chapter, no % 3 > 0 AS ruled FROM b),
ru AS (SELECT *, path || '#rule' AS ref, 'Step1 章节规则 | ' || CASE WHEN path <> '' THEN path ELSE 'region_' || no END AS title FROM r),
t0 AS (SELECT p_brand, p_partkey % 3 AS part, CASE WHEN p_partkey % 3 < 2 THEN trim(string_agg(p_name || ' ', chr(10) ORDER BY p_partkey)) ELSE '' END AS raw FROM part GROUP BY 1, 2),
t1 AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY part) AS i FROM t0 JOIN ru USING (p_brand)),
t2 AS (SELECT * EXCLUDE (ref, title), ref AS rule_ref, title AS rule_title, CASE WHEN part = 0 THEN '表 ' || p_brand ELSE substr(raw, 1, 48) END AS named, path || '#table-' || i AS ref FROM t1),
t AS (SELECT *, 'Step1 表格摘要 | ' || CASE WHEN named <> '' THEN named WHEN path <> '' THEN path ELSE CAST(i AS VARCHAR) END AS title FROM t2),
ro AS (SELECT t.*, p_partkey, trim(p_name) AS p_name, p_type, p_size, row_number() OVER (PARTITION BY t.p_brand, part ORDER BY p_partkey) AS k FROM t JOIN part ON part.p_brand = t.p_brand AND p_partkey % 3 = part),
nm AS (SELECT *, CASE WHEN n_nationkey % 4 > 0 THEN n_name ELSE '' END AS src FROM nation),
mt AS (SELECT *, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE 'canon' END AS nam, CASE WHEN s_suppkey % 2 > 0 THEN 'std' ELSE '' END AS sel FROM supplier),
e AS (
  SELECT {_id('step1_catalog', "'catalog_summary'", "'Step1 总览'")} AS entry_id, CAST(NULL AS VARCHAR) AS parent_id, 'step1_catalog' AS stage, 'Step1 总览' AS title, '{{"brands":' || count(DISTINCT p_brand) || ',"rows":' || count(*) || '}}' AS content, 'catalog_summary' AS source_ref, '目录总览' AS chapter_title, '' AS component_type FROM part
  UNION ALL SELECT {_id('step1_rule', 'ref', 'title')}, NULL, 'step1_rule', title, '章节路径: ' || path || chr(10) || '规则说明:' || chr(10) || 'rule of ' || p_brand, ref, chapter, '' FROM ru WHERE ruled
  UNION ALL SELECT {_id('step1_table', 'ref', 'title')}, CASE WHEN ruled THEN {_id('step1_rule', 'rule_ref', 'rule_title')} END, 'step1_table', regexp_replace(title, '^\\s+|\\s+$', '', 'g'), {_lines(('章节路径', 'path'), ('表格标题', 'named'), ('表格原文', 'raw'))}, ref, chapter, '' FROM t WHERE raw <> ''
  UNION ALL SELECT {_id('step1_row', "ref || '-row-' || k", "'Step1 清单行 | ' || p_partkey || ' ' || p_name")}, CASE WHEN raw <> '' THEN {_id('step1_table', 'ref', 'title')} END, 'step1_row', 'Step1 清单行 | ' || p_partkey || ' ' || p_name, {_lines(*_row)}, ref || '-row-' || k, chapter, '' FROM ro
  UNION ALL SELECT {_id('step2_mapping', "'step2_mapping#' || n_nationkey", "'Step2 构件映射 | ' || CASE WHEN src <> '' THEN src ELSE 'mapping_' || n_nationkey END")}, NULL, 'step2_mapping', 'Step2 构件映射 | ' || CASE WHEN src <> '' THEN src ELSE 'mapping_' || n_nationkey END,
    trim({_blank(E.MAPPING_PARTS, {'source': 'src', 'selected': "'std '", 'aliases': "'[\"it''s\", ''' || n_name || ''']'", 'status': "'matched'", 'confidence': "'0.5'"})}), 'step2_mapping#' || n_nationkey, 'std', src FROM nm
  UNION ALL SELECT {_id('step2_synonym', "'step2_synonym#' || s_suppkey", "'Step2 源构件桥接 | ' || nam")}, NULL, 'step2_synonym', 'Step2 源构件桥接 | ' || nam, {_blank(E.SYNONYM_PARTS, {'source': 'nam', 'selected': 'sel', 'sources': _sources, 'notes': "'n'"})}, 'step2_synonym#' || s_suppkey,
    CASE WHEN sel <> '' THEN sel ELSE 'canon' END, CASE WHEN s_suppkey % 3 > 0 THEN s_name || ' / b' ELSE 'b / ' || s_name || ' / b' END FROM mt
  UNION ALL SELECT {_id('step3_match', "'step3_row#' || p_partkey", "'Step3 清单匹配 | ' || p_size || ' ' || p_name")}, NULL, 'step3_match', 'Step3 清单匹配 | ' || p_size || ' ' || p_name,
    trim({_blank(E.MATCH_PARTS, {'row_id': 'p_partkey', 'code': 'p_size', 'name': 'p_name', 'component': "CASE WHEN p_size % 2 > 0 THEN p_type ELSE '' END", 'unit': "'m'", 'rule_hits': "'[''' || p_brand || ''']'"})}), 'step3_row#' || p_partkey, 'doc', CASE WHEN p_size % 2 > 0 THEN p_type ELSE '' END FROM part
)
SELECT * FROM e"""
