"""Queries of the catalogue operators: part types as components, parts and line items as their items and mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.operators import catalog as K
from termwright.plans import sqltext as S
from termwright.sources.tables import pick, sql_pick, table

QUERIES, ORACLE_SQL = {}, {}

_NAMES = ("厚度", "备注一", "构件编号x", "", "高度")
_CODES = ("HD", "NBZ", "BH", "X1", "GD", "")


def attributes(spark, sf_dir):
    """(component, name, code, pos): an attribute for each part of a brand."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("component"), pick(_NAMES, (F.col("p_size") % 5).cast("int")).alias("name"), pick(_CODES, (F.col("p_partkey") % 6).cast("int")).alias("code"), F.col("p_partkey").alias("pos"))


_ATTRIBUTES = f"attrs AS (SELECT p_brand AS component, {sql_pick(_NAMES, 'p_size % 5')} AS name, {sql_pick(_CODES, 'p_partkey % 6')} AS code, p_partkey AS pos FROM part)"
_GOOD = "trim(name) <> '' AND trim(code) <> '' AND code <> 'NBZ' AND NOT contains(name, '备注') AND NOT contains(name, '构件编号')"


def build_catalog(spark, sf_dir):
    calculations = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_brand").alias("component"), F.col("p_type").alias("name"), F.col("p_name").alias("code"), F.lit("㎡").alias("unit"), F.col("p_partkey").alias("pos"))
    c = K.build_catalog(attributes(spark, sf_dir), calculations)
    return c.select("component", F.array_join(F.transform("attributes", lambda a: F.concat_ws(":", a["name"], a["code"])), "|").alias("attributes"), F.array_join(F.transform("calculations", lambda a: F.concat_ws(":", a["name"], a["code"], a["unit"])), "|").alias("calculations"))


QUERIES["build_catalog"] = build_catalog
ORACLE_SQL["build_catalog"] = f"""WITH {_ATTRIBUTES}, a AS (SELECT component, string_agg(name || ':' || code, '|' ORDER BY pos) AS attributes FROM attrs WHERE {_GOOD} GROUP BY 1),
c AS (SELECT p_brand AS component, string_agg(p_type || ':' || p_name || ':m2', '|' ORDER BY p_partkey) AS calculations FROM part WHERE p_size > 10 AND trim(p_name) <> '' GROUP BY 1)
SELECT coalesce(a.component, c.component) AS component, attributes, calculations FROM a FULL JOIN c USING (component)"""


def migrate_properties(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    old = F.to_json(F.array(F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("code"))))
    new = F.to_json(F.struct(F.array(F.struct(F.col("p_type").alias("name"), F.col("p_brand").alias("code"))).alias("attributes")))
    m = K.migrate_properties(p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, old).otherwise(new).alias("properties")))
    return m.select("p_partkey", F.col("migrated.attributes")[0]["name"].alias("name"), F.size("migrated.calculations").alias("calculations"))


QUERIES["migrate_properties"] = migrate_properties
ORACLE_SQL["migrate_properties"] = "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS name, 0 AS calculations FROM part"

QUERIES["dedupe_by_code"] = lambda spark, sf_dir: K.dedupe_by_code(attributes(spark, sf_dir), ["component"])
ORACLE_SQL["dedupe_by_code"] = f"""WITH {_ATTRIBUTES}, k AS (SELECT *, coalesce(nullif(trim(code), ''), name) AS item_key FROM attrs)
SELECT component, item_key, min(pos) AS pos, arg_max(code, pos) AS code, arg_max(name, pos) AS name FROM k GROUP BY 1, 2"""


def upsert_catalog(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    old = p.where("p_partkey % 3 <> 0").select("p_partkey", "p_name", "p_size")
    new = p.where("p_partkey % 2 = 0").select("p_partkey", F.upper("p_name").alias("p_name"), (F.col("p_size") + 1).alias("p_size"))
    return K.upsert_catalog(old, new, ["p_partkey"])


QUERIES["upsert_catalog"] = upsert_catalog
ORACLE_SQL["upsert_catalog"] = """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS p_name, CASE WHEN p_partkey % 2 = 0 THEN p_size + 1 ELSE p_size END AS p_size,
CASE WHEN p_partkey % 3 = 0 THEN 'added' WHEN p_partkey % 2 <> 0 THEN 'kept' ELSE 'updated' END AS change FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0"""

QUERIES["common_attributes"] = lambda spark, sf_dir: K.common_attributes(table(spark, sf_dir, "part").select(F.col("p_brand").alias("component"), F.col("p_type").alias("code"), F.col("p_name").alias("name")), 20)
ORACLE_SQL["common_attributes"] = "SELECT p_type AS code, count(DISTINCT p_brand) AS components, arg_min(p_name, p_brand || chr(1) || p_name) AS name FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) >= 20"


def raw_mappings(spark, sf_dir):
    """Line items as mappings of parts to suppliers."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("source"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.when(F.col("l_returnflag") == "R", "n/a").when(F.col("l_returnflag") == "A", F.concat(F.lit(" s"), (F.col("l_suppkey") % 7).cast("string"))).alias("selected"),
        F.when(F.col("l_linenumber") % 2 == 0, F.array(F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string")), F.lit(" "), F.lit("面积"))).alias("candidates"),
        F.when(F.col("l_linestatus") == "O", "Conflict").otherwise("").alias("status"),
        F.when(F.col("l_linenumber") == 7, "x").otherwise((F.col("l_discount") * 20).cast("string")).alias("confidence"),
        F.when(F.col("l_linenumber") == 3, " auto ").otherwise("").alias("review"),
    )


MAPPINGS = """
mappings AS (
  SELECT 'part ' || l_partkey AS source, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_returnflag = 'A' THEN 's' || (l_suppkey % 7) END AS selected,
    CASE WHEN l_linenumber % 2 = 0 THEN ['s' || (l_suppkey % 5), '面积'] ELSE [] END AS listed, l_linestatus, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN 0.0 ELSE greatest(0.0, least(1.0, l_discount * 20)) END AS confidence FROM lineitem
), normal AS (
  SELECT source, pos, selected, list_concat(CASE WHEN selected IS NULL THEN [] ELSE [selected] END, list_filter(listed, lambda x: selected IS NULL OR x <> selected)) AS candidates,
    CASE WHEN selected IS NOT NULL THEN 'matched' WHEN len(listed) > 0 THEN CASE WHEN l_linestatus = 'O' THEN 'conflict' ELSE 'candidate_only' END ELSE 'unmatched' END AS status, confidence,
    CASE WHEN l_linenumber = 3 THEN 'auto' WHEN selected IS NOT NULL THEN 'suggested' ELSE 'pending' END AS review FROM mappings
)"""


def mappings(spark, sf_dir):
    return K.normalize_mappings(raw_mappings(spark, sf_dir))


QUERIES["normalize_mappings"] = lambda spark, sf_dir: mappings(spark, sf_dir).withColumn("candidates", F.array_join("candidates", "|"))
ORACLE_SQL["normalize_mappings"] = f"WITH {MAPPINGS} SELECT source, pos, selected, array_to_string(candidates, '|') AS candidates, status, confidence, review FROM normal"


def coerce_results(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    whole = F.to_json(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"), F.when(F.col("event_id") % 3 == 0, F.array("event_type")).when(F.col("event_id") % 3 == 1, F.array("event_type", F.lit("other"))).alias("candidates"), F.when(F.col("event_id") % 5 == 0, F.lit("0.25")).alias("confidence")))
    r = K.coerce_results(e.select("event_id", F.concat(F.lit("Answer:\n"), whole, F.lit("\nend")).alias("answer")))
    return r.withColumn("candidates", F.array_join("candidates", "|"))


QUERIES["coerce_results"] = coerce_results
ORACLE_SQL["coerce_results"] = """SELECT event_id, 'u' || user_id AS source, CASE WHEN event_id % 3 = 0 THEN event_type END AS selected,
CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN event_type || '|other' ELSE '' END AS candidates,
CASE WHEN event_id % 5 = 0 THEN 0.25 WHEN event_id % 3 = 0 THEN 0.7 WHEN event_id % 3 = 1 THEN 0.35 ELSE 0.0 END AS confidence FROM events"""


def synonym_library(spark, sf_dir):
    own = mappings(spark, sf_dir).withColumn("chapter", F.concat(F.lit("ch"), (F.col("pos") % 7).cast("string"))).withColumn("type", F.when(F.col("pos") % 3 > 0, F.concat(F.lit("t"), (F.col("pos") % 3).cast("string"))).otherwise(" "))
    lib = K.synonym_library(own)
    return lib.select("source", "selected", "status", "mappings", *[F.array_join(c, "|").alias(c) for c in ("aliases", "reviews", "chapters", "types")])


QUERIES["synonym_library"] = synonym_library
_SYNONYMS = f"""{MAPPINGS},
al AS (SELECT source, pos, unnest(candidates) AS alias, generate_subscripts(candidates, 1) AS k FROM normal WHERE status <> 'unmatched'),
al1 AS (SELECT source, alias, min(pos * 10 + k) AS first FROM al WHERE alias NOT IN ('面积') AND alias <> source AND trim(alias) <> '' GROUP BY 1, 2),
al2 AS (SELECT source, string_agg(alias, '|' ORDER BY first, alias) AS aliases FROM al1 GROUP BY 1),
rv AS (SELECT source, string_agg(review, '|' ORDER BY first, review) AS reviews FROM (SELECT source, review, min(pos) AS first FROM normal GROUP BY 1, 2) GROUP BY 1),
synonyms AS (SELECT n.source, arg_min(selected, pos) FILTER (selected IS NOT NULL) AS selected, arg_max(status, pos) AS status, any_value(rv.reviews) AS reviews, count(*) AS mappings, coalesce(any_value(al2.aliases), '') AS aliases
FROM normal n LEFT JOIN rv USING (source) LEFT JOIN al2 USING (source) GROUP BY 1)"""
_FIRST = lambda value, test: f"(SELECT source, string_agg(v, '|' ORDER BY first) AS v FROM (SELECT source, {value} AS v, min(pos) AS first FROM normal WHERE {test} GROUP BY 1, 2) GROUP BY 1)"
_NODES = f"chs AS (SELECT source, v AS chapters FROM {_FIRST(chr(39) + 'ch' + chr(39) + ' || (pos % 7)', 'true')}), tys AS (SELECT s.source, coalesce(v, '') AS types FROM (SELECT DISTINCT source FROM normal) s LEFT JOIN {_FIRST(chr(39) + 't' + chr(39) + ' || (pos % 3)', 'pos % 3 > 0')} f USING (source))"
ORACLE_SQL["synonym_library"] = f"WITH {_SYNONYMS}, {_NODES} SELECT source, selected, status, reviews, mappings, aliases, chapters, types FROM synonyms LEFT JOIN chs USING (source) LEFT JOIN tys USING (source)"


def synonym_bridges(spark, sf_dir):
    known = table(spark, sf_dir, "part").where("p_size > 25").select(F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("component"))
    return K.synonym_bridges(K.synonym_library(mappings(spark, sf_dir)), known)


QUERIES["synonym_bridges"] = synonym_bridges
ORACLE_SQL["synonym_bridges"] = f"""WITH {_SYNONYMS}, b AS (SELECT source AS component, unnest(list_concat([source], string_split(aliases, '|'))) AS bridge FROM synonyms WHERE source IN (SELECT 'part ' || p_partkey FROM part WHERE p_size > 25))
SELECT DISTINCT {S.normalize('bridge')} AS key, component FROM b WHERE bridge <> ''"""
