"""Queries of the merging operators: line items are competing mappings of parts to suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.operators import merge as G
from termwright.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}

_TYPES = ("exact", "semantic_match", "partial_match", "none")


def mappings(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    selected = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("s"), (F.col("l_suppkey") % 3).cast("string")))
    candidates = F.when(F.col("l_linenumber") % 2 == 0, F.array(F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string")))).otherwise(F.array().cast("array<string>"))
    return li.select(
        F.col("l_partkey").alias("source"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        selected.alias("selected"),
        candidates.alias("candidates"),
        F.when(selected.isNotNull(), "matched").when(F.size(candidates) > 0, "candidate_only").otherwise("unmatched").alias("status"),
        (F.col("l_discount") * 10).alias("confidence"),
        F.when(F.col("l_linestatus") == "O", "pending").otherwise("auto").alias("review"),
        (F.col("l_quantity") % 4).cast("int").alias("evidence"),
        F.get(F.array(*map(F.lit, _TYPES)), (F.col("l_suppkey") % 4).cast("int")).alias("match_type"),
        (F.col("l_orderkey") % 50).alias("batch"),
    )


_case = lambda x, w, other="0.0": f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in w.items()) + f" ELSE {other} END"
_MAPPINGS = """
m0 AS (
  SELECT l_partkey AS source, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_returnflag = 'A' THEN 's' || (l_suppkey % 3) END AS selected,
    CASE WHEN l_linenumber % 2 = 0 THEN 's' || (l_suppkey % 5) END AS candidate, l_discount * 10 AS confidence, CASE WHEN l_linestatus = 'O' THEN 'pending' ELSE 'auto' END AS review,
    CAST(l_quantity AS INT) % 4 AS evidence, ['exact', 'semantic_match', 'partial_match', 'none'][1 + l_suppkey % 4] AS match_type, l_orderkey % 50 AS batch FROM lineitem
), m AS (SELECT *, CASE WHEN selected IS NOT NULL THEN 'matched' WHEN candidate IS NOT NULL THEN 'candidate_only' ELSE 'unmatched' END AS status FROM m0)"""
_MERGED = f"""{_MAPPINGS},
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_case('status', C.STATUS_RANK)} DESC, confidence DESC, evidence DESC, pos) AS k FROM m) WHERE k = 1),
nm AS (SELECT source, name, min(k) AS first FROM (SELECT source, selected AS name, pos * 2 AS k FROM m UNION ALL SELECT source, candidate, pos * 2 + 1 FROM m) WHERE name IS NOT NULL GROUP BY 1, 2),
sel AS (SELECT source, selected AS name, min(pos) AS first FROM m WHERE selected IS NOT NULL GROUP BY 1, 2),
u AS (SELECT nm.source, list(nm.name ORDER BY sel.first NULLS LAST, nm.first) AS candidates, count(sel.name) AS names FROM nm LEFT JOIN sel ON nm.source = sel.source AND nm.name = sel.name GROUP BY 1),
mx AS (SELECT source, max(confidence) AS confidence FROM m GROUP BY 1),
merged AS (
  SELECT b.source, CASE WHEN names > 1 THEN NULL ELSE b.selected END AS selected, CASE WHEN names > 1 THEN 'conflict' ELSE b.status END AS status, mx.confidence,
    CASE WHEN names > 1 THEN 'pending' ELSE b.review END AS review, array_to_string(coalesce(candidates, []), '|') AS candidates
  FROM b JOIN mx USING (source) LEFT JOIN u USING (source)
)"""


def merged(spark, sf_dir):
    return G.merge_candidates(mappings(spark, sf_dir))


_flat = lambda df: df.withColumn("candidates", F.array_join("candidates", "|"))
QUERIES["merge_candidates"] = lambda spark, sf_dir: _flat(merged(spark, sf_dir))
ORACLE_SQL["merge_candidates"] = f"WITH {_MERGED} SELECT * FROM merged"

QUERIES["resolve_conflicts"] = lambda spark, sf_dir: _flat(G.resolve_conflicts(merged(spark, sf_dir), mappings(spark, sf_dir)))
ORACLE_SQL["resolve_conflicts"] = f"""WITH {_MERGED},
s AS (SELECT source, pos, selected, review, confidence, evidence, {_case('match_type', C.TYPE_WEIGHT)} AS type,
  4000.0::DOUBLE + {_case('status', C.STATUS_SCORE)} + {_case('match_type', C.TYPE_WEIGHT)} * 100 + confidence * 100 + {_case('review', C.REVIEW_WEIGHT)} * 10 + least(evidence, 20.0) AS points FROM m WHERE selected IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY points DESC, confidence DESC, evidence DESC, pos) AS k FROM s),
w AS (SELECT a.source, a.selected AS won, a.review AS won_review FROM r a JOIN r b ON a.source = b.source AND a.k = 1 AND b.k = 2
  WHERE a.points - b.points >= 120 OR a.type - b.type >= 2 OR (a.confidence >= 0.9 AND b.confidence <= 0.5 AND a.type >= b.type))
SELECT g.source, CASE WHEN g.status = 'conflict' AND won IS NOT NULL THEN won ELSE g.selected END AS selected, CASE WHEN g.status = 'conflict' AND won IS NOT NULL THEN 'matched' ELSE g.status END AS status, g.confidence,
  CASE WHEN g.status = 'conflict' AND won IS NOT NULL THEN won_review ELSE g.review END AS review, g.candidates, g.status = 'conflict' AND won IS NOT NULL AS resolved FROM merged g LEFT JOIN w USING (source)"""


def ensure_complete(spark, sf_dir):
    rows = merged(spark, sf_dir).where("source % 5 <> 0").select("source", "selected", "status", "confidence")
    return G.ensure_complete(rows, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source")), "source", {"status": "unmatched", "confidence": 0.0})


QUERIES["ensure_complete"] = ensure_complete
ORACLE_SQL["ensure_complete"] = f"WITH {_MERGED} SELECT p_partkey AS source, g.selected, coalesce(g.status, 'unmatched') AS status, coalesce(g.confidence, 0.0) AS confidence FROM part LEFT JOIN (SELECT * FROM merged WHERE source % 5 <> 0) g ON g.source = p_partkey"


def batch_quality(spark, sf_dir):
    expected = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("batch"), F.col("p_partkey").alias("source"))
    return G.batch_quality(mappings(spark, sf_dir), expected)


QUERIES["batch_quality"] = batch_quality
_QUALITY = f"""{_MAPPINGS}, f AS (SELECT batch, source, arg_min(status, pos) AS status FROM m GROUP BY 1, 2),
e AS (SELECT p_partkey % 50 AS batch, coalesce(f.status, 'missing') AS status FROM part LEFT JOIN f ON f.batch = p_partkey % 50 AND f.source = p_partkey),
quality AS (SELECT batch, count(*) AS expected, count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status = 'candidate_only') AS candidate_only, count(*) FILTER (status = 'conflict') AS conflict,
  count(*) FILTER (status = 'unmatched') AS unmatched, count(*) FILTER (status = 'missing') AS missing, CAST((200 * sum(CAST(round({_case('status', C.DEVIATION, '1.0')} * 100) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 10000.0 AS deviation FROM e GROUP BY 1)"""
ORACLE_SQL["batch_quality"] = f"WITH {_QUALITY} SELECT * FROM quality"
QUERIES["needs_revalidation"] = lambda spark, sf_dir: G.needs_revalidation(batch_quality(spark, sf_dir))
ORACLE_SQL["needs_revalidation"] = f"WITH {_QUALITY} SELECT batch, deviation FROM quality WHERE deviation >= 0.6 OR matched = 0"


def overlay_results(spark, sf_dir):
    """Orders as local results; newer ones supply some fields, and item lists as text."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    own = G.items_of_text(F.concat(F.lit("1. a:"), F.col("o_orderstatus")))
    local = o.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"), own.alias("features"))
    provided = F.when(k % 3 == 0, F.array(F.lit("status"))).when(k % 3 == 1, F.array(F.lit("status"), F.lit("price"))).otherwise(F.array(F.lit("price"), F.lit("features")))
    said = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("1、x:"), k.cast("string"), F.lit("<br> \n2. y")))
    newer = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(k % 4 == 0, " ").otherwise("N").alias("status"), F.lit("TOP").alias("priority"), (F.col("o_totalprice") + 1).alias("price"), said.alias("features"), provided.alias("provided"))
    out = G.overlay_results(local, newer, "o_orderkey", ("features",))
    return out.withColumn("features", F.array_join(F.transform("features", lambda x: F.concat_ws("/", x["order"].cast("string"), x["expression"], x["matched"].cast("string"))), "|"))


QUERIES["overlay_results"] = overlay_results
ORACLE_SQL["overlay_results"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 2 AND o_orderkey % 3 < 2 THEN 'N' ELSE o_orderstatus END AS status, o_orderpriority AS priority, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 > 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 2 THEN CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '1/x:' || o_orderkey || '/true|3/y/false' END ELSE '1/a:' || o_orderstatus || '/true' END AS features FROM orders"""


def recover_partial(spark, sf_dir):
    m = mappings(spark, sf_dir).withColumn("chapter", F.col("source") % 10)
    return G.recover_partial(m.where("chapter < 4 and batch < 25"), m.where("batch >= 25"), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source")))


QUERIES["recover_partial"] = recover_partial
_PARTIAL = _MERGED.replace("FROM m0)", "FROM m0 WHERE (source % 10 < 4 AND batch < 25) OR (source % 10 >= 4 AND batch >= 25))", 1)
ORACLE_SQL["recover_partial"] = f"WITH {_PARTIAL} SELECT p_partkey AS source, g.selected, coalesce(g.status, 'unmatched') AS status, coalesce(g.confidence, 0.0) AS confidence FROM part LEFT JOIN merged g ON g.source = p_partkey"
