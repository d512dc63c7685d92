"""Queries of the audit operators: line items are features of parts, events are review actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.operators import audit as A
from termwright.sources.tables import pick, table

QUERIES, ORACLE_SQL = {}, {}


def items(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    matched = F.col("l_returnflag") != "R"
    return A.audit_items(
        li.select(
            F.concat(F.lit("c"), (F.col("l_suppkey") % 20).cast("string")).alias("component"),
            F.when(F.col("l_linenumber") == 7, "").otherwise(F.concat(F.lit("l"), (F.col("l_partkey") % 13).cast("string"))).alias("label"),
            F.concat(F.lit("raw"), (F.col("l_partkey") % 3).cast("string")).alias("raw_text"),
            F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("int").cast("string")).alias("value"),
            F.when(matched, F.concat(F.lit("a"), (F.col("l_partkey") % 2).cast("string"))).alias("attribute"),
            matched.alias("matched"),
            F.col("l_orderkey").alias("row_id"),
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 100 + F.col("l_quantity").cast("int")).alias("pos"),
        )
    )


_ITEMS = """items AS (SELECT 'c' || (l_suppkey % 20) AS component, CASE WHEN l_linenumber = 7 THEN 'raw' || (l_partkey % 3) ELSE 'l' || (l_partkey % 13) END AS label, CASE WHEN l_linestatus = 'O' THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS value,
  CASE WHEN l_returnflag <> 'R' THEN 'a' || (l_partkey % 2) END AS attribute, l_returnflag <> 'R' AS matched, l_orderkey AS row_id, l_orderkey * 1000 + l_linenumber * 100 + CAST(l_quantity AS INT) AS pos, 'raw' || (l_partkey % 3) AS raw_text FROM lineitem)"""
_AUDIT = f"""{_ITEMS},
vals AS (SELECT component, label, value, row_number() OVER (PARTITION BY component, label ORDER BY min(pos), value) AS k FROM items WHERE value <> '' GROUP BY 1, 2, 3),
samples AS (SELECT component, label, string_agg(value, '|' ORDER BY k) AS samples FROM vals WHERE k <= 3 GROUP BY 1, 2),
audit0 AS (SELECT component, label, count(*) AS occurrences, count(*) FILTER (matched) AS matched, count(*) FILTER (NOT matched) AS unmatched, arg_min(attribute, pos) FILTER (matched) AS attribute FROM items GROUP BY 1, 2),
audit AS (SELECT a.*, coalesce(samples, '') AS samples, CASE WHEN matched > 0 AND unmatched > 0 THEN 'intermittent' WHEN matched > 0 THEN 'matched' ELSE 'unmatched' END AS kind FROM audit0 a LEFT JOIN samples USING (component, label))"""


def audit(spark, sf_dir):
    return A.aggregate_audit(items(spark, sf_dir))


def add(name, query, sql):
    QUERIES[name], ORACLE_SQL[name] = query, sql


add("audit_items", items, f"WITH {_ITEMS} SELECT * FROM items")
add("aggregate_audit", audit, f"WITH {_AUDIT} SELECT * FROM audit")
add("audit_stats", lambda s, d: A.audit_stats(audit(s, d)), f"WITH {_AUDIT} SELECT component, count(*) AS labels, count(*) FILTER (kind = 'matched') AS matched, count(*) FILTER (kind = 'unmatched') AS unmatched, count(*) FILTER (kind = 'intermittent') AS intermittent FROM audit GROUP BY 1")
add("top_open_labels", lambda s, d: A.top_open_labels(audit(s, d)), f"WITH {_AUDIT} SELECT label, count(*) AS components FROM audit WHERE kind <> 'matched' GROUP BY 1 ORDER BY components DESC, label LIMIT 30")
add(
    "gap_analysis",
    lambda s, d: A.gap_analysis(items(s, d)),
    f"""WITH {_ITEMS}, l AS (SELECT component, label, count(*) AS n, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, label) AS k FROM items WHERE NOT matched GROUP BY 1, 2),
x AS (SELECT component, label, raw_text, row_number() OVER (PARTITION BY component, label ORDER BY pos, row_id, raw_text) AS k FROM items WHERE NOT matched),
y AS (SELECT component, label, string_agg(raw_text, ',' ORDER BY k) AS texts FROM x WHERE k <= 3 GROUP BY 1, 2),
t AS (SELECT component, string_agg(label || ':' || n, '|' ORDER BY k) AS labels, string_agg(label || '=' || texts, '|' ORDER BY k) AS samples FROM l JOIN y USING (component, label) WHERE k <= 20 GROUP BY 1),
g AS (SELECT component, count(*) AS items, count(*) FILTER (NOT matched) AS open, count(DISTINCT CASE WHEN NOT matched THEN row_id END) AS rows FROM items GROUP BY 1)
SELECT g.component, items, open, round(open / items::DOUBLE, 3) AS gap_rate, rows, coalesce(labels, '') AS labels, coalesce(samples, '') AS samples FROM g LEFT JOIN t USING (component)""",
)
add("top_gaps", lambda s, d: A.top_gaps(items(s, d)), f"WITH {_ITEMS} SELECT label, count(*) AS n FROM items WHERE NOT matched GROUP BY 1 ORDER BY n DESC, label LIMIT 30")


def matches(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.concat(F.lit("c"), (F.col("o_custkey") % 15).cast("string")).alias("component"),
        F.substring("o_orderpriority", 1, 1).alias("chapter"),
        F.when(F.col("o_orderstatus") == "F", "matched").when(F.col("o_orderstatus") == "O", "candidate_only").otherwise("unmatched").alias("status"),
        F.when(F.col("o_orderkey") % 3 == 0, "pending").when(F.col("o_orderkey") % 3 == 1, "auto").otherwise("").alias("review"),
        (F.col("o_custkey") % 100).alias("code"),
        (F.col("o_totalprice") / 1000000).alias("confidence"),
        pick(("TJ", "MJ", "", "CD"), (F.col("o_custkey") % 4).cast("int")).alias("calc_code"),
        F.when(F.col("o_orderkey") % 5 > 0, (F.col("o_orderkey") % 5).cast("int")).alias("candidate_rank"),
    )


_MATCHES = """matches AS (SELECT o_orderkey AS row_id, 'c' || (o_custkey % 15) AS component, substr(o_orderpriority, 1, 1) AS chapter, CASE o_orderstatus WHEN 'F' THEN 'matched' WHEN 'O' THEN 'candidate_only' ELSE 'unmatched' END AS status,
  CASE o_orderkey % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'auto' ELSE '' END AS review, o_custkey % 100 AS code, o_totalprice / 1000000 AS confidence, ['TJ', 'MJ', '', 'CD'][1 + o_custkey % 4] AS calc_code, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 5 AS INT) END AS candidate_rank FROM orders)"""
_COUNTS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("matched", "candidate_only", "unmatched"))
_TOP = lambda name, of, n: f"{name} AS (SELECT component, string_agg(label || ':' || n, '|' ORDER BY k) AS labels FROM (SELECT component, label, count(*) AS n, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, label) AS k FROM {of} GROUP BY 1, 2) WHERE k <= {n} GROUP BY 1)"
add(
    "component_profile",
    lambda s, d: A.component_profile(matches(s, d), items(s, d)),
    f"""WITH {_ITEMS}, {_MATCHES}, c AS (SELECT row_id, count(*) AS features, count(*) FILTER (matched) AS found FROM items GROUP BY 1), own AS (SELECT m.*, coalesce(features, 0) AS features, coalesce(found, 0) AS found FROM matches m LEFT JOIN c USING (row_id)),
r AS (SELECT component, chapter, CAST(grouping(chapter) AS TINYINT) AS all_chapters, count(*) AS rows, {_COUNTS}, count(*) FILTER (calc_code <> '') AS with_calculation, count(*) FILTER (review = 'pending') AS pending, sum(features)::BIGINT AS features, sum(found)::BIGINT AS found FROM own GROUP BY GROUPING SETS ((component), (component, chapter))),
calcs AS (SELECT component, calc_code AS label FROM matches WHERE calc_code <> ''), said AS (SELECT m.component, label, matched FROM items i JOIN matches m USING (row_id)), yes AS (SELECT * FROM said WHERE matched), no AS (SELECT * FROM said WHERE NOT matched),
{_TOP('t1', 'calcs', 15)}, {_TOP('t2', 'yes', 10)}, {_TOP('t3', 'no', 20)}
SELECT r.*, CASE WHEN all_chapters = 1 THEN round(found::DOUBLE / greatest(features, 1) * 100, 1) END AS feature_rate, CASE WHEN all_chapters = 1 THEN coalesce(t1.labels, '') END AS codes, CASE WHEN all_chapters = 1 THEN coalesce(t2.labels, '') END AS matched_labels, CASE WHEN all_chapters = 1 THEN coalesce(t3.labels, '') END AS open_labels
FROM r LEFT JOIN t1 USING (component) LEFT JOIN t2 USING (component) LEFT JOIN t3 USING (component)""",
)
add("review_queue", lambda s, d: A.review_queue(matches(s, d)), f"WITH {_MATCHES} SELECT row_id, status, CASE WHEN review = '' THEN 'pending' ELSE review END AS review FROM matches WHERE status <> 'matched' OR review = 'pending'")


def library(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.col("s_name").alias("source"), F.when(F.col("s_nationkey") > 5, F.col("s_suppkey").cast("string")).alias("selected"), F.array(F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")).alias("aliases"))


add(
    "writeback_pages",
    lambda s, d: A.writeback_pages(matches(s, d), items(s, d), library(s, d)),
    f"""WITH {_ITEMS}, {_MATCHES}, k AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY row_id, status) AS k FROM matches), l AS (SELECT component, count(*) AS rows, string_agg(row_id || ' ' || status, chr(10) ORDER BY k) FILTER (k <= 30) AS lines FROM k GROUP BY 1),
said AS (SELECT m.component, label FROM items i JOIN matches m USING (row_id)), {_TOP('t', 'said', 15)}
SELECT 'results' AS kind, component AS name, rows, lines || coalesce(chr(10) || 'labels: ' || labels, '') AS content FROM l LEFT JOIN t USING (component)
UNION ALL SELECT 'synonym', s_name, 2, 'name: ' || CASE WHEN s_nationkey > 5 THEN CAST(s_suppkey AS VARCHAR) ELSE '' END || chr(10) || 'aliases: ' || s_suppkey || '|' || s_nationkey FROM supplier""",
)
add("apply_review", lambda s, d: A.apply_review(matches(s, d).withColumn("deleted", F.col("row_id") % 5 == 0).withColumn("source", F.col("code"))), f"WITH {_MATCHES} SELECT status, review, count(*) AS mappings, count(DISTINCT code) AS sources FROM matches WHERE row_id % 5 <> 0 GROUP BY 1, 2")


def edited(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    said = F.col("p_partkey") % 4 > 0
    return p.select(
        F.when(said, F.concat(F.lit(" "), "p_name", F.lit(" "))).otherwise("  ").alias("source"),
        F.when(said, F.concat("p_type", F.lit("；"), "p_brand", F.lit("\n ,"), "p_type")).alias("aliases"),
        F.when(F.col("p_partkey") % 8 > 0, F.when(F.col("p_partkey") % 7 == 0, "bad").otherwise((F.col("p_size") / 20 - 0.5).cast("string"))).alias("confidence"),
        (F.col("p_partkey") % 5 == 0).alias("deleted"),
    )


add(
    "edit_records",
    lambda s, d: A.edit_records(edited(s, d), ("aliases",)).withColumn("aliases", F.array_join("aliases", "|")),
    """SELECT * FROM (SELECT CASE WHEN p_partkey % 4 > 0 THEN p_name END AS source, CASE WHEN p_partkey % 4 > 0 THEN p_type || '|' || p_brand || '|' || p_type ELSE '' END AS aliases,
CASE WHEN p_partkey % 8 > 0 AND p_partkey % 7 <> 0 THEN greatest(0.0, least(1.0, p_size / 20 - 0.5)) END AS confidence FROM part WHERE p_partkey % 5 <> 0) WHERE source IS NOT NULL OR aliases <> '' OR confidence IS NOT NULL""",
)


def reviewed_mappings(spark, sf_dir):
    """Orders as reviewed mappings of a customer to names."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("s"), (F.col("o_custkey") % 40).cast("string")).alias("source"), F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("selected"), F.array(F.concat(F.lit("n"), (F.col("o_orderkey") % 6).cast("string"))).alias("candidates"),
        F.lit("matched").alias("status"), F.col("o_orderstatus").alias("review"), (F.col("o_custkey") % 3 == 0).alias("deleted"),
    )


add(
    "reviewed_synonyms",
    lambda s, d: A.reviewed_synonyms(reviewed_mappings(s, d)).select("source", "selected", "mappings", F.array_join("reviews", "|").alias("reviews"), F.array_join("aliases", "|").alias("aliases")),
    """WITH m AS (SELECT 's' || (o_custkey % 40) AS source, o_orderkey AS pos, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS selected, 'n' || (o_orderkey % 6) AS candidate, o_orderstatus AS review FROM orders WHERE o_custkey % 3 <> 0),
a AS (SELECT source, alias, min(place) AS place FROM (SELECT source, selected AS alias, pos * 2 AS place FROM m WHERE selected IS NOT NULL UNION ALL SELECT source, candidate, pos * 2 + 1 FROM m) GROUP BY 1, 2),
al AS (SELECT source, string_agg(alias, '|' ORDER BY place) AS aliases FROM a GROUP BY 1), rv AS (SELECT source, string_agg(review, '|' ORDER BY f) AS reviews FROM (SELECT source, review, min(pos) AS f FROM m GROUP BY 1, 2) GROUP BY 1)
SELECT m.source, arg_min(selected, pos) FILTER (selected IS NOT NULL) AS selected, count(*) AS mappings, any_value(reviews) AS reviews, any_value(aliases) AS aliases FROM m JOIN al USING (source) JOIN rv USING (source) GROUP BY 1""",
)


def bill_item_summary(spark, sf_dir):
    k = F.col("l_partkey")
    f = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("row_id"), F.col("l_linenumber").alias("feature_order"), F.concat(F.lit("F"), (k % 9).cast("string")).alias("label"), F.when(k % 2 == 0, F.lit("V")).alias("value"), F.when(k % 17 > 0, F.concat(F.lit("e"), (k % 18).cast("string"))).otherwise("").alias("expression"))
    return A.bill_item_summary(matches(spark, sf_dir), f)


add(
    "bill_item_summary",
    bill_item_summary,
    f"""WITH {_MATCHES}, m AS (SELECT *, CASE status WHEN 'matched' THEN 0 WHEN 'candidate_only' THEN 1 ELSE 2 END AS p1, 2 AS p2, coalesce(candidate_rank, 9999) AS p3, -confidence AS p4 FROM matches),
o AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY p1, p2, p3, p4, row_id) AS k, count(*) OVER (PARTITION BY code) AS rows FROM m),
f AS (SELECT code, 'f' || (l_partkey % 9) || '|' || CASE WHEN l_partkey % 2 = 0 THEN 'v' ELSE '' END AS same, k, l_linenumber AS fo, 'e' || (l_partkey % 18) AS expression FROM o JOIN lineitem ON l_orderkey = row_id WHERE l_partkey % 17 > 0),
d AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY code, same ORDER BY k, fo, expression) = 1),
n AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY k, fo, expression, same) AS i, count(*) OVER (PARTITION BY code) AS of FROM d),
t AS (SELECT code, string_agg(expression, '|' ORDER BY i) AS features, max(of) AS n_features FROM n WHERE i <= 12 GROUP BY 1)
SELECT o.code, rows, row_id, status, coalesce(features, '') AS features, coalesce(n_features, 0) AS n_features FROM o LEFT JOIN t USING (code) WHERE k = 1""",
)


def state(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    s = F.get(F.array(*map(F.lit, ("to-confirm", "confirmed", "no-need", "to-wiki"))), (F.col("event_id") % 4).cast("int"))
    return e.select(F.concat(F.lit("c"), (F.col("user_id") % 20).cast("string")).alias("component"), F.concat(F.lit("l"), (F.col("event_id") % 7).cast("string")).alias("label"), s.alias("status"), F.col("event_type").alias("note"), F.col("ts").alias("updated_at"), F.col("event_id").alias("pos"))


_STATE = f"""{_AUDIT}, state AS (SELECT 'c' || (user_id % 20) AS component, 'l' || (event_id % 7) AS label, ['to-confirm', 'confirmed', 'no-need', 'to-wiki'][1 + event_id % 4] AS status, event_type AS note, ts, event_id FROM events),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY component, label ORDER BY ts DESC, event_id DESC) AS k FROM state) WHERE k = 1),
reviewed AS (SELECT a.*, coalesce(l.status, 'to-fill') AS status, l.note FROM audit a LEFT JOIN latest l USING (component, label))"""


def reviewed(spark, sf_dir):
    return A.with_state(audit(spark, sf_dir), state(spark, sf_dir))


add("audit_state", lambda s, d: reviewed(s, d).select("component", "label", "status", "note"), f"WITH {_STATE} SELECT component, label, status, note FROM reviewed")
add("audit_filter", lambda s, d: A.audit_filter(reviewed(s, d), "C1", ("intermittent",), ("to-fill", "confirmed"), "c1", "L1").select("component", "label", "status"), f"WITH {_STATE} SELECT component, label, status FROM reviewed WHERE component = 'c1' AND contains(label, 'l1') AND kind = 'intermittent' AND status IN ('to-fill', 'confirmed') AND contains(lower(concat_ws(' ', component, label, note)), 'c1')")
add("audit_export", lambda s, d: A.audit_export(reviewed(s, d)), f"WITH {_STATE} SELECT component, count(*) FILTER (status = 'to-fill') AS \"to-fill\", count(*) FILTER (status = 'to-confirm') AS \"to-confirm\", count(*) FILTER (status = 'confirmed') AS confirmed FROM reviewed WHERE status <> 'no-need' GROUP BY 1")


add("export_items", lambda s, d: A.export_items(reviewed(s, d), 4), f"WITH {_STATE}, o AS (SELECT * FROM reviewed WHERE status = 'to-fill' OR (status <> 'no-need' AND NOT EXISTS (SELECT 1 FROM reviewed WHERE status = 'to-fill'))) SELECT component, label, kind, status, CAST((row_number() OVER (PARTITION BY component ORDER BY label) - 1) // 4 AS BIGINT) AS file FROM o")


def filled(spark, sf_dir):
    a = audit(spark, sf_dir).select("component", "label", F.when(F.length("label") == 2, F.lit("a0")).otherwise(F.col("attribute")).alias("attribute"))
    return a.union(a.select("component", F.concat("label", F.lit("-new")), F.lit("a9")))


_FILLED = f"""{_AUDIT}, filled AS (SELECT component, label, CASE WHEN length(label) = 2 THEN 'a0' ELSE attribute END AS attribute FROM audit UNION ALL SELECT component, label || '-new', 'a9' FROM audit),
diffs AS (SELECT f.component, f.label, a.attribute AS old, f.attribute, CASE WHEN a.component IS NULL THEN 'unknown' WHEN a.attribute IS NULL THEN 'added' WHEN a.attribute = f.attribute THEN 'unchanged' ELSE 'modified' END AS change FROM filled f LEFT JOIN audit a USING (component, label))"""
add("import_diff", lambda s, d: A.import_diff(filled(s, d), audit(s, d)), f"WITH {_FILLED} SELECT * FROM diffs")
add("catalog_patch", lambda s, d: A.catalog_patch(A.import_diff(filled(s, d), audit(s, d))), f"WITH {_FILLED} SELECT component, label, attribute, CASE WHEN change = 'added' THEN 'add' ELSE 'update' END AS action FROM diffs WHERE change IN ('added', 'modified')")
add(
    "bind_attributes",
    lambda s, d: A.bind_attributes(reviewed(s, d), filled(s, d).where("label like '%3%'")),
    f"WITH {_STATE}, e AS (SELECT * FROM (SELECT component, label, CASE WHEN length(label) = 2 THEN 'a0' ELSE attribute END AS attribute FROM audit UNION ALL SELECT component, label || '-new', 'a9' FROM audit) WHERE label LIKE '%3%') SELECT coalesce(r.component, e.component) AS component, coalesce(r.label, e.label) AS label, coalesce(e.attribute, r.attribute) AS attribute, CASE WHEN e.attribute IS NOT NULL THEN 'to-confirm' ELSE status END AS status FROM reviewed r FULL JOIN e ON r.component = e.component AND r.label = e.label",
)
add("wiki_patch_rows", lambda s, d: A.wiki_patch_rows(items(s, d), reviewed(s, d)), f"WITH {_STATE} SELECT component, label, row_id, k FROM (SELECT i.component, i.label, row_id, row_number() OVER (PARTITION BY i.component, i.label ORDER BY min(pos), row_id) AS k FROM items i JOIN reviewed r ON r.component = i.component AND r.label = i.label AND r.status = 'to-wiki' GROUP BY 1, 2, 3) WHERE k <= 20")


def reviewed_upsert(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("component"), F.concat("s_name", F.when(F.col("s_suppkey") % 2 == 0, "\n<!-- reviewed -->\n- old\n<!-- /reviewed -->\nend").otherwise("")).alias("content"))
    return A.reviewed_upsert(p, audit(spark, sf_dir).where("label <> 'l1'").select("component", "label", (F.col("kind") == "matched").alias("matched")))


add(
    "reviewed_upsert",
    reviewed_upsert,
    f"""WITH {_AUDIT}, b AS (SELECT component, string_agg(label, chr(10) || '- ' ORDER BY label) FILTER (kind = 'matched') AS yes, string_agg(label, chr(10) || '- ' ORDER BY label) FILTER (kind <> 'matched') AS no FROM audit WHERE label <> 'l1' GROUP BY 1)
SELECT 'c' || s_suppkey AS component, CASE WHEN b.component IS NULL THEN s_name || CASE WHEN s_suppkey % 2 = 0 THEN chr(10) || '<!-- reviewed -->' || chr(10) || '- old' || chr(10) || '<!-- /reviewed -->' || chr(10) || 'end' ELSE '' END
ELSE s_name || CASE WHEN s_suppkey % 2 = 0 THEN chr(10) || 'end' ELSE '' END || chr(10) || '<!-- reviewed -->' || coalesce(chr(10) || 'matched:' || chr(10) || '- ' || yes, '') || coalesce(chr(10) || 'open:' || chr(10) || '- ' || no, '') || chr(10) || '<!-- /reviewed -->' END AS content FROM supplier LEFT JOIN b ON b.component = 'c' || s_suppkey""",
)


def rules(spark, sf_dir):
    return A.mapping_rules(items(spark, sf_dir).where("matched").select("component", "label", "attribute"), 15)


_RULES = f"""{_ITEMS}, wide AS (SELECT 'global' AS scope, '' AS component, label, attribute, count(*) AS seen FROM items WHERE matched GROUP BY label, attribute HAVING count(DISTINCT component) >= 15),
rules AS (SELECT * FROM wide UNION ALL SELECT 'component', component, label, attribute, count(*) FROM items WHERE matched AND NOT EXISTS (SELECT 1 FROM wide WHERE wide.label = items.label AND wide.attribute = items.attribute) GROUP BY component, label, attribute)"""
add(
    "mapping_rules",
    rules,
    f"""WITH {_RULES}, o AS (SELECT DISTINCT component, label, attribute FROM items WHERE matched)
SELECT r.*, coalesce((SELECT string_agg(DISTINCT o.label, '|' ORDER BY o.label) FROM o WHERE o.attribute = r.attribute AND o.label <> r.label AND (r.scope = 'global' OR o.component = r.component)), '') AS aliases FROM rules r""",
)
add("promote_hints", lambda s, d: A.promote_hints(rules(s, d)), f"WITH {_RULES} SELECT label, attribute, seen FROM rules WHERE scope = 'global' AND seen >= 10")
add(
    "merge_mapping_rules",
    lambda s, d: A.merge_mapping_rules(*[table(s, d, "events").where(f"event_id % 2 = {k}").select(F.lit("component").alias("scope"), F.concat(F.lit("c"), (F.col("user_id") % 20).cast("string")).alias("component"), "event_type", F.col("event_type").alias("label"), F.concat(F.lit("a"), (F.col("event_id") % 5).cast("string")).alias("attribute"), F.col("ts").alias("updated_at")).drop("event_type") for k in (0, 1)]),
    "SELECT 'component' AS scope, component, label, attribute, updated_at FROM (SELECT 'c' || (user_id % 20) AS component, event_type AS label, 'a' || (event_id % 5) AS attribute, ts AS updated_at, row_number() OVER (PARTITION BY user_id % 20, event_type ORDER BY ts DESC, 'a' || (event_id % 5) DESC) AS k FROM events) WHERE k = 1",
)
add(
    "mapping_override",
    lambda s, d: A.mapping_override(items(s, d).groupBy("component", "label", F.lit("a0").alias("attribute")).agg((F.count_if("matched") / F.count("*")).alias("score")), rules(s, d).withColumn("tier", F.when(F.col("seen") % 2 == 0, "a").otherwise("b")), ("a",)),
    f"""WITH {_RULES}, sc AS (SELECT component, label, 'a0' AS attribute, count(*) FILTER (matched) / count(*)::DOUBLE AS score FROM items GROUP BY 1, 2)
SELECT sc.component, sc.label, sc.attribute, greatest(score, CASE WHEN o.label IS NOT NULL THEN 0.99 END, CASE WHEN w.label IS NOT NULL THEN 0.98 END) AS score FROM sc
LEFT JOIN rules o ON o.seen % 2 = 0 AND o.scope = 'component' AND o.component = sc.component AND o.label = sc.label AND o.attribute = sc.attribute LEFT JOIN rules w ON w.seen % 2 = 0 AND w.scope = 'global' AND w.label = sc.label AND w.attribute = sc.attribute""",
)


def summaries(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("step"), (F.col("o_custkey") % 5).cast("string")).alias("step"), k.alias("run"), pick(("failed", "completed", "completed_local_only"), (k % 3).cast("int")).alias("status"), (k % 4).alias("total"), (k % 3).alias("matched"),
        (k % 2).alias("candidate_only"), F.when(k % 5 > 0, k % 7).alias("unmatched"), F.when(k % 2 == 0, "path").otherwise(" ").alias("synonyms"), F.col("o_orderdate").alias("modified"),
    )


add(
    "run_audit",
    lambda s, d: A.run_audit(summaries(s, d)),
    """WITH n AS (SELECT step, run, ['failed', 'completed', 'completed_local_only'][1 + run % 3] AS status, run % 4 AS total, run % 3 AS m, run % 2 AS c, CASE WHEN run % 5 > 0 THEN run % 7 ELSE 0 END AS u FROM (SELECT 'step' || (o_custkey % 5) AS step, o_orderkey AS run FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey % 5 ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)),
i AS (SELECT step, run, 'STEP2_FAILED' AS code, 'blocker' AS severity, 'status=' || status AS evidence FROM n WHERE step = 'step2' AND status = 'failed'
UNION ALL SELECT step, run, 'STEP3_LOCAL_ONLY', 'blocker', 'matched=' || m || ' candidate_only=' || c || ' unmatched=' || u FROM n WHERE step = 'step3' AND status = 'completed_local_only'
UNION ALL SELECT step, run, 'STEP3_NO_SYNONYMS', 'warning', 'synonyms is empty' FROM n WHERE step = 'step3' AND run % 2 = 1
UNION ALL SELECT step, run, 'STEP3_REVIEW_BACKLOG', 'warning', 'candidate_only=' || c || ' unmatched=' || u FROM n WHERE step = 'step3' AND c + u > 0
UNION ALL SELECT step, run, 'EMPTY', 'warning', 'total=0' FROM n WHERE total = 0)
SELECT * FROM i UNION ALL SELECT step, run, NULL, NULL, NULL FROM n WHERE step NOT IN (SELECT step FROM i)""",
)
