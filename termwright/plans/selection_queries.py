"""Queries of term search and packing: parts are regions and components, brands are groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.operators import selection as L
from termwright.plans import sqltext as S
from termwright.sources.tables import BILL_ROWS, bill_rows, pick, sql_pick, table

QUERIES, ORACLE_SQL = {}, {}


def add(name, query, sql):
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


_TERMS = ", ".join(["name", S.search("name"), *(f"CASE WHEN contains(name, '{a}') THEN '{b}' END" for a, b in C.SEARCH_REPLACEMENTS), *(f"CASE WHEN contains(name, '{t}') THEN '{t}' END" for t in C.FOCUS_TERMS)])


def named(spark, sf_dir):
    """Every brand as an entry that goes by the names of its parts of one size."""
    b = bill_rows(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), "p_brand", "p_size"), "row_id")
    return b.where("p_size < 5").groupBy(F.col("p_brand").alias("source")).agg(F.collect_set(F.trim("name")).alias("aliases"))


add(
    "expand_terms",
    lambda s, d: L.expand_terms(bill_rows(s, d).select(F.trim("name").alias("component")).distinct(), named(s, d)),
    f"""WITH {BILL_ROWS}, n AS (SELECT DISTINCT trim(name) AS name FROM bill_rows), al AS (SELECT DISTINCT p_brand AS source, trim(name) AS term FROM bill_rows JOIN part ON p_partkey = row_id WHERE p_size < 5),
names AS (SELECT * FROM al UNION SELECT source, source FROM al)
SELECT DISTINCT name AS component, term FROM (SELECT name, unnest([{_TERMS}]) AS term FROM n) WHERE term IS NOT NULL AND term <> '' UNION SELECT DISTINCT n.name, b.term FROM n JOIN names a ON a.term = n.name JOIN names b ON b.source = a.source WHERE trim(b.term) <> ''""",
)


_TITLES = ("现浇混凝土墙面", "梁 模板", "Steel beam cover", "砌筑", "")


def regions(spark, sf_dir):
    """Documents as regions; their titles and table titles are made of Chinese names, so that terms stand inside longer runs."""
    k = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        k.alias("region"), F.concat_ws(" ", "source", pick(_TITLES, (k % 5).cast("int"))).alias("title"), F.concat_ws(" > ", "source", "lang").alias("path"), pick(_TITLES, (k % 4).cast("int")).alias("table_titles"), pick(("项目编码 混凝土", "name"), (k % 2).cast("int")).alias("headers"),
        F.col("text").alias("body"), (k % 7).alias("tables"), (F.col("n_chars") % 50).alias("rows"), F.col("source").alias("group"), F.length("text").alias("size"),
    )


def terms(spark, sf_dir):
    """The words of each benchmark text that have at least four letters, and names in Chinese, as a batch's terms; every tenth batch finds nothing."""
    b = table(spark, sf_dir, "benchmark")
    words = b.select(F.col("item_id").alias("batch"), F.explode(F.split(F.concat_ws(" ", "text", F.lit("src7 混凝土 墙面 砼墙 steel-beam 筑 模板")), r"[ .,]+")).alias("term")).where("length(term) >= 4 or term in ('混凝土', '墙面', '砼墙', '筑', '模板')")
    return words.where("batch % 10 <> 3").union(b.where("item_id % 10 = 3").select("item_id", F.lit("no such term anywhere"))).distinct()


_SCORED = f"""
words AS (SELECT item_id AS batch, unnest(regexp_split_to_array(text || ' src7 混凝土 墙面 砼墙 steel-beam 筑 模板', '[ .,]+')) AS term FROM benchmark WHERE item_id % 10 <> 3),
terms AS (SELECT DISTINCT batch, term FROM (SELECT batch, {S.search("term")} AS term FROM words WHERE length(term) >= 4 OR term IN ('混凝土', '墙面', '砼墙', '筑', '模板') UNION ALL SELECT item_id, {S.search("'no such term anywhere'")} FROM benchmark WHERE item_id % 10 = 3) WHERE term <> ''),
regions AS (SELECT doc_id AS region, source || ' ' || {sql_pick(_TITLES, 'doc_id % 5')} AS title, source || ' > ' || lang AS path, {sql_pick(_TITLES, 'doc_id % 4')} AS table_titles, {sql_pick(("项目编码 混凝土", "name"), 'doc_id % 2')} AS headers, text AS body, doc_id % 7 AS tables, n_chars % 50 AS rows, source AS "group", length(text) AS size FROM documents),
forms AS (SELECT region, tables, rows, {", ".join(f"{S.search(c)} AS {c}" for c in ("title", "path", "table_titles", "headers", "body"))} FROM regions),
pts AS (SELECT t.batch, f.region, tables, rows, least(length(t.term), 8) AS n,
  CASE WHEN length(t.term) <= 1 THEN CASE WHEN contains(title, t.term) OR contains(path, t.term) OR contains(table_titles, t.term) THEN 8 END
       WHEN contains(title, t.term) THEN 100 + 10 * n WHEN contains(path, t.term) THEN 80 + 8 * n WHEN contains(table_titles, t.term) THEN 60 + 6 * n WHEN contains(headers, t.term) THEN 40 + 4 * n WHEN contains(body, t.term) THEN 30 + 3 * n END AS points FROM terms t CROSS JOIN forms f),
scored AS (SELECT batch, region, (sum(points) * 10 + least(any_value(tables), 4) * 30 + least(any_value(rows), 30) * 5)::DOUBLE / 100.0::DOUBLE AS score, count(*) AS hits FROM pts WHERE points IS NOT NULL GROUP BY 1, 2)"""


def scored(spark, sf_dir):
    return L.score_regions(regions(spark, sf_dir), terms(spark, sf_dir))


add("score_regions", scored, f"WITH {_SCORED} SELECT batch, region, score, hits FROM scored")


def selected(spark, sf_dir):
    return L.budget_select(L.score_regions(regions(spark, sf_dir), terms(spark, sf_dir), best=True), regions(spark, sf_dir), terms(spark, sf_dir), 12000, 5)


add(
    "budget_select",
    selected,
    _SELECTED := f"""WITH {_SCORED}, g AS (SELECT s.*, r."group", r.size, r.rows, row_number() OVER (PARTITION BY batch, r."group" ORDER BY score DESC, hits DESC, r.rows DESC, r.size, s.region) AS g FROM scored s JOIN regions r USING (region)),
k AS (SELECT *, row_number() OVER w AS rank, sum(size) OVER (PARTITION BY batch ORDER BY score DESC, hits DESC, rows DESC, size, region ROWS UNBOUNDED PRECEDING) AS upto FROM g WHERE g = 1 WINDOW w AS (PARTITION BY batch ORDER BY score DESC, hits DESC, rows DESC, size, region)),
pg AS (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY rows DESC, tables DESC, size, region) AS g FROM regions),
pk AS (SELECT *, row_number() OVER (ORDER BY rows DESC, tables DESC, size, region) AS rank, sum(size) OVER (ORDER BY rows DESC, tables DESC, size, region ROWS UNBOUNDED PRECEDING) AS upto FROM pg WHERE g = 1),
chosen AS (SELECT batch, region, "group", score, rank FROM k WHERE (rank = 1 OR upto <= 12000) AND rank <= 5
  UNION ALL SELECT b.batch, region, "group", 0.0::DOUBLE, rank FROM (SELECT DISTINCT batch FROM terms WHERE batch NOT IN (SELECT batch FROM scored)) b CROSS JOIN pk WHERE (rank = 1 OR upto <= 12000) AND rank <= 5) SELECT * FROM chosen""",
)
add("expand_groups", lambda s, d: L.expand_groups(selected(s, d), regions(s, d)), _SELECTED.replace("SELECT * FROM chosen", 'SELECT DISTINCT batch, r."group", r.region FROM chosen c JOIN regions r ON r."group" = c."group"'))
add(
    "prior_entries",
    lambda s, d: L.prior_entries(table(s, d, "documents").select(F.col("doc_id").alias("entry"), "text"), terms(s, d)),
    f"WITH {_SCORED}, p AS (SELECT batch, region AS entry, sum(length(term)) AS score FROM terms CROSS JOIN forms WHERE contains(body, term) GROUP BY 1, 2) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY score DESC, entry) AS rank FROM p) WHERE rank <= 20",
)
_FOCUS = "CASE " + " ".join(f"WHEN contains(t, '{t}') THEN '{t}'" for t in C.FOCUS_TERMS) + " ELSE CASE WHEN name <> '' THEN substr(name, 1, 2) ELSE '其他' END END"
add(
    "bucket_components",
    lambda s, d: bill_rows(s, d).select("row_id", L.bucket_components(F.col("name"), F.col("unit")).alias("bucket")),
    f"WITH {BILL_ROWS}, n AS (SELECT row_id, name, {S.search(chr(39).join(['name || ', ' ', ' || unit']))} AS t FROM bill_rows) SELECT row_id, {_FOCUS} AS bucket FROM n",
)
add(
    "pack_batches",
    lambda s, d: L.pack_batches(table(s, d, "part").select(F.col("p_brand").alias("bucket"), F.col("p_partkey").cast("string").alias("component"), F.col("p_partkey").alias("pos"), F.length("p_name").alias("size")), 5, 60),
    """WITH RECURSIVE o AS (SELECT p_brand AS bucket, CAST(p_partkey AS VARCHAR) AS component, length(p_name) AS size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part),
f AS (SELECT bucket, component, k, 0 AS batch, 1 AS n, size AS chars FROM o WHERE k = 1
  UNION ALL SELECT o.bucket, o.component, o.k, CASE WHEN f.n >= 5 OR f.chars + o.size > 60 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.n >= 5 OR f.chars + o.size > 60 THEN 1 ELSE f.n + 1 END, CASE WHEN f.n >= 5 OR f.chars + o.size > 60 THEN o.size ELSE f.chars + o.size END FROM f JOIN o ON o.bucket = f.bucket AND o.k = f.k + 1)
SELECT bucket, component, CAST(batch AS INT) AS batch FROM f""",
)
_GRID_ROWS = "(SELECT DISTINCT p_brand AS chapter, p_type AS \"group\" FROM part) c JOIN (SELECT p_type AS \"group\", p_size % 6 AS batch, p_name AS component FROM part) b USING (\"group\")"


def grid(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return L.work_grid(p.select(F.col("p_brand").alias("chapter"), F.col("p_type").alias("group")).distinct(), p.select(F.col("p_type").alias("group"), (F.col("p_size") % 6).alias("batch"), F.col("p_name").alias("component")), 1, 3)


add("work_grid", lambda s, d: grid(s, d).groupBy("chapter", "batch").agg(F.count("*").alias("n")), f"SELECT chapter, batch, count(*) AS n FROM {_GRID_ROWS} WHERE batch BETWEEN 1 AND 3 GROUP BY 1, 2")
add(
    "pending_work",
    lambda s, d: L.pending_work(grid(s, d), grid(s, d).where("chapter < 'Brand#3' and (batch > 1 or component like 'a%')")),
    f"WITH g AS (SELECT DISTINCT chapter, batch, component FROM {_GRID_ROWS} WHERE batch BETWEEN 1 AND 3), d AS (SELECT * FROM g WHERE chapter < 'Brand#3' AND (batch > 1 OR component LIKE 'a%')), a AS (SELECT chapter, batch, list(component ORDER BY component) AS c FROM g GROUP BY 1, 2), b AS (SELECT chapter, batch, list(component ORDER BY component) AS c FROM d GROUP BY 1, 2) SELECT a.chapter, a.batch, len(a.c) AS components FROM a ANTI JOIN b ON a.chapter = b.chapter AND a.batch = b.batch AND a.c = b.c",
)


def payload(spark, sf_dir):
    """Parts in batches of forty, suppliers as their candidates, with the suppliers' nations as attributes."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), (F.col("p_partkey") % 40).alias("batch"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    m = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("row_id"), F.col("l_linenumber").alias("rank"), F.col("l_suppkey").cast("string").alias("component"), F.col("l_orderkey").alias("score")).distinct()
    c = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("component"), F.array("s_name", F.col("s_nationkey").cast("string")).alias("attributes"))
    r = table(spark, sf_dir, "benchmark").select((F.col("item_id") % 40).alias("batch"), F.col("item_id").alias("region"), F.regexp_replace("text", r"[^A-Za-z0-9 ]", "").alias("body"))
    return L.assemble_payload(p, m, c, r)


_TEXT80 = "CASE WHEN length(t) > 80 THEN rtrim(substr(t, 1, 79)) || '…' ELSE t END"
add(
    "assemble_payload",
    payload,
    f"""WITH m AS (SELECT row_id, component, rank, score, row_number() OVER (PARTITION BY row_id ORDER BY rank, component, score) AS k FROM (SELECT DISTINCT l_partkey AS row_id, l_linenumber AS rank, CAST(l_suppkey AS VARCHAR) AS component, l_orderkey AS score FROM lineitem)),
t AS (SELECT row_id, '[' || string_agg('{{"rank":' || rank || ',"component":"' || component || '","score":' || score || '}}', ',' ORDER BY rank, component, score) || ']' AS c FROM m WHERE k <= 3 GROUP BY 1),
p AS (SELECT p_partkey AS row_id, p_partkey % 40 AS batch, {_TEXT80} AS text FROM (SELECT *, trim(regexp_replace(p_name || ' ' || p_type, '\\s+', ' ', 'g')) AS t FROM part)),
r AS (SELECT batch, '"rows":[' || string_agg('{{"row_id":' || row_id || ',"text":"' || text || '"' || coalesce(',"candidates":' || c, '') || '}}', ',' ORDER BY row_id) || ']' AS j, count(*) AS n FROM p LEFT JOIN t USING (row_id) GROUP BY 1),
u AS (SELECT DISTINCT batch, component FROM m JOIN p USING (row_id) WHERE k <= 3),
c AS (SELECT batch, ',"components":[' || string_agg('{{"component":"' || component || '","attributes":["' || s_name || '","' || s_nationkey || '"]}}', ',' ORDER BY component) || ']' AS j FROM u JOIN supplier ON CAST(s_suppkey AS VARCHAR) = component GROUP BY 1),
g AS (SELECT item_id % 40 AS batch, ',"regions":[' || string_agg('{{"region":' || item_id || ',"body":"' || substr(regexp_replace(text, '[^A-Za-z0-9 ]', '', 'g'), 1, 400) || '"}}', ',' ORDER BY item_id) || ']' AS j FROM benchmark GROUP BY 1)
SELECT batch, '{{' || r.j || coalesce(c.j, '') || coalesce(g.j, '') || '}}' AS payload, n FROM r LEFT JOIN c USING (batch) LEFT JOIN g USING (batch)""",
)
