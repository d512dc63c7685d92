"""Queries of regions: the lines of a document are its pages, and words of them the titles of its outline."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.operators import regions as G
from termwright.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def add(name, query, sql):
    QUERIES[name], ORACLE_SQL[name] = query, sql


def pages(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("at", "text")).select("doc", (F.col("at") + 1).alias("page"), "text")


def outline(spark, sf_dir):
    """Two entries on each page of eight words or more, and one of a table of contents on the first page."""
    own = pages(spark, sf_dir).withColumn("w", F.split("text", " ")).where(F.size("w") >= 8)
    word = lambda i: F.get("w", F.lit(i))
    one = F.when(F.col("page") % 11 == 10, F.lit("条文说明")).otherwise(F.concat(word(2), F.lit(" - "), word(3)))
    two = F.when(F.col("doc") % 7 == 0, F.lit("Z.1 no such title")).when(F.col("page") % 2 == 0, F.concat(F.lit("E."), F.col("page").cast("string"), F.lit(" "), word(5), F.lit("\t"), word(6))).otherwise(F.concat(F.lit("附录 B "), word(5), word(6)))
    entry = lambda k, title: F.struct((F.col("page") * 4 + k).alias("idx"), ((F.col("page") * 5 + k) % 3 + 1).alias("level"), title.alias("title"))
    rows = own.select("doc", "page", F.inline(F.array(entry(1, one), entry(2, two))))
    first = pages(spark, sf_dir).where("page = 1 and doc % 3 > 0").select("doc", "page", F.lit(0).alias("idx"), F.lit(1).alias("level"), F.lit(" Contents").alias("title"))
    return rows.unionByName(first)


_BASE = f"""pg AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents),
wd AS (SELECT doc, page, string_split(text, ' ') AS w FROM pg), w8 AS (SELECT * FROM wd WHERE len(w) >= 8),
ol AS (SELECT doc, page, page * 4 + 1 AS idx, (page * 5 + 1) % 3 + 1 AS level, CASE WHEN page % 11 = 10 THEN '条文说明' ELSE w[3] || ' - ' || w[4] END AS title FROM w8
  UNION ALL SELECT doc, page, page * 4 + 2, (page * 5 + 2) % 3 + 1, CASE WHEN doc % 7 = 0 THEN 'Z.1 no such title' WHEN page % 2 = 0 THEN 'E.' || page || ' ' || w[6] || chr(9) || w[7] ELSE '附录 B ' || w[6] || w[7] END FROM w8
  UNION ALL SELECT doc, 1, 0, 1, ' Contents' FROM pg WHERE page = 1 AND doc % 3 > 0),
f AS (SELECT *, regexp_matches(title, '{C.BODY_TITLE}') AS bodylike, CASE WHEN regexp_matches(lower(title), '{"|".join(C.FRONT_TITLES)}') THEN 'front' WHEN regexp_matches(lower(title), '{"|".join(C.BACK_TITLES)}') THEN 'back' ELSE 'body' END AS c0 FROM ol),
fb AS (SELECT doc, arg_min(page, idx) FILTER (bodylike) AS fp FROM f GROUP BY 1),
cl AS (SELECT f.*, fp, CASE WHEN c0 = 'body' AND NOT bodylike AND (fp IS NULL OR page < fp) THEN 'front' ELSE c0 END AS category FROM f JOIN fb USING (doc)),
rg AS (SELECT doc, arg_min(page, idx) FILTER (lower(trim(title)) IN ('目次', 'contents')) AS catalog_start, arg_min(page, idx) FILTER (category = 'body' AND bodylike) AS body_start, arg_min(page, idx) FILTER (category = 'back') AS back FROM cl GROUP BY 1),
rn AS (SELECT doc, catalog_start, CASE WHEN catalog_start IS NOT NULL THEN body_start - 1 END AS catalog_end, body_start - 1 AS front_end, body_start, coalesce(back - 1, (SELECT max(page) FROM pg WHERE pg.doc = rg.doc)) AS body_end FROM rg)"""
add("body_pages", lambda s, d: G.body_pages(outline(s, d)).select("doc", "idx", "category", "body_page"), f"WITH {_BASE} SELECT doc, idx, category, CASE WHEN category = 'body' AND page >= fp THEN page - fp + 1 END AS body_page FROM cl")
add("page_ranges", lambda s, d: G.page_ranges(G.body_pages(outline(s, d)), pages(s, d)), f"WITH {_BASE} SELECT * FROM rn")
_BOUND = "bd AS (SELECT a.doc, a.idx, arg_min(b.idx, b.idx) AS end_idx, arg_min(b.title, b.idx) AS end_title, arg_min(b.page, b.idx) AS end_page FROM cl a LEFT JOIN cl b ON a.doc = b.doc AND b.idx > a.idx AND b.level <= a.level GROUP BY 1, 2)"
add("boundaries", lambda s, d: G.boundaries(outline(s, d)).select("doc", "idx", "end_idx", "end_title", "end_page"), f"WITH {_BASE}, {_BOUND} SELECT * FROM bd")
_norm = lambda x: f"array_to_string(list_transform(list_filter(string_split({x}, ''), lambda c: regexp_matches(c, '[\\p{{L}}\\p{{N}}]')), lambda c: lower(c)), '')"
_bare = lambda x, form: f"regexp_replace({x}, '{form}', '')"


def _found(prefix: str, start: str) -> str:
    """The place of the first form of a title in ``n``, and its length."""
    hit = lambda i: f"strpos(substr(n, {start}), {prefix}{i})"
    fits = lambda i: f"length({prefix}{i}) >= 2 AND {hit(i)} > 0"
    return f"CASE {' '.join(f'WHEN {fits(i)} THEN {hit(i)} + {start} - 1' for i in (1, 2, 3))} END AS {prefix}m, CASE {' '.join(f'WHEN {fits(i)} THEN length({prefix}{i})' for i in (1, 2, 3))} END AS {prefix}l"


_FORMS = lambda prefix, x: ", ".join(f"coalesce({_norm(t)}, '') AS {prefix}{i}" for i, t in enumerate((x, _bare(x, C.TITLE_NUMBER), _bare(x, C.TITLE_APPENDIX)), 1))
add(
    "region_text",
    lambda s, d: G.region_text(G.body_pages(outline(s, d)), pages(s, d)).select("doc", "idx", F.md5(F.col("text").cast("binary")).alias("text"), F.length("text").alias("chars"), "start_found", "end_found", "page_start", "page_end"),
    f"""WITH {_BASE}, {_BOUND},
en AS (SELECT cl.doc, cl.idx, cl.page AS ps, end_page AS pe, body_end, {_FORMS('s', 'title')}, {_FORMS('e', 'end_title')} FROM cl JOIN bd USING (doc, idx) JOIN rn USING (doc) WHERE category = 'body'),
tc AS (SELECT en.*, pg.page, pg.text, pg.page = ps AS b, coalesce(pg.page = pe, false) AS e FROM en JOIN pg ON pg.doc = en.doc AND pg.page >= ps AND pg.page <= greatest(ps, coalesce(pe, body_end))),
ks AS (SELECT doc, page, text, list_filter(list_transform(string_split(text, ''), lambda c, i: {{'c': c, 'i': i}}), lambda x: regexp_matches(x.c, '[\\p{{L}}\\p{{N}}]')) AS k FROM pg),
kn AS (SELECT doc, page, k, array_to_string(list_transform(k, lambda x: lower(x.c)), '') AS n FROM ks),
a1 AS (SELECT tc.*, k, n, {_found('s', '1')} FROM tc JOIN kn USING (doc, page)),
a2 AS (SELECT * REPLACE (CASE WHEN b THEN sm END AS sm, CASE WHEN b THEN sl END AS sl) FROM a1),
a3 AS (SELECT *, {_found('e', '(CASE WHEN sm IS NULL THEN 1 ELSE sm + sl END)')} FROM a2),
pt AS (SELECT doc, idx, ps, page, b AND sm IS NOT NULL AS sf, e AND em IS NOT NULL AS ef, CASE WHEN sm IS NULL THEN 1 ELSE k[sm].i END AS lo, CASE WHEN e AND em IS NOT NULL THEN k[em].i ELSE length(text) + 1 END AS hi, text FROM a3),
st AS (SELECT *, regexp_replace(substr(text, lo, greatest(hi - lo, 0)), '^\\s+|\\s+$', '', 'g') AS part FROM pt),
ag AS (SELECT doc, idx, any_value(ps) AS ps, coalesce(string_agg(nullif(part, ''), chr(10) ORDER BY page), '') AS t, bool_or(sf) AS start_found, bool_or(ef) AS end_found, coalesce(max(page) FILTER (part <> ''), any_value(ps)) AS page_end FROM st GROUP BY 1, 2)
SELECT doc, idx, md5(t) AS text, length(t) AS chars, start_found, end_found, ps AS page_start, page_end FROM ag""",
)
