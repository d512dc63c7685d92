"""Queries of the line operators: the lines of documents, with levels and tags made of their places and texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.operators import lines as N
from termwright.operators import positions as P
from termwright.plans import sqltext as S
from termwright.sources.tables import pick, sql_pick, table

QUERIES, ORACLE_SQL = {}, {}


def add(name, query, sql):
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


_LINES = ("031010201O wall", "m2", "- 12 -", "续表 E.2.1", "表 E.2.1 x", "E.1 head", "按体积计算", "1.厚度", "plain")
#: Beginnings of lines of every kind.
_KINDS = (*_LINES, "项目编码", "项 目 名 称", "材质类别", "表 x 规定执行。", "2 墙", "KG", "### head", "0101O1002", "计量单位：")


def sample(spark, sf_dir):
    """Order lines as lines of documents: a line's text goes by its number and part."""
    li = table(spark, sf_dir, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    pos = F.col("l_linenumber").cast("long") * 1000000 + F.col("l_partkey") * 100 + F.col("l_suppkey") % 100
    return li.groupBy(F.col("l_orderkey").alias("doc"), pos.alias("pos")).agg(F.min("l_partkey").alias("part")).select("doc", "pos", "part", pick(_LINES, (F.col("part") % 9).cast("int")).alias("line"), (F.col("part") % 5 + 1).cast("int").alias("level"), F.concat(F.lit("t"), (F.col("part") % 50).cast("string")).alias("title"))


_S = f"""lines AS (SELECT l_orderkey AS doc, l_linenumber * 1000000 + l_partkey * 100 + l_suppkey % 100 AS pos, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2),
sample AS (SELECT doc, pos, part, {sql_pick(_LINES, 'part % 9')} AS line, CAST(part % 5 + 1 AS INT) AS level, 't' || (part % 50) AS title FROM lines)"""
_TAGS = ("code", "unit", "page", "continuation", "table title", "heading", "rule", "work", "text")


def _compact(x: str) -> str:
    return f"regexp_replace({x}, '\\s+', '', 'g')"


def _header(x: str) -> str:
    c = _compact(x)
    return "CASE " + " ".join(f"WHEN {c} = '{w}' OR (contains({c}, '{w}') AND length({c}) <= {len(w) + 2}) THEN '{name}'" for name, words in C.TABLE_HEADERS.items() for w in words) + " END"


def _tag(x: str) -> str:
    c, t = _compact(x), f"trim({x})"
    unit = f"lower({c}) IN (" + ", ".join(f"'{u}'" for u in C.LINE_UNITS) + ")"
    rule, work = f"regexp_matches({c}, '^({'|'.join(C.RULE_STARTS)})')", f"regexp_matches({t}, '^\\d+\\s*[.．、]')"
    heading = "^(附录\\s*[A-Z]|[A-Z]\\.\\s*\\d+(\\.\\d+)*|\\d+\\.\\d+(\\.\\d+)*|\\d+\\s+[一-鿿]|#{1,6}\\s)"
    return f"""CASE WHEN {_header(x)} IS NOT NULL THEN 'header' WHEN starts_with({c}, '续表') THEN 'continuation' WHEN starts_with({c}, '表') AND NOT regexp_matches({c}, '执行。?$') THEN 'table title'
  WHEN regexp_matches({c}, '^[•·-]?\\d{{1,3}}[•·-]?$') THEN 'page' WHEN regexp_matches({t}, '^[0-9OoIl]{{9,12}}(\\D|$)') THEN 'code' WHEN {unit} THEN 'unit' WHEN regexp_matches({t}, '{heading}') THEN 'heading'
  WHEN {rule} THEN 'rule' WHEN {work} THEN 'work' WHEN regexp_matches({c}, '{'|'.join(C.FEATURE_LINE_WORDS)}') THEN 'feature' ELSE 'text' END"""


def any_lines(spark, sf_dir):
    """The lines of all documents, and lines of every kind with something after them."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("pos", "line")).select("doc", F.col("pos").cast("long").alias("pos"), "line")
    tail = pick(("", " 12", " 墙x"), (F.col("part") % 3).cast("int"))
    return d.unionByName(sample(spark, sf_dir).select((-F.col("doc")).alias("doc"), "pos", F.concat(pick(_KINDS, (F.col("part") % len(_KINDS)).cast("int")), tail).alias("line")))


add(
    "classify_lines",
    lambda s, d: N.classify_lines(any_lines(s, d)).groupBy("doc", "tag").agg(F.count("*").alias("n"), F.sum("pos").alias("places")),
    f"""WITH {_S}, a AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents
UNION ALL SELECT -doc, {sql_pick(_KINDS, f'part % {len(_KINDS)}')} || {sql_pick(('', ' 12', ' 墙x'), 'part % 3')}, pos FROM sample) SELECT doc, {_tag('line')} AS tag, count(*) AS n, sum(pos) AS places FROM a GROUP BY 1, 2""",
)
_OPEN = "NOT EXISTS (SELECT 1 FROM sample q WHERE q.doc = s.doc AND q.pos > p.pos AND q.pos <= s.pos AND q.level <= p.level)"
add(
    "outline_paths",
    lambda s, d: N.outline_paths(sample(s, d)),
    f"""WITH {_S}, c AS (SELECT s.doc, s.pos, any_value(s.level) AS level, any_value(s.title) AS title, list(p.title ORDER BY p.pos) AS path FROM sample s JOIN sample p ON p.doc = s.doc AND p.pos <= s.pos AND {_OPEN} GROUP BY 1, 2)
SELECT doc, pos, level, title, array_to_string(path, ' > ') AS path, CASE WHEN len(path) > 1 THEN path[len(path) - 1] END AS parent FROM c""",
)
add("region_bounds", lambda s, d: N.region_bounds(sample(s, d)).select("doc", "pos", "end"), f'WITH {_S} SELECT a.doc, a.pos, min(b.pos) AS "end" FROM sample a LEFT JOIN sample b ON a.doc = b.doc AND b.pos > a.pos AND b.level <= a.level GROUP BY 1, 2')
add(
    "region_lines",
    lambda s, d: N.region_lines(sample(s, d), sample(s, d)),
    f"""WITH {_S}, b AS (SELECT a.doc, a.pos AS start, min(b.pos) AS e FROM sample a LEFT JOIN sample b ON a.doc = b.doc AND b.pos > a.pos AND b.level <= a.level GROUP BY 1, 2)
SELECT b.doc, start, string_agg(line, chr(10) ORDER BY s.pos) AS text, count(*) AS n_lines FROM b JOIN sample s ON s.doc = b.doc AND s.pos >= start AND (e IS NULL OR s.pos < e) GROUP BY 1, 2""",
)


_BLOCKS = (
    ("表 A.1 x", "项目编码", "项目名称", "", "项目特征", "计量单位", "010101001 挖", "m3", "1.装车"),
    ("E.1 heading", "plain"),
    ("项目编码", "项目名称", "工作内容", "plain"),
    ("01O101002 填", "按体积计算"),
    ("plain text", ""),
    ("编码", "名称", "特征", "续表 A.1", "工作内容", "E.2 next"),
)


def blocks(spark, sf_dir):
    """Lines of suppliers' documents: a block of lines for each order line."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("doc"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("base")).agg(F.min("l_partkey").alias("part"))
    lines = F.get(F.array(*[F.array(*map(F.lit, b)) for b in _BLOCKS]), (F.col("part") % len(_BLOCKS)).cast("int"))
    return li.select("doc", "base", F.posexplode(lines).alias("k", "line")).select("doc", (F.col("base") * 10 + F.col("k")).alias("pos"), "line")


_B = f"""base AS (SELECT l_suppkey AS doc, l_orderkey * 8 + l_linenumber AS base, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2),
picked AS (SELECT doc, base, [{", ".join("[" + ", ".join(f"'{x}'" for x in b) + "]" for b in _BLOCKS)}][1 + part % {len(_BLOCKS)}] AS ls FROM base),
blocks AS (SELECT doc, base * 10 + generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS line FROM picked)"""
_REQUIRED = " AND ".join(f"list_contains(run, '{h}')" for h in C.REQUIRED_HEADERS)
add(
    "table_segments",
    lambda s, d: N.table_segments(N.classify_lines(blocks(s, d))).select("doc", "pos", "table_no"),
    f"""WITH RECURSIVE {_B}, h AS (SELECT doc, pos, {_header('line')} AS header, {_tag('line')} AS tag FROM blocks WHERE trim(line) <> ''),
n AS (SELECT *, sum((header IS NULL)::INT) OVER (PARTITION BY doc ORDER BY pos) AS broken, lag(header) OVER (PARTITION BY doc ORDER BY pos) AS prev FROM h),
a AS (SELECT *, list({{'b': broken, 'h': header}}) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS ahead FROM n),
r AS (SELECT *, list_distinct(list_transform(list_filter(ahead, lambda x: x.b = broken), lambda x: x.h)) AS run FROM a),
ev AS (SELECT doc, pos, CASE WHEN header IS NOT NULL AND prev IS NULL AND len(list_filter(run, lambda x: x IS NOT NULL)) >= 4 AND {_REQUIRED} THEN 'start' WHEN tag = 'code' THEN 'code' WHEN tag = 'heading' THEN 'heading' END AS mark FROM r),
e AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY pos) AS i FROM ev WHERE mark IS NOT NULL),
f AS (SELECT doc, i, CASE WHEN mark = 'start' THEN pos END AS start, false AS seen, CAST(NULL AS BIGINT) AS s, CAST(NULL AS BIGINT) AS e FROM e WHERE i = 1
  UNION ALL SELECT e.doc, e.i, CASE WHEN f.start IS NULL THEN CASE WHEN mark = 'start' THEN e.pos END WHEN mark = 'heading' AND seen THEN NULL ELSE f.start END, f.start IS NOT NULL AND NOT (mark = 'heading' AND seen) AND (seen OR mark = 'code'),
    CASE WHEN f.start IS NOT NULL AND mark = 'heading' AND seen THEN f.start END, CASE WHEN f.start IS NOT NULL AND mark = 'heading' AND seen THEN e.pos END FROM f JOIN e ON e.doc = f.doc AND e.i = f.i + 1),
open_ AS (SELECT doc, start FROM f QUALIFY row_number() OVER (PARTITION BY doc ORDER BY i DESC) = 1),
spans AS (SELECT doc, s, e, row_number() OVER (PARTITION BY doc ORDER BY s) AS table_no FROM (SELECT doc, s, e FROM f WHERE s IS NOT NULL UNION ALL SELECT doc, start, NULL FROM open_ WHERE start IS NOT NULL))
SELECT h.doc, h.pos, CAST(table_no AS INT) AS table_no FROM h JOIN spans ON spans.doc = h.doc AND h.pos >= s AND (e IS NULL OR h.pos < e)""",
)


def sessions(spark, sf_dir):
    rows = sample(spark, sf_dir).withColumn("table_no", F.col("doc") % 2)
    return N.code_sessions(N.classify_lines(rows.withColumn("line", F.when(F.col("part") % 2 == 0, _LINES[0]).otherwise(F.col("line")))))


_SES = f"""{_S}, c AS (SELECT doc, pos, doc % 2 AS table_no, CASE WHEN part % 2 = 0 THEN '{_LINES[0]}' ELSE line END AS line, CASE WHEN part % 2 = 0 THEN 'code' ELSE {sql_pick(_TAGS, 'part % 9')} END AS tag FROM sample),
ses AS (SELECT * FROM (SELECT *, sum((tag = 'code')::INT) OVER (PARTITION BY doc, table_no ORDER BY pos) AS session FROM c) WHERE session > 0)"""
add("code_sessions", lambda s, d: sessions(s, d).select("doc", "table_no", "pos", "session"), f"WITH {_SES} SELECT doc, table_no, pos, session FROM ses")
_ROW_LINES = ("031010201O wall", "m2", "墙面", "材质类别", "按体积计算", "1.运输", "plain line text", "2.x", "m3")


def row_lines(spark, sf_dir):
    own = sample(spark, sf_dir).withColumn("table_no", F.col("doc") % 2)
    own = own.withColumn("line", F.when(F.col("part") % 4 == 0, pick(("0310102O1", "031010202 柱 1.a", "031010203 梁"), (F.col("part") % 3).cast("int"))).otherwise(pick(_ROW_LINES, (F.col("part") % 9).cast("int"))))
    return N.code_sessions(N.classify_lines(own))


_is_unit = lambda x: f"lower({_compact(x)}) IN (" + ", ".join(f"'{u}'" for u in C.LINE_UNITS) + ")"
_is_rule = lambda x: f"regexp_matches({_compact(x)}, '^({'|'.join(C.RULE_STARTS)})')"
_is_work = lambda x: f"regexp_matches(trim({x}), '^\\d+\\s*[.．、]')"
_is_feature = lambda x: f"(regexp_matches({_compact(x)}, '{'|'.join(C.FEATURE_LINE_WORDS)}') AND NOT {_is_rule(x)} AND NOT {_is_unit(x)} AND NOT {_is_work(x)})"
_first = lambda rows, test: f"coalesce(list_position(list_transform({rows}, lambda x: {test('x')}), true), 0)"
add(
    "row_fields",
    lambda s, d: N.row_fields(row_lines(s, d)),
    f"""WITH {_S}, c AS (SELECT doc, pos, doc % 2 AS table_no, CASE WHEN part % 4 = 0 THEN ['0310102O1', '031010202 柱 1.a', '031010203 梁'][1 + part % 3] ELSE {sql_pick(_ROW_LINES, 'part % 9')} END AS line FROM sample),
ses AS (SELECT * FROM (SELECT *, sum((regexp_matches(line, '^[0-9OoIl]{{9,12}}(\\D|$)'))::INT) OVER (PARTITION BY doc, table_no ORDER BY pos) AS session FROM c) WHERE session > 0),
l AS (SELECT doc, table_no, session, list(trim(line) ORDER BY pos) AS ls FROM ses GROUP BY 1, 2, 3),
a AS (SELECT *, translate(regexp_extract(ls[1], '^([0-9OoIl]{{9,12}})', 1), 'OoIl', '0011') AS code, list_filter(list_concat([regexp_extract(ls[1], '^[0-9OoIl]{{9,12}}\\s*(.*)$', 1)], ls[2:]), lambda x: x <> '') AS r0 FROM l),
b AS (SELECT *, CASE WHEN regexp_matches(r0[1], '^(.*?)\\s+(\\d+\\s*[.．、].+)$') THEN list_concat([trim(regexp_extract(r0[1], '^(.*?)\\s+(\\d+\\s*[.．、].+)$', 1)), trim(regexp_extract(r0[1], '^(.*?)\\s+(\\d+\\s*[.．、].+)$', 2))], r0[2:]) ELSE r0 END AS r FROM a),
n AS (SELECT *, CASE WHEN len(r) = 0 THEN 0 WHEN len(r) > 1 AND NOT {_is_feature('r[2]')} AND NOT {_is_rule('r[2]')} AND NOT {_is_unit('r[2]')} AND NOT {_is_work('r[2]')} AND length({_compact('r[1]')}) <= 6 AND length({_compact('r[2]')}) <= 8 THEN 2 ELSE 1 END AS n FROM b),
q AS (SELECT *, array_to_string(r[1:n], chr(10)) AS name, r[n + 1:] AS q0, {_first('r[n + 1:]', _is_unit)} AS u FROM n),
v AS (SELECT *, CASE WHEN u > 0 THEN {_compact('q0[u]')} END AS unit, list_filter(q0, lambda x, i: i <> u) AS q1 FROM q),
w AS (SELECT *, {_first('q1', _is_work)} AS w FROM v),
x AS (SELECT *, CASE WHEN w > 0 THEN q1[1:w - 1] ELSE q1 END AS bf FROM w),
y AS (SELECT *, {_first('bf', _is_rule)} AS ru FROM x)
SELECT doc, table_no, session, code, name, unit, array_to_string(CASE WHEN ru > 0 THEN bf[1:ru - 1] ELSE bf END, chr(10)) AS features, CASE WHEN ru > 0 THEN array_to_string(bf[ru:], chr(10)) ELSE '' END AS rule, CASE WHEN w > 0 THEN array_to_string(q1[w:], chr(10)) ELSE '' END AS work FROM y""",
)


def words(spark, sf_dir):
    return sample(spark, sf_dir).select("doc", (F.col("part") % 2).alias("page"), (F.col("part") % 97).cast("double").alias("x"), (F.col("part") % 23).cast("double").alias("y"), "title").withColumnRenamed("title", "word")


add(
    "cluster_word_lines",
    lambda s, d: N.cluster_word_lines(words(s, d)),
    f"""WITH RECURSIVE {_S}, w AS (SELECT doc, part % 2 AS page, (part % 97)::DOUBLE AS x, (part % 23)::DOUBLE AS y, title AS word, row_number() OVER (PARTITION BY doc, part % 2 ORDER BY part % 23, part % 97, title) AS k FROM sample),
f AS (SELECT doc, page, k, x, word, y AS m, 1 AS n, 0 AS line_no FROM w WHERE k = 1
  UNION ALL SELECT w.doc, w.page, w.k, w.x, w.word, CASE WHEN abs(w.y - f.m) <= 3.0 THEN (f.m * f.n + w.y) / (f.n + 1) ELSE w.y END, CASE WHEN abs(w.y - f.m) <= 3.0 THEN f.n + 1 ELSE 1 END, CASE WHEN abs(w.y - f.m) <= 3.0 THEN f.line_no ELSE f.line_no + 1 END FROM f JOIN w ON w.doc = f.doc AND w.page = f.page AND w.k = f.k + 1)
SELECT doc, page, line_no, string_agg(word, ' ' ORDER BY x, word) AS line FROM f GROUP BY 1, 2, 3""",
)


def columns(spark, sf_dir):
    c = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.lit(float(x)).alias("centre")) for n, x in (("code", 10), ("name", 40), ("unit", 80))])))
    return N.assign_columns(words(spark, sf_dir), c).groupBy("doc", "column").agg(F.count("*").alias("n"), F.sum("x").alias("x"))


add("assign_columns", columns, f"""WITH {_S} SELECT doc, CASE WHEN part % 97 < 25 THEN 'code' WHEN part % 97 < 60 THEN 'name' ELSE 'unit' END AS "column", count(*) AS n, sum(part % 97)::DOUBLE AS x FROM sample GROUP BY 1, 2""")
_CELL_ROWS = (
    ("010101001", "n", "1.x", "", "", "1.a"),
    ("", "", "", "", "", "2.b"),
    ("", "nm", "", "m3", "", ""),
    ("", "", "f", "", "按r", "1.c"),
    ("", "", "", "", "1.r", ""),
    ("O10101002 in", "", "", "", "", ""),
    ("", "nm2", "", "", "", ""),
    ("", "", "", "", "", "tail"),
    ("", "", "", "", "", "1.d"),
)


def cells(spark, sf_dir):
    # A document's lines are brought together once, for all that is asked of them by document.
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("doc"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), "l_partkey").repartition("doc").groupBy("doc", "pos").agg(F.min("l_partkey").alias("part"))
    row = F.get(F.array(*[F.array(*map(F.lit, r)) for r in _CELL_ROWS]), (F.col("part") % len(_CELL_ROWS)).cast("int"))
    own = li.select("doc", (F.col("pos") % 40).alias("table_no"), "pos", "part", row.alias("r"))
    tail = F.when(F.col("r")[1] != "", F.concat(F.col("r")[1], F.col("part").cast("string"))).otherwise("")
    return own.select("doc", "table_no", "pos", (F.col("doc") % 2 == 0).alias("continuation"), *[(tail if c == "name" else F.col("r")[i]).alias(c) for i, c in enumerate(N.CELLS)])


_one = lambda c: f"regexp_matches({c}, '^1\\s*[.．、]')"


def _rows_sql(number: str) -> str:
    """Rows of the cells, whose table has this number."""
    return f"""WITH b AS (SELECT l_suppkey AS doc, l_orderkey * 8 + l_linenumber AS pos, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2),
p AS (SELECT doc, {number} AS table_no, pos, part, [{", ".join("[" + ", ".join(f"'{x}'" for x in r) + "]" for r in _CELL_ROWS)}][1 + part % {len(_CELL_ROWS)}] AS r FROM b),
c AS (SELECT doc, table_no, pos, doc % 2 = 0 AS continuation, translate(nullif(regexp_extract(r[1], '^([0-9OoIl]{{9,12}})', 1), ''), 'OoIl', '0011') AS code, regexp_extract(r[1], '^[0-9OoIl]{{9,12}}\\s*(.*)$', 1) AS inline, CASE WHEN r[2] <> '' THEN r[2] || part ELSE '' END AS name, r[3] AS features, r[4] AS unit, r[5] AS rule, r[6] AS work FROM p),
a AS (SELECT *, row_number() OVER w AS seq, code IS NOT NULL AS is_code, name <> '' OR features <> '' OR unit <> '' AS named FROM c WINDOW w AS (PARTITION BY doc, table_no ORDER BY pos)),
n AS (SELECT *, min(CASE WHEN is_code THEN seq END) OVER w AS code_at, min(CASE WHEN named AND NOT is_code THEN seq END) OVER w AS named_at FROM a WINDOW w AS (PARTITION BY doc, table_no ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING)),
s AS (SELECT *, NOT is_code AND code_at IS NOT NULL AND ({_one('work')} OR {_one('rule')}) AND (named OR coalesce(named_at < code_at, false)) AS anew, NOT is_code AND coalesce(code_at = seq + 1, false) AND named AND rule = '' AND work = '' AS before, sum(is_code::INT) OVER (PARTITION BY doc, table_no ORDER BY pos) AS session FROM n),
m AS (SELECT *, CASE WHEN is_code THEN session WHEN bool_or(anew) OVER (PARTITION BY doc, table_no, session ORDER BY pos) OR before OR (continuation AND session = 0) THEN session + 1 ELSE session END AS row_no FROM s)
SELECT doc, table_no, row_no, max(code) AS code, concat_ws(chr(10), nullif(max(inline), ''), string_agg(nullif(name, ''), chr(10) ORDER BY pos)) AS name, {", ".join(f"coalesce(string_agg(nullif({c}, ''), chr(10) ORDER BY pos), '') AS {c}" for c in ("features", "unit", "rule", "work"))}
FROM m WHERE row_no > 0 GROUP BY 1, 2, 3 HAVING max(code) IS NOT NULL"""


add("rows_from_cells", lambda s, d: N.rows_from_cells(cells(s, d)), _rows_sql("pos % 40"))


def page_words(spark, sf_dir):
    """The cells as words on pages: a table on each, with a title, a header of one of three makes, page marks, and centres that move a little from page to page."""
    own = cells(spark, sf_dir)
    data = own.withColumn("k", F.row_number().over(Window.partitionBy("doc", "table_no").orderBy("pos"))).withColumn("nth", F.dense_rank().over(Window.partitionBy("doc").orderBy("table_no")))
    # What is put on a page: cells by their column, -1 for titles and headers, -2 for marks; most cells are empty, and only others go on.
    item = lambda i, x, y, word: F.struct(F.lit(i).alias("i"), F.lit(float(x)).alias("x"), F.lit(y).alias("y"), word.alias("said"))
    centre = lambda i: 100 * i + 50
    own_cells = F.array(*[item(i, centre(i), 40, F.col(c)) for i, c in enumerate(N.CELLS)])
    full = F.array(*[item(-1, centre(i), 20, F.lit(h)) for i, h in enumerate(C.TABLE_HEADERS)])
    some = F.array(*[item(-1, centre(i), 20, F.lit(h)) for i, h in enumerate(C.TABLE_HEADERS) if h not in ("计量单位", "工程量计算规则")])
    text = F.array(item(-1, centre(1), 20, F.lit("项目编码项目名称项目特征")), item(-1, centre(4), 20, F.lit(" 工作内容")))
    header = F.when((F.col("nth") == 1) | (F.col("table_no") % 3 == 0), full).when(F.col("table_no") % 3 == 1, some).otherwise(text)
    title = lambda word: F.array(item(-1, centre(2), 4, F.lit(word)), item(-1, centre(3), 5, F.lit("A.1")))
    mark, none = F.array(item(-2, 300, 46, F.lit("• 12 •"))), F.array().cast("array<struct<i:int,x:double,y:int,said:string>>")
    # A table's first line brings its title and header, so all words come from one pass.
    data = data.withColumn("top", F.when(F.col("k") == 1, F.concat(F.when(F.col("continuation"), title("续 表")).otherwise(title("表")), header)))
    items = F.concat(own_cells, F.when(F.col("k") % 4 == 0, mark).otherwise(none), F.coalesce("top", none))
    rows = data.select("doc", F.col("table_no").alias("page"), "k", F.inline(items)).where("said <> ''")
    # A code and what stands after it are two words of one cell; lines are a little uneven.
    cell = F.col("i") >= 0
    said = [F.struct(F.lit(n).alias("n"), F.when(cell, F.split_part("said", F.lit(" "), F.lit(n))).otherwise(F.col("said") if n == 1 else F.lit("")).alias("word")) for n in (1, 2)]
    rows = rows.select("doc", "page", "k", "i", "x", "y", F.inline(F.array(*said))).where("word <> ''")
    x = F.col("x") + F.when(F.col("i") > -2, F.col("page") % 5).otherwise(0) + 9 * (F.col("n") - 1)
    y = (F.col("y") + F.when(F.col("i") == -1, 0).otherwise(F.col("k") * 12) + F.when(cell, (F.col("i") + F.col("n")) % 3).otherwise(0)).cast("double")
    return rows.select("doc", "page", (x - 6).alias("x0"), y.alias("y0"), (x + 6).alias("x1"), (y + 8).alias("y1"), "word")


add("rows_from_words", lambda s, d: P.rows_from_words(page_words(s, d)), _rows_sql("dense_rank() OVER (PARTITION BY doc ORDER BY pos % 40)"))
_TITLES = ("表 E.1.1 a", "续表 E.1.1", "续表", "表 E.2.1 b", "续表 E.9.9")
add(
    "merge_continuations",
    lambda s, d: N.merge_continuations(sample(s, d).select("doc", "pos", pick(_TITLES, (F.col("part") % 5).cast("int")).alias("title"))).select("doc", "pos", "merged_no"),
    f"""WITH {_S}, i AS (SELECT doc, pos, part % 5 AS k, ['E.1.1', 'E.1.1', NULL, 'E.2.1', 'E.9.9'][1 + part % 5] AS id FROM sample), b AS (SELECT *, lag(id) OVER (PARTITION BY doc ORDER BY pos) AS before FROM i)
SELECT doc, pos, sum(CASE WHEN k IN (1, 2, 4) AND before IS NOT NULL AND (id IS NULL OR id = before) THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY pos) AS merged_no FROM b""",
)


def table_rows(spark, sf_dir):
    return sample(spark, sf_dir).select(
        "doc", F.lit(1).alias("table_no"), "pos", "part", F.when(F.col("part") % 3 == 0, F.col("title")).otherwise(" ").alias("rule"), F.when(F.col("part") % 4 == 0, F.concat(F.lit("1."), F.col("title"))).when(F.col("part") % 4 == 1, F.concat(F.lit("2."), F.col("title"), F.lit("\n3.x"))).otherwise("").alias("work")
    )


_ROWS = f"{_S}, r AS (SELECT doc, pos, part, CASE WHEN part % 3 = 0 THEN title END AS rule, CASE part % 4 WHEN 0 THEN '1.' || title WHEN 1 THEN '2.' || title || chr(10) || '3.x' ELSE '' END AS work FROM sample)"
add(
    "fill_shared",
    lambda s, d: N.fill_shared(table_rows(s, d)).select("doc", "pos", "rule", "work"),
    f"""WITH {_ROWS} SELECT doc, pos, coalesce(first_value(rule IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(rule IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING)) AS rule,
last_value(nullif(work, '') IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS work FROM r""",
)
add(
    "shift_split_work",
    lambda s, d: N.shift_split_work(table_rows(s, d)).select("doc", "pos", "work"),
    f"""WITH {_ROWS}, k AS (SELECT *, part % 4 AS m, lead(part % 4) OVER o AS nm, lag(part % 4) OVER o AS pm, lag(work) OVER o AS pw FROM r WINDOW o AS (PARTITION BY doc ORDER BY pos))
SELECT doc, pos, CASE WHEN m = 0 AND nm = 1 THEN '' WHEN m = 1 AND pm = 0 THEN pw || chr(10) || work ELSE work END AS work FROM k""",
)
_UNITS, _RULES, _TEXTS = ("m2", "", "0?", "㎡", "kg", "n?", " m* "), ("按图示体积计算", "按建筑面积", "延 长 米", "", "中心线长度", "按质量"), ("以面积计算", "立方米", "x", "")


def measured(spark, sf_dir):
    return sample(spark, sf_dir).select("doc", "pos", pick(_UNITS, (F.col("part") % 7).cast("int")).alias("unit"), F.concat(F.col("title"), pick(_RULES, (F.col("part") % 6).cast("int"))).alias("rule"), pick(_TEXTS, (F.col("doc") % 4).cast("int")).alias("table_text"))


_measure = lambda x: f"CASE WHEN regexp_matches({_compact(x)}, '体积计算|立方米') THEN 'm3' WHEN regexp_matches({_compact(x)}, '面积计算|建筑面积|投影面积') THEN 'm2' WHEN regexp_matches({_compact(x)}, '延长米|长度计算|中心线长度') THEN 'm' END"
add(
    "infer_units",
    lambda s, d: N.infer_units(measured(s, d)).select("doc", "pos", "unit"),
    f"""WITH {_S}, m AS (SELECT doc, pos, {sql_pick(_UNITS, 'part % 7')} AS unit, title || {sql_pick(_RULES, 'part % 6')} AS rule, {sql_pick(_TEXTS, 'doc % 4')} AS t FROM sample), f AS (SELECT *, coalesce({_measure('rule')}, {_measure('t')}) AS fb FROM m)
SELECT doc, pos, CASE WHEN trim(unit) = '' THEN coalesce(fb, '') WHEN trim(unit) IN ('n?', '0?', 'm*') THEN coalesce(fb, trim(unit)) ELSE unit END AS unit FROM f""",
)
_ENDS = (*C.TRAILING_FEATURES, "", "墙")
add(
    "split_trailing_feature",
    lambda s, d: N.split_trailing_feature(sample(s, d).select("doc", "pos", F.concat(F.when(F.col("part") % 10 > 0, F.col("title")).otherwise(""), pick(_ENDS, (F.col("part") % 9).cast("int"))).alias("name"), F.when(F.col("part") % 4 == 0, "1.x").otherwise(" ").alias("features"))),
    f"""WITH {_S}, n AS (SELECT doc, pos, CASE WHEN part % 10 > 0 THEN title ELSE '' END || {sql_pick(_ENDS, 'part % 9')} AS name, CASE WHEN part % 4 = 0 THEN '1.x' ELSE ' ' END AS features FROM sample),
h AS (SELECT *, CASE WHEN trim(features) = '' THEN CASE {" ".join(f"WHEN ends_with(name, '{w}') AND length(name) > {len(w)} THEN '{w}'" for w in C.TRAILING_FEATURES)} END END AS hit FROM n)
SELECT doc, pos, CASE WHEN hit IS NULL THEN name ELSE trim(substr(name, 1, length(name) - length(hit))) END AS name, coalesce(hit, features) AS features FROM h""",
)
add(
    "extraction_summary",
    lambda s, d: N.extraction_summary(sample(s, d).withColumn("kind", pick(("front", "body", "back"), (F.col("part") % 3).cast("int"))), sample(s, d).where("level < 3").select("doc", (F.col("part") % 4).alias("table_no")), sample(s, d).where("level = 4")),
    f"""WITH {_S} SELECT doc, count(*) AS entries, max(level) AS max_level, count(*) FILTER (part % 3 = 0) AS front, count(*) FILTER (part % 3 = 1) AS body, count(*) FILTER (part % 3 = 2) AS back, count(DISTINCT part % 4) FILTER (level < 3) AS tables, count(*) FILTER (level = 4) AS rows FROM sample GROUP BY 1""",
)


def repaired(spark, sf_dir):
    entry = lambda n, t: F.struct(F.lit(n).alias("n"), F.concat(F.lit(t), F.col("part").cast("string")).alias("text"))
    empty = F.array().cast("array<struct<n:int,text:string>>")
    rows = sample(spark, sf_dir).select(
        "doc", "pos", F.col("part").alias("row_id"), F.col("level").cast("string").alias("family"), F.when(F.col("part") % 2 == 0, "m2").otherwise("").alias("unit"),
        F.when(F.col("part") % 3 == 0, F.array(entry(1, "a"), entry(2, "b"))).when(F.col("part") % 3 == 1, F.array(entry(2, "c"))).otherwise(empty).alias("entries"),
        pick(("按体积计算", "", "说明", "按展开面积计算"), (F.col("part") % 4).cast("int")).alias("rule"),
    )
    return N.repair_rows(rows)


add(
    "repair_rows",
    repaired,
    f"""WITH {_S}, r AS (SELECT doc, pos, part, level, CASE WHEN part % 2 = 0 THEN 'm2' ELSE '' END AS unit, {sql_pick(("按体积计算", "", "说明", "按展开面积计算"), 'part % 4')} AS rule, row_number() OVER (PARTITION BY doc ORDER BY pos) AS k FROM sample),
e AS (SELECT doc, k, 1 AS n, 'a' || part AS text FROM r WHERE part % 3 = 0 UNION ALL SELECT doc, k, 2, 'b' || part FROM r WHERE part % 3 = 0 UNION ALL SELECT doc, k, 2, 'c' || part FROM r WHERE part % 3 = 1),
near AS (SELECT a.doc, a.k, b.k AS nk, b.rule FROM r a JOIN r b ON a.doc = b.doc AND abs(a.k - b.k) <= 2 AND (a.k = b.k OR (a.level = b.level AND (a.unit = '' OR b.unit = '' OR a.unit = b.unit)))),
pool AS (SELECT x.doc, x.k, e.n, e.text, row_number() OVER (PARTITION BY x.doc, x.k, e.n ORDER BY (x.k <> x.nk)::INT, x.nk) AS first FROM near x JOIN e ON e.doc = x.doc AND e.k = x.nk),
m AS (SELECT doc, k, string_agg(n || '.' || text, chr(10) ORDER BY n) AS merged FROM pool WHERE first = 1 GROUP BY 1, 2),
br AS (SELECT doc, k, rule AS best FROM (SELECT *, row_number() OVER (PARTITION BY doc, k ORDER BY length(rule) DESC, nk) AS f FROM near WHERE contains(rule, '体积') OR contains(rule, '面积')) WHERE f = 1)
SELECT r.doc, r.pos, r.part AS row_id, CASE WHEN part % 3 = 0 THEN '1.a' || part || chr(10) || '2.b' || part ELSE coalesce(merged, '') END AS features,
CASE WHEN rule = '' THEN coalesce(best, '') WHEN rule = '说明' AND best IS NOT NULL THEN best || chr(10) || rule ELSE rule END AS rule FROM r LEFT JOIN m USING (doc, k) LEFT JOIN br USING (doc, k)""",
)


def paragraphs(spark, sf_dir):
    return N.rule_paragraphs(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text"), r"^(The|La|Die|\d)", ("license", "token", "with"))


_PAR = r"""l AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
p AS (SELECT *, sum(regexp_matches(line, '^(The|La|Die|\d)')::INT) OVER (PARTITION BY doc ORDER BY pos) AS part FROM l),
g AS (SELECT doc, part, string_agg(trim(line), ' ' ORDER BY pos) AS paragraph, min(pos) AS pos FROM p GROUP BY 1, 2),
par AS (SELECT doc, paragraph, min(pos) AS pos FROM g WHERE contains(lower(paragraph), 'license') OR contains(lower(paragraph), 'token') OR contains(lower(paragraph), 'with') GROUP BY 1, 2)"""
add("rule_paragraphs", lambda s, d: paragraphs(s, d).select("doc", "pos", F.md5(F.col("paragraph").cast("binary")).alias("digest")), f"WITH {_PAR} SELECT doc, pos, md5(paragraph) AS digest FROM par")
