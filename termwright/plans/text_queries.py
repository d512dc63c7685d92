"""Queries of the column expressions: each applies one to every row of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X
from termwright.plans import sqltext as S
from termwright.sources.tables import BILL_ROWS, bill_rows, table

QUERIES, ORACLE_SQL = {}, {}


def _on_rows(name, spark_expr, sql_expr):
    def query(spark, sf_dir):
        return bill_rows(spark, sf_dir).select("row_id", spark_expr().alias("value"))

    QUERIES[name] = query
    ORACLE_SQL[name] = f"WITH {BILL_ROWS} SELECT row_id, {sql_expr} AS value FROM bill_rows"


def _on_table(name, source, key, spark_expr, sql_expr):
    def query(spark, sf_dir):
        return table(spark, sf_dir, source).select(key, spark_expr().alias("value"))

    QUERIES[name] = query
    ORACLE_SQL[name] = f"SELECT {key}, {sql_expr} AS value FROM {source}"


_on_rows("normalize_text", lambda: X.normalize_text(F.col("name")), S.normalize("name"))
_on_rows("normalize_search_text", lambda: X.normalize_search_text(F.concat("name", F.lit(" - "), "chapter")), S.search("name || ' - ' || chapter"))
_on_rows("normalize_unit", lambda: X.normalize_unit(F.col("unit")), S.unit("unit"))
_on_rows("strip_affixes", lambda: X.strip_affixes(F.col("name")), S.strip("name"))
_on_table("clean_text", "documents", "doc_id", lambda: F.md5(X.clean_lines(F.col("text")).cast("binary")), f"md5(array_to_string({S.lines('text')}, chr(10)))")
_on_rows(
    "clean_features",
    lambda: X.clean_features(F.col("features")),
    "'1.厚度:' || regexp_extract(features, '([0-9]+)mm', 1) || 'mm' || chr(10) || '2.强度等级大于等于C30' || chr(10) || '4.3.' || split_part(chapter, ' > ', 2)",
)
_on_rows("table_identity", lambda: F.concat_ws("|", X.table_title(F.concat(F.lit("续表 E.2."), F.col("row_id").cast("string"), F.lit("  "), "name")), X.table_id(F.concat(F.lit("续表 E.2."), F.col("row_id").cast("string"), F.lit("  "), "name"))), "'表E.2.' || row_id || regexp_replace(" + S.clean("name") + ", '\\s+', '', 'g') || '|E.2.' || row_id")
_on_rows("classify_family", lambda: X.classify_family(F.col("name")), S.family("name"))
_on_table(
    "classify_title",
    "documents",
    "doc_id",
    lambda: F.when(F.col("text").rlike("(?i)preface|contents|^the and"), "front").when(F.col("text").rlike("(?i)license|appendix|index"), "back").otherwise("body"),
    "CASE WHEN regexp_matches(text, '(?i)preface|contents|^the and') THEN 'front' WHEN regexp_matches(text, '(?i)license|appendix|index') THEN 'back' ELSE 'body' END",
)
_on_table(
    "nullish_to_null",
    "events",
    "event_id",
    lambda: X.nullish_to_null(F.when(F.col("event_id") % 3 == 0, " N/A ").when(F.col("event_id") % 3 == 1, "未匹配").otherwise(F.col("event_type"))),
    "CASE WHEN event_id % 3 = 2 AND lower(trim(event_type)) NOT IN (" + ", ".join(S.quoted(w) for w in C.NULL_WORDS) + ") THEN trim(event_type) END",
)
_on_table("string_list", "part", "p_partkey", lambda: F.array_join(X.string_list(F.concat_ws("、", "p_name", "p_type", "p_name", F.lit(" "), "p_brand")), "|"), f"array_to_string({S.string_list(chr(39).join(['p_name || ', '、', ' || p_type || ', '、', ' || p_name || ', '、 、', ' || p_brand']))}, '|')")
_on_rows("section_root", lambda: X.section_root(F.col("chapter")), "trim(split_part(chapter, ' > ', 1))")
_on_rows("stable_key", lambda: X.stable_key(F.col("row_id"), F.col("name"), F.col("chapter")), S.key("row_id", "name", "chapter"))
_on_rows(
    "slugify",
    lambda: X.slugify(F.concat("chapter", F.lit("/"), "name")),
    "coalesce(nullif(substr(regexp_replace(regexp_replace(trim(chapter || '/' || name), '[\\\\/:*?\"<>|\\s]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), 1, 96), ''), 'item')",
)
_SHORT = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"
_on_table("shorten", "documents", "doc_id", lambda: X.shorten(F.col("text"), 320), f"CASE WHEN length({_SHORT}) > 320 THEN rtrim(substr({_SHORT}, 1, 319)) || '…' ELSE {_SHORT} END")
_on_table(
    "excerpt",
    "documents",
    "doc_id",
    lambda: X.excerpt(F.col("text"), F.array(F.lit("license"), F.lit("token"), F.col("source"))),
    f"substr({_SHORT}, greatest(1, coalesce(list_min(list_filter([position(t IN lower({_SHORT})) FOR t IN ['license', 'token', source]], lambda h: h > 0)), 1) - 65), 260)",
)
_verb = "CASE " + " ".join(f"WHEN starts_with(n, '{v}') AND length(n) > {len(v)} THEN substr(n, {len(v) + 1})" for v in C.VERB_PREFIXES) + " ELSE n END"
_cuts = ", ".join(f"CASE WHEN starts_with(v, '{m}') AND length(v) > {len(m)} THEN substr(v, {len(m) + 1}) END" for m in C.MODIFIERS)
QUERIES["core_tokens"] = lambda spark, sf_dir: bill_rows(spark, sf_dir).select("row_id", F.array_join(X.core_tokens(F.col("name")), "|").alias("value"))
ORACLE_SQL["core_tokens"] = f"""WITH {BILL_ROWS}, a AS (SELECT row_id, {S.normalize('name')} AS n FROM bill_rows), b AS (SELECT row_id, {_verb} AS v FROM a)
SELECT row_id, array_to_string(list_filter([v, {_cuts}], lambda x: x IS NOT NULL AND x <> ''), '|') AS value FROM b"""
_on_table(
    "clamp_confidence",
    "events",
    "event_id",
    lambda: X.clamp_confidence(F.when(F.col("event_id") % 5 == 0, F.lit("bad")).otherwise((F.col("value") / 50).cast("string"))),
    "CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, coalesce(value / 50, 0.0))) END",
)
_VALUES, _SAMPLES = (None, "", "12", "+1.5", "x", "1."), ("", "12", "a1", "-3.25")
_NAMED, _LINKED = ("墙厚", "截面类型", "厚度做法", "备注", "数量", "plain", "标高", "模板面积"), ("", "m2")
_NAMES = "[" + ", ".join(f"'{x}'" for x in _NAMED) + "]"
_VALUE = "[" + ", ".join("NULL" if x is None else f"'{x}'" for x in _VALUES) + "]"
_at = lambda options, by: F.get(F.array(*[F.lit(x).cast("string") for x in options]), (F.floor(F.col("p_partkey") / by) % len(options)).cast("int"))
_on_table(
    # Every combination of values, samples, names and units, and the parts' own sizes and names.
    "infer_value_type",
    "part",
    "p_partkey",
    lambda: X.infer_value_type(F.array(_at(_VALUES, 1), F.when(F.col("p_size") % 5 == 0, F.col("p_size").cast("string"))), F.when(F.col("p_partkey") % 2 == 0, _at(_SAMPLES, 6)), F.concat("p_name", _at(_NAMED, 24)), _at(_LINKED, 192)),
    f"""(SELECT CASE WHEN len(vs) > 0 THEN CASE WHEN len(list_filter(vs, lambda v: NOT regexp_full_match(trim(v), '[+-]?\\d+(\\.\\d+)?'))) = 0 THEN 'number' ELSE 'text' END
WHEN p_partkey % 2 = 0 AND ['', '12', 'a1', '-3.25'][1 + p_partkey // 6 % 4] IN ('12', '-3.25') THEN 'number' WHEN regexp_matches(nm, '{"|".join(C.TEXT_NAME_HINTS)}') THEN 'text' WHEN p_partkey // 192 % 2 = 1 THEN 'number' WHEN regexp_matches(nm, '{"|".join(C.NUMBER_NAME_HINTS)}') THEN 'number' ELSE 'text' END
FROM (SELECT list_filter([{_VALUE}[1 + p_partkey % 6], CASE WHEN p_size % 5 = 0 THEN CAST(p_size AS VARCHAR) END], lambda v: coalesce(v, '') <> '') AS vs, p_name || {_NAMES}[1 + p_partkey // 24 % 8] AS nm))""",
)
_on_table(
    "extract_title",
    "documents",
    "doc_id",
    lambda: X.extract_title(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\n# Part "), "source", F.lit("\n"), "text")).otherwise(F.col("text")), F.col("source")),
    "CASE WHEN doc_id % 2 = 0 THEN 'Part ' || source ELSE substr(coalesce(nullif(trim(regexp_extract(text, '(?m)^[ \\t]*(\\S[^\\n]*)$', 1)), ''), source), 1, 160) END",
)


def _page():
    """A document as a page: its lines in sections of changing levels, some with front matter."""
    k = F.col("doc_id")
    mark = F.when(k % 2 == 0, "##").otherwise("###")
    front = F.when(k % 3 == 0, "---\nfacts: ## Facts\n---\n").otherwise("")
    tail = F.when(k % 5 == 0, "\n#### Deep\nd").when(k % 5 == 1, "\n### Next\nn").otherwise("\n## More\nx")
    return F.concat(front, F.lit("# A\n**Names**: a, b\n"), mark, F.lit(" Facts \n| h |\n| "), F.col("source"), F.lit(" |\n"), F.regexp_replace("text", "[#|]", ""), tail)


_PAGE = "CASE WHEN doc_id % 3 = 0 THEN '---' || chr(10) || 'facts: ## Facts' || chr(10) || '---' || chr(10) ELSE '' END || '# A' || chr(10) || '**Names**: a, b' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '##' ELSE '###' END || ' Facts ' || chr(10) || '| h |' || chr(10) || '| ' || source || ' |' || chr(10) || regexp_replace(text, '[#|]', '', 'g') || CASE doc_id % 5 WHEN 0 THEN chr(10) || '#### Deep' || chr(10) || 'd' WHEN 1 THEN chr(10) || '### Next' || chr(10) || 'n' ELSE chr(10) || '## More' || chr(10) || 'x' END"
_SECTION = f"""WITH p AS (SELECT doc_id, source, {_PAGE} AS page FROM documents),
l AS (SELECT doc_id, source, string_split(CASE WHEN starts_with(page, '---') THEN regexp_replace(page, '(?s)^---.*?---', '') ELSE page END, chr(10)) AS ls FROM p),
i AS (SELECT *, list_position(list_transform(ls, lambda x: regexp_matches(x, '^#{{2,3}}\\s+Facts\\s*$')), true) AS i FROM l),
r AS (SELECT *, length(regexp_extract(ls[i], '^#+')) AS level, ls[i + 1:] AS rest FROM i),
j AS (SELECT *, coalesce(list_position(list_transform(rest, lambda x: regexp_matches(x, '^#{{1,3}}\\s') AND length(regexp_extract(x, '^#+')) <= level), true), 0) AS j FROM r),
s AS (SELECT doc_id, source, regexp_replace(array_to_string(CASE WHEN j > 0 THEN rest[1:j - 1] ELSE rest END, chr(10)), '^\\s+|\\s+$', '', 'g') AS section FROM j)"""
QUERIES["extract_section"] = lambda spark, sf_dir: table(spark, sf_dir, "documents").select("doc_id", F.md5(X.extract_section(_page(), "Facts").cast("binary")).alias("section"))
ORACLE_SQL["extract_section"] = f"{_SECTION} SELECT doc_id, md5(section) AS section FROM s"
QUERIES["page_summary"] = lambda spark, sf_dir: table(spark, sf_dir, "documents").select("doc_id", X.page_summary(_page(), {"Facts": 2, "None": 3}, ("Names", "Other"), 40).alias("summary"))
ORACLE_SQL["page_summary"] = "SELECT doc_id, CASE WHEN length(t) <= 40 THEN t ELSE regexp_replace(substr(t, 1, 40), '\\n[^\\n]*$', '') || chr(10) || '…' END AS summary FROM (SELECT doc_id, 'Facts: | h | | ' || source || ' |' || chr(10) || 'Names: a, b' AS t FROM documents)"
_on_table("repair_codes", "orders", "o_orderkey", lambda: X.repair_code(F.concat(F.lit("OIl"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), F.lit(" x"))), "'011' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0')")
