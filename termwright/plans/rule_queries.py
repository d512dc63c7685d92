"""Queries of the rules in prose: each part is a region of its brand's chapter, whose lines have every form of clause."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X
from termwright.operators import matching as M
from termwright.operators import rules as R
from termwright.plans import sqltext as S
from termwright.sources.tables import BILL_ROWS, bill_rows, table

QUERIES, ORACLE_SQL = {}, {}


def add(name, query, sql):
    QUERIES[name], ORACLE_SQL[name] = query, sql


#: Lines of regions: {a}, {b} are words of a part's name, {t} a word of its type, {k} its size.
_LINES = (
    'E.1.{k} {a}、各种{b}及"{t} "应按本附录中{t}相关项目编码列项。',
    "{b} 不增加相应工程量",
    "F,{k} {a}包括{b}项目、面积≤0.3m2的{t}和墙项目，其他洞。",
    'A.2 {a}的"{b}"可描述为{t}、"{a}{k}"或{b}；其余。',
    'B3 本标准中的{a}应在项目特征中增加"{b}"、“{t}”描述',
    "G.1.{k} {a}工程量按设计图示体积计算，{b}并入{t}面积内|第{k}层",
    "H2 模板按接触面积计算；{a}模板项目按本标准{t}项目列项",
    "J.1 plain {a}",
    "K . 7 “{a}项目”中的{b}按中心线长度或净长计算",
    "L.1 工作内容包括{a}",
    '• M.1 {a}、{b}按"{t}"、" "项目列项  ',
    "{a}适用于{b}",
    "N.{k} {a}适用于{b}数量",
    "",
)


def _line(index, part: str):
    """A line of :data:`_LINES` with the words of a part."""
    words = {"a": F.split_part("p_name", F.lit(" "), F.lit(1)), "b": F.split_part("p_name", F.lit(" "), F.lit(2)), "t": F.split_part("p_type", F.lit(" "), F.lit(1)), "k": F.col("p_size").cast("string")}
    line = F.get(F.array(*map(F.lit, _LINES)), index)
    for k, w in words.items():
        line = F.replace(line, F.lit("{" + k + "}"), w)
    return line


def regions(spark, sf_dir):
    at = lambda step: ((F.col("p_partkey") * step) % len(_LINES)).cast("int")
    text = F.array_join(F.array(*[_line(at(step), "p_partkey") for step in (1, 3, 5, 11)]), "\n")
    return table(spark, sf_dir, "part").select(F.concat(F.col("p_brand"), F.lit(" > "), F.split_part("p_type", F.lit(" "), F.lit(1))).alias("path"), F.col("p_partkey").alias("pos"), text.alias("text"))


def _sql_line(step: int) -> str:
    own = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in _LINES) + f"][1 + (p_partkey * {step}) % {len(_LINES)}]"
    for k, w in {"a": "split_part(p_name, ' ', 1)", "b": "split_part(p_name, ' ', 2)", "t": "split_part(p_type, ' ', 1)", "k": "CAST(p_size AS VARCHAR)"}.items():
        own = f"replace({own}, '{{{k}}}', {w})"
    return own


_strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
_number = lambda x: _strip(f"regexp_replace({_strip(x)}, '{C.RULE_MARK}\\s*', '')")
_clean = lambda x: _strip(f"regexp_replace(regexp_replace({S.replaced(x, C.PARAGRAPH_REPLACEMENTS)}, '[ \\t]+', ' ', 'g'), '\\n+', chr(10), 'g')")
_any = lambda x, words: "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"
_out = lambda x, words: S.replaced(x, [(w, "") for w in words])
_EDGES = C.TERM_EDGES
_quoted = lambda x: f"list_transform(list_filter(regexp_extract_all({x}, '\"([^\"]+)\"', 1), lambda q: {_strip('q')} <> ''), lambda q: {_strip(f'''trim(q, '{_EDGES}')''')})"
_in = lambda x, words: f"{x} IN (" + ", ".join(f"'{w}'" for w in words) + ")"
_codes = lambda x: "list_filter([" + ", ".join([f"CASE WHEN contains({x}, '{C.FORMWORK}') AND {_any(x, C.FORMWORK_WORDS)} THEN '{C.FORMWORK_CODE}' END", *[f"CASE WHEN {_any(x, words)} THEN '{code}' END" for code, words in C.RULE_CODES]]) + "], lambda y: y IS NOT NULL)"
_trimmed = lambda x: f"regexp_replace(regexp_replace(regexp_replace({_number(x)}, '{C.SCOPE_SIZE}', '', 'g'), '{C.SCOPE_LEADS}', ''), '{C.SCOPE_TAILS}', '')"
_edged = lambda x: f"trim({_out(_trimmed(x), C.SCOPE_DROPPED)}, '{_EDGES}\"''')"
_ended = lambda v: f"{_strip(f'''CASE WHEN ends_with({v}, '项目') AND (length({v}) >= 4 OR {_in(f'substr({v}, 1, length({v}) - 2)', C.SHORT_TERMS)}) THEN substr({v}, 1, length({v}) - 2) ELSE {v} END''')}"
_useful = lambda v: f"({v} <> '' AND (length({v}) >= 2 OR {_in(v, C.SHORT_TERMS)}) AND NOT {_in(v, C.SCOPE_STOP_WORDS)} AND regexp_matches({v}, '[一-鿿A-Za-z0-9]'))"
_got = lambda form, k: f"regexp_extract(c, '{form}', {k})"

_PARAGRAPHS = f"""reg AS (SELECT p_brand || ' > ' || split_part(p_type, ' ', 1) AS path, p_partkey AS pos, {" || chr(10) || ".join(_sql_line(s) for s in (1, 3, 5, 11))} AS text FROM part),
cl AS (SELECT path, pos, string_split({_clean('text')}, chr(10)) AS ls FROM reg),
li AS (SELECT path, pos, generate_subscripts(ls, 1) AS k, {_strip('unnest(ls)')} AS line FROM cl),
pa AS (SELECT *, sum(regexp_matches(line, '{C.RULE_MARK}')::INT) OVER (PARTITION BY path, pos ORDER BY k) AS part FROM li WHERE line <> ''),
wh AS (SELECT path, pos, part, string_agg(line, ' ' ORDER BY k) AS paragraph FROM pa WHERE part > 0 GROUP BY 1, 2, 3),
paragraphs AS (SELECT path, pos, part, paragraph FROM (SELECT *, row_number() OVER (PARTITION BY path, {_number('paragraph')} ORDER BY pos, part) AS nth FROM wh WHERE {_any('paragraph', C.RULE_TRIGGERS)}) WHERE nth = 1)"""

#: (list, order, condition, phrase): what is cut into scope terms.
_SCOPES = (
    ("scope", 1, "true", _got(C.ROUTE_FORM, 1)),
    ("scope", 2, "includes", _got(C.INCLUDE_FORM, 2)),
    ("scope", 3, f"described AND NOT contains({_got(C.DESCRIBED_FORM, 1)}, '{C.DESCRIBED_NOT}')", _got(C.DESCRIBED_FORM, 1)),
    ("scope", 4, "true", _got(C.ADDED_FORM, 1)),
    ("scope", 5, "counted", _got(C.CALCULATED_FORM, 1)),
    ("scope", 6, "counted", _got(C.MERGED_FORM, 1)),
    ("example", 1, "described", f"regexp_split_to_array(substr(c, strpos(c, '{C.DESCRIBED}') + 4), '[。；;]')[1]"),
)
_RULES = f"""{_PARAGRAPHS},
co AS (SELECT path, pos, part, {_number(_clean('paragraph'))} AS c FROM paragraphs),
r0 AS (SELECT *, row_number() OVER (ORDER BY path, pos, part) AS id, {_quoted('c')} AS quoted, {_codes('c')} AS codes, {_edged(_got(C.INCLUDE_FORM, 1))} AS t0 FROM co WHERE {_any('c', C.RULE_TRIGGERS)}),
r1 AS (SELECT *, list_filter(quoted, lambda q: q <> '') AS qs, {_ended('t0')} AS target FROM r0),
ru AS (SELECT *, {_got(C.ROUTE_FORM, 1)} <> '' AS route, {_got(C.ADDED_FORM, 1)} <> '' AS added, {_got(C.INCLUDE_FORM, 1)} <> '' AND NOT contains({_got(C.INCLUDE_FORM, 1)}, '{C.INCLUDE_NOT}') AND {_useful('target')} AS includes,
  contains(c, '{C.DESCRIBED}') AND len(qs) > 0 AS described, len(codes) > 0 OR {_any('c', C.CALCULATED_WORDS)} AS counted FROM r1),
ph AS ({" UNION ALL ".join(f"SELECT id, '{k}' AS list, {o} AS o, {_clean(p)} AS v FROM ru WHERE {t}" for k, o, t, p in _SCOPES)}),
te AS (SELECT id, list, o * 1000 + generate_subscripts(q, 1) AS o, unnest(q) AS t FROM (SELECT *, {_quoted('v')} AS q FROM ph)
  UNION ALL SELECT id, list, o * 1000 + 500 + generate_subscripts(s, 1), unnest(s) FROM (SELECT *, regexp_split_to_array(regexp_replace(v, '"[^"]+"', ' ', 'g'), '{C.SCOPE_BREAKS}') AS s FROM ph)),
ed AS (SELECT id, list, o, {_edged('t')} AS v FROM te), en AS (SELECT id, list, o, {_ended('v')} AS t FROM ed),
own AS (SELECT id, list, t, min(o) AS o FROM en WHERE {_useful('t')} GROUP BY 1, 2, 3
  UNION ALL SELECT id, list, t, min(o) FROM (
    SELECT id, 'target' AS list, unnest(CASE WHEN len(q) > 0 THEN q ELSE [{_strip(f'''trim({_out(f"regexp_replace({_number('p')}, '{C.TARGET_LEAD}', '')", C.TARGET_DROPPED)}, '{_EDGES}')''')}] END) AS t, generate_subscripts(CASE WHEN len(q) > 0 THEN q ELSE [''] END, 1) AS o FROM (SELECT id, {_got(C.ROUTE_FORM, 2)} AS p, list_filter({_quoted(_got(C.ROUTE_FORM, 2))}, lambda q: q <> '') AS q FROM ru WHERE route)
    UNION ALL SELECT id, 'target', target, 1000 FROM ru WHERE includes
    UNION ALL SELECT id, 'feature', unnest(qs[1:{C.FEATURE_NAMES}]), generate_subscripts(qs[1:{C.FEATURE_NAMES}], 1) FROM ru WHERE described
    UNION ALL SELECT id, 'feature', unnest(q), 1000 + generate_subscripts(q, 1) FROM (SELECT id, {_quoted(_got(C.ADDED_FORM, 2))} AS q FROM ru WHERE added)) WHERE t <> '' GROUP BY 1, 2, 3),
li2 AS (SELECT id, list(t ORDER BY o) FILTER (list = 'scope') AS scope, list(t ORDER BY o) FILTER (list = 'target') AS targets, list(t ORDER BY o) FILTER (list = 'feature') AS feats, (list(t ORDER BY o) FILTER (list = 'example'))[1:{C.FEATURE_EXAMPLES}] AS examples FROM own GROUP BY 1),
rules AS (SELECT path, split_part(path, ' > ', 1) AS chapter, pos, part, c AS content, {S.key('path', 'c')} AS rule_id, list_filter([CASE WHEN route OR includes THEN 'component_route' END, CASE WHEN described OR added THEN 'feature_hint' END, CASE WHEN counted THEN 'calculation_hint' END], lambda y: y IS NOT NULL) AS types,
  coalesce(scope, []) AS scope, coalesce(targets, []) AS targets, coalesce(feats, []) AS feats, coalesce(examples, []) AS examples, codes, list_filter([{", ".join(f"'{w}'" for w in C.RULE_KEYWORDS)}], lambda w: contains(c, w)) AS words
  FROM ru LEFT JOIN li2 USING (id) WHERE route OR includes OR described OR added OR counted)"""

add("chapter_paragraphs", lambda s, d: R.chapter_paragraphs(regions(s, d)).select("path", F.col("pos.region").alias("region"), F.col("pos.part").alias("part"), "paragraph"), f"WITH {_PARAGRAPHS} SELECT path, pos AS region, part, paragraph FROM paragraphs")
_JOINED = {"types": "types", "scope_terms": "scope", "target_terms": "targets", "feature_names": "feats", "feature_examples": "examples", "codes": "codes", "keywords": "words"}
add(
    "extract_rules",
    lambda s, d: R.chapter_rules(regions(s, d)).select("path", "chapter", "rule_id", F.col("pos.region").alias("region"), "content", *[F.array_join(c, "|").alias(c) for c in _JOINED]),
    f"WITH {_RULES} SELECT path, chapter, rule_id, pos AS region, content, {', '.join(f'''array_to_string({v}, '|') AS {k}''' for k, v in _JOINED.items())} FROM rules",
)
add(
    "calculation_codes",
    lambda s, d: regions(s, d).select("pos", F.array_join(R.calculation_codes(F.col("text")), "|").alias("codes")),
    f"WITH {_PARAGRAPHS} SELECT pos, array_to_string({_codes('text')}, '|') AS codes FROM reg",
)


def ruled(spark, sf_dir):
    """Parts as rows of the chapters, and the rules of these chapters' regions."""
    p = table(spark, sf_dir, "part")
    rows = bill_rows(spark, sf_dir).join(p.select(F.col("p_partkey").alias("row_id"), "p_brand", "p_type"), "row_id")
    rows = rows.select(F.col("p_brand").alias("chapter"), "row_id", "name", F.col("p_type").alias("features"), "rule", F.col("chapter").alias("path"), "unit")
    return rows, R.chapter_rules(regions(spark, sf_dir).where("pos % 4 = 0"))


_HITS = f"""{BILL_ROWS}, {_RULES.replace('FROM part)', 'FROM part WHERE p_partkey % 4 = 0)', 1)},
rw AS (SELECT p_brand AS chapter, row_id, {S.normalize("name || chr(10) || p_type || chr(10) || rule || chr(10) || chapter")} AS a, {S.normalize('p_type')} AS f FROM bill_rows JOIN part ON p_partkey = row_id),
m AS (SELECT row_id, rule_id, pos, part, feats, targets, codes, types, list_filter(scope, lambda x: {S.normalize('x')} <> '' AND contains(a, {S.normalize('x')})) AS s1, list_filter(feats, lambda x: {S.normalize('x')} <> '' AND contains(f, {S.normalize('x')})) AS s2, list_filter(words, lambda x: contains(a, {S.normalize('x')})) AS s3 FROM rw JOIN rules USING (chapter)),
h AS (SELECT *, least(98, CASE WHEN len(s1) > 0 THEN 55 ELSE 0 END + CASE WHEN len(s2) > 0 THEN 25 ELSE 0 END + 8 * len(s3) + CASE WHEN len(s1) + len(s2) + len(s3) > 0 THEN CASE WHEN list_contains(types, 'component_route') THEN 8 ELSE 0 END + CASE WHEN list_contains(types, 'feature_hint') THEN 4 ELSE 0 END + CASE WHEN list_contains(types, 'calculation_hint') THEN 4 ELSE 0 END ELSE 0 END) AS score FROM m),
hits AS (SELECT * FROM h WHERE score >= 30)"""
_FIRSTS = lambda x: f"array_to_string(list_filter({x}, lambda v, i: list_position({x}, v) = i), '|')"
add(
    "attach_rules",
    lambda s, d: R.attach_rules(*ruled(s, d)).select("row_id", "rule_id", "score", F.array_join("terms", "|").alias("terms"), "rank"),
    f"""WITH {_HITS}, k AS (SELECT *, list_concat(s1, s2, s3) AS ts, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, pos, part, rule_id) AS rank FROM hits)
SELECT row_id, rule_id, score::DOUBLE / 100.0::DOUBLE AS score, {_FIRSTS('ts')} AS terms, rank FROM k WHERE rank <= 8""",
)
_HINTS = f"{_HITS}, g AS (SELECT row_id, flatten(list(feats ORDER BY pos, part, rule_id)) AS fs, flatten(list(targets ORDER BY pos, part, rule_id)) AS ts, flatten(list(codes ORDER BY pos, part, rule_id)) AS cs FROM hits GROUP BY 1)"
add(
    "rule_hints",
    lambda s, d: R.rule_hints(*ruled(s, d)).select("row_id", *[F.array_join(c, "|").alias(c) for c in ("features", "targets", "codes")]),
    f"WITH {_HINTS} SELECT row_id, {_FIRSTS('fs')} AS features, {_FIRSTS('ts')} AS targets, {_FIRSTS('cs')} AS codes FROM g",
)

#: Units of which each kind is one, and one of none.
_UNITS = ("m3", "m2", "m", *C.COUNT_UNITS, "榀", "", "㎡")


def _priced(spark, sf_dir):
    """Rows of every kind of word and unit, with the codes of their chapters' rules."""
    rows, rules = ruled(spark, sf_dir)
    hints = R.rule_hints(rows, rules).select("row_id", F.col("codes").alias("chapter_codes"))
    n = len(_UNITS)
    unit = F.get(F.array(*map(F.lit, _UNITS)), (F.col("row_id") % n).cast("int"))
    # Every third row has no word of its own.
    plain = F.col("row_id") % 3 == 0
    bare = F.split_part("path", F.lit(" > "), F.lit(2))
    return rows.join(hints, "row_id", "left").select("row_id", F.when(plain, bare).otherwise(F.col("name")).alias("name"), F.when(plain, "").otherwise(F.col("rule")).alias("rule"), X.normalize_unit(unit).alias("unit"), bare.alias("component"), "chapter_codes")


_WORDED = " ".join(f"WHEN {_any('said', words)} THEN [{', '.join(map(repr, codes))}]" for words, codes, _ in C.PREFERRED_CODES)
_WORDS = " ".join(f"WHEN {_any('said', words)} THEN [{', '.join(map(repr, names))}]" for words, _, names in C.PREFERRED_CODES)
_count = f"u IN ({', '.join(map(repr, C.COUNT_UNITS))})"
_PREFER = f"""{_HINTS}, hi AS (SELECT row_id, list_filter(cs, lambda v, i: list_position(cs, v) = i) AS ch FROM g),
b0 AS (SELECT b.row_id, split_part(b.chapter, ' > ', 2) AS component, CASE WHEN b.row_id % 3 = 0 THEN split_part(b.chapter, ' > ', 2) ELSE name END AS name, CASE WHEN b.row_id % 3 = 0 THEN '' ELSE rule END AS rule, {S.unit("[" + ", ".join(map(repr, _UNITS)) + f"][1 + b.row_id % {len(_UNITS)}]")} AS u, ch FROM bill_rows b LEFT JOIN hi USING (row_id)),
b1 AS (SELECT *, name || chr(10) || rule AS said FROM b0),
prefer AS (SELECT *, CASE {_WORDED} WHEN len(ch) > 0 THEN ch {" ".join(f"WHEN u = '{u}' THEN [{', '.join(map(repr, codes))}]" for u, codes, _ in C.UNIT_CODES)} WHEN {_count} THEN ['SL'] ELSE [] END AS codes,
  CASE {_WORDS} WHEN len(ch) > 0 THEN ch {" ".join(f"WHEN u = '{u}' THEN [{', '.join(map(repr, names))}]" for u, _, names in C.UNIT_CODES)} WHEN {_count} THEN ['数量'] ELSE [] END AS words FROM b1)"""
add(
    "calculation_preference",
    lambda s, d: _priced(s, d).select("row_id", F.array_join(M.calculation_preference(F.col("name"), F.col("rule"), F.col("unit"), F.col("chapter_codes")), "|").alias("codes")),
    f"WITH {_PREFER} SELECT row_id, array_to_string(codes, '|') AS codes FROM prefer",
)
_CALCULATIONS = (("ZTJ", "总体积", "m3"), ("MJ", "净面积", "m2"), ("MBMJ", "模板面积", "m2"), ("GS", "SL 个数", "个"), ("YCD", "外长度", "m"))


def select_calculation(spark, sf_dir):
    items = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("calc_code"), F.lit(n).alias("calc_name"), F.lit(u).alias("calc_unit")) for i, (c, n, u) in enumerate(_CALCULATIONS)])
    calculations = table(spark, sf_dir, "part").where("p_type not like 'PROMO%'").select(F.col("p_type").alias("component")).distinct().select("component", F.inline(items))
    return M.select_calculation(_priced(spark, sf_dir), calculations)


add(
    "select_calculation",
    select_calculation,
    f"""WITH {_PREFER}, c(pos, calc_code, calc_name, calc_unit) AS (VALUES {", ".join(f"({i}, '{c}', '{n}', '{u}')" for i, (c, n, u) in enumerate(_CALCULATIONS))}),
s AS (SELECT r.row_id, c.*, round(CASE WHEN list_position(codes, calc_code) > 0 THEN 0.7 - (list_position(codes, calc_code) - 1) * 0.05 ELSE 0 END + CASE WHEN u <> '' AND u = calc_unit THEN 0.25 ELSE 0 END
  + CASE WHEN len(list_filter(words, lambda w: contains(calc_name, w))) > 0 THEN 0.2 ELSE 0 END + CASE WHEN contains(name, '模板') AND contains(calc_name, '模板') THEN 0.25 ELSE 0 END, 4) AS score FROM prefer r, c WHERE component NOT LIKE 'PROMO%'),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, pos) AS k FROM s WHERE score >= 0.25) WHERE k = 1),
gn AS (SELECT r.*, list_filter(codes, lambda x: x IN ('TJ', 'MJ', 'CD', 'SL'))[1] AS generic FROM prefer r)
SELECT gn.row_id, gn.component, coalesce(calc_code, generic, '') AS calc_code, coalesce(calc_name, CASE generic WHEN 'TJ' THEN '体积' WHEN 'MJ' THEN '面积' WHEN 'CD' THEN '长度' WHEN 'SL' THEN '数量' END, '') AS calc_name,
  CASE WHEN u <> '' THEN u ELSE coalesce(calc_unit, CASE generic WHEN 'TJ' THEN 'm3' WHEN 'MJ' THEN 'm2' WHEN 'CD' THEN 'm' END, '') END AS unit
FROM gn LEFT JOIN b USING (row_id)""",
)
