"""Queries of the matching operators, on parts as bill rows and part names as the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X
from termwright.operators import direct as D
from termwright.operators import matching as M
from termwright.plans import sqltext as S
from termwright.plans.source_queries import folder
from termwright.sources.tables import BILL_ROWS, bill_rows, pick, sql_pick, table

QUERIES, ORACLE_SQL = {}, {}


def catalog(spark, sf_dir):
    """Part names as components, in alphabetical order, with the names and units they go by."""
    p = table(spark, sf_dir, "part").where("p_name is not null")
    n = F.col("p_name")
    base = p.groupBy(F.concat(n, F.lit("梁")).alias("component")).agg(F.min("p_partkey").alias("pos"), F.min("p_size").alias("size"))
    return base.select("component", "pos", F.array(F.col("component"), F.concat(F.lit("现浇"), X.normalize_text(F.col("component")))).alias("names"), F.array(F.when(F.col("size") % 2 == 0, "m2").otherwise("m3")).alias("units"))


_CATALOG = f"""
base AS (SELECT p_name || '梁' AS component, min(p_partkey) AS pos, min(p_size) AS size FROM part WHERE p_name IS NOT NULL GROUP BY 1),
catalog AS (SELECT component, pos, component AS name1, '现浇' || {S.normalize('component')} AS name2, CASE WHEN size % 2 = 0 THEN 'm2' ELSE 'm3' END AS unit FROM base)"""


def index(spark, sf_dir):
    """The alias index of every second component."""
    some = catalog(spark, sf_dir).where("pos % 2 = 0").select("component", "pos")
    return M.alias_index(M.component_aliases(some))


_SPECIAL = ", ".join(f"('{k}', '{c}', {i})" for i, (k, c) in enumerate((k, c) for k, cs in C.SPECIAL_ITEMS.items() for c in cs))
_ALIASES = f"""
named AS (SELECT component, pos, unnest([component, {S.strip('component')}, replace(component, '砼', '混凝土'), replace(component, '混凝土', '砼'), {S.normalize('component')}]) AS alias FROM catalog WHERE pos % 2 = 0),
keyed AS (
  SELECT {S.normalize('alias')} AS key, component, 0 AS priority, pos FROM named
  UNION ALL SELECT {S.normalize(S.strip('alias'))}, component, 0, pos FROM named
  UNION ALL SELECT {S.normalize('item')}, component, 2, pos FROM (VALUES {_SPECIAL}) t(item, component, pos)
), idx AS (SELECT key, component, min(priority) AS priority, arg_min(pos, priority * 1000000000 + pos) AS pos FROM keyed WHERE key <> '' GROUP BY key, component)"""

QUERIES["component_aliases"] = lambda spark, sf_dir: M.component_aliases(catalog(spark, sf_dir).select(F.concat(F.lit("预制砼"), "component").alias("component"))).select("component", "alias")
ORACLE_SQL["component_aliases"] = f"""WITH {_CATALOG}, c AS (SELECT '预制砼' || component AS component FROM catalog)
SELECT DISTINCT component, unnest([component, {S.strip('component')}, replace(component, '砼', '混凝土'), {S.normalize('component')}]) AS alias FROM c"""

QUERIES["alias_index"] = lambda spark, sf_dir: index(spark, sf_dir)
ORACLE_SQL["alias_index"] = f"WITH {_CATALOG}, {_ALIASES} SELECT key, component, priority, pos FROM idx"



def aliased_rows(spark, sf_dir):
    """Rows named by a component, with affixes, brackets or neither."""
    p = table(spark, sf_dir, "part")
    lead, tail = pick(("现浇", "", "(", "预制"), (F.col("p_partkey") % 4).cast("int")), pick(("梁", "梁构件", "梁)", "梁", "墙"), (F.col("p_partkey") % 5).cast("int"))
    return p.select(F.col("p_partkey").alias("row_id"), F.concat(lead, "p_name", tail).alias("name"))


QUERIES["alias_candidates"] = lambda spark, sf_dir: M.alias_candidates(aliased_rows(spark, sf_dir), index(spark, sf_dir))
ORACLE_SQL["alias_candidates"] = f"""WITH {_CATALOG}, {_ALIASES}, r AS (SELECT p_partkey AS row_id, {sql_pick(("现浇", "", "(", "预制"), 'p_partkey % 4')} || p_name || {sql_pick(("梁", "梁构件", "梁)", "梁", "墙"), 'p_partkey % 5')} AS name FROM part)
SELECT DISTINCT row_id, component FROM r JOIN idx ON key IN ({S.normalize('name')}, {S.normalize(S.strip('name'))})"""

_VERB = "CASE " + " ".join(f"WHEN starts_with(q, '{v}') AND length(q) > {len(v)} THEN substr(q, {len(v) + 1})" for v in C.VERB_PREFIXES) + " ELSE q END"
_CUTS = ", ".join(f"CASE WHEN starts_with(v, '{m}') AND length(v) > {len(m)} THEN substr(v, {len(m) + 1}) END" for m in C.MODIFIERS)


def _jaccard(a: str, b: str) -> str:
    a, b = (f"list_distinct(string_split({x}, ''))" for x in (a, b))
    return f"(len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::DOUBLE)"


def _step(k: int) -> str:
    n, s = f"n{k}", f"s{k}"
    cases = (
        (f"done{k - 1} OR {n} = ''", f"score{k - 1}", f"basis{k - 1}", f"done{k - 1}"),
        (f"q = {n}", "1.0", "'exact'", "true"),
        (f"(s <> '' AND s = {n}) OR ({s} <> '' AND q = {s})", f"greatest(score{k - 1}, 0.95)", "'normalized'", "false"),
        (f"q <> '' AND (contains({n}, q) OR contains(q, {n}))", f"greatest(score{k - 1}, 0.88)", f"CASE WHEN basis{k - 1} = 'normalized' THEN 'normalized' ELSE 'contains' END", "false"),
        (f"len(list_filter(tokens, lambda t: contains({n}, t) OR contains(t, {n}))) > 0", f"greatest(score{k - 1}, 0.82)", f"CASE WHEN score{k - 1} < 0.82 THEN 'token_contains' ELSE basis{k - 1} END", "false"),
        (f"{_jaccard('q', n)} > score{k - 1}", _jaccard("q", n), "'fuzzy'", "false"),
    )
    out = []
    for i, (name, prev) in enumerate((("score", f"score{k - 1}"), ("basis", f"basis{k - 1}"), ("done", f"done{k - 1}"))):
        out.append("CASE " + " ".join(f"WHEN {c[0]} THEN {c[1 + i]}" for c in cases) + f" ELSE {prev} END AS {name}{k}")
    return ", ".join(out)


def _scored(pairs: str) -> str:
    """CTEs that score ``pairs`` (row_id, name, component, name1, name2, ...) as score2, basis2."""
    return f"""
f0 AS (SELECT *, {S.normalize('name')} AS q, {S.normalize(S.strip('name'))} AS s, {S.normalize('name1')} AS n1, {S.normalize(S.strip('name1'))} AS s1, {S.normalize('name2')} AS n2, {S.normalize(S.strip('name2'))} AS s2 FROM {pairs}),
f1 AS (SELECT *, {_VERB} AS v FROM f0),
f2 AS (SELECT *, list_filter([v, {_CUTS}], lambda x: x IS NOT NULL AND x <> '') AS tokens, 0.0::DOUBLE AS score0, 'fuzzy' AS basis0, false AS done0 FROM f1),
f3 AS (SELECT *, {_step(1)} FROM f2),
scored AS (SELECT *, {_step(2)} FROM f3)"""


def score_names(spark, sf_dir):
    """Rows with the components that have their number modulo 7; each distinct name is scored against a component once."""
    rows = bill_rows(spark, sf_dir).select("row_id", "name", (F.col("row_id") % 7).alias("k"))
    known = catalog(spark, sf_dir).select("component", (F.col("pos") % 7).alias("k"), M.name_forms(F.col("names")).alias("forms"))
    asked = rows.select("name", "k").distinct().withColumn("f", M.query_form(F.col("name")))
    scored = asked.join(known, "k").select(F.col("name").alias("said"), F.col("k").alias("of"), "component", M.score_forms(F.col("f"), F.col("forms")).alias("s"))
    scored = scored.select("said", "of", "component", F.round("s.score", 4).alias("score"), "s.basis")
    return rows.join(scored, (F.col("k") == F.col("of")) & F.col("name").eqNullSafe(F.col("said"))).select("row_id", "component", "score", "basis")


QUERIES["score_names"] = score_names
ORACLE_SQL["score_names"] = f"WITH {BILL_ROWS}, {_CATALOG}, pairs AS (SELECT * FROM bill_rows JOIN catalog ON row_id % 7 = pos % 7), {_scored('pairs')} SELECT row_id, component, round(score2, 4) AS score, basis2 AS basis FROM scored"


def block_pairs(spark, sf_dir):
    return M.block_pairs(bill_rows(spark, sf_dir).select("row_id", "name"), catalog(spark, sf_dir).select("component", F.col("component").alias("name")))


QUERIES["block_pairs"] = block_pairs
ORACLE_SQL["block_pairs"] = f"""WITH {BILL_ROWS}, {_CATALOG}, p AS (SELECT row_id, component, {S.normalize('name')} AS x, {S.normalize('component')} AS y FROM bill_rows, catalog)
SELECT row_id, component FROM p WHERE x <> '' AND y <> '' AND ({_jaccard('x', 'y')} >= 0.55 OR contains(x, y) OR contains(y, x))"""


def rank_candidates(spark, sf_dir):
    return M.rank_candidates(bill_rows(spark, sf_dir), catalog(spark, sf_dir), index(spark, sf_dir))


QUERIES["rank_candidates"] = rank_candidates
_SPECIAL_OF = "CASE " + " ".join("WHEN name = '{}' THEN [{}]".format(k, ", ".join(f"'{c}'" for c in cs)) for k, cs in C.SPECIAL_ITEMS.items()) + " ELSE flatten([" + ", ".join("CASE WHEN contains({}, {}) THEN [{}] ELSE [] END".format(S.normalize("name"), S.normalize(f"'{k}'"), ", ".join(f"'{c}'" for c in cs)) for k, cs in C.SPECIAL_ITEMS.items()) + "]) END"
_RANKED = f"""WITH {BILL_ROWS}, {_CATALOG}, {_ALIASES},
explicit AS (SELECT DISTINCT row_id, idx.component FROM bill_rows JOIN idx ON key IN ({S.normalize('name')}, {S.normalize(S.strip('name'))}) JOIN catalog USING (component)),
pairs AS (
  SELECT b.row_id, b.name, {S.unit('b.unit')} AS row_unit, c.*, e.component IS NOT NULL AS explicit, {_SPECIAL_OF} AS special
  FROM bill_rows b CROSS JOIN catalog c LEFT JOIN explicit e ON e.row_id = b.row_id AND e.component = c.component
  WHERE e.component IS NOT NULL OR b.row_id NOT IN (SELECT row_id FROM explicit)
), {_scored('pairs')},
g AS (SELECT *, CASE WHEN explicit THEN greatest(score2, 0.93) ELSE score2 END AS sc, CASE WHEN explicit AND basis2 NOT IN ('exact', 'normalized') THEN 'alias_bridge' ELSE basis2 END AS ba FROM scored),
h AS (SELECT *, list_contains(special, component) AND ba NOT IN ('exact', 'normalized', 'alias_bridge') AS sp FROM g),
r AS (
  SELECT row_id, component, pos, CASE WHEN sp THEN 'special_rule' ELSE ba END AS basis,
    round(least(1.0, greatest(sc, CASE WHEN sp THEN 0.88 ELSE 0.0 END) + CASE WHEN sc > 0 AND {S.family('component')} = {S.family('name')} THEN 0.04 ELSE 0.0 END + CASE WHEN row_unit <> '' AND row_unit = unit THEN 0.03 ELSE 0.0 END), 4) AS score
  FROM h
), best AS (SELECT *, max(score) OVER (PARTITION BY row_id) AS best FROM r),
ranked AS (
  SELECT row_id, component, score, basis, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, pos) AS rank FROM best WHERE score >= greatest(best * 0.75, 0.62)
)"""
ORACLE_SQL["rank_candidates"] = _RANKED + " SELECT row_id, component, score, basis, rank FROM ranked WHERE rank <= 3"


def local_match(spark, sf_dir):
    return M.local_match(bill_rows(spark, sf_dir), catalog(spark, sf_dir), index(spark, sf_dir))


QUERIES["local_match"] = lambda spark, sf_dir: local_match(spark, sf_dir).select("row_id", "component", "score", "basis", "status")
_STATUS = "CASE WHEN score IS NULL THEN 'unmatched' WHEN score >= 0.8 AND basis IN (" + ", ".join(f"'{b}'" for b in C.STRONG_BASES) + ") THEN 'matched' ELSE 'candidate_only' END"
_LOCAL = _RANKED + f", local AS (SELECT b.row_id, r.component, r.score, r.basis, {_STATUS} AS status FROM bill_rows b LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r USING (row_id))"
ORACLE_SQL["local_match"] = _LOCAL + " SELECT row_id, component, score, basis, status FROM local"
QUERIES["match_statistics"] = lambda spark, sf_dir: M.match_statistics(local_match(spark, sf_dir))
ORACLE_SQL["match_statistics"] = _LOCAL + " SELECT count(*) AS total, count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status = 'candidate_only') AS candidate_only, count(*) FILTER (status = 'unmatched') AS unmatched, count(DISTINCT component) AS components, count(*) FILTER (trim(features) <> '') AS with_features FROM local JOIN bill_rows USING (row_id)"
QUERIES["unmatched_report"] = lambda spark, sf_dir: local_match(spark, sf_dir).where("status = 'unmatched'").select("row_id", "name", F.lit("no candidate reached the least score").alias("reason"))
ORACLE_SQL["unmatched_report"] = _LOCAL + " SELECT row_id, name, 'no candidate reached the least score' AS reason FROM local JOIN bill_rows USING (row_id) WHERE status = 'unmatched'"
QUERIES["confidence_bands"] = lambda spark, sf_dir: local_match(spark, sf_dir).select("row_id", F.when((F.col("score") >= 0.85) & F.col("basis").isin(*C.STRONG_BASES), "A").when(F.col("score") >= 0.65, "B").otherwise("C").alias("band"))
ORACLE_SQL["confidence_bands"] = _LOCAL + " SELECT row_id, CASE WHEN score >= 0.85 AND basis IN (" + ", ".join(f"'{b}'" for b in C.STRONG_BASES) + ") THEN 'A' WHEN score >= 0.65 THEN 'B' ELSE 'C' END AS band FROM local"


def chapter_fallback(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    fallback = p.groupBy(F.col("p_brand").alias("chapter"), F.col("p_type").alias("component")).agg(F.min("p_partkey").alias("pos"))
    return M.chapter_fallback(bill_rows(spark, sf_dir), rank_candidates(spark, sf_dir), fallback)


QUERIES["chapter_fallback"] = chapter_fallback
ORACLE_SQL["chapter_fallback"] = _RANKED + """, fb AS (SELECT p_brand AS chapter, p_type AS component, row_number() OVER (PARTITION BY p_brand ORDER BY min(p_partkey)) AS rank FROM part GROUP BY 1, 2)
SELECT b.row_id, fb.component, 0.65 AS score, 'chapter_fallback' AS basis, fb.rank FROM bill_rows b JOIN fb ON fb.chapter = trim(split_part(b.chapter, ' > ', 1)) WHERE fb.rank <= 3 AND b.row_id NOT IN (SELECT row_id FROM ranked)"""

QUERIES["explode_features"] = lambda spark, sf_dir: M.explode_features(bill_rows(spark, sf_dir)).select("row_id", "feature_order", "raw_text")
# The texts have no line that is only a number but the last, which numbers the line before.
_FEATURES = r"""
cleaned AS (SELECT row_id, list_filter(list_transform(string_split(trim(regexp_replace(regexp_replace(features, '[ \t]+', ' ', 'g'), '\n+', chr(10), 'g')), chr(10)), lambda x: regexp_replace(x, '^[ .。；;：:]+|[ .。；;：:]+$', '', 'g')), lambda x: x <> '') AS ls FROM bill_rows),
marked AS (SELECT row_id, list_transform(ls, lambda x: regexp_replace(regexp_replace(regexp_replace(trim(translate(x, '．、：', '..:')), '^(\d+)\s*-\s*', '\1.'), '^(\d+)\s*\.\s*', '\1.'), '^(\d+)\s+', '\1.')) AS ls FROM cleaned),
joined AS (SELECT row_id, list_filter(list_transform(ls, lambda x, i: CASE WHEN regexp_matches(x, '^\d+$') AND i > 1 THEN NULL WHEN regexp_matches(coalesce(ls[i + 1], ''), '^\d+$') THEN ls[i + 1] || '.' || regexp_replace(x, '^[.。]+', '') ELSE x END), lambda x: x IS NOT NULL) AS ls FROM marked),
lines AS (SELECT row_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS seq FROM joined),
features AS (
  SELECT row_id, CASE WHEN regexp_matches(line, '^\s*\d+\s*[.\-]?\s*.+$') THEN CAST(regexp_extract(line, '^\s*(\d+)', 1) AS INT) ELSE CAST(seq AS INT) END AS feature_order,
    CASE WHEN regexp_matches(line, '^\s*\d+\s*[.\-]?\s*.+$') THEN regexp_extract(line, '^\s*(\d+)\s*[.\-]?\s*(.+?)\s*$', 2) ELSE trim(line) END AS raw_text FROM lines
)"""
ORACLE_SQL["explode_features"] = f"WITH {BILL_ROWS}, {_FEATURES} SELECT * FROM features"
QUERIES["feature_values"] = lambda spark, sf_dir: M.explode_features(bill_rows(spark, sf_dir)).select("row_id", "feature_order", M.feature_values(F.col("raw_text")).alias("v")).select("row_id", "feature_order", "v.label", "v.value")
_SIGNED = S.replaced("trim(coalesce(raw_text, ''))", C.COMPARISONS)
_BARE = lambda x: f"regexp_replace({x}, '^[ ：:.]+|[ ：:.]+$', '', 'g')"
_OP, _TAIL = "'^(.*?)(>=|<=|>|<|=)\\s*(.+?)$'", "'(?i)^(.*?)(C\\d{2,3}(?:\\.\\d+)?|\\d+(?:\\.\\d+)?\\s*(?:mm|cm|m|m2|m3|kg|t|MPa|%|级))$'"


def _valued(of: str) -> str:
    """``feature_values``: ``of`` with label and value."""
    return f"""signed AS (SELECT *, {_SIGNED} AS own FROM {of}),
feature_values AS (SELECT * EXCLUDE (own), CASE WHEN regexp_matches(own, {_OP}) THEN {_BARE(f'regexp_extract(own, {_OP}, 1)')} WHEN regexp_matches(own, {_TAIL}) THEN {_BARE(f'regexp_extract(own, {_TAIL}, 1)')} ELSE {_BARE("trim(coalesce(raw_text, ''))")} END AS label,
  CASE WHEN regexp_matches(own, {_OP}) THEN regexp_extract(own, {_OP}, 2) || trim(regexp_extract(own, {_OP}, 3)) WHEN regexp_matches(own, {_TAIL}) THEN trim(regexp_extract(own, {_TAIL}, 2)) ELSE '' END AS value FROM signed)"""


_VALUES = _valued("features")
ORACLE_SQL["feature_values"] = f"WITH {BILL_ROWS}, {_FEATURES}, {_VALUES} SELECT row_id, feature_order, label, value FROM feature_values"


def attributes(spark, sf_dir):
    """Four attributes for each part type."""
    names = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), F.lit(c).alias("code")) for i, (n, c) in enumerate((("墙体厚", "HD"), ("砼标号", "TBH"), ("备用", "GD"), ("厚", "BH")))])
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("component")).distinct().select("component", F.inline(names))


def matched_features(spark, sf_dir):
    rows = bill_rows(spark, sf_dir).withColumn("component", F.split_part("chapter", F.lit(" > "), F.lit(2)))
    feats = M.explode_features(rows).join(rows.select("row_id", "component"), "row_id")
    return M.match_features(feats, attributes(spark, sf_dir))


_LABELS = ("厚度", "强度等级", "墙体厚", "标号x", "墙厚度", "备", "")


def labelled(spark, sf_dir):
    """Every part with a label made of its place and type, and one of the attributes."""
    p = table(spark, sf_dir, "part")
    label = F.concat(pick(_LABELS, (F.col("p_partkey") % 7).cast("int")), F.when(F.col("p_partkey") % 11 == 0, F.col("p_brand")).otherwise(""))
    names, codes = ("墙体厚", "砼标号", "备用", "厚", "墙高"), ("HD", "TBH", "GD", "BH", "QG")
    return p.select("p_partkey", label.alias("label"), pick(names, (F.col("p_size") % 5).cast("int")).alias("name"), pick(codes, (F.col("p_size") % 5).cast("int")).alias("code"))


def _attribute_score(label: str, name: str, code: str) -> str:
    """How well a label fits an attribute, as SQL."""
    a, b = S.normalize(label), S.normalize(name)
    hints = f"CASE {code} " + " ".join("WHEN '{}' THEN [{}]".format(k, ", ".join(S.normalize(f"'{w}'") for w in ws)) for k, ws in C.ATTRIBUTE_HINTS.items()) + " ELSE [] END"
    words = f"list_filter(list_concat([{b}], {hints}), lambda k: k <> '')"
    touching = f"len(list_filter({words}, lambda k: k <> {a} AND (contains(k, {a}) OR contains({a}, k)))) > 0"
    best = f"greatest(CASE WHEN contains({b}, {a}) OR contains({a}, {b}) THEN 0.9::DOUBLE ELSE 0.0 END, CASE WHEN list_contains({words}, {a}) THEN 0.98::DOUBLE ELSE 0.0 END, CASE WHEN {touching} THEN 0.92::DOUBLE ELSE 0.0 END, {_jaccard(a, b)})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE round({best}, 4) END"


QUERIES["score_attributes"] = lambda spark, sf_dir: labelled(spark, sf_dir).select("p_partkey", "label", "code", M.attribute_score(F.col("label"), F.col("name"), F.col("code")).alias("score"))
ORACLE_SQL["score_attributes"] = f"""WITH l AS (SELECT p_partkey, {sql_pick(_LABELS, 'p_partkey % 7')} || CASE WHEN p_partkey % 11 = 0 THEN p_brand ELSE '' END AS label, {sql_pick(("墙体厚", "砼标号", "备用", "厚", "墙高"), 'p_size % 5')} AS name, {sql_pick(("HD", "TBH", "GD", "BH", "QG"), 'p_size % 5')} AS code FROM part)
SELECT p_partkey, label, code, {_attribute_score('label', 'name', 'code')} AS score FROM l"""
QUERIES["match_features"] = lambda spark, sf_dir: matched_features(spark, sf_dir)
_ATTRIBUTES = "attrs(pos, name, code) AS (VALUES (0, '墙体厚', 'HD'), (1, '砼标号', 'TBH'), (2, '备用', 'GD'), (3, '厚', 'BH'))"


def _best_attributes(of: str) -> str:
    """``described``: ``of`` (row_id, component, feature_order, raw_text, label, value) with the best attribute of its component, and the expression."""
    return f"""labels AS (SELECT DISTINCT label FROM {of}),
fit AS (SELECT label, name, code, {_attribute_score('label', 'name', 'code')} AS score, pos FROM labels CROSS JOIN attrs),
fits AS (SELECT label, name, code FROM fit WHERE score >= 0.55 QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, pos) = 1),
described AS (SELECT f.*, name AS attribute_name, code AS attribute_code, CASE WHEN code IS NULL THEN raw_text ELSE f.label || ':' || code || CASE WHEN value <> '' THEN '=' || value ELSE '' END END AS expression, code IS NOT NULL AS matched
  FROM {of} f LEFT JOIN fits ON fits.label = f.label AND f.component IS NOT NULL)"""


ORACLE_SQL["match_features"] = f"""WITH {BILL_ROWS}, {_FEATURES}, {_VALUES}, {_ATTRIBUTES}, own AS (SELECT f.row_id, split_part(chapter, ' > ', 2) AS component, feature_order, raw_text, label, value FROM feature_values f JOIN bill_rows b USING (row_id)),
{_best_attributes('own')} SELECT row_id, component, feature_order, raw_text, label, value, attribute_name, attribute_code, expression, matched FROM described"""

_PREFER = f"""prefer AS (SELECT *, {S.unit('unit')} AS u, CASE WHEN contains(name || rule, '模板') THEN ['MBMJ', 'DMMB', 'CMMB', 'ZMBMJ', 'ZMB'] WHEN contains(rule, '体积') THEN ['TJ', 'ZTJ', 'JLQTJ', 'DZJLQTJ', 'CGTJ']
  WHEN contains(rule, '面积') THEN ['MJ', 'TYMJ', 'MBMJ', 'TQMJ', 'DMMJ', 'CMMJ'] WHEN contains(rule, '长度') THEN ['CD', 'JCD', 'YCD'] WHEN contains(rule, '数量') THEN ['SL']
  WHEN {S.unit('unit')} = 'm3' THEN ['TJ', 'ZTJ'] WHEN {S.unit('unit')} = 'm2' THEN ['MJ', 'TYMJ', 'MBMJ'] ELSE [] END AS codes FROM bill_rows)"""


# -- items whose component is given ------------------------------------------------------------------

_CALCULATIONS = (("ZTJ", "总体积", "m3"), ("MJ", "净面积", "m2"), ("MBMJ", "模板面积", "m2"))


def given_items(spark, sf_dir):
    """Bill rows whose component is given: by its name, by a form of it, or by one that is not known; every fourth has its rule in the work text."""
    b = bill_rows(spark, sf_dir)
    k, component = F.col("row_id"), F.split_part("chapter", F.lit(" > "), F.lit(2))
    given = F.when(k % 4 == 0, component).when(k % 4 == 1, F.concat(F.lit("现浇("), component, F.lit(")构件"))).when(k % 4 == 2, F.concat(F.lit("（"), component, F.lit("） "))).otherwise(F.lit("unknown"))
    features = F.concat(F.lit("1.厚度："), (k % 50).cast("string"), F.lit("mm、强度等级>=C30\n"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("2. "), "name", F.lit("；a@b"))))
    return b.select("row_id", given.alias("given"), "name", F.when(k % 5 == 4, "").otherwise(features).alias("features"), "unit", F.when(k % 4 == 2, " ").otherwise(F.col("rule")).alias("rule"), F.col("rule").alias("work"))


def given_catalog(spark, sf_dir):
    p = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("component")).agg(F.min("p_partkey").alias("pos"))
    return p.withColumn("names", F.array(F.concat(F.lit("预制"), "component")))


def given_calculations(spark, sf_dir):
    items = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("calc_code"), F.lit(n).alias("calc_name"), F.lit(u).alias("calc_unit")) for i, (c, n, u) in enumerate(_CALCULATIONS)])
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("component")).distinct().select("component", F.inline(items))


def _directly(operator):
    return lambda spark, sf_dir: operator(given_items(spark, sf_dir), given_catalog(spark, sf_dir), attributes(spark, sf_dir), given_calculations(spark, sf_dir))


QUERIES["atomic_features"] = lambda spark, sf_dir: D.atomic_features(given_items(spark, sf_dir))
QUERIES["forced_match"] = _directly(D.forced_match)
QUERIES["direct_match"] = _directly(D.direct_match)
_EDGES = "'^[ ：:。.;；,，]+|[ ：:。.;；,，]+$'"
_GIVEN = rf"""
given AS (SELECT row_id, split_part(chapter, ' > ', 2) AS type, name, unit, rule AS work, CASE WHEN row_id % 4 = 2 THEN rule ELSE rule END AS rule,
  CASE row_id % 4 WHEN 0 THEN split_part(chapter, ' > ', 2) WHEN 1 THEN '现浇(' || split_part(chapter, ' > ', 2) || ')构件' WHEN 2 THEN '（' || split_part(chapter, ' > ', 2) || '） ' ELSE 'unknown' END AS given,
  CASE WHEN row_id % 5 = 4 THEN '' ELSE '1.厚度：' || (row_id % 50) || 'mm、强度等级>=C30' || chr(10) || CASE WHEN row_id % 3 = 0 THEN '' ELSE '2. ' || name || '；a@b' END END AS features FROM bill_rows),
glines AS (SELECT row_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(translate(features, '　．：', ' .:'), '[ 	]+', ' ', 'g'), '
+', chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM given),
gbare AS (SELECT row_id, list_transform(ls, lambda x: CASE WHEN regexp_matches(x, '^\s*\d+\s*[.\-]?\s*.+$') THEN regexp_extract(x, '^\s*(\d+)\s*[.\-]?\s*(.+?)\s*$', 2) ELSE x END) AS ls FROM glines),
gcut AS (SELECT row_id, flatten(list_transform(ls, lambda x: CASE WHEN len(list_filter(list_transform(regexp_split_to_array(x, '[、,，;；/]+'), lambda p: regexp_replace(p, {_EDGES}, '', 'g')), lambda p: p <> '')) > 1
  THEN list_filter(list_transform(regexp_split_to_array(x, '[、,，;；/]+'), lambda p: regexp_replace(p, {_EDGES}, '', 'g')), lambda p: p <> '') ELSE [x] END)) AS fs FROM gbare),
atomic AS (SELECT row_id, CAST(generate_subscripts(fs, 1) AS INT) AS feature_order, unnest(fs) AS raw_text FROM gcut)"""
ORACLE_SQL["atomic_features"] = f"WITH {BILL_ROWS}, {_GIVEN} SELECT row_id, feature_order, raw_text FROM atomic"
_RULE_CODES = _PREFER.replace("prefer AS", "gprefer AS").replace("FROM bill_rows", "FROM resolved").replace("WHEN {S.unit('unit')} = 'm2'", "WHEN {S.unit('unit')} = 'm2'")
_RESOLVED = f"""
gcat AS (SELECT p_type AS component, min(p_partkey) AS pos FROM part GROUP BY 1),
gname AS (SELECT component, pos, component AS name FROM gcat UNION ALL SELECT component, pos, '预制' || component FROM gcat),
gkey AS (SELECT key, arg_min(component, pos) AS found, min(pos) AS pos FROM (SELECT component, pos, {S.normalize('name')} AS key FROM gname UNION ALL SELECT component, pos, {S.normalize(S.strip('name'))} FROM gname) WHERE key <> '' GROUP BY 1),
galias AS (SELECT row_id, arg_min(found, k.pos) AS found FROM given g JOIN gkey k ON k.key IN ({S.normalize('trim(given)')}, {S.normalize(S.strip('trim(given)'))}) GROUP BY 1),
resolved AS (SELECT g.* EXCLUDE (type), coalesce(e.component, a.found) AS component, CASE WHEN e.component IS NOT NULL THEN 'exact' WHEN a.found IS NOT NULL THEN 'alias' ELSE 'none' END AS basis FROM given g LEFT JOIN gcat e ON e.component = trim(g.given) LEFT JOIN galias a USING (row_id)),
{_RULE_CODES},
gcalc(pos, calc_code, calc_name, calc_unit) AS (VALUES {", ".join(f"({i}, '{c}', '{n}', '{u}')" for i, (c, n, u) in enumerate(_CALCULATIONS))}),
gr AS (SELECT *, CASE codes[1] WHEN 'MBMJ' THEN ['模板', '接触面积'] WHEN 'TJ' THEN ['体积'] WHEN 'MJ' THEN ['面积', '投影面积', '接触面积'] WHEN 'CD' THEN ['长度'] WHEN 'SL' THEN ['数量'] ELSE [] END AS words FROM gprefer WHERE component IS NOT NULL),
gs AS (SELECT gr.row_id, c.*, round(CASE WHEN list_position(codes, calc_code) > 0 THEN 0.7 - (list_position(codes, calc_code) - 1) * 0.05 ELSE 0 END + CASE WHEN u <> '' AND u = calc_unit THEN 0.25 ELSE 0 END
  + CASE WHEN len(list_filter(words, lambda w: contains(calc_name, w))) > 0 THEN 0.2 ELSE 0 END + CASE WHEN contains(name, '模板') AND contains(calc_name, '模板') THEN 0.25 ELSE 0 END, 4) AS score FROM gr CROSS JOIN gcalc c),
gb AS (SELECT * FROM gs WHERE score >= 0.25 QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, pos) = 1),
gg AS (SELECT *, list_filter(codes, lambda x: x IN ('TJ', 'MJ', 'CD', 'SL'))[1] AS generic FROM gr),
gfinal AS (SELECT gg.row_id, coalesce(calc_code, generic, '') AS calc_code, coalesce(calc_name, CASE generic WHEN 'TJ' THEN '体积' WHEN 'MJ' THEN '面积' WHEN 'CD' THEN '长度' WHEN 'SL' THEN '数量' END, '') AS calc_name,
  CASE WHEN u <> '' THEN u ELSE coalesce(calc_unit, CASE generic WHEN 'TJ' THEN 'm3' WHEN 'MJ' THEN 'm2' WHEN 'CD' THEN 'm' END, '') END AS calc_unit FROM gg LEFT JOIN gb USING (row_id)),
gown AS (SELECT a.row_id, component, feature_order, raw_text FROM atomic a JOIN resolved USING (row_id)),
{_valued('gown')}, {_ATTRIBUTES}, {_best_attributes('feature_values')},
gcount AS (SELECT row_id, count(*) AS features, count(*) FILTER (matched) AS found, string_agg(expression, '|' ORDER BY feature_order) AS expressions FROM described GROUP BY 1),
gout AS (SELECT r.row_id, r.component, basis, coalesce(features, 0) AS features, coalesce(found, 0) AS found, coalesce(expressions, '') AS expressions, coalesce(calc_code, '') AS calc_code, coalesce(calc_name, '') AS calc_name, coalesce(calc_unit, '') AS calc_unit
  FROM (SELECT row_id, component, basis FROM resolved) r LEFT JOIN gcount USING (row_id) LEFT JOIN gfinal USING (row_id))"""
ORACLE_SQL["forced_match"] = f"WITH {BILL_ROWS}, {_GIVEN}, {_RESOLVED} SELECT * FROM gout"
ORACLE_SQL["direct_match"] = f"""WITH {BILL_ROWS}, {_GIVEN}, {_RESOLVED}, s AS (SELECT *, CASE WHEN component IS NULL THEN 'unmatched' WHEN found = features AND calc_code <> '' THEN 'matched' WHEN found > 0 THEN 'candidate_only' ELSE 'unmatched' END AS status FROM gout)
SELECT *, CASE WHEN component IS NULL THEN 0.0::DOUBLE WHEN status = 'matched' THEN 0.9::DOUBLE WHEN status = 'candidate_only' THEN 0.55::DOUBLE ELSE 0.1::DOUBLE END AS confidence FROM s"""


def match_rows(spark, sf_dir):
    """Local matches as rows whose component stands in one of several fields."""
    k = F.col("row_id")
    return local_match(spark, sf_dir).select("row_id", F.when(k % 3 == 0, F.col("component")).otherwise(" ").alias("quantity_component"), F.when(k % 3 == 1, F.col("component")).alias("resolved_component_name"), F.when(k % 2 == 0, F.col("name")).otherwise("").alias("component_type"), F.col("status").alias("match_status"))


_HANDED = _LOCAL + """, handed AS (SELECT l.row_id, status, coalesce(CASE WHEN l.row_id % 3 < 2 THEN nullif(trim(l.component), '') END, CASE WHEN l.row_id % 2 = 0 THEN nullif(trim(b.name), '') END) AS given FROM local l JOIN bill_rows b USING (row_id))"""
QUERIES["handoff_items"] = lambda spark, sf_dir: D.handoff_items(match_rows(spark, sf_dir)).select("row_id", "given")
ORACLE_SQL["handoff_items"] = _HANDED + " SELECT row_id, given FROM handed WHERE given IS NOT NULL AND status IN ('matched', 'candidate_only')"
QUERIES["skip_counts"] = lambda spark, sf_dir: D.skip_counts(match_rows(spark, sf_dir))
ORACLE_SQL["skip_counts"] = _HANDED + " SELECT count(*) AS total, count(*) FILTER (given IS NULL) AS no_component, count(*) FILTER (given IS NOT NULL AND status NOT IN ('matched', 'candidate_only')) AS unmatched FROM handed"


def hinted(spark, sf_dir):
    b = bill_rows(spark, sf_dir)
    own = M.explode_features(b.where("row_id % 3 > 0"))
    return own, b.select("row_id", F.array(F.lit("厚度"), F.concat(F.lit("h"), (F.col("row_id") % 5).cast("string")), F.lit(" "), F.lit("厚度")).alias("features"))


QUERIES["features_or_hints"] = lambda spark, sf_dir: M.features_or_hints(*hinted(spark, sf_dir))
ORACLE_SQL["features_or_hints"] = f"""WITH {BILL_ROWS}, {_FEATURES} SELECT row_id, feature_order, raw_text FROM features WHERE row_id % 3 > 0
UNION ALL SELECT row_id, 1, '厚度' FROM bill_rows WHERE row_id % 3 = 0 UNION ALL SELECT row_id, 2, 'h' || (row_id % 5) FROM bill_rows WHERE row_id % 3 = 0"""


def local_catalog_parts(spark, sf_dir):
    """Attributes and calculations of every catalogue component."""
    names = catalog(spark, sf_dir).select("component")
    attrs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), F.lit(c).alias("code")) for i, (n, c) in enumerate((("墙体厚", "HD"), ("砼标号", "TBH"), ("备用", "GD"), ("厚", "BH")))])
    calcs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("calc_code"), F.lit(n).alias("calc_name"), F.lit(u).alias("calc_unit")) for i, (c, n, u) in enumerate(_CALCULATIONS)])
    return names.select("component", F.inline(attrs)), names.select("component", F.inline(calcs))




def local_results(spark, sf_dir):
    """The matches are written once, as features, calculations and the result all read them."""
    path = folder(spark, "local-matches")
    local_match(spark, sf_dir).write.parquet(path)
    return M.local_results(spark.read.parquet(path), *local_catalog_parts(spark, sf_dir))


QUERIES["local_results"] = local_results
_LOCAL_PARTS = _RESOLVED[_RESOLVED.index("gcalc(pos"):]
ORACLE_SQL["local_results"] = _LOCAL + f""", resolved AS (SELECT b.*, l.component FROM bill_rows b JOIN local l USING (row_id)), {_RULE_CODES}, {_FEATURES}, atomic AS (SELECT * FROM features WHERE row_id IN (SELECT row_id FROM local WHERE component IS NOT NULL)),
{_LOCAL_PARTS[:_LOCAL_PARTS.index("gout AS")]} lout AS (SELECT l.row_id, l.component, score, basis, status, coalesce(c.features, 0) AS n_features, coalesce(found, 0) AS found, coalesce(expressions, '') AS expressions, coalesce(calc_code, '') AS calc_code, coalesce(calc_unit, '') AS calc_unit FROM local l LEFT JOIN gcount c USING (row_id) LEFT JOIN gfinal USING (row_id)) SELECT * FROM lout"""
