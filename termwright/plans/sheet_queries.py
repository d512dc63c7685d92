"""Queries of component workbooks: each brand of parts is a workbook with sheets of every kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.operators import sheets as H
from termwright.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}

#: Sheets by number: name, and columns with what stands in them, in Spark's and DuckDB's words alike.
_NAME, _CODE = "concat(p_name, substr(' 厚度', 1, p_size % 4))", "CASE WHEN p_size % 6 = 0 THEN '' ELSE concat(' ', lower(p_type), CAST(p_size % 7 AS STRING)) END"
_CHOICES = "CASE p_size % 5 WHEN 0 THEN '1、2.5；3' WHEN 1 THEN concat(p_name, '| b,b') WHEN 2 THEN '' WHEN 3 THEN CAST(p_size AS STRING) END"
_SHEETS = (
    ("属性表", {"名称": _NAME, "CODE": _CODE, "数据类型": "CASE p_size % 3 WHEN 0 THEN ' Number' WHEN 1 THEN 'x' END", "values": _CHOICES, "可选值": "CASE WHEN p_size % 10 = 1 THEN '7' END"}),
    ("Sheet1", {"名称": _NAME, "CODE": _CODE, " 下拉 ": "'no cell of its own'", "下拉": _CHOICES}),
    ("工程量 list", {"名称": "p_name", "CODE": _CODE, "表达式": "CASE WHEN p_size % 4 > 0 THEN concat(p_type, '*2') END", "公式": "'f'", "计量单位": "CASE WHEN p_size % 3 > 0 THEN 'm2' ELSE ' ' END", "unit": "CASE WHEN p_size % 5 = 0 THEN 'kg' END"}),
    ("defaults", {"名称": _NAME, "CODE": _CODE, "属性值": "CASE p_size % 4 WHEN 0 THEN '-1.5' WHEN 1 THEN p_name END", "默认值": "'9'"}),
    ("misc", {"名称": "p_name", "CODE": _CODE, "formula": "p_type", "单位": "'个'"}),
    ("Core 参数", {"名称": "CASE WHEN p_size % 9 > 0 THEN p_name END", "CODE": _CODE, "值": "CAST(p_size AS STRING)", "数据类型": "'TEXT'"}),
    ("unknown", {"名称": "p_name", "remark": "p_type"}),
)


def cells(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    out = None
    for k, (name, columns) in enumerate(_SHEETS):
        each = [F.struct(F.lit(c).alias("column"), F.expr(e).alias("value")) for c, e in columns.items()]
        own = p.where(F.col("p_partkey") % len(_SHEETS) == k).select(F.col("p_brand").alias("book"), F.lit(k).alias("sheet_no"), F.lit(name).alias("sheet"), F.col("p_partkey").alias("row"), F.inline(F.array(*each)))
        out = own if out is None else out.unionByName(own)
    return out


_string = lambda e: e.replace("AS STRING", "AS VARCHAR")
_filled = lambda e: f"nullif(trim({_string(e)}), '')"


def _first(columns: dict, k: str) -> str:
    return "coalesce(" + ", ".join([*[_filled(columns[n]) for n in C.SHEET_COLUMNS[k] if n in columns], "''"]) + ")"


_KINDS = ("legacy_attributes", "feature_attributes", "calculations", "property_defaults", "calculations", "legacy_core_params")
_ITEMS = "rw AS (" + " UNION ALL ".join(
    f"SELECT p_brand AS book, {k} AS sheet_no, p_partkey AS row, '{name}' AS sheet, '{kind}' AS kind, {_first(cs, 'name')} AS name, upper({_first(cs, 'code')}) AS code, lower({_first(cs, 'kind')}) AS said, {_first(cs, 'choices' if kind == 'feature_attributes' else 'values')} AS listed, {_first(cs, 'value')} AS v, {_first(cs, 'unit')} AS u, {_first(cs, 'expression')} AS ex FROM part WHERE p_partkey % {len(_SHEETS)} = {k}"
    for k, ((name, cs), kind) in enumerate(zip(_SHEETS, _KINDS))
) + f"""),
un AS (SELECT book, code, arg_max(u, (sheet_no, row)) AS linked FROM rw WHERE kind = 'calculations' AND code <> '' AND u <> '' GROUP BY 1, 2),
vl AS (SELECT *, CASE WHEN kind LIKE '%attributes' THEN list_filter(list_transform(regexp_split_to_array(listed, '{C.VALUE_BREAKS}'), lambda x: trim(x)), lambda x: x <> '') ELSE [] END AS l0, CASE WHEN kind IN ('property_defaults', 'legacy_core_params') THEN v ELSE '' END AS value FROM rw LEFT JOIN un USING (book, code) WHERE name <> '' OR code <> ''),
ty AS (SELECT *, list_filter(l0, lambda x, i: list_position(l0, x) = i) AS vals, CASE WHEN len(l0) > 0 THEN CASE WHEN len(list_filter(l0, lambda x: NOT regexp_full_match(x, '[+-]?\\d+(\\.\\d+)?'))) = 0 THEN 'number' ELSE 'text' END WHEN regexp_full_match(value, '[+-]?\\d+(\\.\\d+)?') THEN 'number' WHEN regexp_matches(name, '{"|".join(C.TEXT_NAME_HINTS)}') THEN 'text' WHEN linked IS NOT NULL THEN 'number' WHEN regexp_matches(name, '{"|".join(C.NUMBER_NAME_HINTS)}') THEN 'number' ELSE 'text' END AS guess FROM vl),
it AS (SELECT book, sheet_no, row, sheet, CASE WHEN kind LIKE '%attributes' THEN 'attributes' WHEN kind = 'calculations' THEN kind ELSE 'core_params' END AS list, CASE WHEN code <> '' THEN code ELSE 'name:' || name END AS key, name, code, CASE WHEN kind = 'calculations' THEN NULL WHEN kind <> 'feature_attributes' AND said IN ('text', 'number') THEN said ELSE guess END AS data_type, vals, value, CASE WHEN kind = 'calculations' THEN ex ELSE '' END AS expression, CASE WHEN kind = 'calculations' THEN u ELSE '' END AS unit FROM ty),
rk AS (SELECT *, min((sheet_no, row)) OVER w AS pos, row_number() OVER (PARTITION BY book, list, key ORDER BY sheet_no DESC, row DESC) AS k FROM it WINDOW w AS (PARTITION BY book, list, key)),
items AS (SELECT * FROM rk WHERE k = 1)"""
QUERIES["sheet_items"] = lambda s, d: H.sheet_items(cells(s, d)).select("book", "list", F.col("pos.sheet_no").alias("sheet_no"), F.col("pos.row").alias("row"), "name", "code", "data_type", F.array_join("values", "|").alias("values"), "value", "expression", "unit", "sheet")
ORACLE_SQL["sheet_items"] = f"WITH {_ITEMS} SELECT book, list, pos[1] AS sheet_no, pos[2] AS row, name, code, data_type, array_to_string(vals, '|') AS values, value, expression, unit, sheet FROM items"
_said = lambda k: F.array_join(F.transform(k, lambda x: F.concat_ws("/", x["code"], x["name"])), "|").alias(k)
QUERIES["sheet_catalog"] = lambda s, d: H.sheet_catalog(cells(s, d)).select("book", *map(_said, ("attributes", "calculations", "core_params")), F.size(F.filter("attributes", lambda a: a["data_type"] == "number")).alias("numbers"))
ORACLE_SQL["sheet_catalog"] = f"WITH {_ITEMS} SELECT book, {', '.join(f'''coalesce(string_agg(code || '/' || name, '|' ORDER BY pos) FILTER (list = '{k}'), '') AS {k}''' for k in ('attributes', 'calculations', 'core_params'))}, count(*) FILTER (list = 'attributes' AND data_type = 'number') AS numbers FROM items GROUP BY 1"
