"""Knowledge entries and workbooks: worked cases."""

from pyspark.sql import functions as F

from termwright.operators import entries, retrieval, sheets

TABLES = "array<struct<title:string,raw_text:string,rows:array<struct<code:string,name:string,features:string,unit:string,rule:string,work:string>>>>"


def test_a_region_fans_out(spark):
    row = ("1", "墙", None, "m2", "", "")
    df = spark.createDataFrame([(1, "A > b", " say ", [("T", "raw " * 400, [row, row]), (None, None, [row])]), (2, None, None, None), (3, "", "x", [])], f"region_no int, path string, text string, tables {TABLES}")
    got = {r.source_ref: r for r in entries.collect_entries(df).collect()}
    assert sorted(got) == ["#rule", "A > b#rule", "A > b#table-1", "A > b#table-1-row-1", "A > b#table-1-row-2", "A > b#table-2-row-1"]
    rule, table = got["A > b#rule"], got["A > b#table-1"]
    assert rule.content == "章节路径: A > b\n规则说明:\nsay" and rule.parent_id is None and rule.chapter_title == "A"
    # Texts are whole, and each entry knows the one above it, where that has content.
    assert len(table.content) > 1600 and table.parent_id == rule.entry_id
    assert got["A > b#table-1-row-2"].parent_id == table.entry_id and got["A > b#table-2-row-1"].parent_id is None
    assert got["A > b#table-1-row-1"].content.split("\n")[3:5] == ["项目名称: 墙", "项目特征: "]
    assert got["#rule"].title == "Step1 章节规则 | region_3"


def test_entries_of_all_steps_are_read_by_pages_and_search(spark):
    regions = spark.createDataFrame([(1, "A", "walls and columns", [])], f"region_no int, path string, text string, tables {TABLES}")
    mappings = spark.createDataFrame([(1, "wall", "A", ["w"], 0.5), (2, None, "A", None, None)], "no int, source string, selected string, aliases array<string>, confidence double")
    synonyms = spark.createDataFrame([(1, "canon", "wall", None, ["wall", " x "])], "no int, canonical string, source string, selected string, sources array<string>")
    matches = spark.createDataFrame([(7, "c", "brick wall", "wall", "doc")], "row_id int, code string, name string, component string, document string")
    made = entries.collect_entries(regions, mappings, synonyms, matches, spark.createDataFrame([(3,)], "n int"))
    got = {r.stage: r for r in made.orderBy("source_ref").collect()}
    assert set(got) == {"step1_catalog", "step1_rule", "step2_mapping", "step2_synonym", "step3_match"} and got["step1_catalog"].content == '{"n":3}'
    assert got["step2_synonym"].component_type == "wall / x" and got["step2_synonym"].chapter_title == "canon"
    docs = entries.as_documents(made)
    pages = {(r.page_type, r.name): r.entries for r in retrieval.compile_pages(docs).collect()}
    assert pages["component", "wall"] == 2 and pages["chapter", "A"] == 3 and pages["overview", ""] == 6
    asked = spark.createDataFrame([(1, "brick wall", "wall")], "id long, text string, component string")
    best = retrieval.cosine_topk(asked, docs, 1).first()
    assert best.id == got["step3_match"].entry_id


def test_lists_in_quotes(spark):
    df = spark.createDataFrame([(1, ["a", "it's", 'x"', "b'\"c"]), (2, []), (3, None)], "n int, v array<string>")
    got = {r.n: r.s for r in df.select("n", entries.listed(F.col("v")).alias("s")).collect()}
    assert got == {1: str(["a", "it's", 'x"', "b'\"c"]), 2: "[]", 3: "[]"}


CELLS = "book string, sheet_no int, sheet string, row int, column string, value string"


def workbook(spark, *sheet_rows):
    return spark.createDataFrame([("b", no, name, i, c, v) for no, (name, rows) in enumerate(sheet_rows) for i, row in enumerate(rows) for c, v in row.items()], CELLS)


def test_workbook_lists(spark):
    df = workbook(
        spark,
        ("属性", [{"名称": "墙厚", "CODE": "a1", "数据类型": "TEXT", "可选值": "1、2"}, {"名称": " ", "CODE": None}, {"名称": "X", "CODE": "a2"}]),
        ("s", [{"名称": "截面", "CODE": "A1", "下拉": "x;x; y"}, {"名称": "only name", "CODE": "", "下拉": ""}]),
        ("计算", [{"名称": "体积", "CODE": "a2", "公式": "v", "表达式": "", "单位": "m3"}, {"名称": "", "CODE": "a2", "计量单位": "m"}]),
        ("d", [{"名称": "高", "CODE": "k", "属性值": "+3.5"}, {"名称": "备注", "CODE": "k2", "属性值": "n"}]),
        ("unknown", [{"名称": "no", "CODE": "no"}]),
    )
    r = sheets.sheet_catalog(df).first()
    # The second sheet's A1 counts, in the place of the first; A2 is a number by the unit of its calculation.
    assert [tuple(a)[:4] for a in r.attributes] == [("截面", "A1", "text", ["x", "y"]), ("X", "A2", "number", []), ("only name", "", "text", [])]
    assert [tuple(c)[:4] for c in r.calculations] == [("", "A2", "", "m")]
    assert [tuple(c)[:4] for c in r.core_params] == [("高", "K", "number", "+3.5"), ("备注", "K2", "text", "n")]


def test_kinds_of_sheets(spark):
    cells = {"属性值 here": ["名称"], "plain": ["名称", "CODE", "unit"], "Calc": ["x"], "CoreParams": ["y"], "none": ["名称", "CODE"], "feature": ["名称", "CODE", "属性值"], "t": ["名称", "CODE", "下拉", "属性值"]}
    df = spark.createDataFrame([("b", i, name, 1, c, "v") for i, (name, cs) in enumerate(cells.items()) for c in cs], CELLS)
    got = {r.sheet_no: r.kind for r in sheets.sheet_kinds(df).collect()}
    assert got == {0: "legacy_attributes", 1: "calculations", 2: "calculations", 3: "legacy_core_params", 5: "property_defaults", 6: "feature_attributes"}
    assert sheets.sheet_catalog(df.limit(0)).count() == 0
