"""Rules in prose: worked cases for each form of clause, and what they change in a row's calculation."""

from pyspark.sql import functions as F

from termwright.functions import text as X
from termwright.operators import audit, matching, rules


def made(spark, *paragraphs):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paragraphs)], "n int, paragraph string")
    return {r.n: r for r in rules.extract_rules(df).collect()}


def test_each_form(spark):
    got = made(
        spark,
        'E.1.3 现浇墙、各种柱及“构造柱”应按本附录中墙相关项目编码列项。',
        "墙包括面积≤0.3m2的洞口、门项目和其他，楼板",
        '本标准中的栏杆的"材质"可描述为木材、"不锈钢"或铁件和铁；其余。',
        '踢脚线应在项目特征中增加"高度"、"厚度"描述',
        "A.1 基础工程量按设计图示体积计算，垫层并入基础面积内",
        "H2 模板列项",
        "工作内容包括运输",
        "单独说明",
        None,
        "",
    )
    assert sorted(got) == [0, 1, 2, 3, 4]
    assert (got[0].types, got[0].scope_terms, got[0].target_terms) == (["component_route"], ["构造柱", "现浇墙", "柱"], ["墙"])
    assert (got[1].types, got[1].target_terms, got[1].scope_terms, got[1].codes) == (["component_route", "calculation_hint"], ["墙"], ["洞口", "门", "楼板"], ["MJ"])
    assert (got[2].types, got[2].feature_names, got[2].feature_examples) == (["feature_hint"], ["材质", "不锈钢"], ["不锈钢", "木材", "铁件"])
    assert got[2].scope_terms == ["的栏杆"]
    assert (got[3].types, got[3].scope_terms, got[3].feature_names) == (["feature_hint"], ["踢脚线"], ["高度", "厚度"])
    assert (got[4].types, got[4].codes, got[4].keywords) == (["calculation_hint"], ["TJ", "MJ"], ["体积", "面积", "并入"])
    # The scope of what is calculated, and the one that is merged, up to its word.
    assert got[4].scope_terms == ["基础", "垫层"]


def test_paragraphs_of_a_region(spark):
    text = "前言应按规定\nA.1 墙应按\n砖墙列项\n说明\nB.2 无关\nC.3 墙应按 砖墙列项 说明\n"
    df = spark.createDataFrame([("p", 1, text), ("p", 2, "D.9 墙应按 砖墙列项 说明"), ("q", 1, text), ("p", 3, None)], "path string, pos long, text string")
    got = sorted((r.path, r.pos.region, r.pos.part, r.paragraph) for r in rules.chapter_paragraphs(df).collect())
    # What says the same under another number is one paragraph of its path.
    assert got == [("p", 1, 1, "A.1 墙应按 砖墙列项 说明"), ("q", 1, 1, "A.1 墙应按 砖墙列项 说明")]


def test_codes_of_words(spark):
    texts = ["模板", "模板面积", "并入", "净长", "中心线长度", "数量", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    got = {r.n: r.c for r in df.select("n", rules.calculation_codes(F.col("t")).alias("c")).collect()}
    assert [got[i] for i in range(7)] == [[], ["MBMJ", "MJ"], ["TJ"], ["JCD"], ["JCD", "CD"], ["SL"], []]


def test_preference_of_words_chapter_and_unit(spark):
    rows = [("墙", "按体积", "孔", ["MJ"]), ("墙", "", "孔", ["MJ", "CD"]), ("墙", "", "孔", []), ("墙", None, "处", None), ("墙", "", "项", None), ("墙", "", "榀", None), ("墙", "", "m2", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, name string, rule string, unit string, chapter array<string>")
    got = {r.n: r.c for r in df.select("n", matching.calculation_preference(F.col("name"), F.col("rule"), F.col("unit"), F.col("chapter")).alias("c")).collect()}
    assert got[0][0] == "TJ" and got[1] == ["MJ", "CD"] and [got[i] for i in range(2, 7)] == [["SL"], ["SL"], ["SL"], [], ["MJ", "TYMJ", "MBMJ"]]


def test_rules_choose_the_calculation(spark):
    """From prose to a row's calculation, without hand-made columns."""
    regions = spark.createDataFrame([("c > x", 1, "A.1 洞口工程量按设计图示数量计算")], "path string, pos long, text string")
    rows = spark.createDataFrame([("c", 7, "洞口封堵", "", "", "c > y", "m3"), ("c", 8, "砖", "", "", "c > y", "m3")], "chapter string, row_id long, name string, features string, rule string, path string, unit string")
    hints = rules.rule_hints(rows, rules.chapter_rules(regions))
    own = rows.join(hints.select("row_id", F.col("codes").alias("chapter_codes")), "row_id", "left").withColumn("component", F.lit("k"))
    calculations = spark.createDataFrame([("k", "SL", "SL 总数", "个", 0), ("k", "TJ", "体积", "m3", 1)], "component string, calc_code string, calc_name string, calc_unit string, pos int")
    assert {r.row_id: r.calc_code for r in matching.select_calculation(own, calculations).collect()} == {7: "SL", 8: "TJ"}


def test_value_types(spark):
    rows = [([], "", "截面类型", "m"), ([], "", "厚度做法", ""), ([], "", "墙厚", ""), (["", None], "7", "备注", ""), (["1", "+2.5"], "", "名称", ""), (["1", "x"], "1", "厚", "m"), (None, None, None, "m2"), (None, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, v array<string>, s string, name string, unit string")
    got = {r.n: r.t for r in df.select("n", X.infer_value_type(F.col("v"), F.col("s"), F.col("name"), F.col("unit")).alias("t")).collect()}
    assert [got[i] for i in range(8)] == ["text", "text", "number", "number", "number", "text", "number", "text"]


def test_unpatched_pages_keep_their_block(spark):
    old = "x\n<!-- reviewed -->\n- old\n<!-- /reviewed -->"
    pages = spark.createDataFrame([("a", old), ("b", old)], "component string, content string")
    patch = spark.createDataFrame([("a", "l", True)], "component string, label string, matched boolean")
    got = {r.component: r.content for r in audit.reviewed_upsert(pages, patch).collect()}
    assert got == {"a": "x\n<!-- reviewed -->\nmatched:\n- l\n<!-- /reviewed -->", "b": old}


def test_regions_of_one_place_are_not_mixed(spark):
    rows = [("p", 1, "A.1 墙应按 砖墙列项\n说明"), ("p", 1, "B.2 柱应按 石柱列项\n其他")]
    df = spark.createDataFrame(rows, "path string, pos long, text string")
    assert sorted(r.paragraph for r in rules.chapter_paragraphs(df).collect()) == ["A.1 墙应按 砖墙列项 说明", "B.2 柱应按 石柱列项 其他"]


def test_what_says_the_same_is_captured_once(spark, monkeypatch):
    own, seen = rules.written, {}

    def written(df, name):
        out = own(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(rules, "written", written)
    df = spark.createDataFrame([(f"p{i}", i, f"A.{i} 现浇墙应按本附录中墙相关项目编码列项。") for i in range(40)], "path string, pos long, text string")
    got = rules.chapter_rules(df).collect()
    assert len(got) == 40 and {tuple(r.scope_terms) for r in got} == {("现浇墙",)} and len({r.rule_id for r in got}) == 40
    assert seen["said"] == 1
