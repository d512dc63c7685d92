"""Properties and worked cases of the operators."""

from pyspark.sql import functions as F

from termwright.functions import text as X
from termwright.operators import audit, catalog, lines, matching, merge, retrieval, selection


def values(spark, expr, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_names(spark):
    assert values(spark, X.normalize_text, "（钢筋混凝土）墙、 ", None, "", "雨蓬:砼") == ["混凝土墙", "", "", "雨篷混凝土"]
    assert values(spark, X.strip_affixes, "现浇墙构件", "现浇", "构件", "预制砼", None) == ["墙", "现浇", "构件", "砼", ""]
    assert values(spark, X.normalize_unit, "㎡", "M3", "n?", None) == ["m2", "m3", "m3", ""]
    assert values(spark, X.core_tokens, "挖单独石方", "", "挖") == [["单独石方", "石方"], [], ["挖"]]


def test_features(spark):
    assert values(spark, X.clean_features, "1、厚度：5\n2 - x\n\n3 y\n4", "", None) == ["1.厚度:5\n2.x\n4.3.y", "", ""]
    got = values(spark, lambda c: matching.feature_values(c), "厚度大于等于200mm", "强度等级C30", "墙体", "")
    assert [(g.label, g.value) for g in got] == [("厚度", ">=200mm"), ("强度等级", "C30"), ("墙体", ""), ("", "")]


def test_score_names_keeps_the_order_of_rules(spark):
    df = spark.createDataFrame([("矩形柱", ["矩形柱"]), ("现浇矩形柱", ["柱子", "矩形柱"]), ("abcx", ["abcd", "abcx1"]), ("", ["a"])], "q string, names array<string>")
    got = [(r.s.score, r.s.basis) for r in df.select(matching.score_names(F.col("q"), F.col("names")).alias("s")).collect()]
    assert got[0] == (1.0, "exact") and got[1] == (0.95, "normalized") and got[2] == (0.88, "contains") and got[3] == (0.0, "fuzzy")


def test_block_pairs_equals_all_pairs(spark):
    words = ["ab", "abc", "xyz", "xyzw", "a", "", "bca", "qq", "abcdefgh", "abcdefgx", "zzz"]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "row_id int, name string")
    names = spark.createDataFrame([(w, w) for w in words], "component string, name string")
    want = {(i, b) for i, a in enumerate(words) for b in words if a and b and (a in b or b in a or len({*a} & {*b}) / len({*a} | {*b}) >= 0.55)}
    assert {(r.row_id, r.component) for r in matching.block_pairs(rows, names).collect()} == want


def test_block_pairs_over_a_small_alphabet(spark):
    """Every character is frequent: keys are heavy, and dealt over salts the pairs are the same."""
    import random

    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[: rng.choice((4, 9, 26))]) for _ in range(rng.randrange(1, 14))) for _ in range(220)})
    words += [w[2:9] for w in words[:40] if len(w) > 5]
    want = {(i, b) for i, a in enumerate(words) for b in words if a in b or b in a or len({*a} & {*b}) / len({*a} | {*b}) >= 0.55}
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "row_id int, name string")
    names = spark.createDataFrame([(w, w) for w in words], "component string, name string")
    for heavy in (20, 10**6):
        assert {(r.row_id, r.component) for r in matching.block_pairs(rows, names, heavy=heavy).collect()} == want


def test_table_segments_against_a_fold(spark):
    """Random codes, headings and header runs: windows say what a walk from line to line says."""
    import random

    rng = random.Random(9)
    headers = ["项目编码", "项目名称", "项目特征", "工作内容"]
    rows, want = [], []
    for doc in range(60):
        pos, walk = 0, []
        for _ in range(rng.randrange(1, 30)):
            kind = rng.choice(("start", "start", "code", "heading", "text"))
            for line in headers if kind == "start" else [{"code": "010101001 x", "heading": "E.1 head", "text": "plain"}[kind]]:
                rows.append((doc, pos, line))
                walk.append((pos, kind if line in ("010101001 x", "E.1 head") or line == headers[0] else ""))
                pos += 1
        start, seen, number, before = False, False, 0, ""
        for at, kind in walk:
            # A run of headers goes on where one follows another at once.
            first = kind == "start" and before != "header"
            if first and not start:
                start, seen, number = True, False, number + 1
            elif kind == "code" and start:
                seen = True
            elif kind == "heading" and start and seen:
                start = False
            if start:
                want.append((doc, at, number))
            before = "header" if kind in ("start", "") and rows[-len(walk) + walk.index((at, kind))][2] in headers else kind
    df = spark.createDataFrame(rows, "doc int, pos int, line string")
    got = sorted((r.doc, r.pos, r.table_no) for r in lines.table_segments(lines.classify_lines(df)).collect())
    assert got == sorted(want) and len({r[:1] for r in got}) > 20


def test_heavy_keys_are_dealt(spark):
    left = spark.createDataFrame([("hot", i) for i in range(400)] + [("cold", i) for i in range(3)] + [(None, 1)], "k string, l int")
    right = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1), ("none", 2), (None, 1)], "k string, r int")
    out = matching.dealt_join(left, right, ["k"], 500)
    assert out.columns == ["k", "l", "r"] and out.count() == out.distinct().count() == 400 * 50 + 3


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "row_id long, name string, unit string")
    cat = spark.createDataFrame([], "component string, pos long, names array<string>, units array<string>")
    index = matching.alias_index(matching.component_aliases(cat.select("component", "pos")))
    assert matching.rank_candidates(rows, cat, index).count() == 0
    assert retrieval.hashed_vectors(spark.createDataFrame([], "id long, text string")).count() == 0


def test_conflicts(spark):
    m = spark.createDataFrame(
        [("a", 1, "x", [], "matched", 0.9, "auto", 1, "exact"), ("a", 2, "y", ["z"], "matched", 0.1, "auto", 0, "semantic_match"), ("b", 3, None, ["z"], "candidate_only", 0.3, "pending", 0, "none")],
        "source string, pos long, selected string, candidates array<string>, status string, confidence double, review string, evidence int, match_type string",
    )
    merged = merge.merge_candidates(m)
    by = {r.source: r for r in merged.collect()}
    assert by["a"].status == "conflict" and by["a"].candidates == ["x", "y", "z"] and by["b"].status == "candidate_only"
    done = {r.source: r for r in merge.resolve_conflicts(merged, m).collect()}
    assert done["a"].selected == "x" and done["a"].resolved and not done["b"].resolved


def test_complete_has_exactly_the_expected_keys(spark):
    rows = spark.createDataFrame([("a", "matched"), ("q", "matched")], "source string, status string")
    expected = spark.createDataFrame([("a",), ("b",), ("b",)], "source string")
    assert {tuple(r) for r in merge.ensure_complete(rows, expected, "source", {"status": "unmatched"}).collect()} == {("a", "matched"), ("b", "unmatched")}


def test_pack_batches_loses_nothing(spark):
    c = spark.createDataFrame([("b", str(i), i, i % 7) for i in range(50)], "bucket string, component string, pos long, size int")
    got = selection.pack_batches(c, 5, 12).collect()
    assert sorted(int(r.component) for r in got) == list(range(50))
    sizes = {}
    for r in got:
        sizes.setdefault(r.batch, []).append(int(r.component) % 7)
    assert all(len(s) <= 5 and (sum(s) <= 12 or len(s) == 1) for s in sizes.values())


def test_chunks(spark):
    long = "x" * 25
    got = {r.id: r.c for r in spark.createDataFrame(
        [(1, " aa\n\nbb "), (2, ""), (3, None), (4, "a1234\n \nb1234\n\nc1234567"), (5, f"{long}\n\nab"), (6, f"ab\n\n{long}"), (7, " \u3000\r\n"), (8, "same\n\nsame")], "id long, t string"
    ).select("id", retrieval.chunks(F.col("t"), 12, 3).alias("c")).collect()}
    assert got[1] == ["aa\n\nbb"] and got[2] == got[3] == got[7] == [] and got[8] == ["same\n\nsame"]
    # The last three characters lead the next chunk.
    assert got[4] == ["a1234\n\nb1234", "234\n\nc1234567"]
    # A long paragraph is sliced only where nothing is open before it.
    assert got[5] == [long[:12], long[9:21], long[18:], "ab"] and got[6] == ["ab", f"ab\n\n{long}"]


def test_chunks_cover_the_text(spark):
    text = "\n\n".join(f"paragraph {i} " + "x" * (1 + i * 37 % 400) for i in range(40)) + "\n\n" + "y" * 5000
    got = retrieval.chunk_text(spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, text string"), 300, 40).collect()
    assert {r.id for r in got} == {1} and [r.chunk_no for r in got] == list(range(len(got)))
    assert all(any(f"paragraph {i} " in r.chunk for r in got) for i in range(40)) and any("y" * 5000 in r.chunk for r in got)


def test_corpus_documents(spark):
    files = [
        ("c", "", ["t", "t "], "d/a.json", '[{"title": "T", "text": "one", "tags": ["u", "t"], "n": 3}, "plain", {"text": ""}]'),
        ("c", "kb", None, "d/b.json", '{"x": {"k": 1}, "y": 2, "z": [1]}'),
        ("c", "", [], "d/c.json", '{"y": 2}'),
        ("c", "", [], "d/d.json", "{broken"),
        ("c", "", [], "d/e.jsonl", '{"name": "n1", "text": "r"}\n\n{"text": "s"}\n'),
        ("c", "", [], "d/f.md", "\n# Head\nbody"),
        ("c", "", [], "d/g.txt", "  "),
        ("c", "", [], "d/h.txt", None),
    ]
    df = spark.createDataFrame(files, "collection string, source_type string, tags array<string>, path string, text string")
    got = {r.source_ref: r for r in retrieval.corpus_documents(df, ("text",), ("n",)).collect()}
    assert {k: r.content for k, r in got.items()} == {
        "d/a.json#item-1-chunk-1": "text: one", "d/a.json#item-2-chunk-1": "plain", "d/a.json#item-3-chunk-1": '{"text":""}', "d/b.json#x-chunk-1": '{"k":1}', "d/b.json#z-chunk-1": "[1]",
        "d/c.json#chunk-1": '{"y":2}', "d/d.json#chunk-1": "{broken", "d/e.jsonl#item-1-chunk-1": "text: r", "d/e.jsonl#item-2-chunk-1": "text: s", "d/f.md#chunk-1": "# Head\nbody",
    }
    first = got["d/a.json#item-1-chunk-1"]
    assert first.title == "T" and first.tags == ["t", "u"] and first.source_type == "json"
    assert first.metadata == {"n": "3", "file_suffix": ".json", "source_name": "a.json", "ingest_mode": "json_payload", "item_index": "1", "chunk_index": "1"}
    assert got["d/a.json#item-2-chunk-1"].title == "a item 2" and got["d/b.json#x-chunk-1"].title == "b | x" and got["d/b.json#x-chunk-1"].source_type == "kb"
    assert got["d/e.jsonl#item-1-chunk-1"].title == "n1" and got["d/f.md#chunk-1"].title == "Head" and got["d/c.json#chunk-1"].title == "c"
    assert len({r.entry_id for r in got.values()}) == len(got)


def test_edit_records(spark):
    rows = [("a ", "x, y；z\n\nx", "1.5", False), (" ", None, "bad", False), ("b", None, None, True), (None, "q", "-1", None), (None, None, None, None)]
    got = audit.edit_records(spark.createDataFrame(rows, "source string, names string, confidence string, deleted boolean"), ("names",)).collect()
    assert sorted((r.source or "", r.names, r.confidence) for r in got) == [("", ["q"], 0.0), ("a", ["x", "y", "z", "x"], 1.0)]


def test_fill_and_shift(spark):
    rows = spark.createDataFrame([(1, 1, 1, "", "1.a"), (1, 1, 2, "r", "2.b\n3.c"), (1, 1, 3, None, None)], "doc long, table_no long, pos long, rule string, work string")
    assert [r.work for r in lines.shift_split_work(rows).orderBy("pos").collect()] == ["", "1.a\n2.b\n3.c", None]
    assert [r.rule for r in lines.fill_shared(rows).orderBy("pos").collect()] == ["r", "r", "r"]


def test_review_queue(spark):
    m = spark.createDataFrame([(1, "matched", "auto"), (2, "matched", "pending"), (3, "unmatched", "")], "row_id long, status string, review string")
    assert {(r.row_id, r.review) for r in audit.review_queue(m).collect()} == {(2, "pending"), (3, "pending")}


def test_result_does_not_depend_on_partitions(spark):
    m = spark.range(200).select((F.col("id") % 7).cast("string").alias("source"), F.col("id").alias("pos"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("selected"), F.array().cast("array<string>").alias("candidates"), F.lit("matched").alias("status"), F.lit(0.5).alias("confidence"), F.lit("auto").alias("review"))
    one, many = (catalog.synonym_library(m.repartition(n)).orderBy("source").collect() for n in (1, 13))
    assert one == many


def test_outline_of_any_depth(spark):
    levels = [1, 2, 3, 4, 6, 4, 2, 4, 1]
    rows = spark.createDataFrame([(1, i, n, f"t{i}") for i, n in enumerate(levels)], "doc long, pos long, level int, title string")
    got = [(r.path, r.parent) for r in lines.outline_paths(rows).orderBy("pos").collect()]
    assert got[4] == ("t0 > t1 > t2 > t3 > t4", "t3") and got[5] == ("t0 > t1 > t2 > t5", "t2") and got[7] == ("t0 > t6 > t7", "t6") and got[8] == ("t8", None)
    assert [r.end for r in lines.region_bounds(rows).orderBy("pos").collect()] == [8, 6, 6, 5, 5, 6, 8, 8, None]
    text = {r.start: r.text for r in lines.region_lines(rows, rows.withColumnRenamed("title", "line")).collect()}
    assert text[1] == "t1\nt2\nt3\nt4\nt5" and text[8] == "t8" and len(text[0].split("\n")) == 8


def test_blank_rules_take_the_next_over_any_distance(spark):
    rules = ["", "", "", "r", "", "s", ""]
    rows = spark.createDataFrame([(1, 1, i, r, "") for i, r in enumerate(rules)], "doc long, table_no long, pos long, rule string, work string")
    assert [r.rule for r in lines.fill_shared(rows).orderBy("pos").collect()] == ["r", "r", "r", "r", "s", "s", "s"]


def test_tables_begin_at_headers_and_end_at_a_heading_after_a_code(spark):
    texts = ["E.1 概述", "表 E.1.1 墙", "项目编码", "", "项目名称", "项目特征", "单位", "E.1.2 not yet", "010101001", "砖墙", "续表", "编码", "名称", "E.2 next", "项目编码", "项目名称", "工作内容", "text", "编码", "名称", "特征", "单位", "010101002 柱"]
    df = lines.classify_lines(spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc long, pos long, line string"))
    got = {r.pos: r.table_no for r in lines.table_segments(df).collect()}
    assert got == {**{i: 1 for i in range(2, 13) if texts[i]}, **{i: 2 for i in range(18, 23)}}


def cell_lines(spark, rows, continuation):
    named = [(1, 1, i, continuation, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(named, "doc long, table_no long, pos long, continuation boolean, code string, name string, features string, unit string, rule string, work string")


def test_rows_from_cells_look_ahead(spark):
    # The lines before a code that begin a new work sequence belong to it.
    rows = [
        ("010102004", "挖淤泥", "深度", "", "以体积计算", ""),
        ("", "", "", "", "按图示", "1.开挖"),
        ("", "", "", "", "底面积", "支护"),
        ("", "挖石方", "", "", "", ""),
        ("010102005", "", "", "", "加工作面", "2.装车"),
        ("", "", "2.类别", "", "计算", "3.运输"),
    ]
    got = lines.rows_from_cells(cell_lines(spark, rows, False)).orderBy("row_no").collect()
    assert [(r.code, r.work, r.rule) for r in got] == [("010102004", "", "以体积计算"), ("010102005", "1.开挖\n支护\n2.装车\n3.运输", "按图示\n底面积\n加工作面\n计算")]
    assert got[1].name == "挖石方" and got[1].features == "2.类别"
    # A name right before a code belongs to it; what a continuation has before its first code too.
    rows = [("", "", "", "", "1.前", ""), ("", "头", "", "", "", ""), ("01O102002 沟", "土方", "", "m3", "", "1.a"), ("", "梁", "", "", "", ""), ("010102003", "", "", "", "", "2.b")]
    got = lines.rows_from_cells(cell_lines(spark, rows, True)).orderBy("row_no").collect()
    assert [(r.code, r.name, r.rule, r.work) for r in got] == [("010102002", "沟\n头\n土方", "1.前", "1.a"), ("010102003", "梁", "", "2.b")]
    assert [r.name for r in lines.rows_from_cells(cell_lines(spark, rows, False)).orderBy("row_no").collect()] == ["沟\n头\n土方", "梁"]
    assert lines.rows_from_cells(cell_lines(spark, rows[:2], True)).count() == 0


def test_row_fields(spark):
    texts = ["010101001 砖墙 1.x", "材质类别", "M3", "按体积计算", "2.运输", "尾", "010101002", "柱", "面", "说明"]
    df = spark.createDataFrame([(1, 1, i, t) for i, t in enumerate(texts)], "doc long, table_no long, pos long, line string")
    got = lines.row_fields(lines.code_sessions(lines.classify_lines(df))).orderBy("session").collect()
    assert tuple(got[0])[3:] == ("010101001", "砖墙", "M3", "", "", "1.x\n材质类别\n按体积计算\n2.运输\n尾")
    assert tuple(got[1])[3:] == ("010101002", "柱\n面", None, "说明", "", "")


def test_terms_are_found_inside_longer_runs(spark):
    regions = spark.createDataFrame(
        [(1, "现浇混凝土墙面", "附录E", "", "", "steel beam cover", 2, 40), (2, "其他", "x > 混凝土", "墙面表", "项目 砌筑", "", 0, 0), (3, "none", "", "", "", "砼 柱", 9, 9)],
        "region long, title string, path string, table_titles string, headers string, body string, tables int, rows int",
    )
    terms = spark.createDataFrame([("a", "混凝土"), ("a", "墙面"), ("b", "steel beam"), ("b", "砌筑"), ("c", "墙"), ("d", "nothing")], "batch string, term string")
    got = {(r.batch, r.region): (round(r.score, 9), r.hits) for r in selection.score_regions(regions, terms).collect()}
    assert got == {("a", 1): (13 + 12 + 0.6 + 1.5, 2), ("a", 2): (17.6, 2), ("a", 3): (5.55, 1), ("b", 1): (3 + 2.4 + 0.6 + 1.5, 1), ("b", 2): (4 + 0.8, 1), ("c", 1): (0.8 + 0.6 + 1.5, 1), ("c", 2): (0.8, 1)}
    groups = spark.createDataFrame([(1, "g", 2, 40, 500), (2, "h", 0, 0, 50), (3, "h", 9, 9, 70)], "region long, group string, tables int, rows int, size int")
    chosen = selection.budget_select(selection.score_regions(regions, terms), groups, terms, 560, 5).collect()
    assert sorted((r.batch, r.region, r.rank) for r in chosen) == [("a", 1, 1), ("a", 2, 2), ("b", 1, 1), ("b", 2, 2), ("c", 1, 1), ("c", 2, 2), ("d", 1, 1)]
    entries = spark.createDataFrame([(1, "现浇混凝土 墙面"), (2, "a steel beam"), (3, None)], "entry long, text string")
    assert {(r.batch, r.entry, r.score) for r in selection.prior_entries(entries, terms).collect()} == {("a", 1, 5), ("b", 2, 9), ("c", 1, 1)}
    assert selection.score_regions(regions, terms.limit(0)).count() == 0


def test_terms_in_blocks(spark):
    from termwright.functions.found import terms_found

    df = spark.createDataFrame([(1, "abcabc"), (2, None), (3, "xyz")], "id long, t string")
    terms = spark.createDataFrame([(t,) for t in ("a", "bc", "z", "q", "abc", "")], "term string")
    for most in (1, 2, 100):
        assert {r.id: r.found_t for r in terms_found(df, ["t"], terms, most).collect()} == {1: ["a", "abc", "bc"], 2: [], 3: ["z"]}


def test_rules_score_by_kind(spark):
    from termwright.operators import rules as rules_

    rows = spark.createDataFrame([("c", 1, "砖墙", "1.厚度", "按体积计算", "p"), ("c", 2, "柱", "", "", "x > 砖墙"), ("d", 3, "砖墙", "厚度", "", "")], "chapter string, row_id long, name string, features string, rule string, path string")
    rules = spark.createDataFrame(
        [("c", "r1", 1, ["component_route"], ["砖墙"], ["厚度"], ["体积", "面积"], ["t"], ["TJ"]), ("c", "r2", 2, ["feature_hint"], [], ["厚度"], [], ["t", "u"], []), ("c", "r3", 3, ["calculation_hint"], ["柱"], [], ["体积"], [], ["MJ"])],
        "chapter string, rule_id string, pos int, types array<string>, scope_terms array<string>, feature_names array<string>, keywords array<string>, target_terms array<string>, codes array<string>",
    )
    got = {(r.row_id, r.rule_id): (r.score, r.terms) for r in rules_.attach_rules(rows, rules).collect()}
    # r2 has 0.25 + 0.04 on row 1: below the least.
    assert got == {(1, "r1"): (0.96, ["砖墙", "厚度", "体积"]), (2, "r1"): (0.63, ["砖墙"]), (2, "r3"): (0.59, ["柱"])}
    hints = {r.row_id: (r.features, r.targets, r.codes) for r in rules_.rule_hints(rows, rules).collect()}
    assert hints == {1: (["厚度"], ["t"], ["TJ"]), 2: (["厚度"], ["t"], ["TJ", "MJ"])}


def test_direct_match(spark):
    from termwright.operators import direct

    items = spark.createDataFrame(
        [(1, "砖墙", "砖墙砌筑", "1.厚度：240mm、强度等级≥C30\n2.x@y", "m3", "", "以体积计算"), (2, "现浇（砖墙）构件", "墙", "厚度200mm", "m3", "按体积", ""), (3, "unknown", "a", "1.b", "", "", ""), (4, None, "a", "", "", "", "")],
        "row_id long, given string, name string, features string, unit string, rule string, work string",
    )
    cat = spark.createDataFrame([("砖墙", 1, ["砌体墙"]), ("柱", 2, None)], "component string, pos long, names array<string>")
    attributes = spark.createDataFrame([("砖墙", "墙厚", "QH", 0), ("砖墙", "砼标号", "TBH", 1)], "component string, name string, code string, pos int")
    calcs = spark.createDataFrame([("砖墙", "TJ", "体积", "m3", 0)], "component string, calc_code string, calc_name string, calc_unit string, pos int")
    got = {r.row_id: r for r in direct.direct_match(items, cat, attributes, calcs).collect()}
    assert [(got[i].component, got[i].basis, got[i].features, got[i].found, got[i].status, got[i].confidence) for i in (1, 2, 3, 4)] == [
        ("砖墙", "exact", 3, 2, "candidate_only", 0.55), ("砖墙", "alias", 1, 1, "matched", 0.9), (None, "none", 1, 0, "unmatched", 0.0), (None, "none", 0, 0, "unmatched", 0.0)
    ]
    assert got[1].calc_code == "TJ" and "x@y" in got[1].expressions
    rows = spark.createDataFrame([(1, " ", "q", "matched"), (2, "c", None, "candidate_only"), (3, "c", "q", "unmatched"), (4, None, " ", "matched")], "row_id long, quantity_component string, resolved_component_name string, match_status string")
    assert {(r.row_id, r.given) for r in direct.handoff_items(rows).collect()} == {(1, "q"), (2, "c")}
    assert tuple(direct.skip_counts(rows).collect()[0]) == (4, 1, 1) and direct.handoff_items(rows, "z").count() == 4


def test_entries_without_a_common_bucket_are_ranked(spark):
    queries = spark.createDataFrame([(1, "alpha beta", "c")], "id long, text string, component string")
    entries = spark.createDataFrame([(1, "", "alpha", "d", "step1"), (2, "", "zzz", "c", "step3"), (3, "", "alpha beta", "d", "step3"), (4, "t", None, None, "step1")], "id long, title string, text string, component string, stage string")
    got = retrieval.query_entries(queries, entries).orderBy("rank").collect()
    assert [r.id for r in got][:2] == ["1", "2"] and got[1].score == 0.23 and {r.id for r in got} == {"1", "2", "4"}
    assert retrieval.query_entries(queries.limit(0), entries).count() == 0 and retrieval.query_entries(queries, entries.limit(0)).count() == 0


def test_first_rows_of_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.col("id"))
    assert [r.id for r in catalog.first_rows(df.repartition(7), ["g"], [F.desc("id")], 4).where("g = 'hot'").orderBy("rank").collect()] == [4998, 4995, 4992, 4989]
