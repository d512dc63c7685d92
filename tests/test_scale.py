"""What must not grow faster than its input: rows beside their groups, equal keys, repeated work."""

import re
import time

from pyspark.sql import functions as F

from termwright.operators import entries, lines, matching, positions, retrieval, rules, selection
from termwright.plans import match_queries
from termwright.sources import readers

ROW = "struct<code:string,name:string,features:string,unit:string,rule:string,work:string>"


def seconds(df) -> float:
    began = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - began


def repeated(df) -> list[str]:
    """The columns that a generator repeats beside each of the rows that it makes of them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [made for made, kept in re.findall(r"Generate \w+\((\w+#\d+)[^)]*\), \[([^\]]*)\]", plan) if made in kept.split(", ")]


def test_rows_of_a_region_do_not_carry_their_table(spark):
    df = spark.createDataFrame([("r", ["A", "b"], [("续表 1", [("1", "x", "", "㎡", "", ""), ("1", "y", "", "", "", ""), (" ", "z", "", "", "", "")])])], f"region_id string, path array<string>, tables array<struct<title:string,rows:array<{ROW}>>>")
    made = readers.flatten_bill_rows(df)
    assert [tuple(r) for r in made.collect()] == [("1", "r", "A > b", "表1", "x", "m2")]
    assert not repeated(made)


def test_rows_of_a_table_read_its_text_once(spark):
    n = 3000
    rows = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(i.cast("string").alias("code"), *[F.lit("x").alias(c) for c in ("name", "features", "unit", "rule", "work")]))
    table = F.struct(F.lit("T").alias("title"), F.repeat(F.lit("word "), 100_000).alias("raw_text"), rows.alias("rows"))
    df = spark.range(1).select(F.lit(1).alias("region_no"), F.lit("A > b").alias("path"), F.lit("say").alias("text"), F.array(table).alias("tables"))
    made = entries.region_entries(df)
    assert not repeated(made) and seconds(made) < 20
    got = made.groupBy("stage").agg(F.count("*").alias("n"), F.count_distinct("parent_id").alias("parents")).collect()
    assert {r.stage: (r.n, r.parents) for r in got} == {"step1_rule": (1, 0), "step1_table": (1, 1), "step1_row": (n, 1)}


def test_chapters_and_titles_that_come_often_meet_once(spark):
    many = spark.range(100_000).select(F.concat(F.lit("chapter "), (F.col("id") % 2).cast("string")).alias("chapter"))
    df = retrieval.chapter_lookup(many, many.select(F.col("chapter").alias("title")))
    assert seconds(df) < 30
    assert sorted(map(tuple, df.collect())) == [("chapter 0", "chapter 0"), ("chapter 1", "chapter 1")]


def test_rows_and_rules_alike_meet_once(spark):
    n = 6000
    rows = spark.range(n).select(F.lit("c").alias("chapter"), F.col("id").alias("row_id"), F.concat(F.lit("wall "), "id").alias("name"), F.lit("").alias("features"), F.lit("").alias("rule"), F.lit("c > p").alias("path"))
    own = spark.range(n).select(
        F.lit("c").alias("chapter"), F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("rule_id"), F.col("id").alias("pos"), F.array(F.lit("component_route")).alias("types"), F.array(F.lit("wall"), F.concat(F.lit("unseen "), "id")).alias("scope_terms"),
        F.array(F.concat(F.lit("f"), (F.col("id") % 3).cast("string"))).alias("feature_names"), F.array().cast("array<string>").alias("keywords"), F.array(F.lit("t")).alias("target_terms"), F.array().cast("array<string>").alias("codes"),
    )
    attached = rules.attach_rules(rows, own)
    hints = rules.rule_hints(rows, own)
    assert seconds(attached) + seconds(hints) < 40
    got = {(r.rule_id, r.rank, r.score, tuple(r.terms)): r.n for r in attached.groupBy("rule_id", "rank", "score", "terms").agg(F.count("*").alias("n")).collect()}
    assert got == {(f"r{i:05}", i + 1, 0.63, ("wall",)): n for i in range(8)}
    assert [tuple(r) for r in hints.groupBy("features", "targets", "codes").count().collect()] == [(["f0", "f1", "f2"], ["t"], [], n)]


def test_every_query_is_scored_with_every_row(spark):
    asked = spark.createDataFrame([(i, f"word{i}", None) for i in range(3)], "id long, text string, component string")
    rows = spark.createDataFrame([(i, f"word{i} x", None) for i in range(4)], "id long, text string, component string")
    got = {(r.query_id, r.id) for r in retrieval.hybrid_score(asked, rows).collect()}
    assert got == {(q, i) for q in range(3) for i in range(4)}


def test_each_distinct_name_is_scored_once(spark, tmp_path):
    k = F.col("id")
    part = spark.range(60_000).select(k.alias("p_partkey"), F.concat(F.lit("ring "), (k % 60).cast("string")).alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), (k % 50).cast("int").alias("p_size"))
    part.write.parquet(f"{tmp_path}/part.parquet")
    df = match_queries.score_names(spark, str(tmp_path))
    assert seconds(df) < 40
    # Least keys of the names are 0 to 59; a row meets those that have its number modulo 7.
    assert df.count() == sum(len(range(i % 7, 60, 7)) for i in range(60_000))


def test_words_become_lines_and_cells_once(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 0.0, 1.0, 1.0, "a")], "doc long, page long, x0 double, y0 double, x1 double, y1 double, word string")
    plan = positions.word_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    cells = positions.line_cells(positions.table_lines(positions.word_lines(df)))
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    # The six cells, the words' places and the line's text: none of them is computed again for a filter.
    assert plan.count("transform(") <= 8


def test_a_line_of_words_that_spans_batches_stays_whole(spark):
    n = 25_000
    df = spark.range(n).select(F.lit(1).alias("doc"), F.lit(1).alias("page"), F.col("id").cast("double").alias("x0"), F.lit(0.0).alias("y0"), (F.col("id") + 1).cast("double").alias("x1"), F.lit(1.0).alias("y1"), F.lit("w").alias("word"))
    more = df.limit(2).select("doc", "page", "x0", F.lit(50.0).alias("y0"), "x1", F.lit(51.0).alias("y1"), "word")
    got = positions.word_lines(df.unionByName(more)).select("line_no", F.size("words").alias("n"), F.length("text").alias("t")).orderBy("line_no").collect()
    assert [tuple(r) for r in got] == [(0, n, n), (1, 2, 2)]


def test_items_of_a_file_do_not_carry_it(spark):
    n = 4000
    text = "[" + ",".join(f'{{"name":"{"x" * 500}{i}"}}' for i in range(n)) + "]"
    files = spark.createDataFrame([("c", "", ["t"], "a/b.json", text)], "collection string, source_type string, tags array<string>, path string, text string")
    made = retrieval.corpus_documents(files, ("name",))
    plan = made._jdf.queryExecution().executedPlan().toString()
    kept = re.findall(r"\[([^\[\]]*)\], false, \[__part", plan)
    assert kept and not any(c in k for k in kept for c in ("text#", "__json#"))
    assert not repeated(made) and seconds(made) < 30
    assert made.count() == n


def test_rows_of_a_name_and_unit_are_ranked_once(spark):
    n = 30_000
    rows = spark.range(n).select(F.col("id").alias("row_id"), F.concat(F.lit("deep ring "), (F.col("id") % 3).cast("string")).alias("name"), F.when(F.col("id") % 2 == 0, "m2").alias("unit"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None, "m2")], "row_id long, name string, unit string"))
    catalog = spark.createDataFrame([("deep ring 0", 0, ["deep ring 0"], ["m2"]), ("deep ring 1 x", 1, ["deep ring 1 x"], ["m3"])], "component string, pos long, names array<string>, units array<string>")
    index = matching.alias_index(matching.component_aliases(catalog.where("pos < 0").select("component", "pos")))
    asked = []
    ranked, matching._ranked = matching._ranked, lambda r, *rest: asked.append(r.count()) or ranked(r, *rest)
    try:
        made = matching.rank_candidates(rows, catalog, index)
    finally:
        matching._ranked = ranked
    assert asked == [6]
    got = {r.row_id: (r.component, r.score, r.basis) for r in made.where("rank = 1").collect()}
    assert len(got) == n and got[0][:2] == ("deep ring 0", 1.0) and got[1][0] == "deep ring 1 x" and -1 not in got


def test_a_source_of_many_names_is_dealt_over_tasks(spark):
    n = 200
    components = spark.range(n).select(F.concat(F.lit("c"), "id").alias("component"))
    aliases = components.agg(F.lit("s").alias("source"), F.collect_set("component").alias("aliases"))
    made = selection.expand_terms(components, aliases, heavy=1000)
    assert "__salt" in made._jdf.queryExecution().analyzed().toString()
    got = {tuple(r) for r in made.collect()}
    assert got == {(f"c{i}", t) for i in range(n) for t in [*(f"c{k}" for k in range(n)), "s"]}


def test_regions_are_summed_up_where_they_are(spark):
    words, n = ["ab", "bc", "c", "混凝土", "zz"], 300
    rows = [(i, words[i % 5] + words[i // 5 % 5], words[i // 3 % 4] * (i % 3), i % 7, i % 4, f"g{i % 3}" if i % 11 else None, i % 13) for i in range(n)]
    df = spark.createDataFrame([(i, t, "", "", "", b, x, y, g, s) for i, t, b, x, y, g, s in rows], "region int, title string, path string, table_titles string, headers string, body string, tables int, rows int, group string, size int")
    terms = spark.createDataFrame([(b, w) for b in range(6) for k, w in enumerate(words) if (b + k) % 3], "batch int, term string")
    scored = selection.score_regions(df.repartition(5), terms)
    few = selection.score_regions(df.repartition(5), terms, best=True)
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    # No pair of a batch and a region is shuffled, and those that a better one of their group is beside are left out.
    assert "Aggregate" not in plan.split("MapInArrow")[0] and few.count() < scored.count() / 3
    own = lambda s: sorted(map(tuple, selection.budget_select(s, df, terms, 30, 4).collect()))
    assert own(few) == own(scored) and len(own(few)) > 6


def test_sums_are_whole_in_blocks_and_of_repeated_keys(spark):
    from termwright.functions.found import Best, found_sums

    words = ["ab", "b", "abc", "x", "yx"]
    texts = [(i, words[i % 5] + words[i // 5 % 5] + words[i // 25 % 5]) for i in range(125)]
    terms = spark.createDataFrame([(b, w) for b in ("p", "q", None) for w in words if w != b], "batch string, term string")
    for df in (texts, [*texts, (3, "abc"), (None, "x"), (None, "ab")]):
        frame = spark.createDataFrame(df, "id int, text string")
        expected = {}
        for i, t in df:
            for b in ("p", "q", None):
                if any(w in t for w in words):
                    expected[i, b] = expected.get((i, b), 0) + sum(len(w) for w in words if w in t)
        for most in (100, 2):
            got, _ = found_sums(frame, "id", ["text"], terms, lambda t, k: len(t), most=most)
            assert {(r.id, r.batch): r.points for r in got.collect()} == expected
            best, few = found_sums(frame, "id", ["text"], terms, lambda t, k: len(t), Best(3, (("id", "ascending"),)), most)
            assert few == (most == 100 and len(df) == 125) and best.count() == (9 if few else len(expected)) or few


def test_rows_are_hashed_where_they_are_scored(spark):
    rows = spark.createDataFrame([(i, f"T {i % 3}", f"wall {i} m2 Σ") for i in range(40)], "id long, title string, text string")
    asked = rows.where("id < 5").select("id", "text", F.lit("").alias("component"))
    got = {block: retrieval.top_scored(asked, rows, 3, retrieval.KNOWLEDGE, block=block) for block in (2048, 2)}
    # A text comes to one process, once.
    assert got[2048]._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, got[2048].collect())) == sorted(map(tuple, got[2].collect()))


def test_a_page_is_made_once(spark):
    from termwright.functions import text as X

    page = F.concat(F.lit("---\nx: y\n---\n# A\n**N**: a, b\n## T \n| h |\n# no\n"), "t")
    df = spark.createDataFrame([("## T\n| 1 |\n",), ("### T\n| 1 |\n#x\n#### y\n| 2 |\n| 3 |\n# z\n| 4 |\n",), ("#" * 30_000 + "\n##\n T\n" + "#x\n" * 9000 + "| 5 |",)], "t string")
    made = df.select(X.page_summary(page, {"T": 3, "None": 1}, ("N", "M"), 40).alias("s"), X.extract_section(F.col("t"), "T").alias("x"))
    got = made.collect()
    assert [r.s for r in got] == ["T: | h |\nN: a, b"] * 3
    assert [len(r.x) for r in got] == [5, 27, 3 * 9000 + 5] and got[1].x == "| 1 |\n#x\n#### y\n| 2 |\n| 3 |"
    plan = df.select(X.page_summary(page, {"T": 3, "None": 1}, ("N", "M"), 40).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("# A") == 1


def test_lines_of_tables_are_shuffled_once(spark):
    df = spark.createDataFrame([(1, 0, "编码", "header")], "doc long, pos long, line string, tag string")
    plan = lines.table_segments(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_refresh_is_dealt_over_as_many_tasks_as_there_are(spark):
    from termwright.plans import source_queries

    df = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("step-en").alias("stage"), F.lit("x").alias("text"))
    plan = source_queries.changed(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(doc_id" in plan and "REPARTITION_BY_NUM" not in plan
