"""Regions cut at titles inside pages, body pages, and tables from the places of words: worked cases."""

from pyspark.sql import functions as F

from termwright.operators import positions, regions

OUTLINE = "doc long, idx int, level int, title string, page int"


def cut(spark, entries, texts):
    outline = spark.createDataFrame([(1, i, *e) for i, e in enumerate(entries)], OUTLINE)
    pages = spark.createDataFrame([(1, p, t) for p, t in enumerate(texts, 1)], "doc long, page int, text string")
    return {r.idx: r for r in regions.region_text(outline, pages).collect()}


def test_regions_begin_and_end_inside_a_page(spark):
    got = cut(
        spark,
        [(1, "1 总 则", 1), (2, "1.1 Scope", 1), (2, "1.2 Not there", 2), (1, "附录 A 土石方", 3)],
        ["head 1总则 intro 1.1 SCOPE text one", "  two  ", "three 附录A 土石方 four", "five"],
    )
    assert (got[0].text, got[0].start_found, got[0].end_found, got[0].page_start, got[0].page_end) == ("1总则 intro 1.1 SCOPE text one\ntwo\nthree", True, True, 1, 3)
    # The next title is not found: the whole of its page belongs to both.
    assert (got[1].text, got[1].start_found, got[1].end_found, got[1].page_end) == ("1.1 SCOPE text one\ntwo", True, False, 2)
    assert (got[2].text, got[2].start_found, got[2].end_found) == ("two\nthree", False, True)
    assert (got[3].text, got[3].end_found, got[3].page_end) == ("附录A 土石方 four\nfive", False, 4)


def test_two_entries_on_one_page(spark):
    got = cut(spark, [(1, "E.1 wall", 1), (1, "E.2 wall", 1), (1, "E.3", 2)], ["wall of the title, E.1 wall a E.2 wall b", ""])
    # The whole title comes before its words alone, and the end is sought behind the start.
    assert (got[0].text, got[0].end_found) == ("E.1 wall a", True) and (got[1].text, got[1].end_found) == ("E.2 wall b", False)
    assert (got[2].text, got[2].start_found, got[2].page_end) == ("", False, 2)


def test_missing_pages_and_nulls(spark):
    got = cut(spark, [(1, None, 1), (1, "x", 9)], [None])
    assert (got[0].text, got[0].start_found, got[0].end_found) == ("", False, False) and got[1].text == ""


def test_body_pages(spark):
    rows = [(0, 1, "封面", 1), (1, 1, "Notes", 2), (2, 1, "目次", 3), (3, 1, "1 总则", 6), (4, 2, "More", 7), (5, 1, "附录A", 9), (6, 1, "条文说明", 11), (7, 1, "tail", 12)]
    outline = spark.createDataFrame([(1, *r) for r in rows] + [(2, 0, 1, "only", 1)], OUTLINE)
    classed = regions.body_pages(outline)
    got = {(r.doc, r.idx): (r.category, r.body_page) for r in classed.collect()}
    assert [got[1, i] for i in range(8)] == [("front", None), ("front", None), ("front", None), ("body", 1), ("body", 2), ("body", 4), ("back", None), ("body", 7)]
    assert got[2, 0] == ("front", None)
    pages = spark.createDataFrame([(d, p, "") for d in (1, 2) for p in range(1, 13)], "doc long, page int, text string")
    ranges = {r.doc: tuple(r)[1:] for r in regions.page_ranges(classed, pages).collect()}
    assert ranges == {1: (3, 5, 5, 6, 10), 2: (None, None, None, None, 12)}


def words(spark, lines, page=1):
    rows = [(1, page, float(x - 5), float(10 * i), float(x + 5), float(10 * i + 8), w) for i, line in enumerate(lines) for x, w in line]
    return spark.createDataFrame(rows, "doc long, page int, x0 double, y0 double, x1 double, y1 double, word string")


HEADER = [(50, "项目编码"), (150, "项目名称"), (250, "项目特征"), (350, "计量单位"), (450, "工程量计算规则"), (550, "工作内容")]


def test_words_go_to_the_nearest_column(spark):
    df = words(spark, [HEADER, [(50, "010101001"), (100, "left"), (101, "right"), (240, "1."), (260, "土"), (551, "1.挖")], [(9, "7")], [(350, "m3")]])
    cells = positions.line_cells(positions.table_lines(positions.word_lines(df))).orderBy("pos").collect()
    assert [(r.code, r.name, r.features, r.unit, r.work) for r in cells] == [("010101001left", "right", "1.土", "", "1.挖"), ("", "", "", "m3", "")]


def test_centres_are_carried_down(spark):
    """A later header without some columns takes their centres from the one before; a header in running text takes all."""
    moved = [(x + 40, w) for x, w in HEADER if w not in ("计量单位", "工程量计算规则")]
    pages = [words(spark, [HEADER, [(350, "m")]], 1), words(spark, [moved, [(355, "m2"), (190, "n")]], 2), words(spark, [[(100, "项目编码项目名称项目特征工作内容")], [(190, "n3")]], 3)]
    lines = positions.table_lines(positions.word_lines(pages[0].union(pages[1]).union(pages[2])))
    got = {r.table_no: list(r.centres) for r in lines.collect()}
    assert got == {1: [50, 150, 250, 350, 450, 550], 2: [90, 190, 290, 350, 450, 590], 3: [90, 190, 290, 350, 450, 590]}
    cells = positions.line_cells(lines).orderBy("table_no").collect()
    assert [(r.unit, r.name) for r in cells] == [("m", ""), ("m2", "n"), ("", "n3")]


def test_tables_end_at_titles_and_headings(spark):
    df = words(spark, [[(50, "续表A.1")], HEADER, [(150, "a")], HEADER, [(150, "b")], [(50, "E.1"), (90, "head")], [(150, "no")], [(50, "表B.2")], [(150, "between")], HEADER, [(150, "c")]])
    lines = positions.table_lines(positions.word_lines(df))
    assert [(r.table_no, r.name, r.continuation) for r in positions.line_cells(lines).orderBy("pos").collect()] == [(1, "a", True), (1, "b", True), (2, "c", False)]
    # Without a header that has all six, nothing is a table.
    assert positions.rows_from_words(words(spark, [[x for x in HEADER if x[1] != "计量单位"], [(50, "010101001")]])).count() == 0


def test_lines_of_words(spark):
    df = spark.createDataFrame([(1, 1, 0.0, y, 5.0, y + 4, w) for y, w in ((0.0, "a"), (2.9, "b"), (5.0, "c"), (5.1, "d"), (40.0, " "))] + [(1, 1, None, 1.0, 2.0, 3.0, "x")], "doc long, page int, x0 double, y0 double, x1 double, y1 double, word string")
    got = [(r.line_no, r.text) for r in positions.word_lines(df).orderBy("line_no").collect()]
    # The mean of a and b is 1.45: c is farther than 3 from it.
    assert got == [(0, "ab"), (1, "cd")]


def test_pages_are_not_taken_apart_into_letters(spark):
    outline = spark.createDataFrame([(1, 0, 1, "Σ-İΑΣ", 1), (1, 1, 1, "𝔸 — Ⅷ!b", 1)], OUTLINE)
    pages = spark.createDataFrame([(1, 1, "x ααΣ.. 𝟘 σ (i-α.Σ) one.　 𝔸\nⅧ𝟙 𝔸Ⅷ b two ")], "doc long, page int, text string")
    made = regions.region_text(outline, pages)
    assert [(r.text, r.start_found, r.end_found) for r in made.orderBy("idx").collect()] == [("σ (i-α.Σ) one.　 𝔸\nⅧ𝟙", True, True), ("𝔸Ⅷ b two", True, False)]
    # One pass over a page, not a pattern for each of its letters.
    assert "split(" not in made._jdf.queryExecution().optimizedPlan().toString()
