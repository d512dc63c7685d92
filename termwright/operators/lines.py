"""From ordered lines to rows: a document is one window, and every order is a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X
from termwright.operators.catalog import ordered



def _running(group: list[str], order: str = "pos"):
    return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _following(group: list[str], order: str = "pos"):
    return Window.partitionBy(*group).orderBy(order).rowsBetween(1, Window.unboundedFollowing)


def compact(line: Column) -> Column:
    return F.regexp_replace(F.coalesce(line, F.lit("")), r"(?U)\s+", "")


def is_unit(line: Column) -> Column:
    return F.lower(compact(line)).isin(*C.LINE_UNITS)


def is_rule(line: Column) -> Column:
    return compact(line).rlike(f"^(?:{'|'.join(C.RULE_STARTS)})")


def is_work(line: Column) -> Column:
    """A work item: a number with a mark."""
    return F.trim(line).rlike(r"^\d+\s*[.．、]")


def is_code(line: Column) -> Column:
    return F.trim(line).rlike(r"^[0-9OoIl]{9,12}(?:\D|$)")


def is_feature(line: Column) -> Column:
    return compact(line).rlike("|".join(C.FEATURE_LINE_WORDS)) & ~is_rule(line) & ~is_unit(line) & ~is_work(line)


def header_of(line: Column) -> Column:
    """The table header that a line is: one of its words, or little more than one."""
    return _header(compact(line))


def _header(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, words in reversed(C.TABLE_HEADERS.items()):
        for w in reversed(words):
            out = F.when((c == w) | (c.contains(w) & (F.length(c) <= len(w) + 2)), name).otherwise(out)
    return out


def classify_lines(lines: DataFrame) -> DataFrame:
    """``tag`` of each line: header, continuation, table title, page mark, code, unit, heading, rule, work, feature, or text."""
    # Made once for a line, not for each word that is sought in it.
    rows = lines.withColumns({"__t": F.trim("line"), "__c": compact(F.col("line"))})
    t, c = F.col("__t"), F.col("__c")
    rule, unit = c.rlike(f"^(?:{'|'.join(C.RULE_STARTS)})"), F.lower(c).isin(*C.LINE_UNITS)
    tag = (
        F.when(_header(c).isNotNull(), "header")
        .when(c.startswith("续表"), "continuation")
        .when(c.startswith("表") & ~c.rlike("执行。?$"), "table title")
        .when(c.rlike(r"^[•·-]?\d{1,3}[•·-]?$"), "page")
        .when(is_code(t), "code")
        .when(unit, "unit")
        .when(t.rlike(r"^(?:附录\s*[A-Z]|[A-Z]\.\s*\d+(?:\.\d+)*|\d+\.\d+(?:\.\d+)*|\d+\s+[一-鿿]|#{1,6}\s)"), "heading")
        .when(rule, "rule")
        .when(is_work(t), "work")
        .when(c.rlike("|".join(C.FEATURE_LINE_WORDS)), "feature")
        .otherwise("text")
    )
    return rows.withColumn("tag", tag).drop("__t", "__c")


def levels_of(outline: DataFrame) -> list[int]:
    """The levels that an outline has: as many as its headings are deep, whatever its size."""
    return sorted(r["level"] for r in outline.select("level").where("level is not null").distinct().collect())


def _open_entries(levels: list[int], value: Column, window) -> tuple[list[Column], Column]:
    """For each level the last entry so far (struct ``pos``, ``value``), and the array of those that no shallower or equal one has closed since, outermost first."""
    latest = [F.last(F.when(F.col("level") == n, F.struct("pos", value.alias("value"))), ignorenulls=True).over(window).alias(f"l{n}") for n in levels]

    def valid(n: int) -> Column:
        before = [F.coalesce(F.col(f"l{m}.pos"), F.lit(-1)) for m in levels if m < n]
        shallower = F.greatest(F.lit(-1), F.lit(-1), *before)
        return F.when(F.col(f"l{n}.pos") > shallower, F.col(f"l{n}.value"))

    return latest, F.array_compact(F.array(*[valid(n) for n in levels]))


def outline_paths(outline: DataFrame) -> DataFrame:
    """Each entry (``doc``, ``pos``, ``level``, ``title``) with its ancestors' titles as ``path`` and its ``parent``, whatever the depth.

    The last entry of each level counts as long as no shallower one has come since.
    """
    latest, path = _open_entries(levels_of(outline), F.col("title"), _running(["doc"]))
    rows = outline.select("*", *latest).withColumn("__path", path)
    return rows.select("doc", "pos", "level", "title", F.array_join("__path", " > ").alias("path"), F.get("__path", F.size("__path") - 2).alias("parent"))


def region_bounds(outline: DataFrame) -> DataFrame:
    """``end`` of each entry: the place of the next one that is not deeper; null for the last."""
    w, end = _following(["doc"]), F.lit(None).cast("long")
    for n in levels_of(outline):
        end = F.when(F.col("level") == n, F.min(F.when(F.col("level") <= n, F.col("pos"))).over(w)).otherwise(end)
    return outline.withColumn("end", end)


def region_lines(outline: DataFrame, lines: DataFrame) -> DataFrame:
    """(``doc``, ``start``, ``text``, ``n_lines``): the lines from an entry up to the next that is not deeper, as one text.

    Each line goes to the entries that are open where it stands: as many rows as an outline is deep, not as it is long.
    """
    both = outline.select("doc", "pos", "level", F.lit(None).cast("string").alias("line"), F.lit(0).alias("kind")).unionByName(lines.select("doc", "pos", F.lit(None).cast("int").alias("level"), "line", F.lit(1).alias("kind")))
    w = Window.partitionBy("doc").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    latest, starts = _open_entries(levels_of(outline), F.col("pos"), w)
    own = both.select("*", *latest).where("kind = 1").select("doc", "pos", "line", F.explode(starts).alias("start"))
    return own.groupBy("doc", "start").agg(F.array_join(ordered(F.col("line"), F.col("pos")), "\n").alias("text"), F.count("*").alias("n_lines"))


def header_runs(lines: DataFrame, within: int = 8, least: int = 4) -> DataFrame:
    """``lines`` (``doc``, ``pos``, ``line``, not blank) with ``header`` and ``starts``: at the first line of a run of headers that has the required ones and ``least`` in all."""
    w = Window.partitionBy("doc").orderBy("pos")
    rows = lines.where(F.trim("line") != "").withColumn("__c", compact(F.col("line"))).withColumn("header", _header(F.col("__c"))).drop("__c")
    places = [f"__h{i}" for i in range(1, within)]
    rows = rows.withColumns({"before": F.lag("header").over(w), **{h: F.lead("header", i).over(w) for i, h in enumerate(places, 1)}})
    # What follows up to the first line that is no header.
    run = [F.col("header")]
    for h in places:
        run.append(F.when(run[-1].isNotNull(), F.col(h)))
    run = F.array_distinct(F.array_compact(F.array(*run)))
    good = F.col("header").isNotNull() & F.col("before").isNull() & (F.size(run) >= least) & F.forall(F.array(*map(F.lit, C.REQUIRED_HEADERS)), lambda h: F.array_contains(run, h))
    return rows.withColumn("starts", F.coalesce(good, F.lit(False))).drop("before", *places)


def table_segments(lines: DataFrame) -> DataFrame:
    """The lines of tables (``doc``, ``pos``, ``line``, ``tag``) with ``table_no`` from 1: from a run of headers up to the first heading after a code line.

    Headers inside a table belong to it. A document falls into blocks, each from a code line to the next. Whether a table is open at a
    block's end follows from whether one was at its beginning: it always is, never is, is as before, or is the other way round. So the last block that
    settles it, and how many have turned it since, say it for every block, by windows over the blocks alone.
    """
    rows = header_runs(lines)
    # All windows go by document, so lines are shuffled once; what is said of a block stands on its last line.
    doc = Window.partitionBy("doc").orderBy("pos")
    upto, before = doc.rowsBetween(Window.unboundedPreceding, 0), doc.rowsBetween(Window.unboundedPreceding, -1)
    block = Window.partitionBy("doc", "block")
    rows = rows.withColumn("block", F.sum((F.col("tag") == "code").cast("int")).over(upto))
    heading, start = F.when(F.col("tag") == "heading", F.col("pos")), F.when(F.col("starts"), F.col("pos"))
    rows = rows.withColumns({"heading": F.min(heading).over(block), "first": F.min(start).over(block), "end": F.max("pos").over(block)})
    # A line that starts a table is no heading: the first start counts that stands behind the first heading.
    rows = rows.withColumn("after", F.min(F.when(F.col("pos") > F.col("heading"), start)).over(block))
    if_open = F.col("heading").isNull() | F.col("after").isNotNull()
    if_closed = F.col("first").isNotNull()
    last = F.col("pos") == F.col("end")
    rows = rows.withColumns({"settles": F.when(last & (if_open == if_closed), if_open), "turns": (last & ~if_open & if_closed).cast("int")})
    rows = rows.withColumn("turned", F.coalesce(F.sum("turns").over(before), F.lit(0)))
    # The last block that settles it, with the turns up to and with it: nothing is open before the first block.
    settled = F.when(F.col("settles").isNotNull(), F.struct(F.col("settles").alias("open"), (F.col("turned") + F.col("turns")).alias("turned")))
    settled = F.coalesce(F.last(settled, ignorenulls=True).over(before), F.struct(F.lit(False).alias("open"), F.lit(0).cast("long").alias("turned")))
    rows = rows.withColumn("was_open", settled["open"] != ((F.col("turned") - settled["turned"]) % 2 == 1))
    rows = rows.withColumns({"opens": F.when(F.col("was_open"), F.col("after")).otherwise(F.col("first")), "closes": F.when(F.col("was_open"), F.col("heading"))})
    running = lambda c: F.sum(F.coalesce(F.col("pos") == F.col(c), F.lit(False)).cast("int")).over(upto)
    rows = rows.withColumns({"table_no": running("opens"), "closed": running("closes")})
    return rows.where(F.col("table_no") > F.col("closed")).withColumn("table_no", F.col("table_no").cast("int")).drop("starts", "block", "heading", "first", "end", "after", "settles", "turns", "turned", "was_open", "opens", "closes", "closed")


def code_sessions(lines: DataFrame) -> DataFrame:
    """Lines of a table cut at each code line; lines before the first code are left out."""
    w = _running(["doc", "table_no"])
    return lines.withColumn("session", F.sum(F.when(F.col("tag") == "code", 1).otherwise(0)).over(w)).where("session > 0")


def row_fields(sessions: DataFrame) -> DataFrame:
    """A row for each session (``doc``, ``table_no``, ``session``): code, name, unit, features, rule and work.

    The name is what follows the code, or the first line; a short second line without a mark of its own belongs to it. The first
    line that is a unit is the unit. Of the rest, features come before the first rule, work begins at the first work item.
    """
    lines = sessions.groupBy("doc", "table_no", "session").agg(ordered(F.trim("line"), F.col("pos")).alias("lines"))
    form = r"^\s*([0-9OoIl]{9,12})\s*(.*)$"
    head = F.get("lines", F.lit(0))
    rest = F.filter(F.concat(F.array(F.regexp_extract(head, form, 2)), F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))), lambda x: x != "")
    inline = r"^(.*?)\s+(\d+\s*[.．、].+)$"
    first = F.get("rest", F.lit(0))
    parted = F.concat(F.array(F.trim(F.regexp_extract(first, inline, 1)), F.trim(F.regexp_extract(first, inline, 2))), F.slice("rest", 2, F.greatest(F.size("rest") - 1, F.lit(0))))
    own = lines.withColumn("code", X.repair_code(F.regexp_extract(head, form, 1))).withColumn("rest", rest).withColumn("rest", F.when(first.rlike(inline), parted).otherwise(F.col("rest")))
    second = F.get("rest", F.lit(1))
    joins = second.isNotNull() & ~is_feature(second) & ~is_rule(second) & ~is_unit(second) & ~is_work(second) & (F.length(compact(first)) <= 6) & (F.length(compact(second)) <= 8)
    n = F.when(F.size("rest") == 0, 0).when(F.coalesce(joins, F.lit(False)), 2).otherwise(1)
    own = own.withColumn("n", n).withColumn("name", F.array_join(F.slice("rest", 1, F.col("n")), "\n"))
    own = own.withColumn("rest", F.slice("rest", F.col("n") + 1, F.greatest(F.size("rest") - F.col("n"), F.lit(0))))
    place = lambda rows, test: F.array_position(F.transform(rows, test), True)
    own = own.withColumn("u", place(F.col("rest"), is_unit)).withColumn("unit", F.when(F.col("u") > 0, compact(F.get("rest", (F.col("u") - 1).cast("int")))))
    own = own.withColumn("rest", F.filter("rest", lambda x, i: i + 1 != F.col("u")))
    own = own.withColumn("w", place(F.col("rest"), is_work)).withColumn("before", F.when(F.col("w") > 0, F.slice("rest", 1, F.greatest(F.col("w").cast("int") - 1, F.lit(0)))).otherwise(F.col("rest")))
    own = own.withColumn("r", place(F.col("before"), is_rule))
    part = lambda test: F.array_join(F.filter("before", test), "\n")
    return own.select(
        "doc", "table_no", "session", "code", "name", "unit",
        part(lambda x, i: (F.col("r") == 0) | (i + 1 < F.col("r"))).alias("features"),
        part(lambda x, i: (F.col("r") > 0) & (i + 1 >= F.col("r"))).alias("rule"),
        F.array_join(F.filter("rest", lambda x, i: (F.col("w") > 0) & (i + 1 >= F.col("w"))), "\n").alias("work"),
    )


def cluster_word_lines(words: DataFrame, within: float = 3.0) -> DataFrame:
    """Words of a page (``doc``, ``page``, ``x``, ``y``, ``word``) as visual lines: a word joins the line whose running mean its centre is near to. A fold over one page."""
    own = words.groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("y", "x", "word"))).alias("own"))
    line = "struct<y:double,n:int,words:array<struct<x:double,word:string>>>"
    start = F.struct(F.array().cast(f"array<{line}>").alias("done"), F.lit(None).cast(line).alias("open"))

    def add(s: Column, w: Column) -> Column:
        o = s["open"]
        new = F.struct(w["y"].alias("y"), F.lit(1).alias("n"), F.array(F.struct(w["x"].alias("x"), w["word"].alias("word"))).alias("words"))
        more = F.struct(((o["y"] * o["n"] + w["y"]) / (o["n"] + 1)).alias("y"), (o["n"] + 1).alias("n"), F.concat(o["words"], new["words"]).alias("words"))
        return F.when(o.isNull(), F.struct(s["done"].alias("done"), new.alias("open"))).when(F.abs(w["y"] - o["y"]) <= within, F.struct(s["done"].alias("done"), more.alias("open"))).otherwise(F.struct(F.concat(s["done"], F.array(o)).alias("done"), new.alias("open")))

    lines = F.aggregate("own", start, add, lambda s: F.concat(s["done"], F.array(s["open"])))
    return own.select("doc", "page", F.posexplode(lines).alias("line_no", "l")).select("doc", "page", "line_no", F.array_join(F.transform(F.array_sort("l.words"), lambda w: w["word"]), " ").alias("line"))


def assign_columns(words: DataFrame, centres: DataFrame) -> DataFrame:
    """Each word's (``doc``, ``x``) nearest header column (``doc``, ``column``, ``centre``): bounds are the midpoints between centres."""
    w = Window.partitionBy("doc").orderBy("centre")
    bounds = centres.select("doc", "column", ((F.col("centre") + F.lag("centre").over(w)) / 2).alias("low"), ((F.col("centre") + F.lead("centre").over(w)) / 2).alias("high"))
    # A document has few columns: its words meet those, and the bounds choose.
    return words.join(bounds, "doc").where((F.col("low").isNull() | (F.col("x") >= F.col("low"))) & (F.col("high").isNull() | (F.col("x") < F.col("high")))).drop("low", "high")


#: Columns of a table, in order; lines that a code is looked for ahead.
CELLS = ("code", "name", "features", "unit", "rule", "work")
AHEAD = 6


def rows_from_cells(cells: DataFrame) -> DataFrame:
    """Lines of cells (``doc``, ``table_no``, ``pos``, ``continuation`` and the six ``CELLS``) as rows, their parts in order of the lines.

    A line without a code belongs to the row before, unless it begins the next one: a work sequence that starts anew at 1 with
    a name, feature or unit in it or between it and a code at most six lines ahead (and all after it up to that code), or a
    line of name, feature or unit right before a code. What a continuation table has before its first code belongs to that row. Other lines
    before the first code, and tables without any, give nothing.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    form = r"^([0-9OoIl]{9,12})\s*(.*)$"
    rows = cells.select("doc", "table_no", "pos", F.coalesce("continuation", F.lit(False)).alias("continuation"), *[blank(c).alias(c) for c in CELLS])
    code = F.when(F.col("code").rlike(form), X.repair_code(F.regexp_extract("code", form, 1)))
    rows = rows.withColumn("inline", F.when(code.isNotNull(), F.regexp_extract("code", form, 2))).withColumn("code", code)
    w = Window.partitionBy("doc", "table_no").orderBy("pos")
    rows = rows.withColumn("at", F.row_number().over(w)).withColumn("is_code", F.col("code").isNotNull())
    named = (F.col("name") != "") | (F.col("features") != "") | (F.col("unit") != "")
    near = w.rowsBetween(1, AHEAD)
    rows = rows.withColumn("named", named).withColumn("code_at", F.min(F.when(F.col("is_code"), F.col("at"))).over(near)).withColumn("named_at", F.min(F.when(F.col("named") & ~F.col("is_code"), F.col("at"))).over(near))
    one = lambda c: F.regexp_extract(F.array_join(F.slice(F.filter(F.split(F.col(c), "\n"), lambda x: F.trim(x).rlike(r"^\d+\s*[.．、]")), 1, 1), ""), r"^\s*(\d+)", 1) == "1"
    anew = ~F.col("is_code") & F.col("code_at").isNotNull() & (one("work") | one("rule")) & (F.col("named") | (F.coalesce("named_at", F.lit(2**31)) < F.col("code_at")))
    right_before = ~F.col("is_code") & F.coalesce(F.col("code_at") == F.col("at") + 1, F.lit(False)) & F.col("named") & (F.col("rule") == "") & (F.col("work") == "")
    rows = rows.withColumn("anew", anew).withColumn("session", F.sum(F.col("is_code").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("doc", "table_no", "session").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ahead = (F.max(F.col("anew").cast("int")).over(own) == 1) | right_before | (F.col("continuation") & (F.col("session") == 0))
    rows = rows.withColumn("row", F.when(F.col("is_code"), F.col("session")).when(ahead, F.col("session") + 1).otherwise(F.col("session"))).where("row > 0")
    joined = lambda c: F.array_join(ordered(F.when(F.col(c) != "", F.col(c)), F.col("pos")), "\n").alias(c)
    out = rows.groupBy("doc", "table_no", "row").agg(F.max("code").alias("code"), F.max("inline").alias("inline"), *[joined(c) for c in CELLS[1:]])
    name = F.array_join(F.filter(F.array("inline", "name"), lambda x: x.isNotNull() & (x != "")), "\n")
    return out.where("code is not null").select("doc", "table_no", F.col("row").alias("row_no"), "code", name.alias("name"), *CELLS[2:])


def merge_continuations(tables: DataFrame) -> DataFrame:
    """``merged_no`` of tables (``doc``, ``pos``, ``title``): a continuation with the same id, or none, belongs to the table before."""
    w = Window.partitionBy("doc").orderBy("pos")
    own, before = X.table_id(F.col("title")), F.lag(X.table_id(F.col("title"))).over(w)
    rows = tables.withColumn("own", own).withColumn("before", before)
    new = ~(F.trim("title").startswith("续表") & F.col("before").isNotNull() & (F.col("own").isNull() | (F.col("own") == F.col("before"))))
    return rows.withColumn("merged_no", F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("own", "before")


def fill_shared(rows: DataFrame) -> DataFrame:
    """Blank rules take the next one that there is, else the last one; blank work texts take the last one."""
    w = Window.partitionBy("doc", "table_no").orderBy("pos")
    filled = lambda c: F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.col(c))
    nxt = F.first(filled("rule"), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    last = lambda c: F.last(filled(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"rule": F.coalesce(nxt, last("rule")), "work": last("work")})


def shift_split_work(rows: DataFrame) -> DataFrame:
    """A row whose work is the single item 1, before one whose work begins later, gives its text to that row."""
    w = Window.partitionBy("doc", "table_no").orderBy("pos")
    number = lambda c: F.regexp_extract(c, r"^\s*(\d+)", 1).try_cast("int")
    items = F.size(F.filter(F.split("work", "\n"), lambda x: F.trim(x).rlike(r"^\d+\s*[.．、]")))
    rows = rows.withColumn("n", number(F.col("work"))).withColumn("items", items)
    gives = (F.col("n") == 1) & (F.col("items") == 1) & (F.lead("n").over(w) > 1)
    rows = rows.withColumn("gives", F.coalesce(gives, F.lit(False)))
    taken = F.when(F.lag("gives").over(w), F.lag("work").over(w))
    return rows.withColumn("work", F.when(F.col("gives"), "").when(taken.isNotNull(), F.concat_ws("\n", taken, "work")).otherwise(F.col("work"))).drop("n", "items", "gives")


def unit_of_text(text: Column) -> Column:
    """What a rule measures: volume, area or length; null if it says none of them."""
    c = compact(text)
    return F.when(c.rlike("体积计算|立方米"), "m3").when(c.rlike("面积计算|建筑面积|投影面积"), "m2").when(c.rlike("延长米|长度计算|中心线长度"), "m")


def infer_units(rows: DataFrame) -> DataFrame:
    """The ``unit`` of a row: its own if it is whole, else what the ``rule`` measures, else what the text of its table (``table_text``) does."""
    own = compact(F.col("unit"))
    fallback = F.coalesce(unit_of_text(F.col("rule")), unit_of_text(F.col("table_text")))
    return rows.withColumn("unit", F.when(own == "", F.coalesce(fallback, F.lit(""))).when(own.isin("n?", "0?", "m*"), F.coalesce(fallback, own)).otherwise(F.col("unit")))


def split_trailing_feature(rows: DataFrame) -> DataFrame:
    """A name that ends in a feature word, where there are no features, gives that word to these."""
    blank = F.trim(F.coalesce("features", F.lit(""))) == ""
    hit = F.regexp_extract(F.col("name"), f"^(?s:.*\\S.*?)({'|'.join(C.TRAILING_FEATURES)})$", 1)
    split = blank & (hit != "")
    name = F.when(split, F.trim(F.substring(F.col("name"), F.lit(1), F.length("name") - F.length(hit)))).otherwise(F.col("name"))
    return rows.withColumns({"features": F.when(split, hit).otherwise(F.col("features")), "name": name})


def extraction_summary(outline: DataFrame, tables: DataFrame, rows: DataFrame) -> DataFrame:
    """For each ``doc`` its entries, their greatest level and those of each ``kind``, its tables (``doc``, ``table_no``) and rows (``doc``)."""
    own = outline.groupBy("doc").agg(F.count("*").alias("entries"), F.max("level").alias("max_level"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("front", "body", "back")])
    n_tables = tables.select("doc", "table_no").distinct().groupBy("doc").agg(F.count("*").alias("tables"))
    n_rows = rows.groupBy("doc").agg(F.count("*").alias("rows"))
    return own.join(n_tables, "doc", "left").join(n_rows, "doc", "left").na.fill(0, ["tables", "rows"])


def repair_rows(rows: DataFrame) -> DataFrame:
    """Features from rows within two places of the same table, family and unit, for rows whose own don't start at 1 or are fewer than two.

    ``rows`` are (``doc``, ``pos``, ``row_id``, ``family``, ``unit``, ``entries`` array<struct<n, text>>, ``rule``). The row's own entries win,
    then those of the first neighbour. A blank rule takes the longest of the window that measures something. All
    read the rows as they came, so a repair doesn't depend on another.
    """
    near = Window.partitionBy("doc").orderBy("pos").rowsBetween(-2, 2)
    all_ = F.collect_list(F.struct("pos", "family", "unit", "entries", "rule")).over(near)
    rows = rows.withColumn("near", all_)
    fits = F.filter("near", lambda r: (r["pos"] == F.col("pos")) | ((r["family"] == F.col("family")) & ((F.col("unit") == "") | (r["unit"] == "") | (r["unit"] == F.col("unit")))))
    rows = rows.withColumn("near", F.array_sort(F.filter(fits, lambda r: r["entries"].isNotNull())))
    needs = (F.size("entries") <= 1) | (F.get("entries", F.lit(0))["n"] != 1)
    pool = F.concat("entries", F.flatten(F.transform("near", lambda r: r["entries"])))
    numbers = F.array_sort(F.array_distinct(F.transform(pool, lambda e: e["n"])))
    merged = F.transform(numbers, lambda n: F.get(F.filter(pool, lambda e: e["n"] == n), F.lit(0)))
    measures = lambda c: F.exists(F.array(*map(F.lit, C.CALCULATION_WORDS)), lambda w: c.contains(w))
    best = F.aggregate(F.transform("near", lambda r: r["rule"]), F.lit(""), lambda s, r: F.when(measures(r) & (F.length(r) > F.length(s)), r).otherwise(s))
    rule = F.when(F.col("rule") == "", best).when(~measures(F.col("rule")) & (best != "") & ~F.col("rule").contains(best), F.concat(best, F.lit("\n"), F.col("rule"))).otherwise(F.col("rule"))
    return rows.select("doc", "pos", "row_id", F.array_join(F.transform(F.when(needs, merged).otherwise(F.col("entries")), lambda e: F.concat(e["n"].cast("string"), F.lit("."), e["text"])), "\n").alias("features"), rule.alias("rule"))


def rule_paragraphs(regions: DataFrame, mark: str, triggers: tuple[str, ...]) -> DataFrame:
    """Region prose cut at marks, kept where a trigger word stands, distinct within a document; ``pos`` is the first place."""
    w = Window.partitionBy("doc").orderBy("pos")
    lines = regions.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("part", F.sum(F.col("line").rlike(mark).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = lines.groupBy("doc", "part").agg(F.array_join(ordered(F.trim("line"), F.col("pos")), " ").alias("paragraph"), F.min("pos").alias("pos"))
    hit = F.exists(F.array(*map(F.lit, triggers)), lambda t: F.lower("paragraph").contains(t))
    return parts.where(hit).groupBy("doc", "paragraph").agg(F.min("pos").alias("pos"))
