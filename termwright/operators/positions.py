"""Tables from the places of words on pages: lines, headers and their centres, cells, rows."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.operators.lines import CELLS, compact, rows_from_cells

#: The headers by column, and those that a header line must have.
HEADERS = dict(zip(CELLS, C.TABLE_HEADERS))
REQUIRED = ("code", "name", "features", "work")


def _all(tests) -> Column:
    return reduce(lambda a, b: a & b, tests)


def word_lines(words: DataFrame, within: float = 3.0) -> DataFrame:
    """Words (``doc``, ``page``, ``x0``, ``y0``, ``x1``, ``y1``, ``word``) as visual lines: ``doc``, ``page``, ``line_no`` from 0, ``words`` from left to right, and their ``text``.

    A page's words go by the height of their centres; a word joins the line before if it is within ``within`` of that line's running mean. They
    stream through a task in order, which holds no page. Lines without text are left out, and so are words without a place.
    """
    own = words.where("x0 is not null and x1 is not null and y0 is not null and y1 is not null").select("doc", "page", ((F.col("y0") + F.col("y1")) / 2).alias("y"), F.col("x0").cast("double").alias("x0"), F.col("x1").cast("double").alias("x1"), F.coalesce("word", F.lit("")).alias("word"))
    names, parts = own.columns, ["x0", "x1", "word"]

    def closed(held, starts, numbers):
        # The words of whole lines, which begin at these places: one row for each line.
        words = pa.Table.from_batches(held).combine_chunks()
        boxes = pa.StructArray.from_arrays([words[c].combine_chunks() for c in parts], names=parts)
        lists = pa.ListArray.from_arrays(pa.array([*starts, len(words)], pa.int32()), boxes)
        at = pa.array(starts, pa.int64())
        return pa.RecordBatch.from_arrays([words["doc"].combine_chunks().take(at), words["page"].combine_chunks().take(at), pa.array(numbers, pa.int64()), lists], names=["doc", "page", "line_no", "words"])

    def run(batches):
        page, mean, n, line, held, size = None, 0.0, 0, 0, [], 0
        # A line that goes on in the next batch is held until it ends.
        for batch in batches:
            starts, numbers = ([0], [line]) if held else ([], [])
            for i, (doc, p, y) in enumerate(zip(*[batch.column(names.index(c)).to_pylist() for c in ("doc", "page", "y")]), size):
                if (doc, p) != page:
                    page, mean, n, line = (doc, p), y, 1, 0
                elif abs(mean - y) <= within:
                    mean, n = (mean * n + y) / (n + 1), n + 1
                    continue
                else:
                    mean, n, line = y, 1, line + 1
                starts.append(i)
                numbers.append(line)
            if len(starts) > 1:
                yield closed([*held, batch.slice(0, starts[-1] - size)], starts[:-1], numbers[:-1])
                held, size = [batch.slice(starts[-1] - size)], batch.num_rows - starts[-1] + size
            elif batch.num_rows:
                held, size = [*held, batch], size + batch.num_rows
        if held:
            yield closed(held, [0], [line])

    schema = own.select("doc", "page", F.lit(0).cast("long").alias("line_no"), F.array(F.struct(*parts)).alias("words")).schema
    lines = own.repartition("doc", "page").sortWithinPartitions("doc", "page", "y", "x0", "x1", "word").mapInArrow(run, schema)
    # Whether there is text is asked of the words: what is said of the text would be computed for the question and again for the answer.
    lines = lines.where(F.exists("words", lambda w: w["word"].rlike(r"(?U)\S"))).withColumn("words", F.sort_array("words"))
    return lines.withColumn("text", _joined(F.col("words")))


def _joined(words: Column) -> Column:
    return F.regexp_replace(F.array_join(F.transform(words, lambda w: w["word"]), ""), r"(?U)^\s+|\s+$", "")


def table_lines(lines: DataFrame) -> DataFrame:
    """``lines`` of tables with ``table_no`` from 1 in a document, ``continuation``, whether they are ``data``, and the ``centres`` of their table's columns.

    A header line has all six headers as words, or, once such a line has come in the document, the required ones as words or in its text. It
    starts a table if nothing but data stands between it and the last title, heading or page begin before it, and the table goes on to the next of these. A
    column's centre is that of the last header line that started a table and had its word. Titles right before a header belong to the table, and one of
    a continuation makes it one. Headers that come again and page marks are no data.
    """
    t, c = F.trim("text"), compact(F.col("text"))
    # Few lines have any header: all are sought at once, and each among those found.
    lines = lines.withColumn("heads", F.filter("words", lambda w: F.trim(w["word"]).isin(*HEADERS.values())))
    at = {k: F.try_element_at(F.filter("heads", lambda w: F.trim(w["word"]) == h), F.lit(-1)) for k, h in HEADERS.items()}
    at = {k: (w["x0"] + w["x1"]) / 2 for k, w in at.items()}
    doc = Window.partitionBy("doc").orderBy("page", "line_no")
    upto, before = doc.rowsBetween(Window.unboundedPreceding, 0), doc.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.select("*", F.struct(*[at[k].alias(k) for k in CELLS]).alias("at")).drop("heads")
    rows = rows.withColumns({
        "full": _all([F.col(f"at.{k}").isNotNull() for k in CELLS]),
        "worded": _all([F.col(f"at.{k}").isNotNull() for k in REQUIRED]),
        "said": _all([F.col("text").contains(HEADERS[k]) for k in REQUIRED]),
        "continues": c.startswith("续表"),
        "mark": c.rlike(r"^(?:[•·]\d+[•·]|\d{1,3})$"),
    })
    title = F.col("continues") | (c.startswith("表") & ~c.rlike("执行。?$"))
    heading = t.rlike(r"^(?:[A-Z]\.\s*\d+(?:\.\d+)*|\d+\.\d+(?:\.\d+)*|\d+\s+[一-鿿])")
    started = F.coalesce(F.max(F.col("full").cast("int")).over(before) == 1, F.lit(False))
    rows = rows.withColumns({"title": title, "breaks": ~F.col("mark") & (title | heading), "started": started})
    rows = rows.withColumn("header", F.col("full") | (F.col("started") & (F.col("worded") | F.col("said"))))
    page = Window.partitionBy("doc", "page").orderBy("line_no")
    # A run of titles and the line after it have the same number of other lines before them.
    others = F.coalesce(F.sum((~F.col("title")).cast("int")).over(page.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({"part": F.sum(F.col("breaks").cast("int")).over(page.rowsBetween(Window.unboundedPreceding, 0)), "others": others})
    rows = rows.withColumn("continuation", F.max(F.col("continues") & F.col("title")).over(Window.partitionBy("doc", "page", "others")))
    part = Window.partitionBy("doc", "page", "part").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("headers", F.sum(F.col("header").cast("int")).over(part))
    rows = rows.withColumn("starts", F.col("header") & (F.col("headers") == 1))
    own = F.col("starts") & (F.col("full") | (F.col("started") & F.col("worded")))
    centre = [F.last(F.when(own, F.col(f"at.{k}")), ignorenulls=True).over(upto) for k in CELLS]
    first = F.when(F.col("starts"), F.struct(F.array(*centre).alias("centres"), F.col("continuation").alias("continuation")))
    rows = rows.withColumns({"first": first, "table_no": F.sum(F.col("starts").cast("int")).over(upto)})
    rows = rows.withColumn("first", F.last("first", ignorenulls=True).over(upto)).where("headers > 0")
    return rows.select("doc", "page", "line_no", "words", "text", "table_no", (~F.col("header") & ~F.col("breaks") & ~F.col("mark")).alias("data"), "first.continuation", "first.centres")


def line_cells(lines: DataFrame) -> DataFrame:
    """The data lines of :func:`table_lines` as cells (``doc``, ``table_no``, ``pos``, ``continuation`` and the six columns).

    A word is in the column whose centre is nearest: the bounds are the midpoints between centres, and a word on one belongs to the left. A
    cell is its words from left to right. Lines without any cell go.
    """
    bound = [(F.get("centres", F.lit(i)) + F.get("centres", F.lit(i + 1))) / 2 for i in range(len(CELLS) - 1)]
    # A line has text, so one of its words is in some cell.
    rows = lines.where("data and text <> ''").select("doc", "table_no", "page", "line_no", "continuation", "words", *[b.alias(f"b{i}") for i, b in enumerate(bound)])

    def column(w: Column) -> Column:
        # The first bound that the word is not beyond.
        out, middle = F.lit(len(bound)), (w["x0"] + w["x1"]) / 2
        for i in reversed(range(len(bound))):
            out = F.when(middle <= F.col(f"b{i}"), i).otherwise(out)
        return out

    rows = rows.withColumn("placed", F.transform("words", lambda w: F.struct(column(w).alias("k"), w["word"].alias("word"))))
    cell = lambda k: _joined(F.filter("placed", lambda w: w["k"] == k)).alias(CELLS[k])
    return rows.select("doc", "table_no", F.struct("page", "line_no").alias("pos"), "continuation", *[cell(k) for k in range(len(CELLS))])


def rows_from_words(words: DataFrame, within: float = 3.0) -> DataFrame:
    """The rows of all tables of pages, from nothing but their words: lines, headers, centres, cells, rows."""
    return rows_from_cells(line_cells(table_lines(word_lines(words, within))))
