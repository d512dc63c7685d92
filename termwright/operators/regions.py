"""Regions of documents: from an outline (``doc``, ``idx``, ``level``, ``title``, ``page``) and pages (``doc``, ``page``, ``text``) to the text of each entry.

A region begins and ends inside a page, where its title and the next one's stand. Titles are found in the normal form of a page, which
has only letters and digits; what is found there is sought in the page with anything between its characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C


#: All that is white space in Unicode.
_WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _strip(text: Column) -> Column:
    return F.trim(text, F.lit(_WHITE))


def looks_like_body(title: Column) -> Column:
    return title.rlike(C.BODY_TITLE)


def title_class(title: Column) -> Column:
    """``front``, ``back`` or ``body`` by the words of a title."""
    low = F.lower(title)
    return F.when(low.rlike("|".join(C.FRONT_TITLES)), "front").when(low.rlike("|".join(C.BACK_TITLES)), "back").otherwise("body")


def body_pages(outline: DataFrame) -> DataFrame:
    """``outline`` with ``category`` and ``body_page``: pages are counted from the first entry with a title of the body on.

    What comes before that page and has no such title is front matter, whatever its words. Front and back matter, and entries before the body, have no ``body_page``.
    """
    title = F.coalesce("title", F.lit(""))
    first = F.min(F.when(looks_like_body(title), F.struct("idx", "page"))).over(Window.partitionBy("doc"))["page"]
    rows = outline.withColumn("__first", first).withColumn("category", title_class(title))
    early = ~looks_like_body(title) & (F.col("__first").isNull() | (F.col("page") < F.col("__first")))
    rows = rows.withColumn("category", F.when((F.col("category") == "body") & early, "front").otherwise(F.col("category")))
    page = F.col("page") - F.col("__first") + 1
    return rows.withColumn("body_page", F.when((F.col("category") == "body") & (page > 0), page)).drop("__first")


def page_ranges(outline: DataFrame, pages: DataFrame) -> DataFrame:
    """For each ``doc``: ``catalog_start``, ``catalog_end``, ``front_end``, ``body_start`` and ``body_end``; ``outline`` has its ``category``.

    The catalogue goes up to the body, which ends before the first entry of the back matter, else with the last page.
    """
    at = lambda test, name: F.min(F.when(test, F.struct("idx", "page")))["page"].alias(name)
    catalog = F.lower(_strip(F.coalesce("title", F.lit("")))).isin(*C.CATALOGUE_TITLES)
    body = (F.col("category") == "body") & looks_like_body(F.coalesce("title", F.lit("")))
    own = outline.groupBy("doc").agg(at(catalog, "catalog_start"), at(body, "body_start"), at(F.col("category") == "back", "back"))
    last = pages.groupBy("doc").agg(F.max("page").alias("last"))
    front_end = F.col("body_start") - 1
    return own.join(last, "doc", "left").select("doc", "catalog_start", F.when(F.col("catalog_start").isNotNull(), front_end).alias("catalog_end"), front_end.alias("front_end"), "body_start", F.coalesce(F.col("back") - 1, F.col("last")).alias("body_end"))


def boundaries(outline: DataFrame) -> DataFrame:
    """``outline`` with ``end_idx``, ``end_title`` and ``end_page`` of the next entry that is not deeper.

    An entry stands in the list of each level of its document that is not above its own; the next one in the list of its own level is
    the boundary. That are as many rows as a document has levels, and no level is known to the plan.
    """
    levels = outline.groupBy("doc").agg(F.collect_set("level").alias("levels"))
    rows = outline.join(levels, "doc").withColumn("in_level", F.explode(F.filter("levels", lambda n: n >= F.col("level"))))
    w = Window.partitionBy("doc", "in_level").orderBy("idx")
    after = F.lead(F.struct(F.col("idx").alias("end_idx"), F.col("title").alias("end_title"), F.col("page").alias("end_page"))).over(w)
    return rows.withColumn("__after", after).where("in_level = level").select(*outline.columns, "__after.*")


#: What stands between the letters and digits of a text.
_GAP = r"[^\p{L}\p{N}]"


def _lower(text: Column) -> Column:
    """A text in lower case as its characters are one by one, so that no place moves."""
    return F.lower(F.replace(F.replace(text, F.lit("İ"), F.lit("i")), F.lit("Σ"), F.lit("σ")))


def _normal(low: Column) -> Column:
    """The letters and digits of a text in lower case."""
    return F.regexp_replace(low, f"{_GAP}+", "")


def _spread(form: Column) -> Column:
    """The pattern of a normal form in a text that has anything between its letters and digits."""
    return F.regexp_replace(form, r"(?s)(.)(?=.)", "$1" + _GAP.replace("\\", "\\\\") + "*+")


def title_forms(title: Column) -> Column:
    """The normal forms in which a title is looked for, in order: whole, without its number, without ``附录`` and its letter; of two characters at least."""
    own = F.coalesce(title, F.lit(""))
    forms = F.array(own, F.regexp_replace(own, C.TITLE_NUMBER, ""), F.regexp_replace(own, C.TITLE_APPENDIX, ""))
    return F.array_distinct(F.filter(F.transform(forms, lambda t: _normal(_lower(t))), lambda n: F.length(n) >= C.LEAST_ANCHOR))


def _first_in(normal: Column, forms: Column) -> Column:
    """The first of the forms that stands in a normal form; null if none does."""
    return F.get(F.filter(forms, lambda f: normal.contains(f)), F.lit(0))


def region_text(outline: DataFrame, pages: DataFrame) -> DataFrame:
    """(``doc``, ``idx``, ``text``, ``start_found``, ``end_found``, ``page_start``, ``page_end``) of the body's entries (all, if ``outline`` has no ``category``).

    The text goes from the entry's title on its page to the title of the next entry that is not deeper, or, if there is none, to
    the end of the body (``body_end`` of :func:`page_ranges`). A title that is not found leaves the whole page. On one page the end is sought behind the
    start. Parts without blanks around them are joined by new lines; a page that is missing is empty. Each page is normalised once, whatever begins and ends on it.
    """
    classed = outline if "category" in outline.columns else outline.withColumn("category", F.lit("body"))
    body = page_ranges(classed, pages).select("doc", "body_end")
    rows = boundaries(classed).where("category = 'body'").join(body, "doc", "left")
    start, end = F.col("page"), F.col("end_page")
    to_end = F.sequence(start, F.greatest(start, F.coalesce("body_end", start)))
    span = F.when(end.isNull(), to_end).when(end == start, F.array(start)).otherwise(F.concat(F.sequence(start, F.greatest(start, end - 1)), F.array(end)))
    touch = rows.select("doc", "idx", start.alias("page_start"), end.alias("end_page"), title_forms(F.col("title")).alias("first"), title_forms(F.col("end_title")).alias("last"), span.alias("span"))
    touch = touch.select("*", F.posexplode("span").alias("o", "on_page"))
    begins, ends = F.col("o") == 0, F.col("end_page").isNotNull() & ((F.col("o") > 0) | (F.col("end_page") == F.col("page_start"))) & (F.col("on_page") == F.col("end_page"))
    none = F.array().cast("array<string>")
    touch = touch.select("doc", F.col("on_page").alias("page"), F.struct("idx", "o", "page_start", begins.alias("begins"), ends.alias("ends"), F.when(begins, F.col("first")).otherwise(none).alias("first"), F.when(ends, F.col("last")).otherwise(none).alias("last")).alias("t"))
    asked = touch.groupBy("doc", "page").agg(F.collect_list("t").alias("ts")).join(pages.select("doc", "page", "text"), ["doc", "page"], "left")
    text = F.coalesce("text", F.lit(""))

    # Where a form stands is found in the normal form; only its place in the page is sought letter by letter.
    cuts = F.exists("ts", lambda t: t["begins"] | t["ends"])
    low = asked.select("doc", "page", "ts", text.alias("own"), F.when(cuts, _lower(text)).otherwise("").alias("low"))
    rows = low.withColumn("normal", _normal(F.col("low"))).select("doc", "page", "own", "low", "normal", F.inline("ts"))
    rows = rows.withColumn("s", _first_in(F.col("normal"), F.col("first")))
    rows = rows.withColumns({"begin": F.regexp_substr("low", _spread(F.col("s"))), "behind": F.when(F.col("s").isNull(), F.col("normal")).otherwise(F.substr("normal", F.position("s", "normal") + F.length("s")))})
    rows = rows.withColumns({"at": F.coalesce(F.position("begin", "low") - 1, F.lit(0)), "e": _first_in(F.col("behind"), F.col("last"))})
    rows = rows.withColumn("after", F.col("at") + F.coalesce(F.length("begin"), F.lit(0))).withColumn("low", F.when(F.col("e").isNotNull(), F.substr("low", F.col("after") + 1)))
    stop = F.coalesce(F.col("after") + F.position(F.regexp_substr("low", _spread(F.col("e"))), F.col("low")) - 1, F.length("own"))
    part = _strip(F.substring(F.col("own"), F.col("at") + 1, F.greatest(stop - F.col("at"), F.lit(0))))
    parts = rows.select("doc", "page", "idx", "o", "page_start", (F.col("begins") & F.col("s").isNotNull()).alias("start_found"), (F.col("ends") & F.col("e").isNotNull()).alias("end_found"), part.alias("part"))
    said = F.filter(F.array_sort(F.collect_list(F.struct("o", "page", "part"))), lambda p: p["part"] != "")
    out = parts.groupBy("doc", "idx").agg(said.alias("said"), F.bool_or("start_found").alias("start_found"), F.bool_or("end_found").alias("end_found"), F.first("page_start").alias("page_start"))
    return out.select(
        "doc", "idx", F.array_join(F.transform("said", lambda p: p["part"]), "\n").alias("text"), "start_found", "end_found", "page_start",
        F.when(F.size("said") > 0, F.element_at("said", -1)["page"]).otherwise(F.col("page_start")).alias("page_end"),
    )
