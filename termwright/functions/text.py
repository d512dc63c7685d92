"""Column expressions that clean, normalise and classify texts. All of them are Spark functions; none is a UDF."""

from __future__ import annotations

from functools import reduce

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from termwright.functions import constants as C


def blank_to_empty(text: Column) -> Column:
    """Trimmed text, null as empty: the form in which the rules below are stated."""
    return F.trim(F.coalesce(text.cast("string"), F.lit("")))


def replaced(text: Column, pairs) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def normalize_text(text: Column) -> Column:
    """A name without brackets, commas, colons and blanks, its concrete words unified."""
    return replaced(F.translate(blank_to_empty(text), C.NAME_DROPPED, ""), C.NAME_REPLACEMENTS)


def normalize_search_text(text: Column) -> Column:
    """Domain synonyms replaced in order, then blanks and punctuation dropped."""
    return F.translate(F.regexp_replace(replaced(blank_to_empty(text), C.SEARCH_REPLACEMENTS), r"\s+", ""), C.SEARCH_DROPPED, "")


def normalize_unit(unit: Column) -> Column:
    return replaced(blank_to_empty(unit), C.UNIT_REPLACEMENTS)


def strip_affixes(text: Column) -> Column:
    """At most one prefix and one suffix dropped, never the whole text."""
    own = F.regexp_replace(blank_to_empty(text), f"^(?:{'|'.join(C.PREFIXES)})(?=[\\s\\S])", "")
    return F.trim(F.regexp_replace(own, f"(?<=[\\s\\S])(?:{'|'.join(C.SUFFIXES)})$", ""))


def clean_text(text: Column) -> Column:
    """Full-width blanks and bullets as blanks, runs of blanks and of line ends as one."""
    own = F.translate(F.coalesce(text.cast("string"), F.lit("")), "　•", "  ")
    return F.trim(F.regexp_replace(F.regexp_replace(own, "[ \t]+", " "), "\n+", "\n"))


def clean_lines(text: Column) -> Column:
    """:func:`clean_text`, each line without leading and trailing marks, empty lines dropped."""
    lines = F.transform(F.split(clean_text(text), "\n"), lambda x: F.regexp_replace(x, "^[ .。；;：:]+|[ .。；;：:]+$", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def clean_features(text: Column) -> Column:
    """Feature lines with numbers in the form ``1.x``; a line that is only a number numbers the line before."""
    lines = F.transform(
        F.filter(F.split(clean_lines(text), "\n"), lambda x: x != ""),
        lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(F.translate(x, "．、：", "..:")), r"^(\d+)\s*-\s*", "$1."), r"^(\d+)\s*\.\s*", "$1."), r"^(\d+)\s+", "$1."),
    )
    # A lone number changes the line before it, so lines are folded in order.
    folded = F.aggregate(
        lines,
        F.array().cast("array<string>"),
        lambda s, x: F.when(
            x.rlike(r"^\d+$") & (F.size(s) > 0),
            F.concat(F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), F.array(F.concat(x, F.lit("."), F.regexp_replace(F.get(s, F.size(s) - 1), "^[.。]+", "")))),
        ).otherwise(F.concat(s, F.array(x))),
    )
    return F.array_join(folded, "\n")


def table_title(title: Column) -> Column:
    """The title of the table that a continuation continues."""
    return F.regexp_replace(F.replace(clean_text(title), F.lit("续表"), F.lit("表")), r"\s+", "")


def table_id(title: Column) -> Column:
    """An id like ``E.2.1`` in a title, else null."""
    return F.nullif(F.regexp_extract(F.upper(title), r"([A-Z](?:\.\d+)+)", 1), F.lit(""))


def classify_family(name: Column) -> Column:
    out = None
    for word, family in C.FAMILIES:
        out = F.when(name.contains(word), family) if out is None else out.when(name.contains(word), family)
    return out.otherwise(C.OTHER_FAMILY)


def nullish_to_null(text: Column) -> Column:
    own = F.trim(text.cast("string"))
    return F.when(~F.lower(own).isin(*C.NULL_WORDS), own)


def string_list(text: Column) -> Column:
    """Delimited text as distinct trimmed parts, in order."""
    parts = F.transform(F.split(F.coalesce(text.cast("string"), F.lit("")), "[、,，;；/\n]+"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def section_root(path: Column) -> Column:
    """The part of a path before its first `` > ``."""
    return F.trim(F.split_part(F.coalesce(path.cast("string"), F.lit("")), F.lit(" > "), F.lit(1)))


def stable_key(*parts: Column, length: int = 16) -> Column:
    """A key made of the content alone."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary")), 1, length)


def slugify(text: Column, length: int = 96) -> Column:
    own = F.regexp_replace(F.regexp_replace(blank_to_empty(text), r'[\\/:*?"<>|\s]+', "_"), "^[._]+|[._]+$", "")
    return F.coalesce(F.nullif(F.substring(own, 1, length), F.lit("")), F.lit("item"))


def shorten(text: Column, length: int) -> Column:
    """Blanks in runs as one; longer texts are cut and end in an ellipsis."""
    own = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(F.length(own) > length, F.concat(F.rtrim(F.substring(own, 1, length - 1)), F.lit("…"))).otherwise(own)


def excerpt(text: Column, terms: Column, length: int = 260, lead: int = 65) -> Column:
    """A window of ``length`` that starts ``lead`` before the first hit of any of ``terms``; from the start if none hits."""
    own = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    low = F.lower(own)
    hits = F.filter(F.transform(terms, lambda t: F.locate(F.lower(t), low) if isinstance(t, str) else F.position(F.lower(t), low)), lambda x: x > 0)
    start = F.greatest(F.coalesce(F.array_min(hits), F.lit(1)) - lead, F.lit(1))
    return F.substring(own, start, F.lit(length))


def core_tokens(name: Column) -> Column:
    """A name without one verb before it, and also without each modifier before that."""
    value = F.regexp_replace(normalize_text(name), f"^(?:{'|'.join(C.VERB_PREFIXES)})(?=[\\s\\S])", "")
    cut = F.transform(F.array(*map(F.lit, C.MODIFIERS)), lambda m: F.when(value.startswith(m) & (F.length(value) > F.length(m)), F.substring(value, F.length(m) + 1, F.length(value))))
    return F.array_distinct(F.filter(F.concat(F.array(value), cut), lambda x: x.isNotNull() & (x != "")))


def clamp_confidence(value: Column) -> Column:
    """A number from 0 to 1; what is no number is 0."""
    own = F.coalesce(value.cast("string").try_cast("double"), F.lit(0.0))
    return F.when(F.isnan(own), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), own)))


def infer_value_type(values: Column, sample: Column, name: Column, unit: Column) -> Column:
    """``number`` or ``text``: by the values that are not empty if there are any, else a sample that is a number, else words of text in the name, a unit, words of number in the name."""
    own = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    number = lambda x: F.trim(x).rlike(r"^[+-]?\d+(\.\d+)?$")
    named = lambda words: F.coalesce(name, F.lit("")).rlike("|".join(words))
    return (
        F.when(F.size(own) > 0, F.when(F.forall(own, number), "number").otherwise("text"))
        .when(number(F.coalesce(sample, F.lit(""))), "number")
        .when(named(C.TEXT_NAME_HINTS), "text")
        .when(F.coalesce(unit, F.lit("")) != "", "number")
        .when(named(C.NUMBER_NAME_HINTS), "number")
        .otherwise("text")
    )


def extract_title(text: Column, fallback: Column, length: int = 160) -> Column:
    """The first ``# `` heading, else the first line that is not empty, else ``fallback``."""
    own = F.coalesce(text, F.lit(""))
    heading = F.trim(F.regexp_extract(own, r"(?m)^#[ \t]+(\S[^\n]*)$", 1))
    first = F.trim(F.regexp_extract(own, r"(?m)^[ \t]*(\S[^\n]*)$", 1))
    return F.substring(F.coalesce(F.nullif(heading, F.lit("")), F.nullif(first, F.lit("")), fallback), 1, length)


def strip_front_matter(text: Column) -> Column:
    """A page without the block between ``---`` marks that it begins with, and without blanks around it."""
    own = F.coalesce(text, F.lit(""))
    return F.regexp_replace(F.regexp_replace(own, r"(?s)\A---.*?---", ""), r"\A\s+|\s+\z", "")


def extract_section(text: Column, heading: str) -> Column:
    """What stands under the first heading of level two or three that says ``heading``, up to the next of its level or a higher one; without front matter."""
    return _section(strip_front_matter(text), heading)


def _section(own: Column, heading: str) -> Column:
    # One pass: behind the heading goes all up to a mark at a line's beginning that closes it.
    closes = r"^#\s|^##?\1\s"
    found = F.regexp_extract(own, rf"(?m)^##(#?)\s+{re.escape(heading)}[ \t]*$((?:[^#]++|(?!{closes})#)*+)", 2)
    return F.regexp_replace(found, r"\A\s+|\s+\z", "")


def page_summary(text: Column, tables: dict[str, int], bold: tuple[str, ...] = (), most: int = 600) -> Column:
    """A short form of a page: of each section of ``tables`` its first table lines, as many as given, then the values of the ``bold`` names; at most ``most`` characters, cut at a line."""
    let = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def said(own: Column) -> Column:
        first = lambda h, n: F.slice(F.filter(F.split(_section(own, h), "\n"), lambda x: x.startswith("|")), 1, n)
        rows = lambda h: lambda r: F.when(F.size(r) > 0, F.concat(F.lit(f"{h}: "), F.array_join(r, " ")))
        value = lambda b: F.regexp_extract(own, rf"(?m)\*\*{re.escape(b)}\*\*:[ \t]*([^\n]+)", 1)
        name = lambda b: lambda v: F.when(v != "", F.concat(F.lit(f"{b}: "), F.substring(v, 1, 200)))
        picked = [*[let(first(h, n), rows(h)) for h, n in tables.items()], *[let(value(b), name(b)) for b in bold]]
        return F.concat_ws("\n", *picked)

    cut = lambda whole: F.when(F.length(whole) <= most, whole).otherwise(F.concat(F.regexp_replace(F.substring(whole, 1, most), r"\n[^\n]*\z", ""), F.lit("\n…")))
    # The page is made once, and so is each part of it.
    return let(strip_front_matter(text), lambda own: let(said(own), cut))


def repair_code(text: Column) -> Column:
    """Letters that look like digits as digits; a code of 9 to 12 digits at the start, else null."""
    return F.nullif(F.regexp_extract(F.translate(F.trim(text), "OoIl", "0011"), r"^(\d{9,12})(?:\D|$)", 1), F.lit(""))
