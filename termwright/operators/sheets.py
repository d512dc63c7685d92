"""Component workbooks: cells of their sheets, exported beforehand, as attributes, calculations and core parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X

#: The kinds of sheets, and the list that the rows of each go to.
LISTS = {"feature_attributes": "attributes", "legacy_attributes": "attributes", "calculations": "calculations", "property_defaults": "core_params", "legacy_core_params": "core_params"}
_BY_NAME = {"attributes": "legacy_attributes", "calculations": "calculations", "core_params": "legacy_core_params"}


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def sheet_kinds(cells: DataFrame) -> DataFrame:
    """(``book``, ``sheet_no``, ``kind``): by the columns of a sheet, else by words in its name, else by columns again; sheets of no kind are left out."""
    sheets = cells.groupBy("book", "sheet_no").agg(F.first("sheet").alias("sheet"), F.collect_set(_strip(F.col("column"))).alias("columns"))
    has = lambda *names: F.size(F.array_intersect("columns", F.array(*map(F.lit, names)))) == len(names)
    any_of = lambda k: F.arrays_overlap("columns", F.array(*map(F.lit, C.SHEET_COLUMNS[k])))
    name, code, choices = (C.SHEET_COLUMNS[k][0] for k in ("name", "code", "choices"))
    low = F.lower(_strip(F.coalesce("sheet", F.lit(""))))
    kind = F.when(has(name, code, choices), "feature_attributes").when(has(name, code, C.SHEET_DEFAULTS), "property_defaults")
    for k, words in C.SHEET_NAMES.items():
        kind = kind.when(low.rlike("|".join(words)), _BY_NAME[k])
    kind = kind.when(has(name, code) & (any_of("unit") | any_of("expression")), "calculations")
    return sheets.select("book", "sheet_no", kind.alias("kind")).where("kind is not null")


def split_values(text: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), C.VALUE_BREAKS), _strip)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def sheet_items(cells: DataFrame) -> DataFrame:
    """Cells (``book``, ``sheet_no``, ``sheet``, ``row``, ``column``, ``value``) as items: ``book``, ``list``, ``pos``, ``name``, ``code``, ``data_type``, ``values``, ``value``, ``expression``, ``unit``, ``sheet``.

    A row without name and code is no item. The type of an attribute or parameter is the one that its sheet says, else it is inferred, also from the unit
    that a calculation of the same book has under the same code. Of items with one code (without one: one name) in a list the last one counts, in the place of the first; ``pos`` is
    (sheet, row). The cells of a row are gathered once, for all kinds of sheets.
    """
    kinds = sheet_kinds(cells)
    known = sorted({n for names in C.SHEET_COLUMNS.values() for n in names})
    value = F.nullif(_strip(F.col("value").cast("string")), F.lit(""))
    rows = cells.groupBy("book", "sheet_no", "row").agg(F.first("sheet").alias("sheet"), *[F.min(F.when(F.col("column") == n, value)).alias(f"c{i}") for i, n in enumerate(known)])
    first = lambda k: F.coalesce(*[F.col(f"c{known.index(n)}") for n in C.SHEET_COLUMNS[k]], F.lit(""))
    rows = rows.join(kinds, ["book", "sheet_no"]).select(
        "book", F.struct("sheet_no", "row").alias("pos"), "sheet", "kind", first("name").alias("name"), F.upper(first("code")).alias("code"), F.lower(first("kind")).alias("said"), first("choices").alias("choices"),
        first("values").alias("listed"), first("value").alias("value"), first("unit").alias("unit"), first("expression").alias("expression"),
    )
    # The last unit that a calculation sheet has for a code; calculations need no name for that.
    units = rows.where("kind = 'calculations' and code <> '' and unit <> ''").groupBy("book", "code").agg(F.max_by("unit", "pos").alias("linked"))
    rows = rows.where("name <> '' or code <> ''").join(units, ["book", "code"], "left")
    is_ = lambda *ks: F.col("kind").isin(*ks)
    none = F.array().cast("array<string>")
    values = F.when(is_("feature_attributes"), split_values(F.col("choices"))).when(is_("legacy_attributes"), split_values(F.col("listed"))).otherwise(none)
    core = is_("property_defaults", "legacy_core_params")
    rows = rows.withColumns({"values": values, "value": F.when(core, F.col("value")).otherwise("")})
    inferred = X.infer_value_type(F.col("values"), F.col("value"), F.col("name"), F.col("linked"))
    kind = F.when(is_("calculations"), F.lit(None).cast("string")).when(~is_("feature_attributes") & F.col("said").isin("text", "number"), F.col("said")).otherwise(inferred)
    own = lambda c: F.when(is_("calculations"), F.col(c)).otherwise("").alias(c)
    lists = F.element_at(F.create_map(*[F.lit(x) for p in LISTS.items() for x in p]), F.col("kind"))
    key = F.when(F.col("code") != "", F.col("code")).otherwise(F.concat(F.lit("name:"), F.col("name")))
    items = rows.select("book", lists.alias("list"), key.alias("key"), "pos", F.struct("name", "code", kind.alias("data_type"), "values", "value", own("expression"), own("unit"), "sheet").alias("item"))
    last = items.groupBy("book", "list", "key").agg(F.min("pos").alias("pos"), F.max_by("item", "pos").alias("item"))
    return last.select("book", "list", "pos", "item.*")


def sheet_catalog(cells: DataFrame) -> DataFrame:
    """A row for each ``book`` with its lists in order, each with fields of its own: ``attributes`` (name, code, data_type, values, sheet), ``calculations`` (name, code, expression, unit, sheet), ``core_params`` (name, code, data_type, value, sheet)."""
    fields = {"attributes": ("name", "code", "data_type", "values", "sheet"), "calculations": ("name", "code", "expression", "unit", "sheet"), "core_params": ("name", "code", "data_type", "value", "sheet")}
    part = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("list") == k, F.struct("pos", F.struct(*fields[k]).alias("item"))))), lambda x: x["item"]).alias(k)
    return sheet_items(cells).groupBy("book").agg(*map(part, fields))
