"""Matching of items whose component is given: features and calculation are looked up in that component alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import text as X
from termwright.operators import matching as M

#: Between the features of one line, and what is cut from their ends (fixed values).
FEATURE_MARKS, FEATURE_EDGES = "[、,，;；/]+", "[ ：:。.;；,，]"


def name_keys(name: Column) -> Column:
    """The normal forms of a name, with and without affixes."""
    return F.array_distinct(F.filter(F.array(X.normalize_text(name), X.normalize_text(X.strip_affixes(name))), lambda k: k != ""))


def resolve_component(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """(``row_id``, ``component``, ``basis``) of items (``row_id``, ``given``): the component of that very name, else the first of the ``catalog`` (``component``, ``pos``, ``names``) one of whose names has a normal form in common.

    An item without either has a null component and the basis ``none``.
    """
    own = items.select("row_id", F.trim(F.coalesce("given", F.lit(""))).alias("given"))
    exact = own.join(catalog.select(F.col("component").alias("given"), F.col("component").alias("exact")), "given", "left")
    names = catalog.select("component", "pos", F.explode(F.array_union(F.array("component"), F.coalesce("names", F.array().cast("array<string>")))).alias("name"))
    first = names.select("component", "pos", F.explode(name_keys(F.col("name"))).alias("key")).groupBy("key").agg(F.min_by("component", F.struct("pos", "component")).alias("found"), F.min("pos").alias("pos"))
    keys = exact.where("exact is null").select("row_id", F.explode(name_keys(F.col("given"))).alias("key"))
    alias = keys.join(first, "key").groupBy("row_id").agg(F.min_by("found", F.struct("pos", "found")).alias("alias"))
    out = exact.join(alias, "row_id", "left")
    return out.select("row_id", F.coalesce("exact", "alias").alias("component"), F.when(F.col("exact").isNotNull(), "exact").when(F.col("alias").isNotNull(), "alias").otherwise("none").alias("basis"))


def atomic_features(rows: DataFrame, text: str = "features") -> DataFrame:
    """(``row_id``, ``feature_order``, ``raw_text``): the lines of a feature text, without their numbers, split at marks into single features and numbered anew."""
    clean = F.regexp_replace(F.regexp_replace(F.translate(F.coalesce(F.col(text), F.lit("")), "　．：", " .:"), "[ \t]+", " "), "\n+", "\n")
    lines = F.filter(F.transform(F.split(clean, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    form = r"^\s*(\d+)\s*[.\-]?\s*(.+?)\s*$"
    bare = F.transform(lines, lambda x: F.when(x.rlike(form), F.regexp_extract(x, form, 2)).otherwise(x))

    def parts(line: Column) -> Column:
        cut = F.filter(F.transform(F.split(line, FEATURE_MARKS), lambda p: F.regexp_replace(p, f"^{FEATURE_EDGES}+|{FEATURE_EDGES}+$", "")), lambda p: p != "")
        return F.when(F.size(cut) > 1, cut).otherwise(F.array(line))

    return rows.select("row_id", F.posexplode(F.flatten(F.transform(bare, parts))).alias("at", "raw_text")).select("row_id", (F.col("at") + 1).alias("feature_order"), "raw_text")


def _described(items: DataFrame, resolved: DataFrame, attributes: DataFrame, calculations: DataFrame) -> DataFrame:
    """The items with their ``component``, ``basis``, how many ``features`` they have and how many are ``found``, the ``expressions`` and the calculation."""
    rule = F.when(F.trim(F.coalesce("rule", F.lit(""))) != "", F.col("rule")).otherwise(F.coalesce("work", F.lit("")))
    own = items.withColumn("rule", rule).join(resolved, "row_id")
    features = M.match_features(atomic_features(own).join(own.select("row_id", "component"), "row_id"), attributes)
    counted = features.groupBy("row_id").agg(
        F.count("*").alias("features"), F.count_if("matched").alias("found"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("feature_order", "expression"))), lambda x: x["expression"]), "|").alias("expressions")
    )
    calculation = M.select_calculation(own.where("component is not null").select("row_id", "component", "name", "rule", X.normalize_unit(F.col("unit")).alias("unit")), calculations)
    out = own.select("row_id", "component", "basis").join(counted, "row_id", "left").join(calculation.select("row_id", "calc_code", "calc_name", F.col("unit").alias("calc_unit")), "row_id", "left")
    return out.na.fill(0, ["features", "found"]).na.fill("", ["expressions", "calc_code", "calc_name", "calc_unit"])


def direct_match(items: DataFrame, catalog: DataFrame, attributes: DataFrame, calculations: DataFrame) -> DataFrame:
    """Each item (``row_id``, ``given``, ``name``, ``features``, ``unit``, ``rule``, ``work``) with its component, features and calculation, ``status`` and ``confidence``.

    ``matched`` (0.9) if all its features have an attribute and there is a calculation, ``candidate_only`` (0.55) if some have, else
    ``unmatched`` (0.1; 0 without a component). Where an item has no rule, its work text stands for it.
    """
    out = _described(items, resolve_component(items, catalog), attributes, calculations)
    status = F.when(F.col("component").isNull(), "unmatched").when((F.col("found") == F.col("features")) & (F.col("calc_code") != ""), "matched").when(F.col("found") > 0, "candidate_only").otherwise("unmatched")
    confidence = F.when(F.col("component").isNull(), 0.0).when(F.col("status") == "matched", 0.9).when(F.col("status") == "candidate_only", 0.55).otherwise(0.1)
    return out.withColumn("status", status).withColumn("confidence", confidence)


def forced_match(items: DataFrame, catalog: DataFrame, attributes: DataFrame, calculations: DataFrame) -> DataFrame:
    """Each item (as for :func:`direct_match`) with the component it is given, by exact name or else by alias, and that component's features and calculation."""
    return _described(items, resolve_component(items, catalog), attributes, calculations)


#: Where a row's component is looked for, in order (fixed values).
COMPONENT_FIELDS = ("quantity_component", "resolved_component_name", "source_component_name", "component_type")


def handoff_items(rows: DataFrame, component: str | None = None) -> DataFrame:
    """The match rows as items for :func:`direct_match`: ``row_id`` and ``given``, the first component field that is not blank (or ``component`` for all).

    Rows without a component go; so do those that are neither matched nor candidates, unless ``component`` is given. ``skip_counts`` says how many.
    """
    return _handed(rows, component).where("reason is null").drop("reason")


def skip_counts(rows: DataFrame, component: str | None = None) -> DataFrame:
    """How many rows :func:`handoff_items` is given, and leaves out for want of a component or a match."""
    reason = _handed(rows, component).agg(F.count("*").alias("total"), F.count_if(F.col("reason") == "no component").alias("no_component"), F.count_if(F.col("reason") == "unmatched").alias("unmatched"))
    return reason


def _handed(rows: DataFrame, component: str | None) -> DataFrame:
    filled = lambda c: F.nullif(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(""))
    given = F.lit(component) if component else F.coalesce(*[filled(c) for c in COMPONENT_FIELDS if c in rows.columns])
    fit = F.lit(True) if component else F.coalesce(F.trim("match_status").isin("matched", "candidate_only"), F.lit(False))
    return rows.withColumn("given", given).withColumn("reason", F.when(F.col("given").isNull(), "no component").when(~fit, "unmatched"))
