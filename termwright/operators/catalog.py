"""Catalogue and synonym tables: building, repairing, grouping, updating."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X


def ordered(value: Column, *order: Column) -> Column:
    """Aggregate: the values in order, as an array; nulls are left out."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.alias("v")))))
    return F.transform(pairs, lambda p: p["v"])


def first_values(value: Column, *order: Column) -> Column:
    """Aggregate: the distinct values in the order of their first place."""
    return F.array_distinct(ordered(value, *order))


def distinct_values(df: DataFrame, group: list[str], value: Column, order: Column, name: str) -> DataFrame:
    """(``group``, ``name``): the distinct values of each group in the order of their first place. A value is reduced to that place before values are gathered, so a hot group gathers no more than it has values."""
    first = df.where(value.isNotNull()).groupBy(*group, value.alias("__value")).agg(F.min(order).alias("__first"))
    return first.groupBy(*group).agg(ordered(F.col("__value"), F.col("__first"), F.col("__value")).alias(name))


def first_rows(df: DataFrame, group: list[str], order: list[Column], k: int | Column, salts: int = 32) -> DataFrame:
    """The first ``k`` rows of each group in order, as ``rank``, found within salted parts of the group first: no task sorts a hot group."""
    rows = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    near = rows.withColumn("__k", F.row_number().over(Window.partitionBy(*group, "__salt").orderBy(*order))).where(F.col("__k") <= k)
    return near.drop("__k", "__salt").withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def meaningful_attributes(attributes: DataFrame) -> DataFrame:
    """Attributes (``name``, ``code``, ...) without those that every component has."""
    name, code = X.blank_to_empty(F.col("name")), X.blank_to_empty(F.col("code"))
    generic = reduce(lambda a, b: a | b, [name.contains(p) for p in C.GENERIC_ATTRIBUTE_NAME_PARTS])
    return attributes.where((name != "") & (code != "") & ~code.isin(*C.GENERIC_ATTRIBUTE_CODES) & ~generic)


def build_catalog(attributes: DataFrame, calculations: DataFrame) -> DataFrame:
    """One row for each component: its meaningful attributes and its calculations, in order."""
    a = meaningful_attributes(attributes).groupBy("component").agg(ordered(F.struct("name", "code"), F.col("pos")).alias("attributes"))
    c = calculations.where("trim(code) <> ''").groupBy("component").agg(ordered(F.struct("name", "code", X.normalize_unit(F.col("unit")).alias("unit")), F.col("pos")).alias("calculations"))
    return a.join(c, "component", "full_outer")


def migrate_properties(raw: DataFrame, column: str = "properties") -> DataFrame:
    """Property texts of the old layout (a list of attributes) or the new one (an object) as the new struct."""
    item = "array<struct<name:string,code:string>>"
    new = F.from_json(column, f"struct<attributes:{item},calculations:{item}>")
    old = F.from_json(column, item)
    empty = F.array().cast(item)
    is_list = F.trim(F.col(column)).startswith("[")
    return raw.withColumn(
        "migrated",
        F.struct(
            F.when(is_list, F.coalesce(old, empty)).otherwise(F.coalesce(new["attributes"], empty)).alias("attributes"), F.when(is_list, empty).otherwise(F.coalesce(new["calculations"], empty)).alias("calculations")
        ),
    )


def dedupe_by_code(items: DataFrame, keys: list[str]) -> DataFrame:
    """One item for each code (or name, where the code is blank): the last value, at the first position."""
    rest = [c for c in items.columns if c not in (*keys, "code", "pos")]
    key = F.coalesce(F.nullif(F.trim("code"), F.lit("")), F.col("name"))
    found = items.groupBy(*keys, key.alias("item_key")).agg(F.max_by(F.struct("code", *rest), "pos").alias("last"), F.min("pos").alias("pos"))
    return found.select(*keys, "item_key", "pos", "last.*")


def upsert_catalog(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New items replace the old ones of the same keys, others are added; ``change`` is added, updated or kept."""
    values = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*values).alias("o"))
    n = new.select(*keys, F.struct(*values).alias("n"))
    both = o.join(n, keys, "full_outer")
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "kept").otherwise("updated")
    return both.select(*keys, *[F.coalesce(F.col(f"n.{v}"), F.col(f"o.{v}")).alias(v) for v in values], change.alias("change"))


def common_attributes(attributes: DataFrame, least: int = 40) -> DataFrame:
    """Attribute codes of at least ``least`` components, with the name of the first."""
    found = attributes.groupBy("code").agg(F.count_distinct("component").alias("components"), F.min_by("name", F.struct("component", "name")).alias("name"))
    return found.where(F.col("components") >= least)


def normalize_mappings(records: DataFrame) -> DataFrame:
    """Raw mapping records with clean fields; the status follows from them: selected, candidates or none."""
    selected = X.nullish_to_null(F.col("selected"))
    listed = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    candidates = F.array_distinct(F.filter(F.concat(F.array(selected), listed(F.col("candidates"))), lambda x: x.isNotNull()))
    status = F.when(selected.isNotNull(), "matched").when(F.size(candidates) > 0, F.when(F.lower(F.trim("status")) == "conflict", "conflict").otherwise("candidate_only")).otherwise("unmatched")
    review = F.coalesce(F.nullif(F.trim("review"), F.lit("")), F.when(selected.isNotNull(), "suggested").otherwise("pending"))
    return records.select("source", "pos", selected.alias("selected"), candidates.alias("candidates"), status.alias("status"), X.clamp_confidence(F.col("confidence")).alias("confidence"), review.alias("review"))


def coerce_results(raw: DataFrame, column: str = "answer") -> DataFrame:
    """Answers as text: the JSON part read under any of the known field names, with a default confidence; a sole candidate is selected."""
    form = "struct<source_component_name:string,name:string,selected_standard_name:string,match:string,candidates:array<string>,confidence:string>"
    j = F.from_json(F.regexp_extract(column, r"(?s)(\{.*\})", 1), form)
    rows = raw.withColumn("j", j).where("j is not null")
    candidates = F.coalesce("j.candidates", F.array().cast("array<string>"))
    named = F.coalesce(X.nullish_to_null(F.col("j.selected_standard_name")), X.nullish_to_null(F.col("j.match")))
    selected = F.coalesce(named, F.when(F.size(candidates) == 1, F.get(candidates, F.lit(0))))
    default = F.when(selected.isNotNull(), 0.7).when(F.size(candidates) > 0, 0.35).otherwise(0.0)
    return rows.select(
        *[c for c in raw.columns if c != column],
        F.coalesce("j.source_component_name", "j.name").alias("source"),
        selected.alias("selected"),
        candidates.alias("candidates"),
        F.coalesce(F.col("j.confidence").try_cast("double"), default).alias("confidence"),
    )


def synonym_library(mappings: DataFrame) -> DataFrame:
    """Mappings grouped by source: aliases in order of appearance, the chapters and types they stand in, first selected name, last status, review states.

    ``mappings`` are (``source``, ``pos``, ``selected``, ``candidates``, ``status``, ``review``) and, if there are such columns, ``chapter`` and ``type``.
    """
    generic = ("面积", "周长", "体积", "长度", "高度", "厚度", "宽度", "数量", "重量", "净面积", "外放面积")
    alias = F.col("alias")
    aliases = mappings.where("status in ('matched', 'candidate_only', 'conflict')").select("source", "pos", F.posexplode(F.array_compact(F.concat(F.array("selected"), F.col("candidates")))).alias("at", "alias"))
    aliases = aliases.where((F.trim(alias) != "") & (alias != F.col("source")) & ~alias.isin(*generic))
    out = mappings.groupBy("source").agg(
        F.min_by(F.when(F.col("selected").isNotNull(), F.col("selected")), F.when(F.col("selected").isNotNull(), F.col("pos"))).alias("selected"), F.max_by("status", "pos").alias("status"), F.count("*").alias("mappings")
    )
    out = out.join(distinct_values(mappings, ["source"], F.col("review"), F.col("pos"), "reviews"), "source", "left")
    out = out.join(distinct_values(aliases, ["source"], alias, F.struct("pos", "at"), "aliases"), "source", "left")
    for column, name in (("chapter", "chapters"), ("type", "types")):
        if column in mappings.columns:
            out = out.join(distinct_values(mappings.where(F.trim(column) != ""), ["source"], F.col(column), F.col("pos"), name), "source", "left")
    none = F.array().cast("array<string>")
    return out.withColumns({c: F.coalesce(c, none) for c in ("reviews", "aliases", "chapters", "types") if c in out.columns})


def synonym_bridges(synonyms: DataFrame, components: DataFrame) -> DataFrame:
    """(``key``, ``component``) for known components: aliases normalised, with and without affixes."""
    known = synonyms.withColumnRenamed("source", "component").join(components.select("component"), "component", "left_semi")
    names = known.select("component", F.explode(F.array_distinct(F.concat(F.array("component"), F.col("aliases")))).alias("bridge"))
    keys = F.array(X.normalize_text(F.col("bridge")), X.normalize_text(X.strip_affixes(F.col("bridge"))))
    return names.select(F.explode(keys).alias("key"), "component").where("key <> ''").distinct()
