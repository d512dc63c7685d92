"""Merging of competing results: best of several, conflicts, completeness, overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.operators.catalog import first_values


def weight(value: Column, weights: dict[str, float], other: float = 0.0) -> Column:
    """The fixed weight of a word, by a chain of constants."""
    out = None
    for k, w in weights.items():
        out = F.when(value == k, float(w)) if out is None else out.when(value == k, float(w))
    return out.otherwise(other)


def merge_candidates(mappings: DataFrame) -> DataFrame:
    """One mapping for each source: the best by status, confidence, evidence and place; candidates united; several selected names are a conflict.

    ``mappings`` are (``source``, ``pos``, ``selected``, ``candidates``, ``status``, ``confidence``, ``review``, ``evidence``).
    """
    rank = F.struct(weight(F.col("status"), C.STATUS_RANK), "confidence", "evidence", -F.col("pos"))
    names = mappings.select("source", "pos", F.posexplode(F.array_compact(F.concat(F.array("selected"), F.col("candidates")))).alias("at", "name"))
    united = names.where("name <> ''").groupBy("source").agg(first_values(F.col("name"), F.col("pos"), F.col("at")).alias("candidates"))
    best = mappings.groupBy("source").agg(
        F.max_by(F.struct("selected", "status", "review"), rank).alias("b"), F.max("confidence").alias("confidence"), first_values(F.col("selected"), F.col("pos")).alias("names")
    )
    several = F.size("names") > 1
    empty = F.array().cast("array<string>")
    return best.join(united, "source", "left").select(
        "source",
        F.when(several, F.lit(None)).otherwise(F.coalesce("b.selected", F.get("names", F.lit(0)))).alias("selected"),
        F.when(several, "conflict").when(F.coalesce("b.selected", F.get("names", F.lit(0))).isNotNull(), "matched").otherwise(F.col("b.status")).alias("status"),
        "confidence",
        F.when(several, "pending").otherwise(F.col("b.review")).alias("review"),
        F.array_distinct(F.concat("names", F.coalesce("candidates", empty))).alias("candidates"),
    )


def conflict_score(m: DataFrame) -> Column:
    """How strong a mapping is: selected, status, type, confidence, review, evidence."""
    return (
        F.when(F.col("selected").isNotNull(), 4000.0).otherwise(0.0)
        + weight(F.lower(F.trim("status")), C.STATUS_SCORE)
        + weight(F.lower(F.trim("match_type")), C.TYPE_WEIGHT) * 100
        + F.col("confidence") * 100
        + weight(F.lower(F.trim("review")), C.REVIEW_WEIGHT) * 10
        + F.least(F.col("evidence").cast("double"), F.lit(20.0))
    )


def resolve_conflicts(merged: DataFrame, mappings: DataFrame, gap: float = 120.0) -> DataFrame:
    """``merged`` with conflicts settled where the best selected mapping is far enough ahead of the second; ``resolved`` says which.

    Far enough: by ``gap`` points, by 2 in the weight of its type, or a confidence of 0.9 against 0.5 with a type no weaker.
    """
    scored = mappings.where("selected is not null").join(merged.where("status = 'conflict'").select("source"), "source", "left_semi").withColumn("points", conflict_score(mappings)).withColumn("type", weight(F.lower(F.trim("match_type")), C.TYPE_WEIGHT))
    order = Window.partitionBy("source").orderBy(F.desc("points"), F.desc("confidence"), F.desc("evidence"), "pos")
    two = scored.withColumn("k", F.row_number().over(order)).where("k <= 2").groupBy("source").agg(
        *[F.max(F.when(F.col("k") == k, F.struct("points", "type", "confidence", "selected", "review"))).alias(n) for k, n in ((1, "a"), (2, "b"))]
    )
    ahead = (F.col("a.points") - F.col("b.points") >= gap) | (F.col("a.type") - F.col("b.type") >= 2) | ((F.col("a.confidence") >= 0.9) & (F.col("b.confidence") <= 0.5) & (F.col("a.type") >= F.col("b.type")))
    won = two.where(ahead).select("source", F.col("a.selected").alias("won"), F.col("a.review").alias("won_review"))
    return merged.join(won, "source", "left").select(
        "source",
        F.coalesce("won", "selected").alias("selected"),
        F.when(F.col("won").isNotNull(), "matched").otherwise(F.col("status")).alias("status"),
        "confidence",
        F.coalesce("won_review", "review").alias("review"),
        "candidates",
        F.col("won").isNotNull().alias("resolved"),
    )


def ensure_complete(rows: DataFrame, expected: DataFrame, key: str, defaults: dict) -> DataFrame:
    """One row for each expected key: its own, or the defaults."""
    values = [c for c in rows.columns if c != key]
    found = rows.withColumn("__found", F.lit(True))
    return expected.select(key).distinct().join(found, key, "left").select(key, *[F.when(F.col("__found"), F.col(c)).otherwise(F.lit(defaults.get(c))).alias(c) for c in values])


def batch_quality(mappings: DataFrame, expected: DataFrame) -> DataFrame:
    """For each ``batch``: how many expected sources have which status, and the mean deviation; the first mapping of a source counts."""
    first = mappings.groupBy("batch", "source").agg(F.min_by("status", "pos").alias("status"))
    own = expected.select("batch", "source").distinct().join(first, ["batch", "source"], "left")
    count = lambda s: F.count_if(F.coalesce("status", F.lit("missing")) == s)
    # Whole hundredths and whole division: the mean depends on no order and on no binary fraction.
    points = F.sum(F.round(weight(F.coalesce("status", F.lit("missing")), C.DEVIATION, 1.0) * 100).cast("long"))
    sums = own.groupBy("batch").agg(F.count("*").alias("expected"), *[count(s).alias(s) for s in ("matched", "candidate_only", "conflict", "unmatched", "missing")], points.alias("points"))
    return sums.withColumn("deviation", F.expr("(200 * points + expected) div (2 * expected)") / 10000.0).drop("points")


def needs_revalidation(quality: DataFrame, least: float = 0.6) -> DataFrame:
    return quality.where((F.col("deviation") >= least) | (F.col("matched") == 0)).select("batch", "deviation")


def items_of_text(text: Column) -> Column:
    """array<struct<order, expression, matched>>: the lines of a text as feature items, without their numbers; a line with a colon counts as matched."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "<br>|\r\n?", "\n"), "\n")
    own = F.transform(lines, lambda x, i: F.struct((i + 1).alias("order"), F.regexp_replace(F.trim(x), r"^\d+[.、]\s*", "").alias("expression"), (F.trim(x) == "").alias("blank")))
    return F.transform(F.filter(own, lambda x: ~x["blank"]), lambda x: F.struct(x["order"].alias("order"), x["expression"].alias("expression"), x["expression"].contains(":").alias("matched")))


def overlay_results(local: DataFrame, newer: DataFrame, key: str, items: tuple[str, ...] = ()) -> DataFrame:
    """``local`` with the fields that ``newer`` supplies (column ``provided``) and that are not blank; fields of ``newer`` for other keys are left out.

    Columns of ``items`` are item lists (:func:`items_of_text`): one that is supplied always replaces the other, an empty one too; where ``newer`` has a text it is made a list.
    """
    values = [c for c in local.columns if c != key]
    text = {c for c, kind in newer.dtypes if kind == "string"}
    n = newer.select(key, F.struct("provided", *[(items_of_text(F.col(c)) if c in items and c in text else F.col(c)).alias(c) for c in values if c in newer.columns]).alias("n"))
    given = lambda c: F.array_contains("n.provided", c)
    filled = lambda c: F.col(f"n.{c}").isNotNull() & (F.trim(F.col(f"n.{c}").cast("string")) != "")
    supplied = lambda c: given(c) if c in items else given(c) & filled(c)
    none = lambda c: F.coalesce(F.col(f"n.{c}"), F.array().cast(local.schema[c].dataType)) if c in items else F.col(f"n.{c}")
    return local.join(n, key, "left").select(key, *[F.when(supplied(c), none(c)).otherwise(F.col(c)).alias(c) if c in newer.columns else F.col(c) for c in values])


def recover_partial(chapters: DataFrame, batches: DataFrame, expected: DataFrame) -> DataFrame:
    """For each expected source the merge of all chapters: a chapter's own mappings, or else those of its batches; ``whole`` is whether all expected sources have one."""
    lacking = batches.join(chapters.select("chapter").distinct(), "chapter", "left_anti")
    merged = merge_candidates(chapters.unionByName(lacking).drop("chapter"))
    return ensure_complete(merged.drop("candidates", "review"), expected, "source", {"status": "unmatched", "confidence": 0.0, "selected": None})
