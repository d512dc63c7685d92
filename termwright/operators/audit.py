"""Audit of features that found no attribute, review states, and rules learnt from corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termwright.operators.catalog import first_rows, ordered, synonym_library


def audit_items(features: DataFrame) -> DataFrame:
    """One row for each feature: ``component``, ``label``, ``value``, ``attribute``, ``matched``, ``row_id``, ``pos``; the raw text stands for a missing label."""
    return features.select(
        F.coalesce("component", F.lit("unknown")).alias("component"), F.coalesce(F.nullif("label", F.lit("")), F.col("raw_text")).alias("label"), "value", "attribute", F.coalesce("matched", F.lit(False)).alias("matched"), "row_id", "pos", F.coalesce("raw_text", F.lit("")).alias("raw_text")
    )


def aggregate_audit(items: DataFrame) -> DataFrame:
    """For each component and label: counts, the first attribute, at most three values, the kind of match.

    Values are reduced to their first places before they are gathered, so a common label doesn't gather all its rows.
    """
    counts = items.groupBy("component", "label").agg(
        F.count("*").alias("occurrences"),
        F.count_if("matched").alias("matched"),
        F.min_by(F.when(F.col("matched"), F.col("attribute")), F.when(F.col("matched") & F.col("attribute").isNotNull(), F.col("pos"))).alias("attribute"),
    )
    values = items.where("value is not null and value <> ''").groupBy("component", "label", "value").agg(F.min("pos").alias("first"))
    w = Window.partitionBy("component", "label").orderBy("first", "value")
    samples = values.withColumn("k", F.row_number().over(w)).where("k <= 3").groupBy("component", "label").agg(F.array_join(ordered(F.col("value"), F.col("k")), "|").alias("samples"))
    kind = F.when((F.col("matched") > 0) & (F.col("matched") < F.col("occurrences")), "intermittent").when(F.col("matched") > 0, "matched").otherwise("unmatched")
    return counts.join(samples, ["component", "label"], "left").select("component", "label", "occurrences", "matched", (F.col("occurrences") - F.col("matched")).alias("unmatched"), "attribute", F.coalesce("samples", F.lit("")).alias("samples"), kind.alias("kind"))


def audit_stats(audit: DataFrame) -> DataFrame:
    """How many labels of each kind every component has."""
    return audit.groupBy("component").agg(F.count("*").alias("labels"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("matched", "unmatched", "intermittent")])


def top_open_labels(audit: DataFrame, most: int = 30) -> DataFrame:
    """The labels that are open in most components; equal counts go by label."""
    return audit.where("kind <> 'matched'").groupBy("label").agg(F.count("*").alias("components")).orderBy(F.desc("components"), "label").limit(most)


def top_labels(items: DataFrame, most: int, group: tuple[str, ...] = ("component",)) -> DataFrame:
    """(``group``, ``labels``): the ``most`` frequent labels of each group with their counts; equal counts go by label."""
    counts = items.groupBy(*group, "label").count()
    w = Window.partitionBy(*group).orderBy(F.desc("count"), "label")
    top = counts.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)
    return top.groupBy(*group).agg(F.array_join(ordered(F.concat_ws(":", "label", "count"), F.col("k")), "|").alias("labels"))


def gap_analysis(items: DataFrame, most: int = 20, samples: int = 3) -> DataFrame:
    """For each component: features, open ones, their share, the rows they are in, the ``most`` frequent open labels, and the first ``samples`` raw texts of each of these."""
    total = items.groupBy("component").agg(F.count("*").alias("items"), F.count_if(~F.col("matched")).alias("open"), F.count_distinct(F.when(~F.col("matched"), F.col("row_id"))).alias("rows"))
    open_ = items.where("not matched")
    counts = open_.groupBy("component", "label").count()
    top = counts.withColumn("k", F.row_number().over(Window.partitionBy("component").orderBy(F.desc("count"), "label"))).where(F.col("k") <= most)
    first = first_rows(open_.where("raw_text <> ''").select("component", "label", "pos", "row_id", "raw_text"), ["component", "label"], [F.col("pos"), F.col("row_id"), F.col("raw_text")], samples)
    texts = first.groupBy("component", "label").agg(F.array_join(ordered(F.col("raw_text"), F.col("rank")), ",").alias("texts"))
    told = top.join(texts, ["component", "label"], "left").groupBy("component").agg(
        F.array_join(ordered(F.concat_ws(":", "label", "count"), F.col("k")), "|").alias("labels"), F.array_join(ordered(F.concat_ws("=", "label", F.coalesce("texts", F.lit(""))), F.col("k")), "|").alias("samples")
    )
    rate = F.round(F.col("open") / F.col("items"), 3)
    return total.join(told, "component", "left").select("component", "items", "open", rate.alias("gap_rate"), "rows", *[F.coalesce(c, F.lit("")).alias(c) for c in ("labels", "samples")])


def top_gaps(items: DataFrame, most: int = 30) -> DataFrame:
    """The open labels that are most frequent overall."""
    return items.where("not matched").groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(most)


def component_profile(matches: DataFrame, items: DataFrame) -> DataFrame:
    """For each component, and for each of its chapters (``all_chapters`` 0): rows by status, those with a calculation and pending ones, features and how many are matched.

    A component as a whole also has its share of matched features, its most frequent calculation codes (15) and matched (10) and open labels (20).
    ``matches`` are (``row_id``, ``component``, ``chapter``, ``status``, ``review``, ``calc_code``), ``items`` (``row_id``, ``label``, ``matched``).
    """
    counted = items.groupBy("row_id").agg(F.count("*").alias("features"), F.count_if("matched").alias("found"))
    own = matches.join(counted, "row_id", "left").withColumns({"features": F.coalesce("features", F.lit(0)), "found": F.coalesce("found", F.lit(0))})
    calc = F.coalesce("calc_code", F.lit("")) != ""
    rows = own.groupingSets([["component"], ["component", "chapter"]], "component", "chapter").agg(
        F.grouping("chapter").alias("all_chapters"),
        F.count("*").alias("rows"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("matched", "candidate_only", "unmatched")],
        F.count_if(calc).alias("with_calculation"),
        F.count_if(F.col("review") == "pending").alias("pending"),
        F.sum("features").alias("features"),
        F.sum("found").alias("found"),
    )
    codes = top_labels(matches.where(calc).select("component", F.col("calc_code").alias("label")), 15).withColumnRenamed("labels", "codes")
    told = items.select("row_id", "label", "matched").join(matches.select("row_id", "component"), "row_id")
    found, open_ = (top_labels(told.where(F.col("matched") == m), n).withColumnRenamed("labels", c) for m, n, c in ((True, 10, "matched_labels"), (False, 20, "open_labels")))
    tops = rows.where("all_chapters = 1").select("component", F.lit(1).alias("all_chapters")).join(codes, "component", "left").join(found, "component", "left").join(open_, "component", "left")
    tops = tops.na.fill("", ["codes", "matched_labels", "open_labels"])
    rate = F.when(F.col("all_chapters") == 1, F.round(F.col("found") / F.greatest("features", F.lit(1)) * 100, 1))
    return rows.withColumn("feature_rate", rate).join(tops.withColumn("all_chapters", F.col("all_chapters").cast("tinyint")), ["component", "all_chapters"], "left")


def with_state(audit: DataFrame, state: DataFrame) -> DataFrame:
    """Audit rows with their latest review state (``component``, ``label``, ``status``, ``note``, ``updated_at``, ``pos``); none yet is ``to-fill``."""
    latest = state.groupBy("component", "label").agg(F.max_by(F.struct("status", "note", "updated_at"), F.struct("updated_at", "pos")).alias("s"))
    return audit.join(latest, ["component", "label"], "left").withColumn("status", F.coalesce("s.status", F.lit("to-fill"))).withColumn("note", F.col("s.note")).withColumn("updated_at", F.col("s.updated_at")).drop("s")


def audit_filter(audit: DataFrame, text: str = "", kinds: tuple = (), statuses: tuple = (), component: str = "", label: str = "") -> DataFrame:
    """Rows of the given kinds, statuses and component, whose label holds ``label``, and whose component, label or note holds ``text``, whatever the case."""
    out = audit
    if component:
        out = out.where(F.col("component") == component)
    if label:
        out = out.where(F.lower("label").contains(label.lower()))
    if kinds:
        out = out.where(F.col("kind").isin(*kinds))
    if statuses:
        out = out.where(F.col("status").isin(*statuses))
    return out.where(F.lower(F.concat_ws(" ", "component", "label", "note")).contains(text.lower())) if text else out


def audit_export(audit: DataFrame) -> DataFrame:
    """For each component how many rows have which status, those that need nothing left out."""
    return audit.where("status <> 'no-need'").groupBy("component").pivot("status", ["to-fill", "to-confirm", "confirmed"]).count().na.fill(0)


def export_items(audit: DataFrame, most: int = 65_535) -> DataFrame:
    """The rows to fill in, or where there are none all but those that need nothing: ``component``, ``label``, ``kind``, ``status`` and the ``file`` of its component, each of ``most`` rows."""
    open_ = audit.where("status = 'to-fill'")
    rows = open_ if open_.limit(1).count() else audit.where("status <> 'no-need'")
    # A component's labels are distinct: they are as many as the catalogue's, not as the rows.
    place = F.row_number().over(Window.partitionBy("component").orderBy("label")) - 1
    return rows.select("component", "label", "kind", "status", F.floor(place / most).alias("file"))


def import_diff(filled: DataFrame, audit: DataFrame) -> DataFrame:
    """Filled-in rows against the audit: added, modified or unchanged attributes."""
    a = audit.select("component", "label", F.col("attribute").alias("old"), F.lit(True).alias("known"))
    joined = filled.join(a, ["component", "label"], "left")
    change = F.when(F.col("known").isNull(), "unknown").when(F.col("old").isNull(), "added").when(F.col("old") == F.col("attribute"), "unchanged").otherwise("modified")
    return joined.select("component", "label", "old", "attribute", change.alias("change"))


def catalog_patch(diffs: DataFrame) -> DataFrame:
    """What accepted diffs do to the catalogue."""
    return diffs.where("change in ('added', 'modified')").select("component", "label", "attribute", F.when(F.col("change") == "added", "add").otherwise("update").alias("action"))


def bind_attributes(audit: DataFrame, edits: DataFrame) -> DataFrame:
    """Attributes chosen by hand replace the found ones and wait for confirmation; edits of unknown rows are added."""
    e = edits.select("component", "label", F.col("attribute").alias("new"))
    both = audit.select("component", "label", "attribute", "status").join(e, ["component", "label"], "full_outer")
    return both.select("component", "label", F.coalesce("new", "attribute").alias("attribute"), F.when(F.col("new").isNotNull(), "to-confirm").otherwise(F.col("status")).alias("status"))


def wiki_patch_rows(items: DataFrame, audit: DataFrame, most: int = 20) -> DataFrame:
    """For rows marked for knowledge: their first ``most`` source rows, one for each project."""
    marked = items.join(audit.where("status = 'to-wiki'").select("component", "label"), ["component", "label"], "left_semi")
    one = marked.groupBy("component", "label", "row_id").agg(F.min("pos").alias("pos"))
    return one.withColumn("k", F.row_number().over(Window.partitionBy("component", "label").orderBy("pos", "row_id"))).where(F.col("k") <= most).select("component", "label", "row_id", "k")


def reviewed_upsert(pages: DataFrame, patch: DataFrame) -> DataFrame:
    """Pages with a reviewed block, which replaces an older one: the labels of ``patch`` (``component``, ``label``, ``matched``) that are matched, and those that are not.

    A page without a patch stays as it is, with the block that it has; patches of unknown pages are skipped.
    """
    listed = lambda test: F.array_join(F.array_sort(F.collect_set(F.when(test, F.col("label")))), "\n- ")
    block = patch.groupBy("component").agg(listed(F.col("matched")).alias("yes"), listed(~F.col("matched")).alias("no"), F.lit(True).alias("patched"))
    part = lambda title, c: F.when(F.col(c) != "", F.concat(F.lit(f"\n{title}\n- "), F.col(c))).otherwise("")
    bare = F.regexp_replace("content", r"(?s)\n<!-- reviewed -->.*?<!-- /reviewed -->", "")
    new = F.concat(bare, F.lit("\n<!-- reviewed -->"), part("matched:", "yes"), part("open:", "no"), F.lit("\n<!-- /reviewed -->"))
    return pages.join(block, "component", "left").select("component", F.when(F.col("patched"), new).otherwise(F.col("content")).alias("content"))


def writeback_pages(matches: DataFrame, items: DataFrame, synonyms: DataFrame, most: int = 30, labels: int = 15) -> DataFrame:
    """(``kind``, ``name``, ``rows``, ``content``): a result page for each component with its first ``most`` rows and its ``labels`` most frequent labels, and a page for each entry of ``synonyms`` (``source``, ``selected``, ``aliases``)."""
    first = first_rows(matches.select("component", "row_id", "status"), ["component"], [F.col("row_id"), F.col("status")], most)
    lines = first.groupBy("component").agg(F.array_join(ordered(F.concat_ws(" ", "row_id", "status"), F.col("rank")), "\n").alias("lines"))
    told = top_labels(items.join(matches.select("row_id", F.col("component").alias("c")), "row_id").select(F.col("c").alias("component"), "label"), labels)
    own = matches.groupBy("component").agg(F.count("*").alias("rows")).join(lines, "component").join(told, "component", "left")
    results = own.select(F.lit("results").alias("kind"), F.col("component").alias("name"), "rows", F.concat(F.col("lines"), F.coalesce(F.concat(F.lit("\nlabels: "), F.col("labels")), F.lit(""))).alias("content"))
    said = F.concat(F.lit("name: "), F.coalesce("selected", F.lit("")), F.lit("\naliases: "), F.array_join("aliases", "|"))
    return results.unionByName(synonyms.select(F.lit("synonym").alias("kind"), F.col("source").alias("name"), F.size("aliases").cast("long").alias("rows"), said.alias("content")))


def review_queue(matches: DataFrame) -> DataFrame:
    """Rows that are not matched, or matched but open in review."""
    return matches.where("status in ('candidate_only', 'unmatched', 'conflict') or (status = 'matched' and review in ('pending', 'rejected', 'needs_review'))").select("row_id", "status", F.coalesce(F.nullif("review", F.lit("")), F.lit("pending")).alias("review"))


def apply_review(mappings: DataFrame) -> DataFrame:
    """Counts of statuses after deleted mappings are dropped."""
    return mappings.where("not deleted").groupBy("status", "review").agg(F.count("*").alias("mappings"), F.count_distinct("source").alias("sources"))


def reviewed_synonyms(mappings: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """The synonyms after a review: rebuilt from the mappings that stayed, or, with an ``old`` library, the old entries of all sources whose mappings were not deleted one and all."""
    left = mappings.where("not deleted")
    return synonym_library(left) if old is None else old.join(left.select("source").distinct(), "source", "left_semi")


def edit_records(records: DataFrame, lists: tuple[str, ...] = (), confidence: str = "confidence", deleted: str = "deleted") -> DataFrame:
    """Rows of an editor as records: ``deleted`` ones and those without content are dropped.

    Columns of ``lists`` are text with an entry a line (or between commas and semicolons) and become arrays; other texts are trimmed, and
    null if blank. ``confidence`` is held between 0 and 1, and null if it is no number. A row has content if any column has.
    """
    fields = [c for c in records.columns if c != deleted]
    texts = {c for c, kind in records.dtypes if kind == "string"} - {*lists, confidence}
    own = lambda c: F.coalesce(records[f"`{c}`"].cast("string"), F.lit(""))
    entries = lambda c: F.filter(F.transform(F.split(own(c), r"[\r\n,;，；]+"), lambda x: F.trim(x)), lambda x: x != "")
    number = own(confidence).try_cast("double")
    held = F.when(number.isNotNull() & ~F.isnan(number), F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))
    out = records.where(~F.coalesce(F.col(deleted), F.lit(False))).select(
        *[(entries(c) if c in lists else held if c == confidence else F.nullif(F.trim(own(c)), F.lit("")) if c in texts else records[f"`{c}`"]).alias(c) for c in fields]
    )
    says = [F.size(f"`{c}`") > 0 if c in lists else F.col(f"`{c}`").isNotNull() for c in fields]
    return out.where(F.greatest(*says) if len(says) > 1 else says[0])


#: Ranks of a row's status and review state; others come after them (fixed values).
STATUS_RANK, REVIEW_RANK = {"matched": 0, "candidate_only": 1}, {"reviewed": 0, "suggested": 1}


def bill_item_summary(matches: DataFrame, features: DataFrame, most: int = 12) -> DataFrame:
    """For each project code its best row, by status, review state, candidate rank and confidence, and its first ``most`` distinct features, in that order of rows.

    ``matches`` are (``row_id``, ``code``, ``status``, ``review``, ``candidate_rank``, ``confidence``), ``features`` (``row_id``, ``feature_order``, ``label``, ``value``, ``expression``). Features are one if label and value
    are, whatever their case.
    """
    ranked = lambda c, ranks: F.coalesce(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.trim(F.coalesce(c, F.lit("")))], F.lit(2))
    priority = F.struct(ranked("status", STATUS_RANK).alias("s"), ranked("review", REVIEW_RANK).alias("v"), F.coalesce("candidate_rank", F.lit(9999)).alias("k"), (-F.coalesce("confidence", F.lit(0.0))).alias("c"), F.col("row_id").alias("id"))
    own = matches.withColumn("priority", priority)
    best = own.groupBy("code").agg(F.min_by(F.struct("row_id", "status"), "priority").alias("b"), F.count("*").alias("rows"))
    same = F.lower(F.concat_ws("|", F.coalesce("label", F.lit("")), F.coalesce("value", F.lit(""))))
    seen = own.select("row_id", "code", "priority").join(features.where("expression <> ''"), "row_id").groupBy("code", same.alias("same")).agg(F.min(F.struct("priority", "feature_order", "expression")).alias("first"))
    top = seen.withColumn("k", F.row_number().over(Window.partitionBy("code").orderBy("first", "same"))).withColumn("of", F.count("*").over(Window.partitionBy("code"))).where(F.col("k") <= most)
    told = top.groupBy("code").agg(F.array_join(ordered(F.col("first.expression"), F.col("k")), "|").alias("features"), F.max("of").alias("n_features"))
    return best.join(told, "code", "left").select("code", "rows", F.col("b.row_id").alias("row_id"), F.col("b.status").alias("status"), F.coalesce("features", F.lit("")).alias("features"), F.coalesce("n_features", F.lit(0)).alias("n_features"))


def mapping_rules(bindings: DataFrame, least: int = 3) -> DataFrame:
    """Confirmed bindings (``component``, ``label``, ``attribute``) as rules: the same in ``least`` components is global, others are the component's own.

    ``aliases`` are the other labels that a component binds to the same attribute (for a global rule, any component).
    """
    own = bindings.groupBy("component", "label", "attribute").agg(F.count("*").alias("seen"))
    spread = own.groupBy("label", "attribute").agg(F.count("*").alias("components"), F.sum("seen").alias("seen"))
    wide = spread.where(F.col("components") >= least).select(F.lit("global").alias("scope"), F.lit("").alias("component"), "label", "attribute", "seen")
    narrow = own.join(wide.select("label", "attribute"), ["label", "attribute"], "left_anti").select(F.lit("component").alias("scope"), "component", "label", "attribute", "seen")
    # Labels of an attribute are names from the catalogue's side: few.
    by_component = own.groupBy("component", "attribute").agg(F.collect_set("label").alias("all"))
    by_all = own.select("attribute", "label").distinct().groupBy("attribute").agg(F.collect_set("label").alias("all"))
    others = lambda rows: rows.withColumn("aliases", F.array_join(F.array_sort(F.array_remove("all", F.col("label"))), "|")).drop("all")
    return others(wide.join(by_all, "attribute")).unionByName(others(narrow.join(by_component, ["component", "attribute"])))


def merge_mapping_rules(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rounds merged: for each scope, component and label the latest attribute stands."""
    both = old.unionByName(new)
    return both.groupBy("scope", "component", "label").agg(F.max_by("attribute", F.struct("updated_at", "attribute")).alias("attribute"), F.max("updated_at").alias("updated_at"))


def promote_hints(rules: DataFrame, least: int = 10) -> DataFrame:
    return rules.where((F.col("scope") == "global") & (F.col("seen") >= least)).select("label", "attribute", "seen")


def mapping_override(scores: DataFrame, rules: DataFrame, tiers: tuple[str, ...] = ()) -> DataFrame:
    """Scores of (``component``, ``label``, ``attribute``) raised by reviewed rules: 0.99 by the component's own, 0.98 by a global one. With ``tiers`` only rules of these (column ``tier``) count."""
    rules = rules.where(F.col("tier").isin(*tiers)) if tiers else rules
    own = rules.where("scope = 'component'").select("component", "label", "attribute", F.lit(0.99).alias("own")).distinct()
    wide = rules.where("scope = 'global'").select("label", "attribute", F.lit(0.98).alias("wide")).distinct()
    return scores.join(own, ["component", "label", "attribute"], "left").join(wide, ["label", "attribute"], "left").select("component", "label", "attribute", F.greatest("score", "own", "wide").alias("score"))


def run_audit(summaries: DataFrame) -> DataFrame:
    """(``step``, ``run``, ``code``, ``severity``, ``evidence``): the newest summary of each step, and what is wrong with it; a step without fault has one row without code.

    ``summaries`` are (``step``, ``run``, ``modified``, ``status``, ``total``, ``matched``, ``candidate_only``, ``unmatched``, ``synonyms``).
    """
    newest = summaries.groupBy("step").agg(F.max_by(F.struct("run", "status", "total", "matched", "candidate_only", "unmatched", "synonyms"), F.struct("modified", "run")).alias("n")).select("step", "n.*")
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    issue = lambda test, code, severity, evidence: F.when(test, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), evidence.alias("evidence")))
    step, said = F.col("step"), F.concat(F.lit("status="), F.coalesce("status", F.lit("")))
    backlog = F.concat_ws(" ", F.concat(F.lit("candidate_only="), count("candidate_only").cast("string")), F.concat(F.lit("unmatched="), count("unmatched").cast("string")))
    issues = F.array_compact(
        F.array(
            issue((step == "step2") & (F.col("status") == "failed"), "STEP2_FAILED", "blocker", said),
            issue((step == "step3") & (F.col("status") == "completed_local_only"), "STEP3_LOCAL_ONLY", "blocker", F.concat_ws(" ", F.concat(F.lit("matched="), count("matched").cast("string")), backlog)),
            issue((step == "step3") & (F.trim(F.coalesce("synonyms", F.lit(""))) == ""), "STEP3_NO_SYNONYMS", "warning", F.lit("synonyms is empty")),
            issue((step == "step3") & (count("candidate_only") + count("unmatched") > 0), "STEP3_REVIEW_BACKLOG", "warning", backlog),
            issue(count("total") == 0, "EMPTY", "warning", F.lit("total=0")),
        )
    )
    return newest.select("step", "run", F.explode_outer(issues).alias("i")).select("step", "run", "i.code", "i.severity", "i.evidence")
