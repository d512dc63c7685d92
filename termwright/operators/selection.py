"""Term search over regions and packing of work under size limits."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X
from termwright.functions.found import Best, found_sums
from termwright.operators.matching import HEAVY, dealt_join
from termwright.operators.retrieval import within_budget
from termwright.sources.shared import written


def expand_terms(components: DataFrame, aliases: DataFrame | None = None, heavy: int = HEAVY) -> DataFrame:
    """(``component``, ``term``): the name, its normal form, the synonyms of its parts, the focus words in it; and the names of every entry of ``aliases`` (``source``, ``aliases``) that goes by it."""
    n = X.blank_to_empty(F.col("component"))
    options = F.array(
        n, X.normalize_search_text(n), *[F.when(n.contains(a), F.lit(b)) for a, b in C.SEARCH_REPLACEMENTS], *[F.when(n.contains(t), F.lit(t)) for t in C.FOCUS_TERMS], F.when(n.endswith("墙面"), F.lit("墙")), F.when(n.endswith("柱面"), F.lit("柱"))
    )
    out = components.select("component", F.explode(F.array_distinct(F.filter(options, lambda t: t.isNotNull() & (t != "")))).alias("term"))
    if aliases is None:
        return out
    names = aliases.select("source", F.explode(F.array_union(F.array("source"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("term")).where("trim(term) <> ''")
    # A source that many components go by, with many names, is dealt over tasks.
    shared = dealt_join(components.select("component", n.alias("term")).distinct().join(names, "term").select("component", "source").distinct(), names.distinct(), ["source"], heavy)
    return out.union(shared.select("component", "term")).distinct()


#: The fields of a region in the order in which a term is looked for, and its points in tenths: once, and for each of at most 8 characters (fixed values).
FIELDS = {"title": (100, 10), "path": (80, 8), "table_titles": (60, 6), "headers": (40, 4), "body": (30, 3)}
#: Where a term of one character counts, and its tenths (fixed values).
SHORT_FIELDS, SHORT_POINTS = ("title", "path", "table_titles"), 8


def _points(term: str, field: int) -> int | None:
    once, each = [*FIELDS.values()][field]
    return once + min(len(term), 8) * each if len(term) > 1 else SHORT_POINTS if field < len(SHORT_FIELDS) else None


def score_regions(regions: DataFrame, terms: DataFrame, best: bool = False) -> DataFrame:
    """(``batch``, ``region``, ``score``, ``hits``): each distinct term scores by the first field that contains it, anywhere.

    ``regions`` are (``region``, ``title``, ``path``, ``table_titles``, ``headers``, ``body``, ``tables``, ``rows``), ``terms`` are (``batch``, ``term``); both are compared in
    their search form. The terms are a stated set: one pass over each text finds all of them and sums them up, and no text leaves its task. With ``best``, for
    :func:`budget_select`, which has use for no others, regions have ``group`` and ``size``, and those of a group that a task has seen a better one of may be left out.
    """
    # Whole tenths and hundredths: sums don't depend on their order.
    extra = F.least("tables", F.lit(4)) * 30 + F.least("rows", F.lit(30)) * 5
    more = ["group", "size"] if best else []
    # The fields in which a short term counts come first.
    own = regions.select("region", "tables", "rows", *more, extra.cast("long").alias("extra"), *[X.normalize_search_text(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in FIELDS])
    t = terms.select("batch", X.normalize_search_text(F.col("term")).alias("term")).where("term <> ''").distinct()
    first = Best(1, (("rows", "descending"), ("size", "ascending"), ("region", "ascending")), "group", "extra", hits=True) if best else None
    scored, few = found_sums(own, "region", [*FIELDS], t, lambda term, field: 10 * (_points(term, field) or 0), first)
    return scored.select("batch", "region", ((F.col("points") + F.col("extra")) / 100).alias("score"), "hits", *(["group", "rows", "size"] if few else []))


def budget_select(scored: DataFrame, regions: DataFrame, batches: DataFrame, budget: int, most: int) -> DataFrame:
    """For each ``batch`` the best region of each ``group``, best first, within ``budget`` characters and ``most`` regions; the first always stays.

    ``regions`` are (``region``, ``group``, ``tables``, ``rows``, ``size``). A batch without any hit gets the regions with the most table rows, then tables, then the smallest.
    """
    order = [F.desc("score"), F.desc("hits"), F.desc("rows"), "size", "region"]
    # Scores that bring their region's columns need no join.
    own = scored if "group" in scored.columns else scored.join(regions.select("region", "group", "rows", "size"), "region")
    own = own.where("region is not null")
    best = own.groupBy("batch", "group").agg(F.min_by(F.struct("region", "score", "hits", "rows", "size"), F.struct(-F.col("score"), -F.col("hits"), -F.col("rows"), "size", "region")).alias("b")).select("batch", "group", "b.*")
    # Every batch with a hit keeps a region, so the scores are read once.
    chosen = written(within_budget(best, ["batch"], order, "size", budget, most).select("batch", "region", "group", "score", "rank"), "chosen-regions")
    # What a batch without hits gets is the same for all of them: one list of at most ``most`` regions.
    plain = [F.desc("rows"), F.desc("tables"), "size", "region"]
    first = regions.groupBy("group").agg(F.min_by(F.struct("region", "tables", "rows", "size"), F.struct(-F.col("rows"), -F.col("tables"), "size", "region")).alias("b")).select("group", "b.*")
    listed = within_budget(first.orderBy(*plain).limit(most).withColumn("one", F.lit(1)), ["one"], plain, "size", budget, most)
    without = batches.select("batch").distinct().join(chosen.select("batch").distinct(), "batch", "left_anti").withColumn("one", F.lit(1))
    return chosen.unionByName(without.join(F.broadcast(listed), "one").select("batch", "region", "group", F.lit(0.0).alias("score"), "rank"))


def expand_groups(selected: DataFrame, regions: DataFrame) -> DataFrame:
    """All regions of the groups that have a selected one."""
    return selected.select("batch", "group").distinct().join(regions.select("group", "region"), "group").select("batch", "group", "region")


def prior_entries(entries: DataFrame, terms: DataFrame, most: int = 20) -> DataFrame:
    """(``batch``, ``entry``, ``score``, ``rank``): earlier entries (``entry``, ``text``) by the total length of the distinct terms that stand anywhere in them, in search form."""
    t = terms.select("batch", X.normalize_search_text(F.col("term")).alias("term")).where("term <> ''").distinct()
    own = entries.select("entry", X.normalize_search_text(F.coalesce("text", F.lit(""))).alias("text"))
    scored, _ = found_sums(own, "entry", ["text"], t, lambda term, field: len(term), Best(most, (("entry", "ascending"),)))
    scored = scored.select("batch", "entry", F.col("points").alias("score"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("batch").orderBy(F.desc("score"), "entry"))).where(F.col("rank") <= most)


def bucket_components(name: Column, values: Column) -> Column:
    """The first focus word in the name or values, else the first two characters."""
    text = X.normalize_search_text(F.concat_ws(" ", name, values))
    out = None
    for t in C.FOCUS_TERMS:
        out = F.when(text.contains(t), t) if out is None else out.when(text.contains(t), t)
    return out.otherwise(F.when(name != "", F.substring(name, 1, 2)).otherwise("其他"))


def pack_batches(components: DataFrame, most: int, budget: int) -> DataFrame:
    """(``bucket``, ``component``, ``batch``): components of a bucket in order of ``pos``, a new batch where count or size would pass the limit.

    Where a batch ends depends on all before it, so a bucket is packed by one task, which holds a batch's worth of it at a time: rows arrive sorted and
    leave as they come, and no bucket is gathered.
    """
    out = components.select("bucket", "component", "pos", F.col("size").cast("long").alias("size")).repartition("bucket").sortWithinPartitions("bucket", "pos", "component")

    def run(batches):
        bucket, batch, n, chars, started = None, 0, 0, 0, False
        for own in batches:
            numbers = []
            for b, size in zip(own.column("bucket").to_pylist(), own.column("size").to_pylist()):
                if not started or b != bucket:
                    bucket, batch, n, chars, started = b, 0, 0, 0, True
                elif n >= most or chars + size > budget:
                    batch, n, chars = batch + 1, 0, 0
                n, chars = n + 1, chars + size
                numbers.append(batch)
            yield pa.RecordBatch.from_arrays([own.column("bucket"), own.column("component"), pa.array(numbers, pa.int32())], names=["bucket", "component", "batch"])

    return out.mapInArrow(run, "bucket string, component string, batch int")


def work_grid(chapters: DataFrame, batches: DataFrame, skip: int = 0, most: int | None = None) -> DataFrame:
    """Every chapter with every batch that applies to it (``group``), as a slice by number."""
    grid = chapters.join(batches, "group").where(F.col("batch") >= skip)
    return grid.where(F.col("batch") < skip + most) if most else grid


def pending_work(grid: DataFrame, done: DataFrame) -> DataFrame:
    """The grid without what is finished: the same chapter, batch and set of components."""
    same = lambda df: df.groupBy("chapter", "batch").agg(F.array_sort(F.collect_set("component")).alias("components"))
    return same(grid).join(same(done), ["chapter", "batch", "components"], "left_anti").select("chapter", "batch", F.size("components").alias("components"))


def assemble_payload(rows: DataFrame, matches: DataFrame, catalog: DataFrame, regions: DataFrame, most: int = 3, length: int = 80, summary: int = 15, text: int = 400) -> DataFrame:
    """(``batch``, ``payload``, ``n``): one JSON text for each batch with its rows and their candidates, the summaries of the candidates' components, and region texts.

    ``rows`` are (``batch``, ``row_id``, ``text``), ``matches`` (``row_id``, ``rank``, ``component``, ``score``), ``catalog`` (``component``, ``attributes``, an array), ``regions`` (``batch``, ``region``,
    ``body``). A row has its first ``most`` candidates, a component the first ``summary`` attributes, and is told once for a batch. A batch is bounded by :func:`pack_batches`.
    """
    top = matches.withColumn("k", F.row_number().over(Window.partitionBy("row_id").orderBy("rank", "component", "score"))).where(F.col("k") <= most)
    first = top.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("rank", "component", "score"))).alias("candidates"))
    own = rows.join(first, "row_id", "left").withColumn("text", X.shorten(F.col("text"), length))
    told = own.select("batch", F.explode("candidates.component").alias("component")).distinct().join(catalog.select("component", F.slice("attributes", 1, summary).alias("attributes")), "component")
    told = told.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("component", "attributes"))).alias("components"))
    cut = regions.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("region", F.substring("body", 1, text).alias("body")))).alias("regions"))
    whole = own.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("row_id", "text", "candidates"))).alias("rows"), F.count("*").alias("n"))
    whole = whole.join(told, "batch", "left").join(cut, "batch", "left")
    return whole.select("batch", F.to_json(F.struct("rows", "components", "regions")).alias("payload"), "n")
