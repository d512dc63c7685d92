"""Readers and writers: nested region files, record files with several roots, text trees, sheets, knowledge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termwright.functions import text as X
from termwright.operators.catalog import ordered

ROW = "struct<code:string,name:string,features:string,unit:string,rule:string,work:string>"
REGION = f"region_id string, path array<string>, text string, page_start int, page_end int, tables array<struct<title:string,rows:array<{ROW}>>>"
RECORD = "source_component_name string, selected_standard_name string, confidence double"
ROOTS = ("mappings", "matches", "data", "匹配结果")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions, one JSON object a line (``.jsonl``) or one array."""
    return spark.read.schema(REGION).option("multiLine", not path.rstrip("/").endswith(".jsonl")).json(path)


def read_any_root(spark: SparkSession, path: str) -> DataFrame:
    """Records under any of the known roots, or at the root itself."""
    rec = f"array<struct<{', '.join(f.replace(' ', ':') for f in RECORD.split(', '))}>>"
    wide = spark.read.schema(f"{RECORD}, " + ", ".join(f"`{r}` {rec}" for r in ROOTS)).json(path)
    own = F.array(F.struct(*[c.split()[0] for c in RECORD.split(", ")]))
    return wide.select(F.inline(F.coalesce(*[F.col(f"`{r}`") for r in ROOTS], own)))


def flatten_bill_rows(regions: DataFrame) -> DataFrame:
    """A row for each table row with a code, cleaned; the first row of a code, by region, table and place, counts."""
    # What goes with a row beside itself is small: a generator repeats all that is read behind it.
    t = regions.select("region_id", F.array_join("path", " > ").alias("path"), F.posexplode("tables").alias("table_pos", "t"))
    t = t.select("region_id", "path", "table_pos", X.table_title(F.col("t.title")).alias("title"), F.col("t.rows").alias("rows"))
    r = t.select("region_id", "path", "table_pos", "title", F.posexplode("rows").alias("row_pos", "r"))
    rows = r.select("region_id", "path", "table_pos", "row_pos", "title", F.trim("r.code").alias("code"), X.clean_lines(F.col("r.name")).alias("name"), X.normalize_unit(F.col("r.unit")).alias("unit")).where("code <> ''")
    return rows.groupBy("code").agg(F.min_by(F.struct("region_id", "path", "title", "name", "unit"), F.struct("region_id", "table_pos", "row_pos")).alias("r")).select("code", "r.*")


#: The titles of bill chapters (fixed value).
BILL_CHAPTER = r"(?i)^附录\s*[A-Z]"


def chapter_packages(regions: DataFrame, pattern: str = BILL_CHAPTER) -> DataFrame:
    """Totals for each first path element that is a bill chapter by ``pattern``; those chapters are numbered from 1 by their first page, without gaps."""
    c = regions.groupBy(F.get("path", F.lit(0)).alias("chapter")).agg(F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page"), F.count("*").alias("regions"), F.sum(F.size("tables")).alias("tables"))
    # One row for each chapter of a standard: their titles are few, whatever the pages.
    return c.where(F.col("chapter").rlike(pattern)).withColumn("number", F.row_number().over(Window.orderBy("first_page", "chapter")))


def load_chapters(regions: DataFrame, index: DataFrame, pattern: str) -> DataFrame:
    """Regions of the chapters that the index lists and whose title fits."""
    listed = index.where(F.col("title").rlike(pattern)).select(F.col("title").alias("chapter")).distinct()
    return regions.withColumn("chapter", F.get("path", F.lit(0))).join(listed, "chapter", "left_semi")


#: Files up to this size are read at once; larger ones by ranges of bytes.
AT_ONCE = 2_000_000


def _fits(column: str, extensions: tuple[str, ...], exclude: str):
    fits = F.lower(column).rlike("(" + "|".join(e.replace(".", r"\.") for e in extensions) + ")$")
    return fits & ~F.col(column).rlike(exclude) if exclude else fits


def read_file_ranges(spark: SparkSession, path: str, glob: str = "*", extensions: tuple[str, ...] = (".txt", ".md", ".json"), exclude: str = "", above: int = AT_ONCE) -> DataFrame:
    """(``path``, ``size``, ``start``, ``text``, ``last``) of the files of more than ``above`` bytes: a row for each range of bytes that a task reads, in order of ``start``.

    A line belongs to the range it begins in, so no character is cut. The pieces of a file, joined by new lines, are its text; it ends with one more if ``size`` says so.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
    own = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"))
    own = own.where((F.col("size") > above) & _fits("path", extensions, exclude)).withColumn("at", F.monotonically_increasing_id())
    return own.groupBy("path", "size", "start").agg(F.array_join(ordered(F.col("value"), F.col("at")), "\n").alias("text"), F.sum(F.octet_length("value") + 1).alias("bytes"))


def read_corpus_files(spark: SparkSession, path: str, glob: str = "*", extensions: tuple[str, ...] = (".txt", ".md", ".json"), exclude: str = "", most: int | None = None, at_once: int = AT_ONCE) -> DataFrame:
    """(``path``, ``text``, ``size``) of the text files of a tree, whatever their size; bad bytes are marked, and an empty file has no row.

    Files of more than ``at_once`` bytes are read in ranges, by as many tasks, and stitched by offset; a text of 2 GB or more fits into no row: :func:`read_file_ranges` has its
    pieces. With ``most``, larger files are left out, and :func:`skipped_files` counts them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    files = files.where(_fits("path", extensions, exclude) & (F.col("length") <= (at_once if most is None else min(at_once, most))))
    small = files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"), F.col("length").alias("size"))
    if most is not None and most <= at_once:
        return small
    parts = read_file_ranges(spark, path, glob, extensions, exclude, at_once)
    whole = parts.groupBy("path", "size").agg(F.array_join(ordered(F.col("text"), F.col("start")), "\n").alias("text"), F.sum("bytes").alias("bytes"))
    whole = whole.where(F.col("size") <= most) if most is not None else whole
    # The bytes of all lines, each with a new line, are the size, or one more where the last line has none.
    text = F.when(F.col("bytes") == F.col("size"), F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    return small.unionByName(whole.select("path", F.make_valid_utf8(text).alias("text"), "size"))


def skipped_files(spark: SparkSession, path: str, most: int) -> DataFrame:
    """How many files of a tree are larger than ``most`` bytes, and their bytes; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length").where(F.col("length") > most)
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def read_manifest(spark: SparkSession, sources: list[dict], most: int | None = None) -> DataFrame:
    """Several trees, each with its collection, type and tags; with ``most`` (of all, or of a source) without files larger than that, which :func:`manifest_skips` counts."""
    out = None
    for s in sources:
        own = read_corpus_files(spark, s["path"], s.get("glob", "*"), exclude=s.get("exclude", ""), most=s.get("most", most)).select(
            F.lit(s["collection"]).alias("collection"), F.lit(s.get("source_type", "")).alias("source_type"), F.array(*map(F.lit, s.get("tags", []))).cast("array<string>").alias("tags"), "path", "text"
        )
        out = own if out is None else out.unionByName(own)
    return out


def manifest_skips(spark: SparkSession, sources: list[dict], most: int | None = None) -> DataFrame:
    """(``collection``, ``files``, ``bytes``): what :func:`read_manifest` leaves out of each source for its size."""
    out = None
    for s in sources:
        limit = s.get("most", most)
        own = skipped_files(spark, s["path"], 2**63 - 1 if limit is None else limit).select(F.lit(s["collection"]).alias("collection"), "files", "bytes")
        out = own if out is None else out.unionByName(own)
    return out


def chapter_texts(regions: DataFrame) -> DataFrame:
    """The texts of a chapter's regions in order of pages."""
    return regions.groupBy(F.get("path", F.lit(0)).alias("chapter")).agg(F.array_join(ordered(F.col("text"), F.col("page_start"), F.col("region_id")), "\n").alias("text"))
