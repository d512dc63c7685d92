"""One table of knowledge entries from the results of all steps, with keys made of their content alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termwright.functions import text as X

#: The parts of entries, each as its label and the field that it shows (fixed values).
ROW_PARTS = (("项目编码", "code"), ("项目名称", "name"), ("项目特征", "features"), ("计量单位", "unit"), ("工程量计算规则", "rule"), ("工作内容", "work"))
MAPPING_PARTS = (
    ("来源构件", "source"), ("标准名称", "selected"), ("别名", "aliases"), ("候选标准名", "candidates"), ("匹配状态", "status"), ("匹配类型", "match_type"), ("置信度", "confidence"),
    ("证据路径", "evidence_paths"), ("证据文本", "evidence_texts"), ("推理", "reasoning"), ("备注", "notes"),
)
SYNONYM_PARTS = (
    ("源构件", "source"), ("当前匹配结果", "selected"), ("别名", "aliases"), ("章节/节点", "chapter_nodes"), ("来源构件集合", "sources"), ("匹配类型", "match_types"), ("复核状态", "review_statuses"),
    ("证据路径", "evidence_paths"), ("说明", "notes"),
)
MATCH_PARTS = (
    ("row_id", "row_id"), ("项目编码", "code"), ("项目名称", "name"), ("构件类型", "component"), ("原始项目特征", "features"), ("特征表达式", "expression"), ("计量单位", "unit"), ("计算项目代码", "calc_code"),
    ("计算项目名称", "calc_name"), ("匹配状态", "status"), ("匹配依据", "basis"), ("章节规则命中", "rule_hits"), ("章节特征提示", "feature_hints"), ("推理", "reasoning"), ("备注", "notes"),
)
#: Characters of a table's text that stand in for a missing title.
TITLE_CHARS = 48

ENTRY = "struct<entry_id:string,parent_id:string,stage:string,title:string,content:string,source_ref:string,chapter_title:string,component_type:string>"


def _strip(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")


def listed(values: Column) -> Column:
    """An array as one line: its values in quotes, in brackets; null is an empty one."""
    mark = lambda v: F.when(v.contains("'") & ~v.contains('"'), F.lit('"')).otherwise(F.lit("'"))
    said = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.concat(mark(v), F.when(v.contains("'") & v.contains('"'), F.replace(v, F.lit("'"), F.lit("\\'"))).otherwise(v), mark(v)))
    return F.concat(F.lit("["), F.array_join(said, ", "), F.lit("]"))


def entry_id(stage: Column, ref: Column, title: Column) -> Column:
    return F.concat(stage, F.lit("_"), X.stable_key(stage, ref, title))


def _entry(stage: str, ref: Column, title: Column, content: Column, chapter: Column, component: Column | None = None, parent: Column | None = None) -> Column:
    own = F.when(_strip(ref) != "", _strip(ref)).otherwise(_strip(title))
    text = lambda c: F.lit("") if c is None else _strip(c)
    return F.struct(
        entry_id(F.lit(stage), own, title).alias("entry_id"), (F.lit(None).cast("string") if parent is None else parent).alias("parent_id"), F.lit(stage).alias("stage"), _strip(title).alias("title"), _strip(content).alias("content"), own.alias("source_ref"),
        text(chapter).alias("chapter_title"), text(component).alias("component_type"),
    ).cast(ENTRY)


def _parts(parts, of) -> Column:
    return F.concat_ws("\n", *[F.concat(F.lit(f"{label}: "), of(field)) for label, field in parts])


def region_entries(regions: DataFrame) -> DataFrame:
    """Entries of regions (``region_no``, ``path``, ``text``, ``tables`` array<struct<title, raw_text, rows array<struct<code, name, features, unit, rule, work>>>>): the rules of each, its tables, their rows.

    One scan fans a region out. A row's ``parent_id`` is its table's entry, a table's that of the rules; null where that has no content.
    """
    path = _strip(F.col("path"))
    chapter = X.section_root(path)
    rules = _strip(F.col("text"))
    rule = _entry("step1_rule", F.concat(path, F.lit("#rule")), F.concat(F.lit("Step1 章节规则 | "), F.when(path != "", path).otherwise(F.concat(F.lit("region_"), F.col("region_no").cast("string")))), F.concat(F.lit("章节路径: "), path, F.lit("\n规则说明:\n"), rules), chapter)
    tables = regions.schema["tables"].dataType
    none = F.lit(None)
    # A region fans out into its rules and its tables, a table into its own entry and its rows. What a row needs of its table is made once, before, and is small.
    parts = F.concat(F.array(F.struct(F.when(rules != "", rule).alias("rule"), none.cast("int").alias("i"), none.cast(tables.elementType).alias("t"))), F.transform(F.coalesce("tables", F.array().cast(tables)), lambda t, i: F.struct(none.cast(ENTRY).alias("rule"), i.alias("i"), t.alias("t"))))
    own = regions.select(path.alias("path"), chapter.alias("chapter"), F.when(rules != "", rule["entry_id"]).alias("rule_id"), parts.alias("parts")).select("path", "chapter", "rule_id", F.explode("parts").alias("part"))
    raw, number = _strip(F.col("t.raw_text")), (F.col("i") + 1).cast("string")
    own = own.select("path", "chapter", "rule_id", "part.rule", "part.t", "part.i").select("path", "chapter", "rule_id", "rule", raw.alias("raw"), F.col("i").isNotNull().alias("table"), number.alias("number"), _strip(F.col("t.title")).alias("title"), F.col("t.rows").alias("rows"))
    own = own.withColumn("named", F.when(F.col("title") != "", F.col("title")).otherwise(F.substring("raw", 1, TITLE_CHARS)))
    shown = F.when(F.col("named") != "", F.col("named")).when(F.col("path") != "", F.col("path")).otherwise(F.col("number"))
    own = own.withColumns({"ref": F.concat("path", F.lit("#table-"), "number"), "head": F.concat(F.lit("章节路径: "), F.col("path"), F.lit("\n表格标题: "), F.col("named"))})
    table = _entry("step1_table", F.col("ref"), F.concat(F.lit("Step1 表格摘要 | "), shown), F.concat("head", F.lit("\n表格原文: "), "raw"), F.col("chapter"), parent=F.col("rule_id"))
    own = own.select("path", "chapter", "ref", "head", F.coalesce("rule", F.when(F.col("table") & (F.col("raw") != ""), table)).alias("entry"), F.coalesce("rows", F.array().cast(tables.elementType["rows"].dataType)).alias("rows"))
    row = tables.elementType["rows"].dataType.elementType
    below = F.concat(F.array(F.struct(F.col("entry"), none.cast("int").alias("k"), none.cast(row).alias("r"))), F.transform("rows", lambda r, k: F.struct(none.cast(ENTRY).alias("entry"), k.alias("k"), r.alias("r"))))
    out = own.select("chapter", "ref", "head", F.col("entry.entry_id").alias("table_id"), below.alias("below"))
    out = out.select("chapter", "ref", "head", "table_id", F.explode("below").alias("e")).select("chapter", "ref", "head", "table_id", "e.entry", "e.k", "e.r")
    said = F.concat("head", F.lit("\n"), _parts(ROW_PARTS, lambda f: _strip(F.col(f"r.{f}"))))
    title = F.concat(F.lit("Step1 清单行 | "), _strip(F.col("r.code")), F.lit(" "), _strip(F.col("r.name")))
    made = _entry("step1_row", F.concat("ref", F.lit("-row-"), (F.col("k") + 1).cast("string")), _strip(title), said, F.col("chapter"), parent=F.col("table_id"))
    return out.select(F.when(F.col("k").isNotNull(), made).otherwise(F.col("entry")).alias("e")).where("e is not null").select("e.*")


def summary_entry(summary: DataFrame) -> DataFrame:
    """The entry of a catalogue's summary, one row with any columns, as JSON."""
    said = F.to_json(F.struct(*sorted(summary.columns)))
    return summary.select(_entry("step1_catalog", F.lit("catalog_summary"), F.lit("Step1 总览"), said, F.lit("目录总览")).alias("e")).select("e.*")


def _shown(df: DataFrame, column: str) -> Column:
    if column not in df.columns:
        return F.lit("")
    return listed(F.col(column)) if df.schema[column].dataType.typeName() == "array" else F.coalesce(F.col(column).cast("string"), F.lit(""))


def mapping_entries(mappings: DataFrame) -> DataFrame:
    """Entries of mappings (``no``, ``source``, ``selected``, and what else of :data:`MAPPING_PARTS` there is), numbered by ``no``."""
    number, source = F.col("no").cast("string"), _strip(F.col("source"))
    title = F.concat(F.lit("Step2 构件映射 | "), F.when(source != "", source).otherwise(F.concat(F.lit("mapping_"), number)))
    return mappings.select(_entry("step2_mapping", F.concat(F.lit("step2_mapping#"), number), title, _parts(MAPPING_PARTS, lambda f: _shown(mappings, f)), F.col("selected"), source).alias("e")).select("e.*")


def synonym_entries(synonyms: DataFrame) -> DataFrame:
    """Entries of a synonym library (``no``, ``canonical``, ``source``, ``selected``, ``sources`` array, and what else of :data:`SYNONYM_PARTS` there is); the own name comes first among the sources, each once."""
    number, source, canonical, selected = F.col("no").cast("string"), _strip(F.col("source")), _strip(F.col("canonical")), _strip(F.col("selected"))
    own = F.coalesce("sources", F.array().cast("array<string>"))
    clean = F.array_distinct(F.filter(F.transform(F.concat(F.array(source), own), _strip), lambda x: x != ""))
    rows = synonyms.withColumn("sources", F.when(source != "", clean).otherwise(own))
    name = F.when(source != "", source).when(canonical != "", canonical)
    said = _parts(SYNONYM_PARTS, lambda f: F.coalesce(name, F.lit("")) if f == "source" else _shown(rows, f))
    title = F.concat(F.lit("Step2 源构件桥接 | "), F.coalesce(name, F.concat(F.lit("synonym_"), number)))
    component = F.array_join(F.filter(F.transform("sources", _strip), lambda x: x != ""), " / ")
    return rows.select(_entry("step2_synonym", F.concat(F.lit("step2_synonym#"), number), title, said, F.when(selected != "", selected).otherwise(canonical), component).alias("e")).select("e.*")


def match_entries(matches: DataFrame) -> DataFrame:
    """Entries of matched rows (``row_id``, ``code``, ``name``, ``component``, ``document``, and what else of :data:`MATCH_PARTS` there is)."""
    title = _strip(F.concat(F.lit("Step3 清单匹配 | "), _strip(F.col("code")), F.lit(" "), _strip(F.col("name"))))
    said = _parts(MATCH_PARTS, lambda f: _strip(F.col(f)) if f in ("code", "name", "component") else _shown(matches, f))
    return matches.select(_entry("step3_match", F.concat(F.lit("step3_row#"), F.col("row_id").cast("string")), title, said, F.col("document"), F.col("component")).alias("e")).select("e.*")


def collect_entries(regions: DataFrame | None = None, mappings: DataFrame | None = None, synonyms: DataFrame | None = None, matches: DataFrame | None = None, summary: DataFrame | None = None) -> DataFrame:
    """All entries of the sources that are given, their texts whole: ``entry_id``, ``parent_id``, ``stage``, ``title``, ``content``, ``source_ref``, ``chapter_title``, ``component_type``; those without content are left out."""
    made = [make(df) for make, df in ((summary_entry, summary), (region_entries, regions), (mapping_entries, mappings), (synonym_entries, synonyms), (match_entries, matches)) if df is not None]
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out.where("content <> ''")


def as_documents(entries: DataFrame) -> DataFrame:
    """Entries under the names that pages and retrieval read: ``id``, ``title``, ``text``, ``component``, ``chapter``, ``stage``."""
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    step = F.regexp_extract("stage", "^(step[0-9])", 1)
    return entries.select(F.col("entry_id").alias("id"), "title", F.col("content").alias("text"), filled("component_type").alias("component"), filled("chapter_title").alias("chapter"), step.alias("stage"))
