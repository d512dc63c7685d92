"""Queries of the readers and writers, and of direct matching; files are made of the tables, in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.sources import published as P
from termwright.sources import readers as R
from termwright.sources.shared import new_place as folder
from termwright.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def add(name, query, sql):
    QUERIES[name], ORACLE_SQL[name] = query, sql


def regions(spark, sf_dir):
    """Each brand and type is a region; its parts are the rows of its table."""
    p = table(spark, sf_dir, "part")
    row = F.struct(
        (F.col("p_partkey") % 700).cast("string").alias("code"), F.concat(F.col("p_name"), F.lit("\n。")).alias("name"), F.lit("").alias("features"), F.lit("㎡").alias("unit"), F.lit("").alias("rule"), F.lit("").alias("work"), F.col("p_partkey").alias("k")
    )
    g = p.groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))).alias("rows"), F.min("p_partkey").cast("int").alias("first"), F.max("p_partkey").cast("int").alias("last"))
    rows = F.transform("rows", lambda x: F.struct(*[x["r"][f].alias(f) for f in ("code", "name", "features", "unit", "rule", "work")]))
    return g.select(
        F.concat_ws("/", "p_brand", "p_type").alias("region_id"), F.array("p_brand", "p_type").alias("path"), F.col("p_type").alias("text"), F.col("first").alias("page_start"), F.col("last").alias("page_end"),
        F.array(F.struct(F.concat(F.lit("续表 "), "p_type").alias("title"), rows.alias("rows"))).alias("tables"),
    )


def read_regions(spark, sf_dir):
    path = folder(spark, "regions") + ".jsonl"
    regions(spark, sf_dir).write.json(path)
    return R.read_regions(spark, path).select("region_id", F.array_join("path", " > ").alias("path"), "page_start", F.size(F.col("tables")[0]["rows"]).alias("rows"))


add("read_regions", read_regions, "SELECT p_brand || '/' || p_type AS region_id, p_brand || ' > ' || p_type AS path, CAST(min(p_partkey) AS INT) AS page_start, CAST(count(*) AS INT) AS rows FROM part GROUP BY p_brand, p_type")


def read_any_root(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    rec = F.struct(F.col("p_name").alias("source_component_name"), F.col("p_type").alias("selected_standard_name"), (F.col("p_size") / 100).alias("confidence"))
    path = folder(spark, "records")
    roots = [F.when(F.col("p_partkey") % 5 == i, F.to_json(F.struct(F.array(rec).alias(r)))) for i, r in enumerate(R.ROOTS)]
    p.select(F.coalesce(*roots, F.to_json(rec)).alias("value")).write.text(path)
    return R.read_any_root(spark, path)


add("read_any_root", read_any_root, "SELECT p_name AS source_component_name, p_type AS selected_standard_name, p_size / 100.0 AS confidence FROM part")
add(
    "flatten_bill_rows",
    lambda s, d: R.flatten_bill_rows(regions(s, d)),
    """SELECT code, region_id, path, title, name, 'm2' AS unit FROM (SELECT CAST(p_partkey % 700 AS VARCHAR) AS code, p_brand || '/' || p_type AS region_id, p_brand || ' > ' || p_type AS path, '表' || replace(p_type, ' ', '') AS title, p_name AS name,
row_number() OVER (PARTITION BY p_partkey % 700 ORDER BY p_brand || '/' || p_type, p_partkey) AS k FROM part) WHERE k = 1""",
)
add(
    "chapter_packages",
    lambda s, d: R.chapter_packages(regions(s, d).withColumn("path", F.transform("path", lambda x: F.replace(x, F.lit("Brand#"), F.lit("附录 A"))).cast("array<string>")).where("path[0] not like '附录 A1%'").unionByName(regions(s, d))),
    "WITH c AS (SELECT replace(p_brand, 'Brand#', '附录 A') AS chapter, CAST(min(p_partkey) AS INT) AS first_page, CAST(max(p_partkey) AS INT) AS last_page, count(DISTINCT p_type) AS regions, count(DISTINCT p_type) AS tables FROM part WHERE p_brand NOT LIKE 'Brand#1%' GROUP BY 1) SELECT *, CAST(row_number() OVER (ORDER BY first_page, chapter) AS INT) AS number FROM c",
)
add("load_chapters", lambda s, d: R.load_chapters(regions(s, d), table(s, d, "part").select(F.col("p_brand").alias("title")), "^Brand#[12]").select("region_id", "chapter"), "SELECT DISTINCT p_brand || '/' || p_type AS region_id, p_brand AS chapter FROM part WHERE regexp_matches(p_brand, '^Brand#[12]')")
add("chapter_texts", lambda s, d: R.chapter_texts(regions(s, d)), "SELECT p_brand AS chapter, string_agg(p_type, chr(10) ORDER BY f) AS text FROM (SELECT p_brand, p_type, min(p_partkey) AS f FROM part GROUP BY 1, 2) GROUP BY 1")


def corpus(spark, sf_dir, name):
    path = folder(spark, name)
    table(spark, sf_dir, "documents").select("source", "text").repartition("source").select("source", F.regexp_replace("text", "\n", " ").alias("text")).write.partitionBy("source").option("lineSep", "\n").text(path)
    return path


def read_corpus_files(spark, sf_dir):
    files = R.read_corpus_files(spark, corpus(spark, sf_dir, "corpus"), "*.txt", at_once=20_000)
    return files.groupBy(F.regexp_extract("path", "source=([^/]+)", 1).alias("source")).agg(F.sum(F.size(F.split("text", "\n")) - 1).alias("lines"), F.sum("size").alias("bytes"))


add("read_corpus_files", read_corpus_files, "SELECT source, count(*) AS lines, sum(octet_length(encode(text)) + 1) AS bytes FROM documents GROUP BY 1")


def skipped_files(spark, sf_dir):
    """Files of one source each, told apart by a size that some pass."""
    sizes = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text") + 1).alias("n"))
    return R.skipped_files(spark, corpus(spark, sf_dir, "skipped"), sizes.agg(F.expr("CAST(avg(n) AS BIGINT)")).collect()[0][0])


add("skipped_files", skipped_files, "WITH s AS (SELECT source, sum(octet_length(encode(text)) + 1)::BIGINT AS n FROM documents GROUP BY 1), a AS (SELECT CAST(floor(avg(n)) AS BIGINT) AS most FROM s) SELECT count(*) AS files, coalesce(sum(n), 0)::BIGINT AS bytes FROM s, a WHERE n > most")


def sources_of(spark, sf_dir, name):
    """Each source of the documents as a tree of its own; files of some are beyond a size that is set for them alone."""
    path = corpus(spark, sf_dir, name)
    names = [r[0] for r in table(spark, sf_dir, "documents").select("source").distinct().orderBy("source").collect()]
    return [{"path": f"{path}/source={n}", "collection": f"c-{n}", "tags": ["t", n], "glob": "*.txt", **({"most": 10} if n.endswith("7") else {})} for n in names]


def read_manifest(spark, sf_dir):
    m = R.read_manifest(spark, sources_of(spark, sf_dir, "manifest"))
    return m.groupBy("collection").agg(F.sum(F.length("text")).alias("characters"), F.min(F.array_join("tags", "|")).alias("tags"))


add("read_manifest", read_manifest, "SELECT 'c-' || source AS collection, sum(length(text) + 1) AS characters, 't|' || source AS tags FROM documents WHERE NOT ends_with(source, '7') GROUP BY source")
add(
    "manifest_skips",
    lambda s, d: R.manifest_skips(s, sources_of(s, d, "skips")),
    "SELECT 'c-' || source AS collection, CASE WHEN ends_with(source, '7') THEN 1 ELSE 0 END AS files, CASE WHEN ends_with(source, '7') THEN sum(octet_length(encode(text)) + 1)::BIGINT ELSE 0 END AS bytes FROM documents GROUP BY source",
)


def write_match(spark, sf_dir):
    """A run and the next one, whose open orders are gone: all four tables of the last generation, and which generation wrote their parts."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    root = folder(spark, "matches")
    runs = [o, o.where("status <> 'O' or o_orderkey % 2 = 0")]
    for own in runs:
        last = P.write_match(root, own, table(spark, sf_dir, "nation").select("n_name"), table(spark, sf_dir, "region").select("r_name"), own.agg(F.count("*").alias("rows")))
    first = {p["path"].split("/data/")[1].split("/")[0] for t in last.tables.values() for p in t["parts"].values()}
    assert len(first) == 2, "two generations have written what the last one shows"
    matches = P.read_published(spark, root, "matches").groupBy("status").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    others = [P.read_published(spark, root, n).agg(F.lit(n).alias("status"), F.count("*").alias("n"), F.lit(0.0).alias("total")) for n in ("rules", "catalog")]
    return matches.unionByName(others[0]).unionByName(others[1]).unionByName(P.read_published(spark, root, "summary").select(F.lit("summary").alias("status"), F.col("rows").alias("n"), F.lit(0.0).alias("total")))


add(
    "write_match",
    write_match,
    """WITH m AS (SELECT * FROM orders WHERE o_orderstatus <> 'O' OR o_orderkey % 2 = 0) SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM m GROUP BY 1
UNION ALL SELECT 'rules', count(*), 0 FROM nation UNION ALL SELECT 'catalog', count(*), 0 FROM region UNION ALL SELECT 'summary', count(*), 0 FROM m""",
)


def changed(entries):
    """Entries in another order, those of one language changed; as many tasks as the session has partitions."""
    return entries.withColumn("text", F.when(F.col("stage") == "step-en", F.concat("text", F.lit("!"))).otherwise(F.col("text"))).repartition("doc_id")


def refresh_knowledge(spark, sf_dir):
    """Documents as entries, refreshed with those of one language changed: rows of each part, and whether the second refresh wrote it."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("step-"), "lang").alias("stage"), "text")
    pages = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("page_type"), "n_name")
    root = folder(spark, "knowledge")
    P.refresh_knowledge(root, d, pages)
    before = {p["path"] for t in P.manifest(spark, root).tables.values() for p in t["parts"].values()}
    P.refresh_knowledge(root, changed(d), pages)
    old = F.array(*map(F.lit, sorted(x.split("/data/")[1] for x in before)))
    own = P.read_published(spark, root, "entries").select("stage", F.length("text").alias("size"), F.regexp_extract(F.col("_metadata.file_path"), "/data/(.*)/[^/]*$", 1).alias("part"))
    return own.groupBy("stage").agg(F.count("*").alias("n"), F.sum("size").alias("characters"), F.max(~F.array_contains(old, F.col("part"))).alias("written"))


add("refresh_knowledge", refresh_knowledge, "SELECT 'step-' || lang AS stage, count(*) AS n, sum(length(text)) + CASE WHEN lang = 'en' THEN count(text) ELSE 0 END AS characters, lang = 'en' AS written FROM documents GROUP BY lang")
