"""Queries of the retrieval operators: documents are the entries, the benchmark texts are the stated queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from termwright.operators import retrieval as R
from termwright.plans import sqltext as S
from termwright.sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def entries(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.concat_ws(" ", "source", "lang").alias("title"), F.when(F.col("doc_id") % 4 != 0, F.col("source")).alias("component"), F.concat(F.lit("step"), (F.col("doc_id") % 4).cast("string")).alias("stage"), "lang", "source", F.col("lang").alias("chapter")
    )


def queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text", F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("component"))


_ENTRIES = "entries AS (SELECT doc_id AS id, text, source || ' ' || lang AS title, CASE WHEN doc_id % 4 <> 0 THEN source END AS component, 'step' || (doc_id % 4) AS stage, lang, source, lang AS chapter FROM documents)"
_QUERIES = "queries AS (SELECT item_id AS id, text, 'src' || (item_id % 20) AS component FROM benchmark)"
_TOKENS = "regexp_extract_all(lower(trim(text)), '[a-z0-9_]+')"
_COMPACT = "regexp_replace(lower(trim(text)), '\\s+', '', 'g')"
_ALL = f"CASE WHEN {_COMPACT} <> '' AND length({_COMPACT}) <= 24 AND NOT list_contains({_TOKENS}, {_COMPACT}) THEN list_append({_TOKENS}, {_COMPACT}) ELSE {_TOKENS} END"


def _vectors(name: str, of: str) -> str:
    return f"""{name}_t AS (SELECT id, unnest({_ALL}) AS token FROM {of}),
{name}_c AS (SELECT id, token, count(*) AS n, sha1(token) AS h FROM {name}_t GROUP BY 1, 2),
{name}_s AS (SELECT id, CAST('0x' || substr(h, 1, 8) AS BIGINT) % 192 AS bucket, sum(CASE WHEN CAST('0x' || substr(h, 9, 2) AS BIGINT) % 2 = 0 THEN n ELSE -n END)::DOUBLE AS w FROM {name}_c GROUP BY 1, 2 HAVING w <> 0),
{name} AS (SELECT id, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM {name}_s)"""


QUERIES["tokenize"] = lambda spark, sf_dir: entries(spark, sf_dir).select("id", F.size(R.tokens(F.col("text"))).alias("n"), F.md5(F.array_join(R.tokens(F.col("text")), "|").cast("binary")).alias("digest"))
ORACLE_SQL["tokenize"] = f"WITH {_ENTRIES}, t AS (SELECT id, {_ALL} AS tokens FROM entries) SELECT id, len(tokens) AS n, md5(array_to_string(tokens, '|')) AS digest FROM t"
QUERIES["hashed_embedding"] = lambda spark, sf_dir: R.hashed_vectors(entries(spark, sf_dir)).withColumn("weight", F.round("weight", 6))
ORACLE_SQL["hashed_embedding"] = f"WITH {_ENTRIES}, {_vectors('v', 'entries')} SELECT id, bucket, round(weight, 6) AS weight FROM v"


def _rounded(x: str) -> str:
    return f"floor(({x}) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE"


def _cosines(name: str, of: str, queries: str = "q") -> str:
    """(``query_id``, ``id``, ``cosine``) of all pairs, from whole numbers: the sums are exact."""
    return f"""{name}_n AS (SELECT id, sum(w * w) AS n FROM {of}_s GROUP BY 1),
{name}_d AS (SELECT q.id AS query_id, v.id, sum(v.w * q.w) AS dot FROM {of}_s v JOIN {queries}_s q USING (bucket) GROUP BY 1, 2),
{name} AS (SELECT q.id AS query_id, e.id, coalesce(dot::DOUBLE / sqrt((a.n * b.n)::DOUBLE), 0.0::DOUBLE) AS cosine FROM queries q CROSS JOIN (SELECT id FROM {of}_of) e LEFT JOIN {name}_d d ON d.query_id = q.id AND d.id = e.id LEFT JOIN {name}_n a ON a.id = e.id LEFT JOIN (SELECT id, sum(w * w) AS n FROM {queries}_s GROUP BY 1) b ON b.id = q.id)"""


QUERIES["cosine_topk"] = lambda spark, sf_dir: R.cosine_topk(queries(spark, sf_dir), entries(spark, sf_dir), 5)
_COSINE = f"{_ENTRIES}, {_QUERIES}, v_of AS (SELECT id FROM entries), {_vectors('v', 'entries')}, {_vectors('q', 'queries')}, {_cosines('cosines', 'v')}"
ORACLE_SQL["cosine_topk"] = f"WITH {_COSINE} SELECT * FROM (SELECT query_id, id, {_rounded('cosine')} AS score, row_number() OVER (PARTITION BY query_id ORDER BY {_rounded('cosine')} DESC, id) AS rank FROM cosines) WHERE rank <= 5"


def dense_topk(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return R.dense_topk(v.where("id % 20 = 0"), v, 5)


QUERIES["dense_topk"] = dense_topk
ORACLE_SQL["dense_topk"] = f"""WITH p AS (SELECT q.vec_id AS query_id, v.vec_id AS id, {_rounded('list_sum(list_transform(list_zip(v.embedding, q.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))')} AS score FROM embeddings v, embeddings q WHERE q.vec_id % 20 = 0)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM p) WHERE rank <= 5"""


def pages(spark, sf_dir):
    """The component pages of all entries, as rows that can be searched."""
    p = R.compile_pages(entries(spark, sf_dir)).where("page_type = 'component'")
    return p.select(F.col("name").alias("id"), F.concat(F.lit("page "), "name").alias("title"), F.col("content").alias("text"), F.col("name").alias("component"))


QUERIES["hybrid_score"] = lambda spark, sf_dir: R.hybrid_score(queries(spark, sf_dir), entries(spark, sf_dir))
QUERIES["query_knowledge"] = lambda spark, sf_dir: R.query_entries(queries(spark, sf_dir), entries(spark, sf_dir), pages(spark, sf_dir))
_SHORT80 = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"


def _line(n: int) -> str:
    return f"'- ' || title || ': ' || CASE WHEN length({_SHORT80}) > {n} THEN rtrim(substr({_SHORT80}, 1, {n - 1})) || '…' ELSE {_SHORT80} END"


_PAGES = f"""k AS (SELECT *, row_number() OVER (PARTITION BY component, stage ORDER BY id) AS k, CASE stage WHEN 'step2' THEN 8 WHEN 'step3' THEN 10 WHEN 'step1' THEN 6 ELSE 0 END AS most, CASE stage WHEN 'step2' THEN 1 WHEN 'step3' THEN 2 ELSE 3 END AS place FROM entries WHERE component IS NOT NULL),
sections AS (SELECT component, place, '## ' || any_value(stage) || chr(10) || string_agg({_line(220)}, chr(10) ORDER BY id) AS section FROM k WHERE k <= most GROUP BY 1, 2),
cp AS (SELECT component, string_agg(section, chr(10) ORDER BY place) AS content FROM sections GROUP BY 1),
compiled AS (SELECT 'component' AS page_type, component AS name, count(*) AS entries, coalesce(any_value(content), '') AS content FROM k LEFT JOIN cp USING (component) GROUP BY 2),
pages AS (SELECT name AS id, 'page ' || name AS title, content AS text, name AS component, 'step2' AS stage FROM compiled)"""


def _hybrid(name: str, of: str, cosines: str) -> str:
    """The hybrid scores of all pairs of queries and rows of ``of``, those with another component in steps 2 and 3 marked ``other``."""
    hits = "len(list_filter(qt.terms, lambda t: contains(lower(e.title || chr(10) || e.text), t)))"
    score = f"cosine + least(0.35::DOUBLE, {hits}::DOUBLE * 0.03::DOUBLE) + CASE WHEN e.component = qt.component THEN 0.18::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN e.stage LIKE 'step3%' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END"
    return f"""{name} AS (SELECT c.query_id, c.id, {_rounded(score)} AS score, least(260, length({_SHORT80.replace('text', 'e.text')})) AS size, coalesce(e.component <> qt.component AND regexp_matches(e.stage, '^step[23]'), false) AS other
  FROM {cosines} c JOIN {of} e ON e.id = c.id JOIN (SELECT id, component, {_ALL} AS terms FROM queries) qt ON qt.id = c.query_id)"""


def _budgeted(name: str, of: str, most: int) -> str:
    return f"""{name}_w AS (SELECT query_id, id, score, size, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, sum(size) OVER (PARTITION BY query_id ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS upto FROM {of} WHERE NOT other),
{name} AS (SELECT query_id, CAST(id AS VARCHAR) AS id, score, size, rank FROM {name}_w WHERE (rank = 1 OR upto <= 2000) AND rank <= {most})"""


_HYBRID = f"{_COSINE}, {_hybrid('h', 'entries', 'cosines')}"
ORACLE_SQL["hybrid_score"] = f"WITH {_HYBRID} SELECT query_id, id, score FROM h"
_PAGED = f"{_PAGES}, p_of AS (SELECT id FROM pages), {_vectors('p', 'pages')}, {_cosines('page_cosines', 'p')}, {_hybrid('hp', 'pages', 'page_cosines')}"
ORACLE_SQL["query_knowledge"] = f"WITH {_HYBRID}, {_PAGED}, {_budgeted('be', 'h', 8)}, {_budgeted('bp', 'hp', 3)} SELECT query_id, 'entry' AS kind, id, score, size, rank FROM be UNION ALL SELECT query_id, 'page', id, score, size, rank FROM bp"

_FACETS = {"step1": 3, "step2": 3, "step0": 1, "page": 2}


def retrieve_context(spark, sf_dir):
    """The best entries of three steps and the best component pages for every query."""
    e = entries(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "text", F.col("stage").alias("facet"))
    return R.retrieve_context(queries(spark, sf_dir), e.unionByName(pages(spark, sf_dir).select("id", "text", F.lit("page").alias("facet"))), _FACETS)


QUERIES["retrieve_context"] = retrieve_context
ORACLE_SQL["retrieve_context"] = f"""WITH {_COSINE}, {_PAGES}, p_of AS (SELECT id FROM pages), {_vectors('p', 'pages')}, {_cosines('page_cosines', 'p')},
f AS (SELECT query_id, stage AS facet, CAST(id AS VARCHAR) AS id, {_rounded('cosine')} AS score FROM cosines JOIN entries USING (id) UNION ALL SELECT query_id, 'page', id, {_rounded('cosine')} FROM page_cosines)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, facet ORDER BY score DESC, id) AS rank FROM f) WHERE rank <= CASE facet WHEN 'step1' THEN 3 WHEN 'step2' THEN 3 WHEN 'step0' THEN 1 WHEN 'page' THEN 2 ELSE 0 END"""

QUERIES["compile_pages"] = lambda spark, sf_dir: R.compile_pages(entries(spark, sf_dir))
ORACLE_SQL["compile_pages"] = f"""WITH {_ENTRIES}, {_PAGES}, ch AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY id) AS n FROM entries), pt AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY id) AS n FROM entries WHERE component IS NOT NULL AND stage = 'step3')
SELECT * FROM compiled UNION ALL SELECT 'chapter', chapter, count(*), string_agg({_line(180)}, chr(10) ORDER BY id) FILTER (n <= 10) FROM ch GROUP BY 2 HAVING count(*) >= 2
UNION ALL SELECT 'pattern', component, count(*), string_agg({_line(140)}, chr(10) ORDER BY id) FILTER (n <= 6) FROM pt GROUP BY 2
UNION ALL SELECT 'overview', '', sum(n)::BIGINT, string_agg(stage || ': ' || n, chr(10) ORDER BY stage) FROM (SELECT stage, count(*) AS n FROM entries GROUP BY 1)"""


def tagged(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("title"), "text", F.col("source").alias("collection"), F.col("lang").alias("source_type"), F.array(F.concat(F.lit("t"), (F.col("doc_id") % 30).cast("string")), F.col("lang"), F.col("lang")).alias("tags"))


QUERIES["corpus_pages"] = lambda spark, sf_dir: R.corpus_pages(tagged(spark, sf_dir))
ORACLE_SQL["corpus_pages"] = """WITH d AS (SELECT doc_id AS id, length(text) AS size, source, lang, ['t' || (doc_id % 30), lang] AS tags FROM documents),
r AS (SELECT id, size, tags, 'overview' AS page_type, '' AS name FROM d UNION ALL SELECT id, size, tags, 'collection', source FROM d UNION ALL SELECT id, size, tags, 'type', lang FROM d UNION ALL SELECT id, size, tags, 'tag', unnest(tags) FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY page_type, name ORDER BY id) AS k FROM r),
u AS (SELECT page_type, name, tag, count(*) AS n, row_number() OVER (PARTITION BY page_type, name ORDER BY count(*) DESC, tag) AS k FROM (SELECT page_type, name, unnest(tags) AS tag FROM r) GROUP BY 1, 2, 3),
t AS (SELECT page_type, name, string_agg(tag || ':' || n, '|' ORDER BY k) AS tags FROM u WHERE k <= 20 GROUP BY 1, 2)
SELECT k.page_type, k.name, count(*) AS documents, sum(size)::BIGINT AS characters, any_value(t.tags) AS tags, string_agg('d' || id, '|' ORDER BY k) FILTER (k <= 20) AS samples, string_agg(id::VARCHAR, '|' ORDER BY k) FILTER (k <= 50) AS refs FROM k JOIN t ON t.page_type = k.page_type AND t.name = k.name GROUP BY 1, 2"""


def _chunks(of: str, size: int = 1400, overlap: int = 180) -> str:
    """SQL of chunks (``id``, ``chunk_no``, ``chunk``) of ``of`` (``id``, ``text``): a fold by recursion over the paragraphs."""
    strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    return f"""own AS (SELECT id, {strip("replace(coalesce(text, ''), chr(13) || chr(10), chr(10))")} AS own FROM {of}),
paragraphs AS (SELECT id, list_filter(list_transform(regexp_split_to_array(own, '\\n\\s*\\n'), lambda x: {strip('x')}), lambda x: x <> '') AS ps FROM own WHERE length(own) > {size}),
fold AS (
  SELECT id, 0 AS k, CAST([] AS VARCHAR[]) AS done, '' AS open FROM paragraphs
  UNION ALL
  SELECT id, k + 1,
    CASE WHEN open = '' AND length(p) > {size} THEN list_concat(done, list_filter(list_transform(range(0, length(p), {size - overlap}), lambda i: {strip(f'substr(p, i + 1, {size})')}), lambda x: x <> ''))
         WHEN open = '' OR length(open) + 2 + length(p) <= {size} THEN done ELSE list_append(done, open) END,
    CASE WHEN open = '' AND length(p) > {size} THEN '' WHEN open = '' THEN p WHEN length(open) + 2 + length(p) <= {size} THEN open || chr(10) || chr(10) || p
         WHEN {strip(f'right(open, {overlap})')} <> '' THEN {strip(f'right(open, {overlap})')} || chr(10) || chr(10) || p ELSE p END
  FROM (SELECT f.*, ps[k + 1] AS p FROM fold f JOIN paragraphs USING (id) WHERE k < len(ps))
),
ended AS (SELECT id, CASE WHEN open = '' THEN done ELSE list_append(done, open) END AS cs FROM fold JOIN paragraphs USING (id) WHERE k = len(ps) UNION ALL SELECT id, [own] FROM own WHERE own <> '' AND length(own) <= {size}),
chunks AS (SELECT id, unnest(range(len(cs))) AS chunk_no, unnest(cs) AS chunk FROM ended)"""


QUERIES["chunk_text"] = lambda spark, sf_dir: R.chunk_text(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"))
ORACLE_SQL["chunk_text"] = f"WITH RECURSIVE d AS (SELECT doc_id AS id, text FROM documents), {_chunks('d')} SELECT id, CAST(chunk_no AS INT) AS chunk_no, chunk FROM chunks"


def corpus_documents(spark, sf_dir):
    """Texts as files of their own, parts of a brand as an array, benchmark items as an object."""
    tagged = lambda df, kind: df.select(F.lit(kind).alias("collection"), F.lit("").alias("source_type"), F.array(F.lit("t"), F.lit(kind)).alias("tags"), "path", "text")
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "text")
    item = F.struct("p_partkey", F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.array(F.col("p_brand"), F.lit("t")).alias("tags"))).alias("json"))
    p = table(spark, sf_dir, "part").withColumn("item", item).groupBy("p_brand").agg(F.array_sort(F.collect_list("item")).alias("items"))
    p = p.select(F.concat(F.lit("p/"), "p_brand", F.lit(".json")).alias("path"), F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["json"]), ","), F.lit("]")).alias("text"))
    b = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b/"), F.col("item_id").cast("string"), F.lit(".json")).alias("path"), F.to_json(F.struct(F.lit(1).alias("n"), F.array("item_id").alias("ids"))).alias("text"))
    out = R.corpus_documents(tagged(d, "docs").unionByName(tagged(p, "parts")).unionByName(tagged(b, "bench")), ("name", "kind"), ("kind",))
    return out.select("entry_id", "collection", "source_type", "title", "content", "source_ref", F.array_join("tags", "|").alias("tags"), F.col("metadata.kind").alias("kind"), F.col("metadata.chunk_index").alias("chunk_index"))


QUERIES["corpus_documents"] = corpus_documents
ORACLE_SQL["corpus_documents"] = f"""WITH RECURSIVE d AS (SELECT doc_id AS id, text FROM documents), {_chunks('d')},
parts AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part),
r AS (
  SELECT 'docs' AS collection, 'txt' AS source_type, substr(coalesce(nullif(trim(regexp_extract(text, '(?m)^#[ \t]+(\\S[^\\n]*)$', 1)), ''), nullif(trim(regexp_extract(text, '(?m)^[ \t]*(\\S[^\\n]*)$', 1)), ''), CAST(id AS VARCHAR)), 1, 160) AS title,
    chunk AS content, 'd/' || id || '.txt' AS path, 'd/' || id || '.txt#chunk-' || (chunk_no + 1) AS source_ref, 't|docs' AS tags, NULL AS kind, CAST(chunk_no + 1 AS VARCHAR) AS chunk_index FROM chunks JOIN d USING (id)
  UNION ALL SELECT 'parts', 'json', p_name, 'name: ' || p_name || chr(10) || 'kind: ' || p_type, 'p/' || p_brand || '.json', 'p/' || p_brand || '.json#item-' || k || '-chunk-1', 't|parts|' || p_brand, p_type, '1' FROM parts
  UNION ALL SELECT 'bench', 'json', item_id || ' | ids', '[' || item_id || ']', 'b/' || item_id || '.json', 'b/' || item_id || '.json#ids-chunk-1', 't|bench', NULL, '1' FROM benchmark
)
SELECT 'gk_' || {S.key('collection', 'path', 'source_ref', 'trim(title)', length=20)} AS entry_id, collection, source_type, trim(title) AS title, content, source_ref, tags, kind, chunk_index FROM r"""


def corpus(spark, sf_dir):
    """Documents as a corpus: the source is the collection, the language a tag. Queries ask for their source, every second one for a language too."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), "text", F.col("source").alias("component"), F.array("lang").alias("tags"))
    q = queries(spark, sf_dir).withColumn("tags", F.when(F.col("id") % 2 == 0, F.array(F.lit("en"), F.lit("de"))))
    p = d.groupBy("component").agg(F.min("text").alias("text")).select(F.col("component").alias("id"), F.lit("page").alias("title"), "text", "component")
    return q, d, p


QUERIES["query_corpus"] = lambda spark, sf_dir: R.query_corpus(*corpus(spark, sf_dir))


def _corpus_scores(name: str, of: str, cosines: str, untagged: str) -> str:
    hits = "len(list_filter(qt.terms, lambda t: contains(lower(e.title || chr(10) || e.text), t)))"
    common = "len(list_intersect(coalesce(e.tags, []), coalesce(qt.tags, [])))"
    score = f"cosine + least(0.4::DOUBLE, {hits}::DOUBLE * 0.03::DOUBLE) + CASE WHEN e.component = qt.component THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END + 0.0::DOUBLE + {common}::DOUBLE * 0.06::DOUBLE"
    return f"""{name} AS (SELECT c.query_id, c.id, {_rounded(score)} AS score, least(260, length({_SHORT80.replace('text', 'e.text')})) AS size, e.component <> qt.component OR (qt.tags IS NOT NULL AND {common} = 0 AND NOT {untagged}) AS other
  FROM {cosines} c JOIN {of} e ON e.id = c.id JOIN asked qt ON qt.id = c.query_id)"""


ORACLE_SQL["query_corpus"] = f"""WITH {_QUERIES}, asked AS (SELECT id, component, CASE WHEN id % 2 = 0 THEN ['en', 'de'] END AS tags, list_transform(regexp_extract_all(text, '[A-Za-z0-9_.:-]+|[一-鿿]{{1,8}}'), lambda t: lower(t)) AS terms FROM queries),
entries AS (SELECT doc_id AS id, lang AS title, text, source AS component, [lang] AS tags FROM documents), pages AS (SELECT source AS id, 'page' AS title, min(text) AS text, source AS component, CAST(NULL AS VARCHAR[]) AS tags FROM documents GROUP BY source),
v_of AS (SELECT id FROM entries), {_vectors('v', 'entries')}, {_vectors('q', 'queries')}, {_cosines('cosines', 'v')}, {_corpus_scores('h', 'entries', 'cosines', 'false')},
p_of AS (SELECT id FROM pages), {_vectors('p', 'pages')}, {_cosines('page_cosines', 'p')}, {_corpus_scores('hp', 'pages', 'page_cosines', '(e.tags IS NULL)')},
{_budgeted('be', 'h', 4)}, pr AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM hp WHERE NOT other)
SELECT query_id, 'document' AS kind, id, score, rank FROM be UNION ALL SELECT query_id, 'page', id, score, rank FROM pr WHERE rank <= 4"""


def budget_contexts(spark, sf_dir):
    r = table(spark, sf_dir, "events").select(F.col("user_id").alias("request"), F.concat(F.lit("src"), (F.col("event_id") % 30).cast("string")).alias("name"), F.col("event_id").alias("pos"))
    pages = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("name")).agg(F.min("text").alias("content"))
    return R.budget_contexts(r, pages, 6000)


QUERIES["budget_contexts"] = budget_contexts
ORACLE_SQL["budget_contexts"] = """WITH n AS (SELECT user_id AS request, 'src' || (event_id % 30) AS name, min(event_id) AS pos FROM events GROUP BY 1, 2), p AS (SELECT source AS name, length(min(text)) AS size FROM documents GROUP BY 1),
w AS (SELECT request, name, size, row_number() OVER (PARTITION BY request ORDER BY pos) AS rank, sum(size) OVER (PARTITION BY request ORDER BY pos ROWS UNBOUNDED PRECEDING) AS upto FROM n JOIN p USING (name))
SELECT request, name, size, rank FROM w WHERE rank = 1 OR upto <= 6000"""


def chapter_lookup(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return R.chapter_lookup(p.select(F.col("p_type").alias("chapter")).union(p.select("p_name")), p.select(F.concat_ws(" ", "p_type", "p_brand").alias("title")).union(p.where("p_size > 25").select("p_name")))


QUERIES["chapter_lookup"] = chapter_lookup
ORACLE_SQL["chapter_lookup"] = """WITH c AS (SELECT DISTINCT p_type AS chapter FROM part UNION SELECT p_name FROM part), t AS (SELECT DISTINCT p_type || ' ' || p_brand AS title FROM part UNION SELECT p_name FROM part WHERE p_size > 25)
SELECT chapter, chapter AS title FROM c JOIN t ON t.title = chapter UNION ALL SELECT chapter, min(title) FROM c JOIN t ON contains(title, chapter) WHERE chapter NOT IN (SELECT title FROM t) GROUP BY chapter"""
