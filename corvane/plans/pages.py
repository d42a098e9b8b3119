r"""Registered queries of pages and models: recognised text, tables, figures, captions, headings, manifests, and what models answer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import providers
from ..functions import text as T
from ..operators import chunking, dense, evaluation, ingest
from ..sources import readers, sinks
from .composed import _CLEAN, _NEAR, _NEAR_DIST, near_corpus, near_questions
from .queries import _FLAT, _ORDERED, corpus, query, table

# ------------------------------------------------------------------ text of pages

@query("SELECT conv_id, turn, length(trim(text)) < 40 AS automatic, true AS always, false AS never FROM conversations")
def ocr_decision(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", ingest.needs_ocr(F.col("text")).alias("automatic"), ingest.needs_ocr(F.col("text"), "ocr").alias("always"), ingest.needs_ocr(F.col("text"), "auto", False).alias("never"))


@query("""WITH l AS (SELECT conv_id, turn, text, (turn * 37 + conv_id) % 100 / 100.0::DOUBLE AS c FROM conversations)
SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE c >= 0.7), '') AS recognised, round(avg(c) FILTER (WHERE c >= 0.7), 6) AS confidence FROM l GROUP BY conv_id""")
def ocr_texts(spark, d):
    """Lines with enough confidence and their mean confidence."""
    c = table(spark, d, "conversations").select("conv_id", F.struct("turn", "text", ((F.col("turn") * 37 + F.col("conv_id")) % 100 / F.lit(100.0)).alias("confidence")).alias("x"))
    lines = c.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("lines"))
    text, mean = ingest.ocr_text(F.col("lines"))
    return lines.select("conv_id", text.alias("recognised"), F.round(mean, 6).alias("confidence"))


@query("""SELECT n_regionkey AS region, string_agg(CASE WHEN n_nationkey % 4 <> 0 THEN coalesce(trim(n_name), '') || ' | ' || n_nationkey || ' | ' END, chr(10) ORDER BY n_nationkey) AS table_text FROM nation GROUP BY ALL""")
def table_texts(spark, d):
    """Cells of tables, rows without any left out."""
    n = table(spark, d, "nation")
    full = n["n_nationkey"] % 4 != 0
    row = F.array(F.when(full, F.concat(F.lit(" "), F.col("n_name"))), F.when(full, F.col("n_nationkey").cast("string")), F.lit(None).cast("string"))
    rows = n.groupBy(F.col("n_regionkey").alias("region")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("cells")))), lambda x: x["cells"]).alias("rows"))
    return rows.select("region", ingest.table_text(F.col("rows")).alias("table_text"))


@query("""SELECT p_partkey, coalesce(nullif(concat_ws(chr(10) || chr(10), CASE WHEN p_partkey % 2 = 0 THEN 'Caption: ' || trim(p_name) END, CASE WHEN p_partkey % 3 = 0 THEN 'OCR:' || chr(10) || p_brand END,
  CASE WHEN p_partkey % 5 = 0 THEN 'Description: ' || p_type END), ''), 'Figure from page ' || (p_partkey % 9)) AS content FROM part""")
def figure_texts(spark, d):
    n = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", ingest.figure_text(F.when(n % 2 == 0, F.concat(F.lit(" "), "p_name")), F.when(n % 3 == 0, F.col("p_brand")).otherwise(" "), F.when(n % 5 == 0, F.col("p_type")), n % 9).alias("content"))


@query("""SELECT c_custkey, '{"nation":"' || c_nationkey || '","segment":"' || c_mktsegment || '"}' AS kept, ['Account', 'NAME'] AS masked FROM customer""")
def sanitized_metadata(spark, d):
    """A customer's own columns as metadata, of which two name a person."""
    text = lambda c: F.col(c).cast("string")
    meta = F.create_map(F.lit("segment"), text("c_mktsegment"), F.lit("NAME"), text("c_name"), F.lit("nation"), text("c_nationkey"), F.lit("Account"), text("c_acctbal"))
    kept, names = ingest.sanitize_metadata(meta)
    return table(spark, d, "customer").select("c_custkey", T.stable_json(kept).alias("kept"), names.alias("masked"))


@query("""SELECT doc_id, sha256(sha256(text) || '|800') AS signature FROM documents WHERE text IS NOT NULL AND sha256(sha256(text) || '|800') NOT IN (SELECT sha256(sha256(text) || '|800') FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL)""")
def preprocess_cache_misses(spark, d):
    """Files whose signature, of their own hash and the settings, is not in the cache."""
    docs = table(spark, d, "documents").filter("text is not null")
    signed = docs.select("doc_id", F.sha2(F.concat(F.sha2("text", 256), F.lit("|800")), 256).alias("signature"))
    return readers.cache_misses(signed, signed.filter("doc_id % 3 = 0"))


@query("""SELECT 'f' || (p_partkey % 7) AS source, count(*) AS n, '[' || string_agg('{"page_number":' || (p_partkey % 5) || ',"image_index":' || p_partkey || ',"image_path":"' || p_brand || '","caption":"' || p_type || '"}', ',' ORDER BY p_partkey % 5, p_partkey) || ']' AS assets
FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL""")
def asset_manifests(spark, d):
    n = F.col("p_partkey")
    docs = table(spark, d, "part").select(F.concat(F.lit("f"), (n % 7).cast("string")).alias("source"), F.when(n % 2 == 0, "image").otherwise("text").alias("block_type"), (n % 5).alias("page_number"), n.alias("image_index"), F.col("p_brand").alias("image_path"), F.col("p_type").alias("caption"))
    return sinks.asset_manifest(docs)


@query("SELECT doc_id AS no, quality AS score, CASE WHEN doc_id % 2 = 1 AND doc_id % 3 <> 0 THEN 'late' END AS note FROM labels WHERE doc_id % 3 = 0 OR doc_id % 2 = 1")
def appended_results(spark, d):
    """Results so far, and new ones that aren't there; a column that only they have."""
    rows = table(spark, d, "labels").select(F.col("doc_id").alias("no"), F.col("quality").alias("score"))
    return sinks.append_results(rows.filter("no % 3 = 0"), rows.filter("no % 2 = 1").withColumn("note", F.lit("late")), "no")


@query("""WITH b AS (SELECT o_custkey AS total, o_orderkey AS n, (o_custkey + o_orderkey) % 60 / 4::DOUBLE AS seconds FROM orders),
a AS (SELECT total, n, avg(seconds) OVER (PARTITION BY total ORDER BY n) AS average FROM b) SELECT n, round(average, 3) AS average, round(average * (total - n), 3) AS eta FROM a""")
def progress_estimates(spark, d):
    o = table(spark, d, "orders")
    return sinks.progress(o.select(F.col("o_orderkey").alias("n"), F.col("o_custkey").alias("total"), ((F.col("o_custkey") + F.col("o_orderkey")) % 60 / 4).alias("seconds")))


# ------------------------------------------------------------------ geometry; a page is an order, its images and blocks are line items

_RECTS = """r AS (SELECT l_orderkey AS page_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY x, y, w, h) AS i, 'mode ' || CASE WHEN l_linenumber % 4 = 0 THEN repeat(' long', 80) ELSE '  ' || l_partkey END AS content,
  least(x, 600.0) AS x0, least(y, 800.0) AS y0, least(x + w, 600.0) AS x1, least(y + h, 800.0) AS y1, l_linenumber FROM (
  SELECT *, (l_partkey * 37 % 560)::DOUBLE AS x, (l_suppkey * 91 % 760)::DOUBLE AS y, (l_quantity * 7)::DOUBLE AS w, (l_quantity * 5 + l_linenumber)::DOUBLE AS h FROM lineitem))"""
_JOINED = """greatest(a.x0, b.x0) <= least(a.x1, b.x1) AND greatest(a.y0, b.y0) <= least(a.y1, b.y1)
  OR greatest(a.x0, b.x0) - least(a.x1, b.x1) <= 28 AND greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) >= 0.18::DOUBLE * least(a.y1 - a.y0, b.y1 - b.y0)
  OR greatest(a.y0, b.y0) - least(a.y1, b.y1) <= 28 AND greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) >= 0.18::DOUBLE * least(a.x1 - a.x0, b.x1 - b.x0)"""


def _rects(spark, d):
    i = table(spark, d, "lineitem")
    q = F.col("l_quantity").cast("double")
    x, y = (F.col("l_partkey") * 37 % 560).cast("double"), (F.col("l_suppkey") * 91 % 760).cast("double")
    text = F.concat(F.lit("mode "), F.when(F.col("l_linenumber") % 4 == 0, F.repeat(F.lit(" long"), 80)).otherwise(F.concat(F.lit("  "), F.col("l_partkey").cast("string"))))
    return i.select(F.col("l_orderkey").alias("page_id"), x.alias("x0"), y.alias("y0"), (x + q * 7).alias("x1"), (y + q * 5 + F.col("l_linenumber")).alias("y1"), F.lit(600.0).alias("width"), F.lit(800.0).alias("height"), text.alias("content"), "l_linenumber")


@query(f"""WITH RECURSIVE {_RECTS}, k AS (SELECT * FROM r WHERE x1 - x0 > 2 AND y1 - y0 > 2),
e AS (SELECT a.page_id, a.i, b.i AS j FROM k a JOIN k b ON a.page_id = b.page_id WHERE {_JOINED}),
reach AS (SELECT page_id, i, j FROM e UNION SELECT reach.page_id, reach.i, e.j FROM reach JOIN e ON e.page_id = reach.page_id AND e.i = reach.j),
c AS (SELECT page_id, i, min(j) AS c FROM reach GROUP BY ALL),
u AS (SELECT page_id, c, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM c JOIN k USING (page_id, i) GROUP BY ALL)
SELECT page_id, greatest(0, x0 - 8) AS x0, greatest(0, y0 - 8) AS y0, least(600, x1 + 8) AS x1, least(800, y1 + 8) AS y1 FROM u
WHERE (x1 - x0) * (y1 - y0) / 480000 < 0.88 AND (x1 - x0) * (y1 - y0) / 480000 >= 0.0015 AND x1 - x0 >= 34 AND y1 - y0 >= 34 AND greatest((x1 - x0) / (y1 - y0), (y1 - y0) / (x1 - x0)) <= 12""")
def figure_clusters(spark, d):
    """Image rectangles that touch or nearly do, as figures."""
    return ingest.figure_regions(_rects(spark, d))


@query(f"""WITH {_RECTS}, f AS (SELECT page_id, x0, y0, x1, y1 FROM r WHERE l_linenumber = 1 GROUP BY ALL), b AS (SELECT page_id, x0, y0, x1, y1, trim(regexp_replace(content, '\\s+', ' ', 'g')) AS content FROM r WHERE l_linenumber > 1),
n AS (SELECT f.*, b.content, CASE WHEN b.y0 >= f.y1 THEN 0 WHEN b.y1 <= f.y0 THEN 1 ELSE 2 END AS side, CASE WHEN b.y0 >= f.y1 THEN b.y0 - f.y1 WHEN b.y1 <= f.y0 THEN f.y0 - b.y1 ELSE 0 END AS away
  FROM f JOIN b USING (page_id) WHERE least(f.x1, b.x1) > greatest(f.x0, b.x0) AND length(b.content) <= 300)
SELECT page_id, x0::INTEGER || '/' || y0::INTEGER || '/' || x1::INTEGER || '/' || y1::INTEGER AS figure_id, content AS caption FROM n WHERE away <= 120 QUALIFY row_number() OVER (PARTITION BY page_id, x0, y0, x1, y1 ORDER BY side, away, length(content), content) = 1""")
def captions(spark, d):
    """The nearest short text block of each figure; long and blank ones are none."""
    box = [F.least(F.col(c), F.lit(w)).alias(c) for c, w in (("x0", 600.0), ("y0", 800.0), ("x1", 600.0), ("y1", 800.0))]
    rows = _rects(spark, d).select("page_id", "l_linenumber", "content", *box)
    name = F.concat_ws("/", *[F.col(c).cast("int").cast("string") for c in ("x0", "y0", "x1", "y1")])
    figures = rows.filter("l_linenumber = 1").select("page_id", name.alias("figure_id"), "x0", "y0", "x1", "y1").distinct()
    blank = rows.filter("l_linenumber = 1").withColumn("content", F.lit("  \n"))
    return ingest.nearest_caption(figures, rows.filter("l_linenumber > 1").unionByName(blank).drop("l_linenumber"))


@query(r"""WITH l AS (SELECT l_orderkey % 60 AS page_id, l_linenumber::DOUBLE AS y, CASE WHEN l_partkey % 10 = 0 THEN '1.2 ' ELSE '' END || 'line ' || (l_partkey % 90) AS content, l_quantity::DOUBLE AS size FROM lineitem),
m AS (SELECT page_id, list_sort(list(size))[len(list(size)) // 2 + 1] AS median FROM l GROUP BY ALL),
f AS (SELECT page_id, content, y, CASE WHEN size / median >= 1.45 THEN 1 WHEN size / median >= 1.25 THEN 2 ELSE 3 END AS level FROM l JOIN m USING (page_id) WHERE size / median >= 1.18 OR content LIKE '1.2 %'),
o AS (SELECT page_id, content, min(y) AS y, arg_min(level, y * 10 + level) AS level FROM f GROUP BY ALL)
SELECT page_id, y, content, level FROM o QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY y, content) <= 50""")
def heading_sizes(spark, d):
    """Heading candidates of pages by size and number."""
    i = table(spark, d, "lineitem")
    text = F.concat(F.when(F.col("l_partkey") % 10 == 0, "1.2 ").otherwise(""), F.lit("line "), (F.col("l_partkey") % 90).cast("string"))
    return ingest.heading_candidates(i.select((F.col("l_orderkey") % 60).alias("page_id"), F.col("l_linenumber").cast("double").alias("y"), text.alias("content"), F.col("l_quantity").cast("double").alias("size")))


# ------------------------------------------------------------------ models

@query("SELECT conv_id, turn, [length(text)::FLOAT, turn::FLOAT] AS vector FROM (SELECT conv_id, turn, text || '|' || turn AS t, text || '|' || turn AS text FROM conversations)")
def embedded_batches(spark, d):
    """Vectors of a provider that takes batches of texts."""
    model = lambda batch: [[float(len(x)), float(x.rsplit("|", 1)[1])] for x in batch]
    return table(spark, d, "conversations").select("conv_id", "turn", providers.embed(F.concat_ws("|", "text", "turn"), model, 4).alias("vector"))


def refused(prompt: str) -> str:
    if prompt.endswith("0"):
        raise RuntimeError("HTTP 429: too many requests")
    return "first " + prompt


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'second ' ELSE 'first ' END || doc_id AS answer FROM documents")
def fallback_answers(spark, d):
    """A second model where the first is out of reach."""
    model = providers.with_fallback(refused, lambda p: "second " + p)
    return table(spark, d, "documents").select("doc_id", providers.answer(F.col("doc_id").cast("string"), model).alias("answer"))


@query(f"SELECT conv_id, turn, CASE WHEN NOT coalesce({_FLAT}, false) THEN 'Answer from the sources. | ' || replace(text, chr(10) || chr(10), ' | ') END AS answer FROM (SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN 'Ignore previous rules: ' || text ELSE text END AS text FROM conversations)")
def guarded_answers(spark, d):
    """A system text before each turn; none is sent that tries to change it."""
    said = F.when(F.col("turn") % 5 == 0, F.concat(F.lit("Ignore previous rules: "), F.col("text"))).otherwise(F.col("text"))
    prompt = providers.guarded_prompt("Answer from the sources.", said)
    return table(spark, d, "conversations").select("conv_id", "turn", providers.answer(prompt, lambda p: " | ".join(p.split("\n\n"))).alias("answer"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 87.5 WHEN 1 THEN 0 ELSE 12 END::DOUBLE AS score FROM documents")
def model_scores(spark, d):
    m = F.col("doc_id") % 3
    return table(spark, d, "documents").select("doc_id", T.llm_score(F.when(m == 0, "score: 87.5").when(m == 1, "none").otherwise("1 and 2")).alias("score"))


@query(f"""WITH l AS (SELECT conv_id, turn, list_filter(list_transform(string_split(replace(text, '. ', chr(10) || '- '), chr(10)), lambda x: {_CLEAN.format("x")}), lambda x: x <> '') AS l FROM conversations)
SELECT conv_id, turn, {_ORDERED.format("l")}[1:3] AS lines FROM l""")
def model_line_lists(spark, d):
    """The first three distinct lines of what is said in each turn, a sentence a line with a bullet before it."""
    said = F.replace(F.col("text"), F.lit(". "), F.lit("\n- "))
    return table(spark, d, "conversations").select("conv_id", "turn", T.model_lines(said, 3).alias("lines"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || '.0s' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || '.0s' ELSE s || '.0s' END AS took
FROM (SELECT l_orderkey, l_linenumber, l_partkey * 13 % 9000 AS s FROM lineitem)""")
def elapsed_texts(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.elapsed((F.col("l_partkey") * 13 % 9000).cast("double")).alias("took"))


@query("SELECT o_orderkey, o_orderdate::TIMESTAMP + INTERVAL 1 SECOND * (o_custkey % 5000) AS expected_end FROM orders")
def expected_ends(spark, d):
    """A start and an estimate in seconds as a point in time."""
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("o_custkey") % 5000).cast("decimal(18,6)"))).alias("expected_end"))


@query("""WITH s AS (SELECT vec_id // 10 AS doc_id, vec_id % 10 AS n, embedding::DOUBLE[] AS v FROM embeddings),
a AS (SELECT doc_id, n, CASE WHEN n > 0 THEN 1 - coalesce(list_cosine_similarity(lag(v) OVER w, v), 0) END AS away FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
l AS (SELECT doc_id, quantile_cont(away, 0.95) AS top FROM a GROUP BY ALL)
SELECT doc_id, n, sum(CASE WHEN away > top THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n)::BIGINT AS chunk_index FROM a JOIN l USING (doc_id)""")
def semantic_chunks(spark, d):
    """Sentences cut where the distance to the one before lies over the document's percentile."""
    e = table(spark, d, "embeddings")
    return chunking.semantic_breaks(e.select(F.floor(F.col("vec_id") / 10).alias("doc_id"), (F.col("vec_id") % 10).alias("n"), F.col("embedding").alias("vector")))


@query(f"WITH {_NEAR}, {_NEAR_DIST} SELECT query_id, rank, '#' || (rank + 1) || ' ' || d.source || ' ' || substr(d.text, 1, 400) AS line FROM nvec JOIN documents d USING (doc_id) WHERE rank < 3")
def top_lines(spark, d):
    """The first of each question's nearest documents as lines of text, cut to 400 characters."""
    c = near_corpus(spark, d)
    found = dense.vector_search(near_questions(spark, d), c, 3).join(c.select("doc_id", "heading", "content"), "doc_id")
    return found.select("query_id", "rank", F.concat(F.lit("#"), (F.col("rank") + 1).cast("string"), F.lit(" "), "heading", F.lit(" "), F.substring("content", 1, 400)).alias("line"))


@query("""WITH a AS (SELECT lang, source FROM documents), b AS (SELECT lang, source FROM documents JOIN labels USING (doc_id)),
x AS (SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b),
y AS (SELECT (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT ALL SELECT doc_id FROM documents)) AS only_a, (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels)) AS only_b)
SELECT 'groups' AS compared, only_a, only_b, only_a = 0 AND only_b = 0 AS same FROM x UNION ALL SELECT 'ids', only_a, only_b, only_a = 0 AND only_b = 0 FROM y
UNION ALL SELECT 'itself', 0, 0, true""")
def equal_sets(spark, d):
    """Rows that one table has more often than another: groups of all and of labelled documents, ids of labels and documents, documents dealt anew."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    groups = docs.select("lang", "source")
    pairs = {"groups": (groups, docs.join(labels.select("doc_id"), "doc_id").select("lang", "source")), "ids": (labels.select("doc_id"), docs.select("doc_id")), "itself": (groups, groups.repartition("source"))}
    return reduce(DataFrame.unionByName, [ingest.differences(a, b).select(F.lit(k).alias("compared"), "*") for k, (a, b) in pairs.items()])


@query("""SELECT case_id, question, collection_code FROM (SELECT item_id AS case_id, CASE WHEN item_id % 2 = 0 THEN 'of b ' || item_id ELSE trim(text) END AS question, 'b' AS collection_code FROM benchmark)""")
def split_cases(spark, d):
    q = table(spark, d, "benchmark")
    own = F.create_map(F.lit("b"), F.when(F.col("item_id") % 2 == 0, F.concat(F.lit(" of b "), F.col("item_id").cast("string"))).otherwise(""))
    return ingest.split_cases(q.select(F.col("item_id").alias("case_id"), F.col("text").alias("question"), own.alias("questions")), "b")


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'given' WHEN 1 THEN 'row' ELSE 'none' END AS kind, CASE doc_id % 3 WHEN 0 THEN ['a', 'b'] WHEN 1 THEN [doc_id::VARCHAR] ELSE []::VARCHAR[] END AS truth FROM labels""")
def truth_modes(spark, d):
    """Given ids before a case's own row; a held-out row is no truth."""
    n = F.col("doc_id") % 3
    cases = table(spark, d, "labels").select(F.col("doc_id").alias("case_id"), F.when(n == 0, F.array(F.lit("a"), F.lit(""), F.lit("b"), F.lit("a"))).otherwise(F.array().cast("array<string>")).alias("relevant_ids"), F.array(F.col("doc_id").cast("string")).alias("ground_truth_rows"), (n == 2).alias("held_out"))
    kind = F.element_at(F.array(F.lit("given"), F.lit("row"), F.lit("none")), (F.col("case_id") % 3 + 1).cast("int"))
    return evaluation.ground_truth(cases).select(F.col("case_id").alias("doc_id"), kind.alias("kind"), "truth")


@query("SELECT doc_id, max(n_chunks) AS n_chunks, min(covers) AS covers FROM (SELECT doc_id, greatest(1, length(trim(coalesce(text, ''))) // 400000 + 1) AS n_chunks, true AS covers FROM documents WHERE trim(coalesce(text, '')) <> '') GROUP BY doc_id")
def whole_chunks(spark, d):
    """With a size over every text, a chunk is the text."""
    made = chunking.chunk_recursive(corpus(spark, d), chunking.ChunkConfig("recursive", 400000, 0))
    x = made.join(corpus(spark, d), "doc_id")
    strip = F.regexp_replace("content", r"(?U)^\s+|\s+$", "")
    return x.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.bool_and(F.regexp_replace("chunk", r"(?U)^\s+|\s+$", "") == strip).alias("covers"))
