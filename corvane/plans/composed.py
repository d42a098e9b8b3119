"""Registered queries of composed retrieval: documents and questions with vectors, other wordings, model reranking, evidence.

The shared tables hold vectors and texts side by side only by number: a document or question takes the vector of its own id.
Models are plain functions here, so that SQL can say what they answer.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dense, fusion, sparse
from . import retrieve
from .queries import _BM25, _KEYWORD, _ORDERED, _TERMS, _TFIDF, _TOK, corpus, mmr_sql, query, questions, table, vectors


def near_corpus(spark, d):
    """Every document, with the vector of its id where there is one."""
    return corpus(spark, d).withColumnRenamed("source", "heading").join(vectors(spark, d).select("doc_id", "vector"), "doc_id", "left")


def near_vectors(spark, d):
    """The vectors of documents, beside their texts: these need not travel to be joined with them."""
    return vectors(spark, d).select("doc_id", "vector").join(corpus(spark, d).select("doc_id"), "doc_id", "left_semi")


def headed(spark, d):
    return corpus(spark, d).withColumnRenamed("source", "heading")


def near_questions(spark, d):
    return questions(spark, d).join(vectors(spark, d).select(F.col("doc_id").alias("query_id"), "vector"), "query_id", "left")


#: Stand before the tables of the same names: documents and questions with the vector of their id, where there is one.
_NEAR = """documents AS MATERIALIZED (SELECT d.*, e.embedding::DOUBLE[] AS v FROM main.documents d LEFT JOIN main.embeddings e ON e.vec_id = d.doc_id),
benchmark AS MATERIALIZED (SELECT b.*, e.embedding::DOUBLE[] AS v FROM main.benchmark b LEFT JOIN main.embeddings e ON e.vec_id = b.item_id)"""
_NEAR_DIST = """ndist AS MATERIALIZED (SELECT item_id AS query_id, doc_id, round(1 - coalesce(list_cosine_similarity(b.v, d.v), 0), 6) + 0.0 AS distance, d.v AS dv, b.v AS qv FROM benchmark b, documents d WHERE b.v IS NOT NULL AND d.v IS NOT NULL),
nvec AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) - 1 AS rank FROM ndist QUALIFY rank < 12)"""
#: A filter text's documents: those with a vector first, nearest to the question.
_AWAY = "CASE WHEN b.v IS NOT NULL AND d.v IS NOT NULL THEN round(1 - coalesce(list_cosine_similarity(b.v, d.v), 0), 6) END"
_NEAR_WHERE = f"""
qf AS (SELECT query_id, {_ORDERED.format("(ps || ts)")}[1:6] AS fs FROM qp),
qx AS (SELECT query_id, unnest(fs) AS filter_text, unnest(range(1, len(fs) + 1)) AS place FROM qf),
filt AS (SELECT query_id, filter_text, doc_id, row_number() OVER (PARTITION BY query_id, place ORDER BY {_AWAY}, doc_id) - 1 AS rank
  FROM qx JOIN benchmark b ON item_id = query_id JOIN documents d ON d.text ILIKE '%' || filter_text || '%' QUALIFY rank < 5)
"""


@query(f"WITH {_NEAR}, {_TERMS}, {_NEAR_WHERE} SELECT * FROM filt")
def where_vector_route(spark, d):
    """Of each filter text the documents nearest to the question among those that hold it."""
    return sparse.where_document(near_questions(spark, d), near_corpus(spark, d))


@query(f"WITH {_NEAR}, {_NEAR_DIST}, b8 AS (SELECT * FROM nvec WHERE rank < 8), {mmr_sql('b8', 8)} SELECT query_id, doc_id, rank::BIGINT AS rank FROM m7")
def mmr_route(spark, d):
    return dense.mmr(near_questions(spark, d), near_corpus(spark, d), 8, 8, 0.5)


_SIX = f"""{_NEAR}, {_BM25}, {_TFIDF}, {_TERMS}, {_KEYWORD}, {_NEAR_WHERE}, {_NEAR_DIST}, b8 AS (SELECT * FROM nvec WHERE rank < 8), {mmr_sql('b8', 8)},
u AS (SELECT query_id, doc_id, 1 AS route, rank, NULL::DOUBLE AS score, NULL AS text FROM tfidf UNION ALL SELECT query_id, doc_id, 2, rank, NULL, NULL FROM bm25
  UNION ALL SELECT query_id, doc_id, 3, rank, NULL, NULL FROM nvec UNION ALL SELECT query_id, doc_id, 4, rank, NULL, NULL FROM m7
  UNION ALL SELECT query_id, doc_id, 5, rank, NULL, filter_text FROM filt UNION ALL SELECT query_id, doc_id, 6, rank, score, NULL FROM keyword),
m AS (SELECT query_id, doc_id, coalesce(max(score), 0) + least(20, 8 * count(DISTINCT text))
    + sum(DISTINCT CASE WHEN route = 1 THEN 100.0::DOUBLE / (61 + rank) ELSE 0 END) + sum(DISTINCT CASE WHEN route = 2 THEN 100.0::DOUBLE / (61 + rank) ELSE 0 END)
    + sum(DISTINCT CASE WHEN route = 3 THEN 100.0::DOUBLE / (61 + rank) ELSE 0 END) + sum(DISTINCT CASE WHEN route = 4 THEN 100.0::DOUBLE / (61 + rank) ELSE 0 END) AS final,
  min(route * 1000000 + rank) AS seen FROM u GROUP BY ALL),
fused AS (SELECT query_id, doc_id, round(final, 6) AS final_score, row_number() OVER (PARTITION BY query_id ORDER BY round(final, 6) DESC, seen, doc_id) - 1 AS rank FROM m QUALIFY rank < 8)"""


@query(f"WITH {_SIX} SELECT * FROM fused")
def six_route_fusion(spark, d):
    """All routes at once."""
    s = retrieve.Settings(tfidf=True, mmr=True)
    return fusion.fuse(retrieve.routes(near_questions(spark, d), headed(spark, d), s, vectors=near_vectors(spark, d)))


# ------------------------------------------------------------------ other wordings

def halves(q: str) -> list[str]:
    w = q.split()
    return [" ".join(w[: len(w) // 2]), " ".join(w[len(w) // 2 :])]


_CLEAN = r"trim(regexp_replace({}, '^[\s\-*•\d.)]+', ''))"
_WORDINGS = f"""
ww AS (SELECT item_id AS query_id, text, string_split_regex(trim(text), '\\s+') AS w FROM benchmark),
wl AS (SELECT query_id, text, {_ORDERED.format("l")} AS l FROM (SELECT query_id, text, list_filter([text, {_CLEAN.format("array_to_string(w[1 : len(w) // 2], ' ')")}, {_CLEAN.format("array_to_string(w[len(w) // 2 + 1 : ], ' ')")}], lambda x: x <> '') AS l FROM ww)),
wordings AS MATERIALIZED (SELECT query_id, unnest(l) AS query, unnest(range(0, len(l))) AS variant FROM wl)"""


@query(f"WITH {_WORDINGS} SELECT query_id, variant::INTEGER AS variant, query FROM wordings")
def expand_wordings(spark, d):
    """Each question, its halves as a model's other wordings, and no parts, as a single part is none."""
    return retrieve.expand(questions(spark, d), halves, lambda q: q.split()[:1])


_EXPANDED_BM25 = _BM25.replace("q AS (SELECT item_id AS query_id, token, count(*) AS times", "q AS (SELECT wid AS query_id, token, count(*) AS times").replace(
    f"(SELECT item_id, unnest({_TOK.format('text')}) AS token FROM benchmark)", f"(SELECT query_id * 10 + variant AS wid, unnest({_TOK.format('query')}) AS token FROM wordings)"
)
_EXPANDED = f"""{_WORDINGS}, {_EXPANDED_BM25},
ebest AS (SELECT query_id // 10 AS query_id, doc_id, max(score) AS score FROM bm25 GROUP BY ALL),
ebm25 AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) - 1 AS rank FROM ebest QUALIFY rank < 12)"""


@query(f"WITH {_EXPANDED} SELECT * FROM ebm25")
def expanded_bm25(spark, d):
    """The best score of any wording counts, once."""
    return sparse.over_variants(sparse.bm25, retrieve.expand(questions(spark, d), halves).select("query_id", "query"), corpus(spark, d), 12)


@query(f"""WITH {_NEAR}, w AS (SELECT item_id AS query_id, 0 AS variant, v FROM benchmark UNION ALL SELECT item_id, 1, e.embedding::DOUBLE[] FROM benchmark JOIN main.embeddings e ON e.vec_id = item_id + 40),
x AS (SELECT query_id, variant, doc_id, round(1 - coalesce(list_cosine_similarity(w.v, d.v), 0), 6) + 0.0 AS distance FROM w, documents d WHERE w.v IS NOT NULL AND d.v IS NOT NULL),
y AS (SELECT *, row_number() OVER (PARTITION BY query_id, variant ORDER BY distance, doc_id) AS r FROM x QUALIFY r <= 12),
z AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY variant, r) - 1 AS place FROM y)
SELECT query_id, doc_id, min(distance) AS distance, min(place) AS rank FROM z GROUP BY ALL""")
def expanded_vector(spark, d):
    """The least distance and first place over two vectors a question."""
    q, v = near_questions(spark, d), vectors(spark, d)
    second = q.select("query_id").join(v.select((F.col("doc_id") - 40).alias("query_id"), "vector"), "query_id")
    both = q.select("query_id", F.lit(0).alias("variant"), "vector").unionByName(second.withColumn("variant", F.lit(1)))
    return dense.over_wordings(both, near_corpus(spark, d))


_JOINED = f"""jw AS (SELECT query_id AS item_id, string_agg(query, ' | ' ORDER BY variant) AS text FROM wordings GROUP BY ALL)"""
_EXPANDED_FUSED = f"""{_EXPANDED}, {_JOINED}, {_TERMS.replace("FROM benchmark", "FROM jw")}, {_KEYWORD},
qf AS (SELECT query_id, {_ORDERED.format("(ps || ts)")}[1:6] AS fs FROM qp),
qx AS (SELECT query_id, unnest(fs) AS filter_text, unnest(range(1, len(fs) + 1)) AS place FROM qf),
filt AS (SELECT query_id, filter_text, doc_id, row_number() OVER (PARTITION BY query_id, place ORDER BY doc_id) - 1 AS rank FROM qx JOIN documents ON text ILIKE '%' || filter_text || '%' QUALIFY rank < 5),
u AS (SELECT query_id, doc_id, 2 AS route, rank, NULL AS score, NULL AS text FROM ebm25 UNION ALL SELECT query_id, doc_id, 5, rank, NULL, filter_text FROM filt UNION ALL SELECT query_id, doc_id, 6, rank, score, NULL FROM keyword),
m AS (SELECT query_id, doc_id, min(CASE WHEN route = 2 THEN rank END) AS b, max(score) AS k, count(DISTINCT text) AS hits, min(route * 1000000 + rank) AS seen FROM u GROUP BY ALL),
f AS (SELECT query_id, doc_id, round(coalesce(k, 0) + least(20, 8 * hits) + coalesce(100.0::DOUBLE / (61 + b), 0), 6) AS score, seen FROM m),
top3 AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seen, doc_id) - 1 AS rank FROM f QUALIFY rank < 3),
n3 AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS n FROM top3)"""


@query(f"WITH {_EXPANDED_FUSED} SELECT query_id, doc_id, score, rank, CASE WHEN n <= 2 OR rank % 2 = 0 THEN rank ELSE 2 * (n // 2 - 1 - rank // 2) + 1 END AS position FROM n3")
def expanded_retrieve(spark, d):
    """retrieve over several wordings: lexical routes over each, terms of all together."""
    c = corpus(spark, d).withColumnRenamed("source", "heading")
    return retrieve.retrieve(questions(spark, d), c, variants=halves).drop("content", "heading")


@query("""SELECT doc_id FROM documents WHERE doc_id % 4 <> 3 AND ((doc_id % 5 = 0 AND lang = 'en') OR doc_id % 7 = 0)""")
def excluded_evaluation_rows(spark, d):
    """Documents that evaluation keys of their sheet and row, or of the row in any sheet, leave out; a row that is no number stays."""
    docs = table(spark, d, "documents")
    sheets = docs.select("doc_id", F.col("lang").alias("sheet"), F.when(F.col("doc_id") % 4 == 3, F.concat(F.lit("r"), F.col("doc_id"))).otherwise(F.col("doc_id").cast("string")).alias("row"))
    keys = docs.filter("doc_id % 5 = 0").select(F.lit("en").alias("sheet"), F.col("doc_id").alias("row")).union(docs.filter("doc_id % 7 = 0").select(F.lit(""), "doc_id"))
    return retrieve.excluded_rows(sheets, keys)


@query(f"""WITH {_NEAR}, {_TERMS}, {_NEAR_DIST}, dense_left AS (SELECT query_id, doc_id, distance FROM ndist QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) <= 12 + least(100, (SELECT count(*) FROM documents WHERE doc_id % 5 = 0)))
SELECT 'vector' AS route, query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) - 1 AS rank FROM dense_left WHERE doc_id % 5 <> 0
UNION ALL SELECT 'filter', query_id, doc_id, rank FROM (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id, place ORDER BY {_AWAY}, doc_id) - 1 AS rank
  FROM (SELECT query_id, unnest(fs) AS filter_text, unnest(range(1, len(fs) + 1)) AS place FROM (SELECT query_id, {_ORDERED.format("(ps || ts)")}[1:6] AS fs FROM qp)) JOIN benchmark b ON item_id = query_id JOIN documents d ON d.doc_id % 5 <> 0 AND d.text ILIKE '%' || filter_text || '%' QUALIFY rank < 5)""")
def excluded_routes(spark, d):
    """Evaluation rows are no candidates of the vector and filter routes."""
    c = near_corpus(spark, d)
    found = retrieve.routes(near_questions(spark, d), c, retrieve.Settings(bm25=False, keyword=False), excluded=c.filter("doc_id % 5 = 0"))
    return found["vector"].select(F.lit("vector").alias("route"), "query_id", "doc_id", "rank").union(found["filter"].select(F.lit("filter"), "query_id", "doc_id", "rank"))


@query(f"WITH {_NEAR}, {_NEAR_DIST} SELECT query_id, doc_id, distance, round(1 / (1 + greatest(distance, 0)), 6) AS similarity FROM nvec")
def display_similarity(spark, d):
    found = dense.vector_search(near_questions(spark, d), near_corpus(spark, d))
    return found.select("query_id", "doc_id", "distance", F.round(dense.display_similarity(F.col("distance")), 6).alias("similarity"))


_HEADED = r"documents AS MATERIALIZED (SELECT doc_id, regexp_replace('    ' || lang || ' ' || source || chr(10) || coalesce(text, ''), '^\s+|\s+$', '', 'g') AS text FROM main.documents)"


@query(f"WITH {_HEADED}, {_BM25} SELECT * FROM bm25")
def bm25_with_headings(spark, d):
    """BM25 over texts with their title and source in front."""
    c = corpus(spark, d)
    text = T.sparse_text(F.create_map(F.lit("title"), F.col("lang"), F.lit("source"), F.col("source")), F.col("content"))
    return sparse.bm25(questions(spark, d), c.select("doc_id", text.alias("content")))


# ------------------------------------------------------------------ models on the documents found

def _found(spark, d, k=6):
    """The nearest documents of each question with their texts."""
    found = dense.vector_search(near_questions(spark, d), near_corpus(spark, d), k)
    return found.join(corpus(spark, d).select("doc_id", "content"), "doc_id").join(questions(spark, d), "query_id")


_FOUND = f"{_NEAR}, {_NEAR_DIST}, f6 AS (SELECT n.query_id, n.doc_id, n.rank, n.distance, d.text, b.text AS question FROM nvec n JOIN documents d USING (doc_id) JOIN benchmark b ON b.item_id = n.query_id WHERE rank < 6)"


@query(f"WITH {_FOUND}, p AS (SELECT *, ((length(question) + 1 + length(substr(text, 1, 3000))) % 101)::DOUBLE AS points FROM f6) SELECT query_id, doc_id, points, row_number() OVER (PARTITION BY query_id ORDER BY points DESC, rank) - 1 AS rank FROM p")
def pointwise_rerank(spark, d):
    from ..functions import providers

    found = _found(spark, d)
    return fusion.pointwise(found, providers.rated(F.col("query"), F.col("content"), lambda p: f"{len(p) % 101} points")).select("query_id", "doc_id", "points", "rank")


@query(f"WITH {_FOUND} SELECT query_id, doc_id, CASE rank WHEN 2 THEN 0 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE rank END AS rank FROM f6")
def listwise_rerank(spark, d):
    """A model that says 3, 1, 3, x, 9 puts the third first, then the first, then the others as they were."""
    from ..functions import providers

    found = _found(spark, d).drop("query")
    shown = fusion.listed(found, 1200)
    return fusion.listwise(found, shown.select("query_id", providers.answer(F.col("listing"), lambda p: "3, 1,3,x,9").alias("said"))).select("query_id", "doc_id", "rank")


@query(f"WITH {_FOUND}, y AS (SELECT * FROM f6 WHERE length(substr(text, 1, 3000)) % 2 = 0) SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) - 1 AS rank FROM y")
def yes_no_filter(spark, d):
    from ..functions import providers

    said = providers.answer(F.substring("content", 1, 3000), lambda p: "Yes." if len(p) % 2 == 0 else "no")
    return fusion.approved(_found(spark, d).withColumn("said", said), F.col("said")).select("query_id", "doc_id", "rank")


def even_blocks(prompt: str) -> str:
    """1 for each listed document of an even number of characters."""
    return ",".join(str(1 - len(x) % 2) for x in re.split(r"(?:^|\n)\d+\. ", prompt)[1:])


@query(f"""WITH {_FOUND}, near AS (SELECT * FROM f6 WHERE distance <= 0.8), y AS (SELECT * FROM near WHERE length(substr(text, 1, 3000)) % 2 = 0)
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) - 1 AS rank FROM y""")
def evidence_validate(spark, d):
    """Documents within a distance of their question to which a model that sees them together gives a 1."""
    found = _found(spark, d).drop("query", "distance")
    return retrieve.validated(found, near_questions(spark, d), near_corpus(spark, d), 0.8, even_blocks).select("query_id", "doc_id", "rank")


@query(f"""WITH {_SIX}, vnear AS (SELECT f.query_id, f.doc_id, f.rank FROM fused f JOIN ndist n USING (query_id, doc_id) WHERE f.rank < 3 AND n.distance <= 0.95),
vc AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) - 1 AS r, count(*) OVER (PARTITION BY query_id) AS n FROM vnear),
vp AS (SELECT query_id, doc_id, CASE WHEN n <= 2 OR r % 2 = 0 THEN r ELSE 2 * (n // 2 - 1 - r // 2) + 1 END AS position FROM vc),
vs AS (SELECT query_id, source, min(position) AS position FROM vp JOIN documents USING (doc_id) GROUP BY ALL),
va AS (SELECT query_id, string_agg(source, chr(10) ORDER BY position) AS sources FROM vs GROUP BY ALL)
SELECT item_id AS query_id, CASE WHEN sources IS NULL THEN '{retrieve.REFUSAL}' ELSE 'answer to ' || b.text END AS answer, coalesce(sources, '') AS sources FROM benchmark b LEFT JOIN va ON query_id = item_id""")
def validated_answers(spark, d):
    """All routes, evidence within a distance, and an answer or a refusal."""
    s = retrieve.Settings(tfidf=True, mmr=True, threshold=0.95)
    return retrieve.answers(near_questions(spark, d), headed(spark, d), lambda p: "answer to " + p.rsplit("\n\n", 1)[1], s, vectors=near_vectors(spark, d))
