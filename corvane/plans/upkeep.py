r"""Registered queries of the corpus' upkeep: document and chunk sync, chunks by class, evaluation runs, question sets."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import tables
from ..functions import text as T
from ..operators import chunking, dense, evaluation, fusion, ingest, versioning
from ..sources import readers, sinks
from ..streaming import sync
from . import retrieve
from .composed import _NEAR, _NEAR_DIST, headed, near_questions, near_vectors
from .queries import corpus, query, table

# ------------------------------------------------------------------ documents and chunks of the common tables

_VERSIONS = """
coll AS (SELECT DISTINCT source AS collection_code, substr(source, 4)::BIGINT AS collections_id FROM documents WHERE source <> 'src3'),
ver AS (SELECT doc_id AS source_versions_id, source AS collection_code, 'k' || (doc_id % 300) AS source_key, CASE WHEN doc_id % 11 <> 0 THEN sha256(lang || (doc_id % 3)) END AS source_hash,
  doc_id // 300 + 1 AS document_version, doc_id % 3 <> 0 AS is_active, 'n' || doc_id AS source_name, lang, CASE WHEN doc_id % 4 = 0 THEN 'x' ELSE doc_id::VARCHAR END AS row FROM documents),
incoming AS (SELECT collections_id, source_key, source_hash, document_version, is_active, source_versions_id, upper(CASE WHEN lang = 'en' THEN 'csv' ELSE 'FILE' END) AS source_type, source_name,
  'p' || source_versions_id AS source_path, CASE WHEN row <> 'x' THEN row::INTEGER END AS source_record_no, source_name AS title, source_versions_id % 10 = 0 AS is_evaluation,
  '{"collection_code":"' || collection_code || '","loader":"' || CASE WHEN lang = 'en' THEN 'csv' ELSE ' ' END || '","namespace":"default","relative_path":"p' || source_versions_id || '","row":"' || row || '","source_key":"' || source_key || '","source_versions_id":"' || source_versions_id || '"}' AS metadata
  FROM ver JOIN coll USING (collection_code)),
old AS (SELECT collections_id, source_key, CASE WHEN source_versions_id % 4 = 1 THEN 'other' ELSE source_hash END AS source_hash, document_version, source_versions_id % 7 <> 0 AS is_active, -1::BIGINT AS source_versions_id, 'OLD' AS source_type, 'old' AS source_name,
  '' AS source_path, 0 AS source_record_no, 'old' AS title, false AS is_evaluation, '{}' AS metadata FROM incoming WHERE source_versions_id % 2 = 0 OR source_versions_id % 4 = 1)"""


def _versions(spark, d):
    docs = table(spark, d, "documents")
    lang, n = F.col("lang"), F.col("doc_id").cast("string")
    meta = F.create_map(F.lit("loader"), F.when(lang == "en", "csv").otherwise(" "), F.lit("relative_path"), F.concat(F.lit("p"), n), F.lit("row"), F.when(F.col("doc_id") % 4 == 0, "x").otherwise(n))
    return docs.select(
        F.col("doc_id").alias("source_versions_id"), F.col("source").alias("collection_code"), F.concat(F.lit("k"), (F.col("doc_id") % 300).cast("string")).alias("source_key"),
        F.when(F.col("doc_id") % 11 != 0, F.sha2(F.concat(lang, (F.col("doc_id") % 3).cast("string")), 256)).alias("source_hash"), (F.floor(F.col("doc_id") / 300) + 1).alias("document_version"),
        (F.col("doc_id") % 3 != 0).alias("is_active"), F.concat(F.lit("n"), n).alias("source_name"), meta.alias("metadata"),
    )


def _incoming(spark, d):
    docs = table(spark, d, "documents")
    coll = docs.select(F.col("source").alias("collection_code"), F.substring("source", 4, 9).cast("long").alias("collections_id")).distinct().filter("collection_code <> 'src3'")
    v = _versions(spark, d)
    # ids that are divisible by 10 share their source keys with no other
    marked = v.filter("source_versions_id % 10 = 0").select("source_key")
    return versioning.common_documents(v, coll, marked)


def _common(spark, d):
    x = _incoming(spark, d).filter("source_versions_id % 2 = 0 or source_versions_id % 4 = 1")
    n = F.col("source_versions_id")
    return x.select(
        "collections_id", "source_key", F.when(n % 4 == 1, "other").otherwise(F.col("source_hash")).alias("source_hash"), "document_version", (n % 7 != 0).alias("is_active"), F.lit(-1).cast("long").alias("source_versions_id"),
        F.lit("OLD").alias("source_type"), F.lit("old").alias("source_name"), F.lit("").alias("source_path"), F.lit(0).alias("source_record_no"), F.lit("old").alias("title"), F.lit(False).alias("is_evaluation"), F.lit("{}").alias("metadata"),
    )


@query(f"WITH {_VERSIONS} SELECT * FROM incoming")
def common_documents(spark, d):
    """Rows of the common document table from source versions: joined with collections, defaults, numbers, JSON."""
    return _incoming(spark, d)


_FIELDS = "source_versions_id source_type source_name source_path source_record_no title is_evaluation metadata".split()
_KEYS = "collections_id source_key source_hash document_version".split()
_SAME = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in _KEYS)
_SYNCED = f"""{_VERSIONS},
ends AS (SELECT o.*, o.is_active AND EXISTS (SELECT 1 FROM incoming n WHERE n.is_active AND n.collections_id = o.collections_id AND n.source_key = o.source_key
  AND NOT (n.source_hash IS NOT DISTINCT FROM o.source_hash AND n.document_version = o.document_version)) AS ended FROM old o),
synced AS (SELECT {', '.join(f'CASE WHEN n.collections_id IS NOT NULL THEN n.{k} ELSE o.{k} END AS {k}' for k in [*_KEYS, *_FIELDS])},
  CASE WHEN n.collections_id IS NOT NULL THEN n.is_active ELSE o.is_active AND NOT o.ended END AS is_active,
  CASE WHEN o.collections_id IS NULL THEN 'inserted' WHEN n.collections_id IS NOT NULL THEN 'updated' WHEN o.ended THEN 'ended' ELSE 'kept' END AS action
  FROM ends o FULL JOIN incoming n ON {_SAME})"""


@query(f"WITH {_SYNCED} SELECT * FROM synced")
def document_sync(spark, d):
    """Old versions end, the same ones take new fields, missing ones are added."""
    return versioning.sync_documents(_common(spark, d), _incoming(spark, d))


_CHUNKS = """
chunks AS (SELECT l_orderkey % 150 AS source_versions_id, l_linenumber AS created_at, sha256(l_orderkey || '-' || l_linenumber || '-' || l_partkey) AS document_key,
  CASE WHEN l_orderkey % 5 = 0 THEN sha256(l_partkey::VARCHAR) ELSE sha256(l_orderkey || '/' || l_linenumber || '/' || l_partkey) END AS chunk_hash, 'c' || l_partkey AS content,
  CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber::VARCHAR ELSE 'p' END AS page, CASE WHEN l_linenumber = 3 THEN ' ' ELSE 'row' END AS strategy FROM lineitem),
owners AS (SELECT source_versions_id + 1000 AS documents_id, source_versions_id FROM (SELECT DISTINCT source_versions_id FROM chunks) WHERE source_versions_id % 6 <> 0),
there AS (SELECT documents_id, i AS chunk_index, sha256('there' || documents_id || i) AS chunk_hash FROM owners, range(0, 3) r(i) WHERE documents_id % 4 = 0
  UNION ALL SELECT 5, row_number() OVER (ORDER BY p_partkey), sha256(p_partkey::VARCHAR) FROM part WHERE p_partkey % 3 = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source_versions_id ORDER BY created_at, document_key) - 1 AS chunk_index FROM chunks),
fresh AS (SELECT documents_id, chunk_index, chunk_hash, content AS chunk_text, CASE WHEN page <> 'p' THEN page::INTEGER END AS page_number, 'text' AS block_type, coalesce(nullif(trim(strategy), ''), 'recursive') AS chunk_strategy, 800 AS chunk_size, 150 AS chunk_overlap
  FROM numbered n JOIN owners USING (source_versions_id)
  WHERE NOT EXISTS (SELECT 1 FROM there t WHERE t.documents_id = owners.documents_id AND t.chunk_index = n.chunk_index) AND NOT EXISTS (SELECT 1 FROM there t WHERE t.chunk_hash = n.chunk_hash))"""


def _line_chunks(spark, d):
    i = table(spark, d, "lineitem")
    text = lambda *c: F.concat(*[F.col(x).cast("string") if x.startswith("l_") else F.lit(x) for x in c])
    meta = F.create_map(F.lit("page_number"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber").cast("string")).otherwise("p"), F.lit("block_type"), F.lit("text"), F.lit("chunk_strategy"), F.when(F.col("l_linenumber") == 3, " ").otherwise("row"))
    chunks = i.select(
        (F.col("l_orderkey") % 150).alias("source_versions_id"), F.col("l_linenumber").alias("created_at"), F.sha2(text("l_orderkey", "-", "l_linenumber", "-", "l_partkey"), 256).alias("document_key"),
        F.when(F.col("l_orderkey") % 5 == 0, F.sha2(text("l_partkey"), 256)).otherwise(F.sha2(text("l_orderkey", "/", "l_linenumber", "/", "l_partkey"), 256)).alias("chunk_hash"), text("c", "l_partkey").alias("content"), meta.alias("metadata"),
    )
    v = F.col("source_versions_id")
    owners = chunks.select("source_versions_id").distinct().filter(v % 6 != 0).select((v + 1000).alias("documents_id"), F.to_json(F.struct(v.cast("string").alias("source_versions_id"))).alias("metadata"))
    hashed = owners.filter("documents_id % 4 = 0").select("documents_id", F.explode(F.array(*[F.lit(i).cast("long") for i in range(3)])).alias("chunk_index"))
    hashed = hashed.withColumn("chunk_hash", F.sha2(F.concat(F.lit("there"), F.col("documents_id").cast("string"), F.col("chunk_index").cast("string")), 256))
    parts = table(spark, d, "part").filter("p_partkey % 3 = 0").select(F.lit(5).cast("long").alias("documents_id"), F.col("p_partkey").cast("long").alias("chunk_index"), F.sha2(F.col("p_partkey").cast("string"), 256).alias("chunk_hash"))
    return chunks, owners, hashed.unionByName(parts)


@query(f"WITH {_CHUNKS} SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY chunk_hash ORDER BY documents_id, chunk_index) = 1")
def chunk_sync(spark, d):
    """Chunks that repeat neither a hash nor a place."""
    chunks, owners, there = _line_chunks(spark, d)
    return versioning.sync_chunks(there, chunks, owners)


@query(f"""WITH {_CHUNKS}, v AS (SELECT DISTINCT source_versions_id FROM chunks), nd AS (SELECT count(*) AS n_documents FROM v WHERE source_versions_id NOT IN (SELECT source_versions_id FROM owners)),
nc AS (SELECT count(*) AS n_chunks FROM (SELECT DISTINCT chunk_hash FROM chunks) WHERE chunk_hash NOT IN (SELECT chunk_hash FROM there))
SELECT n_documents, n_chunks, n_documents = 0 AND n_chunks = 0 AS nothing_to_do FROM nd, nc""")
def sync_needed(spark, d):
    chunks, owners, there = _line_chunks(spark, d)
    known = owners.select(F.get_json_object("metadata", "$.source_versions_id").cast("long").alias("source_versions_id"))
    return versioning.to_sync(chunks.select("source_versions_id").distinct(), known, chunks, there)


@query("""WITH ch AS (SELECT doc_id, doc_id % 300 AS source_versions_id, doc_id % 5 <> 0 AS is_active FROM documents), v AS (SELECT doc_id AS source_versions_id, doc_id % 3 <> 0 AS is_active FROM documents WHERE doc_id < 250)
SELECT ch.doc_id, ch.source_versions_id, ch.is_active AND NOT EXISTS (SELECT 1 FROM v WHERE v.source_versions_id = ch.source_versions_id AND NOT v.is_active) AS is_active FROM ch""")
def ended_chunks(spark, d):
    """Chunks end with their source version."""
    docs = table(spark, d, "documents").select("doc_id")
    chunks = docs.select("doc_id", (F.col("doc_id") % 300).alias("source_versions_id"), (F.col("doc_id") % 5 != 0).alias("is_active"))
    return versioning.end_chunks(chunks, docs.filter("doc_id < 250").select(F.col("doc_id").alias("source_versions_id"), (F.col("doc_id") % 3 != 0).alias("is_active"))).select("doc_id", "source_versions_id", "is_active")


@query("""WITH st AS (SELECT source AS collection_code, doc_id::VARCHAR AS source_key, 1::BIGINT AS version, doc_id % 4 <> 0 AS is_active, CASE WHEN doc_id % 4 = 0 THEN doc_id END AS superseded_at FROM documents)
SELECT collection_code, source_key, version, is_active AND NOT (collection_code IN ('src1', 'src2')) AS is_active, CASE WHEN is_active AND collection_code IN ('src1', 'src2') THEN coalesce(superseded_at, 99) ELSE superseded_at END AS superseded_at FROM st""")
def forced_rebuild(spark, d):
    n = F.col("doc_id")
    state = table(spark, d, "documents").select(F.col("source").alias("collection_code"), n.cast("string").alias("source_key"), F.lit(1).cast("long").alias("version"), (n % 4 != 0).alias("is_active"), F.when(n % 4 == 0, n).alias("superseded_at"))
    return versioning.rebuild(state, state.select("collection_code").filter("collection_code in ('src1', 'src2')"), F.lit(99).cast("long"))


@query("SELECT c_custkey, c_name, 100 + row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS source_versions_id FROM customer")
def version_ids(spark, d):
    return versioning.with_ids(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"], 100)


_PIECE = """sha256(text || chr(10) || '{"lang":"' || lang || '"}')"""


@query(f"""WITH p AS (SELECT source AS source_key, doc_id, {_PIECE} AS h FROM documents), g AS (SELECT source_key, string_agg(h, '' ORDER BY doc_id) AS hs FROM p GROUP BY ALL)
SELECT source_key, CASE WHEN substr(source_key, 4)::INTEGER % 2 = 0 THEN sha256('f' || source_key || '|' || '{{"size":800}}') ELSE sha256(hs) END AS source_hash FROM g
UNION ALL SELECT 'row' || doc_id, sha256({_PIECE}) FROM documents""")
def source_group_hash(spark, d):
    """Files by their own hash and the configuration; rows, and sources without a file, by their pieces."""
    c = corpus(spark, d)
    piece = lambda key, loader, row: c.select(key.alias("source_key"), F.lit(loader).alias("loader"), row.alias("row"), F.lit(None).cast("long").alias("item"), F.col("doc_id").alias("place"), "content", F.create_map(F.lit("lang"), F.col("lang"), F.lit("start_index"), F.lit("0")).alias("metadata"))
    both = piece(F.col("source"), "pdf", F.lit(None).cast("long")).unionByName(piece(F.concat(F.lit("row"), F.col("doc_id").cast("string")), "csv", F.col("doc_id")))
    names = c.select(F.col("source").alias("source_key")).distinct()
    files = names.filter(F.substring("source_key", 4, 9).cast("int") % 2 == 0).union(c.select(F.concat(F.lit("row"), F.col("doc_id").cast("string"))))
    return versioning.group_source_hash(both, files.select("source_key", F.sha2(F.concat(F.lit("f"), F.col("source_key")), 256).alias("x"), F.concat(F.lit("f"), F.col("source_key")).alias("file_hash"), F.lit('{"size":800}').alias("config")))


# ------------------------------------------------------------------ chunks by class

_CONFIGS = {"src1": {"strategy": "token", "size": 60, "overlap": 10}, "src2": {"strategy": "token", "size": 50}}
_DEFAULT = chunking.ChunkConfig("token", 100, 20)


def _blocks(spark, d):
    n = F.col("doc_id")
    kind = F.when(n % 4 == 1, "table").when(n % 4 == 2, "image").otherwise("text")
    loader = F.when(n % 4 == 0, "csv").when(n % 4 == 3, "web").otherwise("pdf")
    return corpus(spark, d).select("doc_id", "content", loader.alias("loader"), kind.alias("block_type"), F.when(n % 9 == 0, " ").otherwise(F.col("source")).alias("collection_code"), F.when(n % 8 == 1, n).alias("page_number"), n.alias("page"))


@query(r"""WITH b AS (SELECT doc_id, coalesce(text, '') AS content, CASE WHEN doc_id % 9 = 0 THEN 'DEFAULT' ELSE source END AS code, CASE doc_id % 4 WHEN 0 THEN 'structured' WHEN 3 THEN 'other' ELSE 'standalone' END AS class FROM documents),
c AS (SELECT *, CASE code WHEN 'src1' THEN 60 WHEN 'src2' THEN 50 ELSE 100 END AS size, CASE code WHEN 'src1' THEN 10 ELSE 20 END AS overlap,
  CASE WHEN class = 'standalone' THEN CASE WHEN doc_id % 8 = 1 THEN doc_id ELSE doc_id + 1 END END::INTEGER AS page FROM b),
w AS (SELECT *, list_filter(string_split_regex(content, '\s+'), lambda x: x <> '') AS ts FROM c WHERE class = 'other'),
s AS (SELECT *, unnest(range(0, greatest(ceil((len(ts) - overlap) / (size - overlap)::DOUBLE)::BIGINT, 1))) AS i FROM w WHERE len(ts) > 0)
SELECT doc_id, class AS block_class, content AS chunk, code AS collection_code, CASE WHEN class = 'structured' THEN 'row' ELSE 'token' END AS chunk_strategy, CASE WHEN class <> 'structured' THEN size END::INTEGER AS chunk_size,
  CASE WHEN class = 'structured' THEN 0 ELSE overlap END::INTEGER AS chunk_overlap, NULL::VARCHAR AS section_title, NULL::VARCHAR AS section_path, page AS page_start, page AS page_end, 0 AS chunk_index FROM c WHERE class <> 'other'
UNION ALL SELECT doc_id, class, array_to_string(ts[i * (size - overlap) + 1 : i * (size - overlap) + size], ' '), code, 'token', size, overlap, NULL, NULL, page, page, i FROM s""")
def chunk_compose(spark, d):
    """Rows, tables, images and other texts, each by its class and its collection's configuration."""
    return chunking.compose(_blocks(spark, d), _CONFIGS, _DEFAULT)


@query("""SELECT CASE doc_id % 4 WHEN 0 THEN 'structured' WHEN 3 THEN 'other' ELSE 'standalone' END AS block_class, count(*) AS n FROM documents GROUP BY ALL""")
def block_router(spark, d):
    b = _blocks(spark, d)
    return b.groupBy(ingest.block_class(F.col("loader"), F.col("block_type")).alias("block_class")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id ELSE doc_id + 1 END AS page_start, CASE WHEN doc_id % 5 = 0 THEN 7 WHEN doc_id % 3 = 0 THEN doc_id ELSE doc_id + 1 END AS page_end FROM documents")
def page_spans(spark, d):
    n = F.col("doc_id")
    x = table(spark, d, "documents").select("doc_id", F.when(n % 3 == 0, n).alias("page_number"), n.alias("page"), F.lit(None).cast("long").alias("page_start"), F.when(n % 5 == 0, F.lit(7).cast("long")).alias("page_end"))
    return chunking.page_span(x).select("doc_id", "page_start", "page_end")


@query("SELECT doc_id, coalesce(text, '') AS chunk, 0::BIGINT AS chunk_index, 'row' AS chunk_strategy FROM documents")
def row_chunks(spark, d):
    return chunking.chunk_rows(corpus(spark, d)).select("doc_id", "chunk", "chunk_index", "chunk_strategy")


# ------------------------------------------------------------------ evaluation

def picky(prompt: str) -> str:
    if len(prompt) % 5 == 0:
        raise ValueError("out of order")
    return f"{len(prompt) % 7}"


def strict(prompt: str) -> str:
    if prompt.endswith("\n\n6"):
        raise ValueError("no verdict")
    n = int(prompt.rsplit("\n\n", 1)[1])
    return "So be it: " + json.dumps({r: {"score": n + i} for i, r in enumerate(evaluation.RUBRIC)})


_GIVEN = " + ".join(f"least(greatest(a + {i}, 1), 5)" for i in range(len(evaluation.RUBRIC)))


@query(f"""WITH {_NEAR}, {_NEAR_DIST}, top AS (SELECT n.query_id, n.doc_id, n.rank, d.text FROM nvec n JOIN documents d USING (doc_id) WHERE rank < 3),
truth AS (SELECT item_id AS query_id, e.vec_id AS doc_id FROM benchmark b JOIN main.embeddings q ON q.vec_id = item_id JOIN main.embeddings e ON e.label = q.label),
h AS (SELECT query_id, count(*) AS hits, min(rank) AS first FROM top JOIN truth USING (query_id, doc_id) GROUP BY ALL), tn AS (SELECT query_id, count(*) AS n FROM truth GROUP BY ALL),
p AS (SELECT query_id, list(doc_id ORDER BY rank) AS retrieved, sum(length(text)) + 2 * (count(*) - 1) + 2 AS n_context FROM top GROUP BY ALL),
q AS (SELECT item_id AS query_id, text, length(text) AS n_text FROM benchmark ORDER BY item_id LIMIT 30),
x AS (SELECT q.*, retrieved, coalesce(hits, 0) AS hits, first, n, n_context + n_text AS n_prompt, CASE WHEN (n_context + n_text) % 5 <> 0 THEN (n_context + n_text) % 7 END AS a FROM q JOIN p USING (query_id) LEFT JOIN h USING (query_id) LEFT JOIN tn USING (query_id))
SELECT query_id AS case_id, text AS question, retrieved, round(hits / n, 6) AS recall, round(hits / 5, 6) AS precision, round(coalesce(1.0::DOUBLE / (first + 1), 0), 6) AS mrr, coalesce(a::VARCHAR, '') AS answer,
  CASE WHEN a <> 6 THEN round(({_GIVEN}) / 7.0::DOUBLE, 3) END AS generation_average, CASE WHEN a <> 6 THEN round(({_GIVEN}) / 7.0::DOUBLE / 5 * 100, 2) END AS generation_score_100,
  coalesce(a <> 6, false) AS success, CASE WHEN a IS NULL THEN 'ValueError: out of order' WHEN a = 6 THEN 'ValueError: no verdict' ELSE '' END AS error_message FROM x""")
def experiment_run(spark, d):
    """The first 30 questions: what is found, metrics, an answer, its rubric, and the errors of models that fail on some."""
    c, v, ask = headed(spark, d), near_vectors(spark, d), near_questions(spark, d)
    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    # questions get their label first: labels among themselves would be rows times rows of a label
    own = ask.select("query_id").join(labels.select(F.col("doc_id").alias("query_id"), "label"), "query_id")
    truth = own.join(labels, "label").select("query_id", "doc_id")
    retriever = lambda q: dense.vector_search(ask.join(q.select("query_id"), "query_id"), v, 3).join(c.select("doc_id", "content"), "doc_id")
    cases = ask.select(F.col("query_id").alias("case_id"), F.col("query").alias("question"))
    return evaluation.experiment(cases, retriever, truth, picky, strict, 3, 5, 30)


@query("""SELECT name, value, n_questions, n_documents, corpus FROM (VALUES ('ChunkConfig.overlap', '150'), ('ChunkConfig.size', '800'), ('ChunkConfig.strategy', '"recursive"'), ('Settings.bm25', 'true'), ('Settings.candidates', '12'), ('Settings.embed_variants', 'false'), ('Settings.guard', 'false'),
 ('Settings.hybrid', 'true'), ('Settings.k', '3'), ('Settings.keyword', 'true'), ('Settings.mmr', 'false'), ('Settings.mmr_fetch', '8'), ('Settings.mmr_weight', '0.5'), ('Settings.pool', '8'), ('Settings.reorder', 'true'), ('Settings.rerank', 'true'),
 ('Settings.tfidf', 'false'), ('Settings.threshold', '0.9'), ('Settings.validate', 'true'), ('Settings.vector', 'true'), ('Settings.where_document', 'true')) t(name, value),
 (SELECT count(*) AS n_questions FROM benchmark), (SELECT sum(n)::BIGINT AS n_documents, sha256(string_agg(h, '' ORDER BY lang)) AS corpus FROM (SELECT lang, count(*) AS n, lang || ':' || count(*) || ':' || sum(length(text)) AS h FROM documents GROUP BY lang))""")
def runtime_config(spark, d):
    """The settings of a run with what it ran on: its questions, its documents, and a digest of their number and length by language."""
    by_lang = corpus(spark, d).groupBy("lang").agg(F.concat_ws(":", "lang", F.count("*").cast("string"), F.sum(F.length("content")).cast("string")).alias("h"), F.count("*").alias("n"))
    ran = by_lang.agg(F.sum("n").alias("n_documents"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lang", "h"))), lambda x: x["h"]), ""), 256).alias("corpus"))
    ran = ran.crossJoin(F.broadcast(table(spark, d, "benchmark").agg(F.count("*").alias("n_questions"))))
    return evaluation.config_snapshot(spark, retrieve.Settings(), chunking.ChunkConfig()).crossJoin(F.broadcast(ran))


@query("SELECT doc_id AS case_id, CASE doc_id % 3 WHEN 0 THEN 'A' ELSE '' END AS business_grade, CASE doc_id % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS business_score, CASE doc_id % 3 WHEN 1 THEN 'shorten' ELSE '' END AS business_revision_notes FROM labels")
def business_grade(spark, d):
    n = F.col("doc_id") % 3
    said = F.when(n == 0, '{"business": {"grade": " A ", "score": 9}}').when(n == 1, '{"business": {"score": 2, "revision_notes": "shorten"}}').otherwise("{}")
    return evaluation.business(table(spark, d, "labels").select(F.col("doc_id").alias("case_id"), said.alias("judged")))


@query("""SELECT 'src' || (item_id % 3) AS source, 's' AS source_sheet, item_id AS source_row, 2 AS n_collections, trim(text) AS asked_a, 'b asks ' || item_id AS asked_b FROM benchmark""")
def question_sets(spark, d):
    """Question sets written a collection each, read back by their manifest and merged by case."""
    q = table(spark, d, "benchmark")
    cases = q.select(F.concat(F.lit("src"), (F.col("item_id") % 3).cast("string")).alias("source"), F.lit("s").alias("source_sheet"), F.col("item_id").alias("source_row"), F.col("text").alias("question"), F.create_map(F.lit("b b"), F.concat(F.lit("b asks "), F.col("item_id").cast("string"))).alias("questions"))
    place = f"{sync.work_dir(spark)}-sets"
    sinks.write_question_sets(cases, ["a", "b b"], place)
    tables.keep_until_exit(spark, place)
    read = sinks.read_question_sets(spark, place)
    return read.select("source", "source_sheet", "source_row", F.size("questions").alias("n_collections"), F.col("questions")["a"].alias("asked_a"), F.col("questions")["b b"].alias("asked_b"))


@query("SELECT DISTINCT source_key FROM (SELECT 'k' || (doc_id % 70) AS source_key FROM documents UNION ALL SELECT 'k' || (item_id + 50) FROM benchmark)")
def evaluation_keys(spark, d):
    key = lambda t, c: table(spark, d, t).select(F.concat(F.lit("k"), c.cast("string")).alias("source_key"))
    return ingest.evaluation_keys(key("documents", F.col("doc_id") % 70), key("benchmark", F.col("item_id") + 50))


@query("SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation UNION ALL SELECT r_regionkey, r_name, NULL FROM region")
def source_union(spark, d):
    """Sources with different columns as one table."""
    a = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return ingest.union_sources([a, table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))])


@query("""SELECT c_custkey AS row, concat_ws(chr(10), CASE WHEN c_custkey % 2 = 0 THEN 'c_name: ' || c_name END, 'c_mktsegment: ' || c_mktsegment) AS content FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, 'c_nationkey: ' || c_nationkey FROM customer WHERE c_custkey % 2 = 1""")
def columns_by_source(spark, d):
    """Row documents of two sources, each of the columns its collection's configuration names."""
    config = {"crm": {"a/even.csv": ["c_name", "c_mktsegment"], "odd": ["c_nationkey", " "]}}
    out = []
    for part, source in ((0, {"collection_code": "crm", "relative_path": "a\\even.csv"}), (1, {"collection_code": " crm", "relative_path": "b.csv", "label": "odd"})):
        rows = table(spark, d, "customer").filter(F.col("c_custkey") % 2 == part)
        chosen = ingest.source_columns(source, config, None, rows.columns)
        lines = [F.when(T.null_token(F.col(c)) != "", F.concat(F.lit(f"{c}: "), T.null_token(F.col(c)))) for c in chosen]
        out.append(rows.select(F.col("c_custkey").alias("row"), F.concat_ws("\n", *lines).alias("content")))
    return ingest.union_sources(out)


@query("SELECT doc_id, doc_id % 3 = 0 OR doc_id % 5 = 0 AS is_pdf, least(greatest(CASE WHEN doc_id % 4 = 0 THEN 1 ELSE doc_id END, 1), 256)::INTEGER AS batch, 2 * (doc_id % 2)::INTEGER AS n_nul, 'ab' AS cleaned FROM documents")
def small_rules(spark, d):
    """Whether a group is of page documents, a clamped batch size, and metadata without NUL characters."""
    n = F.col("doc_id")
    name = F.when(n % 5 == 0, " Report.PDF").otherwise("notes.txt")
    clean, count = T.strip_nul_map(F.create_map(F.lit("k"), F.when(n % 2 == 1, F.lit("a\x00b\x00")).otherwise("ab")))
    return table(spark, d, "documents").select("doc_id", ingest.block_kind(F.when(n % 3 == 0, "PDF"), name).alias("is_pdf"), T.clamped(F.when(n % 4 == 0, "many").otherwise(n.cast("string")), 1, 256).alias("batch"), count.alias("n_nul"), clean["k"].alias("cleaned"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE props END AS found FROM events""")
def json_in_text(spark, d):
    """The JSON of events' properties: alone, in the middle of what is said, and not there or broken."""
    m, props = F.col("event_id") % 4, F.col("props")
    said = F.when(m == 0, F.concat(F.lit(" "), props, F.lit("\n"))).when(m == 3, F.concat(F.lit("none {here "), "event_type")).otherwise(F.concat("event_type", F.lit(": "), props, F.lit(" so it is.")))
    return table(spark, d, "events").select("event_id", T.json_object_text(said).alias("found"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'g' END AS registration_group_id FROM customer""")
def tagged_sources(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    both = [readers.tagged(c.filter("c_custkey % 3 = 0"), None, " ", None), readers.tagged(c.filter("c_custkey % 3 <> 0"), "g", None, "")]
    return ingest.union_sources(both).filter("collection_code = 'DEFAULT' and duplicate_policy = 'update_changed'").select("c_custkey", "registration_group_id")


@query("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END, ''), source) AS identity FROM documents")
def source_identities(spark, d):
    n = F.col("doc_id") % 2
    return table(spark, d, "documents").select("doc_id", readers.source_identity(F.when(n == 0, F.col("lang")).otherwise(" "), F.col("source"), F.lit("f")).alias("identity"))


@query("SELECT doc_id, source, text AS content FROM documents WHERE doc_id % 3 <> 0")
def active_corpus(spark, d):
    """The active rows of a stored corpus."""
    return corpus(spark, d).withColumn("is_active", F.col("doc_id") % 3 != 0).filter("is_active").select("doc_id", "source", "content")


@query("SELECT conv_id, count(*) AS n_turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS history FROM conversations GROUP BY conv_id")
def chat_log_stream(spark, d):
    """The chat log as a stream that grows by a third of the conversations between runs, some of them given twice."""
    place = sync.work_dir(spark)
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    for k in range(3):
        part = turns.filter((F.col("conv_id") % 3 == k) | ((F.col("conv_id") % 3 == k - 1) & (F.col("turn") == 0)))
        part.write.mode("append").parquet(f"{place}/in")
        sync.chat_log(spark.readStream.schema(turns.schema).parquet(f"{place}/in"), f"{place}/log", f"{place}/checkpoint").awaitTermination()
    tables.keep_until_exit(spark, place)
    log = spark.read.schema(turns.schema).parquet(f"{place}/log")
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))))
    return log.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("history"))


@query("""WITH m AS (SELECT 'm' || (doc_id % 20) AS source_key, sum(length(text)) AS n FROM documents GROUP BY ALL) SELECT source_key, n, n > 0 AS found FROM m""")
def inserted_once(spark, d):
    """Rows added only where their key is missing."""
    c = corpus(spark, d).groupBy(F.concat(F.lit("m"), (F.col("doc_id") % 20).cast("string")).alias("source_key")).agg(F.sum(F.length("content")).alias("n"))
    half = c.filter("source_key < 'm15'")
    return versioning.insert_missing(half, c.unionByName(c), ["source_key"]).withColumn("found", F.col("n") > 0)


@query("SELECT source AS query_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank FROM documents")
def closed_ranks(spark, d):
    """Ranks without the gaps that others have left."""
    x = table(spark, d, "documents").select(F.col("source").alias("query_id"), "doc_id", (3 * F.col("doc_id")).alias("rank"))
    return fusion.closed_up(x).select("query_id", "doc_id", "rank")
