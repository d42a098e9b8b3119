"""Registered queries of indexes that are kept between runs, and of chunks by a model's tokens."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import tables
from ..operators import chunking, commits, lexical, substring, token_windows, vector_index
from ..session import shared_dir
from .queries import _BM25, _DIST, _TOK, corpus, query, questions, vector_questions, vectors


def _updated_index(spark, d) -> str:
    """An index of an earlier corpus, in which some documents lack, some read otherwise and some are too many, brought up to the present one."""
    place = f"{shared_dir(spark)}/lexical-{uuid.uuid4().hex}"
    tables.keep_until_exit(spark, place)
    docs = corpus(spark, d).select("doc_id", "content")
    other = F.when(F.col("doc_id") % 7 == 0, F.concat("content", F.lit(" words of an earlier version"))).otherwise(F.col("content"))
    before = docs.filter("doc_id % 3 <> 0").select("doc_id", other.alias("content"))
    before = before.unionByName(docs.filter("doc_id % 50 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), "content"))
    lexical.update(before, place, complete=True)
    lexical.update(docs, place, complete=True)
    return place


@query(f"WITH {_BM25} SELECT * FROM bm25")
def bm25_stored_index(spark, d):
    """BM25 from a stored index after an incremental change: the rows of bm25_topk."""
    return lexical.bm25_search(questions(spark, d), _updated_index(spark, d))


@query(f"SELECT token, doc_id, count(*) AS tf, dl FROM (SELECT doc_id, len(ts) AS dl, unnest(ts) AS token FROM (SELECT doc_id, {_TOK.format('text')} AS ts FROM documents)) GROUP BY ALL")
def stored_postings(spark, d):
    """All live postings of the same index."""
    return lexical.postings(spark, _updated_index(spark, d)).select("token", "doc_id", "tf", "dl")


def _vector_index(spark, d) -> tuple[str, int]:
    place = f"{shared_dir(spark)}/vectors-{uuid.uuid4().hex}"
    tables.keep_until_exit(spark, place)
    return place, vector_index.build(vectors(spark, d), place)


@query(f"WITH {_DIST} SELECT query_id, doc_id, distance, rank FROM vec")
def vector_index_all_cells(spark, d):
    """The stored vector index with every cell open: the rows of vector_topk."""
    place, cells = _vector_index(spark, d)
    return vector_index.search(vector_questions(spark, d), place, probes=cells)


@query(None)
def vector_index_topk(spark, d):
    """The stored vector index with a few cells a question; tests hold its recall against the exact search."""
    return vector_index.search(vector_questions(spark, d), _vector_index(spark, d)[0])


@query(None)
def chunk_model_tokens(spark, d):
    """Every document in windows of 256 tokens of a public vocabulary; tests hold them against the library."""
    import public_tokenizers

    return token_windows.chunk_model_tokens(corpus(spark, d).select("doc_id", "content"), public_tokenizers.path("byte_bpe_50k.json"))


@query(r"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ts FROM documents),
s AS (SELECT doc_id, ts, unnest(range(0, greatest(ceil((len(ts) - 50) / 150.0)::BIGINT, 1))) AS i FROM t WHERE len(ts) > 0)
SELECT doc_id::VARCHAR AS source_key, CASE WHEN doc_id % 3 <> 0 AND doc_id % 7 = 0 THEN 2 ELSE 1 END::BIGINT AS version, i AS chunk_index, array_to_string(ts[i * 150 + 1 : i * 150 + 200], ' ') AS chunk FROM s""")
def versions_with_chunks(spark, d):
    """The newest versions after two commits: an earlier corpus, in which some documents lack and some read otherwise, and the present one."""
    place = f"{shared_dir(spark)}/commits-{uuid.uuid4().hex}"
    tables.keep_until_exit(spark, place)
    docs = corpus(spark, d).select("doc_id", "content")
    other = F.when(F.col("doc_id") % 7 == 0, F.concat("content", F.lit(" words of an earlier version"))).otherwise(F.col("content"))
    for k, some in enumerate((docs.filter("doc_id % 3 <> 0").select("doc_id", other.alias("content")), docs)):
        sources = some.select(F.col("doc_id").cast("string").alias("source_key"), F.sha2("content", 256).alias("source_hash"))
        chunks = chunking.chunk_tokens(some).select(F.col("doc_id").cast("string").alias("source_key"), "chunk_index", "chunk")
        commits.commit(sources, chunks, place, k)
    now = commits.newest(commits.read(spark, place))
    return now.select("source_key", "version", F.explode("chunks").alias("c")).select("source_key", "version", "c.chunk_index", "c.chunk")


@query(r"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{8,}')) AS t FROM benchmark),
p AS (SELECT DISTINCT substr(t, 1, 4) || '_' || substr(t, 6) AS pattern FROM w)
SELECT pattern, doc_id FROM p JOIN documents ON lower(text) LIKE '%' || pattern || '%'""")
def substring_wildcards(spark, d):
    """Documents with a word of `benchmark` whose fifth letter may be any: candidates by stored trigrams, each compared with its text."""
    place = f"{shared_dir(spark)}/trigrams-{uuid.uuid4().hex}"
    tables.keep_until_exit(spark, place)
    docs = corpus(spark, d).select("doc_id", "content")
    substring.store(docs, place)
    words = spark.read.parquet(f"{d}/benchmark.parquet").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{8,}"), F.lit(0))).alias("t"))
    patterns = words.select(F.concat(F.substring("t", 1, 4), F.lit("_"), F.expr("substring(t, 6)")).alias("pattern")).distinct()
    return substring.matches(docs, patterns, place).select("pattern", "doc_id")
