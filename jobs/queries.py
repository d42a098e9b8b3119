"""The jobs as registered queries: each runs twice into a new folder and returns its output, which both runs must leave the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corvane.plans.queries import _BM25
from corvane.session import shared_dir

from . import ingest_stream, retrieval_report


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = _place(spark, "job1")
    for _ in range(2):
        # a pattern, as the table may be one file or a folder, and streams take folders and patterns only
        ingest_stream.run(spark, f"{sf_dir}/documents.parque[t]", f"{place}/out", f"{place}/checkpoint")
    return ingest_stream.read(spark, f"{place}/out", "chunks").select("doc_id", "version", "chunk_index", "chunk", "chunk_hash", "lang")


def job2_retrieval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = _place(spark, "job2")
    for _ in range(2):
        retrieval_report.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/benchmark.parquet", place)
    results = spark.read.schema(retrieval_report.RESULTS).parquet(f"{place}/results")
    return results.join(spark.read.schema(retrieval_report.METRICS).parquet(f"{place}/metrics"), "query_id", "full_outer")


QUERIES = {f.__name__: f for f in (job1_ingest_stream, job2_retrieval_report)}

ORACLES = {
    "job1_ingest_stream": r"""WITH t AS (SELECT doc_id, lang, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> '') AS ts FROM documents),
s AS (SELECT doc_id, lang, ts, unnest(range(0, greatest(ceil((len(ts) - 50) / 150.0)::BIGINT, 1))) AS i FROM t WHERE len(ts) > 0),
c AS (SELECT doc_id, lang, i, array_to_string(ts[i * 150 + 1 : i * 150 + 200], ' ') AS chunk FROM s)
SELECT doc_id, 1::BIGINT AS version, i AS chunk_index, chunk, sha256(chunk) AS chunk_hash, lang FROM c""",
    "job2_retrieval_report": f"""WITH {_BM25},
truth AS (SELECT DISTINCT item_id AS query_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE b.text <> ''),
n AS (SELECT query_id, count(*) AS n FROM truth GROUP BY ALL),
h AS (SELECT query_id, count(*) AS hits, min(rank) AS first FROM bm25 JOIN truth USING (query_id, doc_id) WHERE rank < 5 GROUP BY ALL),
m AS (SELECT item_id AS query_id, CASE WHEN n > 0 THEN round(coalesce(hits, 0)::DOUBLE / n, 6) END AS recall, round(coalesce(hits, 0) / 5::DOUBLE, 6) AS precision,
  CASE WHEN n > 0 THEN round(coalesce(1.0::DOUBLE / (first + 1), 0), 6) END AS mrr FROM benchmark LEFT JOIN n ON n.query_id = item_id LEFT JOIN h ON h.query_id = item_id),
r AS (SELECT b.query_id, b.doc_id, b.rank, b.score, t.doc_id IS NOT NULL AS relevant, lang FROM bm25 b LEFT JOIN truth t ON t.query_id = b.query_id AND t.doc_id = b.doc_id JOIN documents d ON d.doc_id = b.doc_id)
SELECT query_id, doc_id, rank, score, relevant, lang, recall, precision, mrr FROM r FULL JOIN m USING (query_id)""",
}
