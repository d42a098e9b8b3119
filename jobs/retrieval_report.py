"""Search a corpus for a set of questions from its stored lexical index, and report how well that went.

    python jobs/retrieval_report.py DOCUMENTS QUESTIONS OUTPUT [--config jobs/retrieval_report.json]

DOCUMENTS is a Parquet table (doc_id, text, lang), QUESTIONS one of (item_id, text). OUTPUT gets

* ``index``: the lexical index, brought up to DOCUMENTS: only new and changed texts are tokenised again;
* ``results``: each question's documents with rank, BM25 score and whether they hold the question's text, partitioned by language;
* ``metrics``: recall, precision and reciprocal rank of each question; recall and rank are null where no document holds it.

Results and metrics are written anew by each run, so a rerun over the same tables gives the same.
"""

from __future__ import annotations

import logging
import os
import sys

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from corvane.operators import evaluation, lexical, sparse
from corvane.operators.sizes import if_small
from corvane.tables import materialize, scope
from jobs import settings

LOG = logging.getLogger("retrieval_report")
DEFAULTS = {"k": 12, "eval_k": 5, "buckets": lexical.BUCKETS}
RESULTS = "query_id long, doc_id long, rank long, score double, relevant boolean, lang string"
METRICS = "query_id long, recall double, precision double, mrr double"


def run(spark: SparkSession, documents: str, questions: str, output: str, config: str | None = None) -> None:
    """Update the index, search, and write results and metrics."""
    s = settings.read_settings(spark, config, DEFAULTS)
    docs = spark.read.parquet(documents).select("doc_id", F.coalesce("text", F.lit("")).alias("content"), "lang")
    asked = spark.read.parquet(questions).select(F.col("item_id").alias("query_id"), F.coalesce("text", F.lit("")).alias("query"))
    version = lexical.update(docs, f"{output}/index", complete=True, buckets=s["buckets"])
    part = lexical.segments(spark, f"{output}/index", version).orderBy(F.desc("segment")).first()
    LOG.info("read %s: index version %d, whose last segment took %d new, %d changed and %d gone documents", documents, version, part["n_new"], part["n_changed"], part["n_gone"])
    with scope():
        found = materialize(lexical.bm25_search(asked, f"{output}/index", s["k"], buckets=s["buckets"]), "found")
        patterns = asked.filter("query <> ''").select(F.col("query").alias("pattern"))
        holds = sparse.pattern_counts(docs.select("doc_id", "content", F.lit("").alias("heading")), patterns).select("doc_id", "pattern")
        truth = materialize(holds.join(asked, F.col("pattern") == F.col("query")).select("query_id", "doc_id"), "truth")
        marked = evaluation.ranked_hits(found, truth).withColumn("relevant", F.col("hit") == 1)
        results = if_small(marked, sparse.MOST_PATTERNS).join(docs.select("doc_id", "lang"), "doc_id").select("query_id", "doc_id", "rank", "score", "relevant", "lang")
        wrote = Observation("wrote")
        results.observe(wrote, F.count("*").alias("rows"), F.count_if(F.col("relevant")).alias("hits")).write.mode("overwrite").partitionBy("lang").parquet(f"{output}/results")
        measured = evaluation.runtime_metrics(found, truth, asked, s["eval_k"])
        means = Observation("means")
        measured.observe(means, F.count("*").alias("n"), F.avg("recall").alias("recall"), F.avg("mrr").alias("mrr")).write.mode("overwrite").parquet(f"{output}/metrics")
    w, m = wrote.get, means.get
    LOG.info("wrote %d results (%d relevant) of %d questions to %s: mean recall %s, mean reciprocal rank %s", w["rows"], w["hits"], m["n"], output, m["recall"], m["mrr"])


if __name__ == "__main__":
    settings.main(run, ["documents", "questions", "output"], __doc__)
