"""Ingest new and changed documents as chunks, as files arrive.

    python jobs/ingest_stream.py SOURCE OUTPUT CHECKPOINT [--config jobs/ingest_stream.json]

SOURCE is a folder of Parquet files (doc_id, text, lang, source) that grows, or a pattern of folders and files. A file stream takes the files that its
checkpoint hasn't seen, all that are there now, and ends. A document that the output holds with the same text is left
out; one with another text becomes the next version. OUTPUT gets two tables, partitioned by batch and language:

* ``documents``: doc_id, source_key, content_hash, version, n_chunks;
* ``chunks``: doc_id, version, chunk_index, chunk, chunk_hash: windows of white-space tokens.

A batch that is run again reads the same files, compares with earlier batches only and overwrites its own partitions,
so it counts once. If one batch holds a document several times, its text with the greatest hash counts. Rows without a
doc_id are left out and logged; a null text is an empty document without chunks.
"""

from __future__ import annotations

import logging
import os
import sys

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corvane.functions.text import strip_nul
from corvane.operators import chunking, versioning
from corvane.tables import materialize, scope
from jobs import settings

LOG = logging.getLogger("ingest_stream")
DEFAULTS = {"size": 200, "overlap": 50, "files_per_batch": 1000}
DOCUMENTS = "doc_id long, source_key string, content_hash string, version long, n_chunks long, batch long, lang string"
CHUNKS = "doc_id long, version long, chunk_index long, chunk string, chunk_hash string, batch long, lang string"


def read(spark: SparkSession, output: str, name: str) -> DataFrame:
    """One of the output's tables; empty before the first batch."""
    schema = {"documents": DOCUMENTS, "chunks": CHUNKS}[name]
    try:
        return spark.read.schema(schema).parquet(f"{output}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _write(df: DataFrame, place: str, number: int) -> None:
    """A batch's partitions, in place of what an earlier try has left of them."""
    out = df.withColumn("batch", F.lit(number).cast("long"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "lang").parquet(place)


def take(batch: DataFrame, number: int, output: str, size: int, overlap: int) -> None:
    """Write what is new in one batch of documents."""
    spark = batch.sparkSession
    with scope():
        text = strip_nul(F.coalesce("text", F.lit("")))
        key = versioning.logical_source_key(F.coalesce("source", F.lit("")), F.lit("csv"), F.coalesce("lang", F.lit("")), F.col("doc_id"), F.lit(None))
        rows = batch.select("doc_id", "lang", key.alias("source_key"), text.alias("content")).withColumn("content_hash", F.sha2("content", 256))
        seen = Observation("seen")
        rows = rows.observe(seen, F.count("*").alias("rows"), F.count_if(F.col("doc_id").isNull()).alias("without_id"))
        # ids and hashes decide, then texts of what is new are taken: the state is read without any text
        known = read(spark, output, "documents").filter(F.col("batch") < number)
        known = known.groupBy("doc_id").agg(F.max_by(F.struct("version", "content_hash"), "version").alias("old"))
        arrived = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.max("content_hash").alias("content_hash"))
        new = arrived.join(known, "doc_id", "left").filter(~F.col("old.content_hash").eqNullSafe(F.col("content_hash")))
        new = materialize(new.select("doc_id", "content_hash", (F.coalesce("old.version", F.lit(0)) + 1).alias("version")), "ingest-new")
        taken = rows.join(new, ["doc_id", "content_hash"]).dropDuplicates(["doc_id"])
        taken = materialize(taken.select("doc_id", "lang", "source_key", "content_hash", "version", "content"), "ingest-taken")
        pieces = chunking.chunk_tokens(taken, size, overlap).join(taken.select("doc_id", "version", "lang"), "doc_id")
        wrote = Observation("wrote")
        pieces = pieces.withColumn("chunk_hash", F.sha2("chunk", 256)).select("doc_id", "version", "chunk_index", "chunk", "chunk_hash", "lang")
        _write(pieces.observe(wrote, F.count("*").alias("chunks")), f"{output}/chunks", number)
        n = read(spark, output, "chunks").filter(F.col("batch") == number).groupBy("doc_id").agg(F.count("*").alias("n_chunks"))
        docs = taken.select("doc_id", "source_key", "content_hash", "version", "lang").join(n, "doc_id", "left").withColumn("n_chunks", F.coalesce("n_chunks", F.lit(0)))
        kinds = Observation("kinds")
        _write(docs.observe(kinds, F.count_if(F.col("version") == 1).alias("new"), F.count_if(F.col("version") > 1).alias("changed")), f"{output}/documents", number)
        s, w, k = seen.get, wrote.get, kinds.get
        LOG.info("batch %d: read %d rows (%d without an id); wrote %d new and %d changed documents, %d chunks to %s", number, s["rows"], s["without_id"], k["new"], k["changed"], w["chunks"], output)


def run(spark: SparkSession, source: str, output: str, checkpoint: str, config: str | None = None) -> None:
    """Take all files of ``source`` that are new since the checkpoint, and return when they are written."""
    s = settings.read_settings(spark, config, DEFAULTS)
    LOG.info("reading what is new in %s", source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", s["files_per_batch"]).parquet(source)
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: take(batch, number, output, s["size"], s["overlap"]))
        .start()
    )
    query.awaitTermination()


if __name__ == "__main__":
    settings.main(run, ["source", "output", "checkpoint"], __doc__)
