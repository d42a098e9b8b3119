"""Source versions and their chunks in one commit: one table, written by one Spark job.

A row is a version with its chunks inside, so there is no moment at which a version is there without them. Each commit is
a partition of its own; a job that fails leaves none behind, and one that is run again overwrites its own. After the write
the commit is read back and its numbers of versions and chunks are compared with what was written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "source_key string, source_hash string, version long, chunks array<struct<chunk_index: long, chunk: string>>, commit long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all commits; none where nothing has been committed."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def newest(versions: DataFrame) -> DataFrame:
    """The newest version of each source."""
    return versions.groupBy("source_key").agg(F.max_by(F.struct("source_hash", "version", "chunks", "commit"), "version").alias("x")).select("source_key", "x.*")


def commit(sources: DataFrame, chunks: DataFrame, path: str, number: int) -> dict[str, int]:
    """Add the versions that ``sources`` (source_key, source_hash) begin, with their ``chunks`` (source_key, chunk_index, chunk), as commit ``number``.

    Sources whose newest earlier version has the same hash are left out. Returns the numbers of versions and chunks.
    """
    spark = sources.sparkSession
    old = read(spark, path).filter(F.col("commit") < number).groupBy("source_key").agg(F.max_by(F.struct("source_hash", "version"), "version").alias("old"))
    begun = sources.join(old, "source_key", "left").filter(F.col("old").isNull() | ~F.col("old.source_hash").eqNullSafe(F.col("source_hash")))
    begun = begun.select("source_key", "source_hash", (F.coalesce("old.version", F.lit(0)) + 1).alias("version"))
    pieces = chunks.groupBy("source_key").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk"))).alias("chunks"))
    rows = begun.join(pieces, "source_key", "left").withColumn("chunks", F.coalesce("chunks", F.array().cast("array<struct<chunk_index: long, chunk: string>>")))
    counts = lambda: (F.count("*").alias("versions"), F.coalesce(F.sum(F.size("chunks")), F.lit(0)).alias("chunks"))
    wrote = Observation("wrote")
    rows.observe(wrote, *counts()).write.mode("overwrite").parquet(f"{path}/commit={number}")
    there = spark.read.schema(SCHEMA).parquet(path).filter(F.col("commit") == number).agg(*counts()).first().asDict()
    if there != wrote.get:
        raise RuntimeError(f"commit {number} at {path} holds {there}, not {wrote.get}")
    return there
