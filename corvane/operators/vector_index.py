"""A vector index that is kept between runs: rows by the nearest of some centroids, a partition a cell.

Centroids are those of Spark's k-means over unit vectors, fitted on at most about ``SAMPLE`` rows (a documented bound);
every row with a vector is then assigned and written. A search compares each question with the centroids, scans the
``probes`` nearest cells and works out exact cosine distances there. With ``probes`` of all cells it is the exact search.
Vectors without length are in the index and have distance 1 to everything; rows without a vector are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import materialize, scope
from .dense import BLOCK, blocks_of, nearest_in_blocks, units

#: Rows that centroids are fitted on, about.
SAMPLE = 100_000
#: Most cells: centroids are broadcast and compared with every question.
MOST_CELLS = 16_384
ROWS = "doc_id long, vector array<double>, cell int"
CENTROIDS = "cell int, vector array<double>"


def build(vectors: DataFrame, path: str, cells: int | None = None, seed: int = 13) -> int:
    """Write the index of ``vectors`` (doc_id, vector) and return its number of cells: by default the root of the number of rows."""
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("vector").isNotNull()).select("doc_id", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
    n = rows.count()
    if not n:
        spark.createDataFrame([], CENTROIDS).write.mode("overwrite").parquet(f"{path}/centroids")
        spark.createDataFrame([], ROWS).write.mode("overwrite").parquet(f"{path}/rows")
        return 0
    cells = max(1, min(cells or round(n**0.5), MOST_CELLS, n))
    # a small file is read by few tasks, however long its rows take; a vector without length stays as it is
    wide = rows.repartition(blocks_of(n), "doc_id").withColumn("whole", array_to_vector("vector"))
    wide = Normalizer(inputCol="whole", outputCol="features").transform(wide)
    part = wide if n <= SAMPLE else wide.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * SAMPLE / n))
    model = KMeans(k=cells, seed=seed, maxIter=10, featuresCol="features", predictionCol="cell").fit(part.select("features"))
    centres = [(k, [float(x) for x in c]) for k, c in enumerate(model.clusterCenters())]
    spark.createDataFrame(centres, CENTROIDS).coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    # a range of (cell, doc_id) deals a crowded cell over several tasks and gives each task few cells
    dealt = model.transform(wide).select("doc_id", "vector", "cell").repartitionByRange("cell", "doc_id")
    dealt.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    return len(centres)


def search(queries: DataFrame, path: str, k: int = 12, probes: int | None = None) -> DataFrame:
    """(query_id, doc_id, distance, rank) of the ``k`` nearest by cosine among the rows of the cells nearest to each question (query_id, vector).

    By default three fifths of the cells are opened, which vectors without much structure need for a recall of 0.95;
    clustered ones need fewer.
    """
    spark = queries.sparkSession
    asked = queries.filter(F.col("vector").isNotNull()).select("query_id", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
    centres = spark.read.schema(CENTROIDS).parquet(f"{path}/centroids").orderBy("cell").collect()  # at most MOST_CELLS
    probes = probes or -(-3 * len(centres) // 5)
    with scope():
        chosen = materialize(_opened(asked, [r.cell for r in centres], [r.vector for r in centres], probes), "probes", result=True)
    open_cells = [r["cell"] for r in chosen.select(F.explode("cells").alias("cell")).distinct().collect()]  # at most MOST_CELLS numbers
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows").filter(F.col("cell").isin(open_cells))
    # cells are dealt into groups, and a crowded cell into parts, so that a group is a block whatever the cells are like
    sizes = materialize(rows.groupBy("cell").agg(F.count("*").alias("n")), "cell-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    groups = blocks_of(total)
    parts = sizes.select("cell", F.pmod(F.xxhash64("cell"), F.lit(groups)).cast("int").alias("_g"), F.ceil(F.col("n") / BLOCK).cast("int").alias("_parts"))
    here = rows.join(F.broadcast(parts), "cell").withColumn("_p", F.pmod(F.xxhash64("doc_id"), F.col("_parts")).cast("int"))
    deals = max(1, -(-chosen.count() // BLOCK))
    deal = F.pmod(F.xxhash64("query_id"), F.lit(deals)).cast("int").alias("_q")
    # of each question go those cells to a group that lie in it
    met = chosen.select("query_id", deal, F.explode("cells").alias("cell")).join(F.broadcast(parts), "cell")
    met = met.select("query_id", "_q", "cell", "_g", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_p"))
    met = met.groupBy("_q", "_g", "_p", "query_id").agg(F.collect_list("cell").alias("cells")).join(asked, "query_id")
    here = here.select("doc_id", "vector", "cell", F.col("_g").alias("_g"), "_p", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("_q"))
    found = nearest_in_blocks(met, here, ["_q", "_g", "_p"], k, max(1, groups * deals))
    return found.select("query_id", "doc_id", "distance", "rank")


def _opened(asked: DataFrame, cells: list[int], centres: list[list[float]], probes: int) -> DataFrame:
    """(query_id, cells): the ``probes`` cells nearest to each question (query_id, vector), ties to the smaller cell."""
    kinds = T.StructType([asked.schema["query_id"], T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, numbers = np.array(centres, float), np.array(cells, np.int32)
        for f in frames:
            for start in range(0, f.num_rows, 1024):
                own = f.slice(start, 1024)
                gap = np.tile((by * by).sum(axis=1), (own.num_rows, 1)) if len(by) else np.zeros((own.num_rows, 0))
                for size, (at, q) in units(own["vector"]).items():
                    if len(by) and size == by.shape[1]:
                        gap[at] -= 2 * q @ by.T  # squared distance less a term that is the same for all cells
                best = np.argsort(gap, axis=1, kind="stable")[:, :probes]
                ends = np.arange(own.num_rows + 1, dtype=np.int32) * best.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers[best].ravel()))
                yield pa.RecordBatch.from_arrays([own["query_id"], lists], names=["query_id", "cells"])

    return asked.mapInArrow(run, kinds)
