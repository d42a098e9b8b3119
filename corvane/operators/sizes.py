"""Broadcasts behind a check of their size, and row numbers without a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import set_checkpoints

#: Rows up to which a side is broadcast.
MOST_ROWS = 10_000


def if_small(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows; else as it is, for Spark to choose a join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def in_blocks(df: DataFrame, key: str, most: int = MOST_ROWS) -> list[DataFrame]:
    """``df`` as broadcastable blocks of about ``most`` rows, dealt by a hash of ``key``; an empty one is one block."""
    blocks = max(1, -(-df.count() // most))
    return [F.broadcast(df.filter(F.pmod(F.xxhash64(key), F.lit(blocks)) == b)) for b in range(blocks)]


def numbered(df: DataFrame, order: list[Column | str], name: str = "row", start: int = 1) -> DataFrame:
    """``df`` with global row numbers: range partitions, sorted, each numbered from the count of those before.

    The sorted rows are checkpointed, so that both passes see the same partitions; the driver gets one count a
    partition and deals the starts out as a broadcast table of as many rows.
    """
    spark = df.sparkSession
    set_checkpoints(spark)
    dealt = df.orderBy(*order).checkpoint()
    dealt = dealt.select("*", F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id() % (1 << 33)).alias("_nth"))
    starts, total = [], start
    for r in dealt.groupBy("_part").count().orderBy("_part").collect():
        starts.append((r["_part"], total))
        total += r["count"]
    first = spark.createDataFrame(starts, "_part int, _first long")
    return dealt.join(F.broadcast(first), "_part").withColumn(name, (F.col("_nth") + F.col("_first")).cast("long")).drop("_part", "_nth", "_first")
