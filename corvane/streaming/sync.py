"""Incremental sync as a stream, and windows over events."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.window import Window

from ..session import shared_dir

#: What the stream appends: one row for each version that begins.
BEGUN = "collection_code string, source_key string, version long, source_hash string, valid_from long"
#: Hash buckets of sources; those of one are handled together. A checkpoint goes on with the number that it began with.
BUCKETS = 1024
#: Sources of a bucket that arrive at once up to which each is looked up by itself, and how many are read together for one of more.
FEW, PASSED = 16, 8
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SourceVersions(StatefulProcessor):
    """The newest version of each source of a bucket, a row of state each; a source's arrivals (source_hash, seq) are judged one after another.

    A hash that is the newest already begins nothing, except under the policy ``force``: then the version begins anew.
    Every call to the state waits for the JVM: where more than FEW sources of a bucket arrive up to PASSED times as many
    are read together, in a few calls, the others source by source; a source is written where it has changed.
    """

    def __init__(self, policy: str):
        self.policy = policy

    def init(self, handle) -> None:
        self.newest = handle.getMapState("newest", "collection_code string, source_key string", "version long, source_hash string")

    def _read(self, sources) -> dict[tuple, tuple]:
        found = {}
        if len(sources) > FEW:
            for passed, (source, value) in enumerate(self.newest.iterator(), 1):
                if source in sources:
                    found[source] = value
                if len(found) == len(sources) or passed == PASSED * len(sources):
                    break
            else:
                return found
        for source in sources.keys() - found.keys():
            if (value := self.newest.getValue(source)) is not None:
                found[source] = tuple(value)
        return found

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived: dict[tuple, list] = {}
        for f in rows:
            for *source, source_hash, seq in zip(*[f[c].tolist() for c in ("collection_code", "source_key", "source_hash", "seq")], strict=True):
                arrived.setdefault(tuple(source), []).append((seq, source_hash))
        newest, begun = self._read(arrived), []
        for source, pairs in arrived.items():
            before = version, last = newest.get(source, (0, None))
            for seq, source_hash in sorted(pairs, key=lambda p: p[0]):
                same = version > 0 and source_hash == last
                if same and self.policy != "force":
                    continue
                version, last = version + (not same), source_hash
                begun.append((*source, version, source_hash, seq))
            if (version, last) != before:
                self.newest.updateValue(source, (version, last))
        if begun:
            yield pd.DataFrame(begun, columns=[c.split()[0] for c in BEGUN.split(", ")])

    def close(self) -> None:
        pass


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Keyed state of streams that start inside is kept by the provider that their processors need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def sync_stream(arrivals: DataFrame, path: str, checkpoint: str, policy: str = "update_changed"):
    """Append the versions that a stream of (collection_code, source_key, source_hash, seq) begins to the table at ``path``.

    State is one row a source, in the stream's own store: a batch writes that of its arrivals alone and reads at most
    PASSED times as many; the file sink counts each batch once. versions() gives the state of all sources.
    """
    with rocks_state(arrivals.sparkSession):
        bucket = F.pmod(F.xxhash64("collection_code", "source_key"), F.lit(BUCKETS)).cast("int")
        begun = arrivals.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(SourceVersions(policy), BEGUN, "Append", "None")
        return begun.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def versions(begun: DataFrame) -> DataFrame:
    """One row a version of what sync_stream() wrote: when it began, when another followed (null while it is active)."""
    after = F.lead("valid_from").over(Window.partitionBy("collection_code", "source_key").orderBy("valid_from", "version"))
    out = begun.withColumn("superseded_at", after)
    return out.select("collection_code", "source_key", "version", "source_hash", "valid_from", "superseded_at", F.col("superseded_at").isNull().alias("is_active"))


def chat_log(turns: DataFrame, path: str, checkpoint: str):
    """Append a stream of (conv_id, turn, role, text) to a table; a turn that comes again changes nothing.

    The stream's own store holds the keys of all turns, so a batch asks it about its arrivals and reads no earlier output.
    """
    with rocks_state(turns.sparkSession):
        fresh = turns.dropDuplicates(["conv_id", "turn"])
        return fresh.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Progress(StreamingQueryListener):
    """Rows and seconds of every batch of the streams of a session, and the mean rate so far."""

    def __init__(self):
        self.batches: list[tuple[int, int, float]] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.append((p.batchId, p.numInputRows, p.batchDuration / 1000))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def rate(self) -> float:
        seconds = sum(s for _, _, s in self.batches)
        return sum(n for _, n, _ in self.batches) / seconds if seconds else 0.0


def synced(spark: SparkSession, path: str) -> DataFrame:
    """All versions of the table at ``path``."""
    return versions(spark.read.schema(BEGUN).parquet(path))


def work_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sync-{uuid.uuid4().hex}"


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value by type and window; works on streams and tables alike."""
    kept = events.withWatermark("ts", late) if events.isStreaming else events
    return kept.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    kept = events.withWatermark("ts", late) if events.isStreaming else events
    return kept.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
