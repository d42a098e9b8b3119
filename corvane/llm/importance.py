"""Target-distribution importance resampling: documents whose hashed word runs look like a target's are drawn more likely.

A vectorised byte-automaton finds the features. A table classifies and lower-cases the UTF-8 bytes of an Arrow
buffer, differences of the classes are the word boundaries, and the table-driven CRC of every word of a chunk
advances one byte a step at once; a run of n words goes on from the state of the run of n - 1. The few spans that are
much longer than the rest are finished by zlib from the states they have reached.

One pass counts buckets of all documents and of the target in the tasks (a vector a task, summed by bucket), the
next adds up each document's gains. Only the gains, one number a bucket, reach the driver and the workers. The draw
keeps the greatest sums of weight and a seeded Gumbel noise: a sample without replacement that a rerun repeats. Ranks
come from range partitions and their counts, so nothing is ordered in one task.

Defined results: null or empty text has no words, weight 0, and is drawn only if ``least_words`` is 0. A null doc_id
draws its noise from the empty id and ties last. Rows of one doc_id share their noise; each is weighed and ranked by
itself. An empty table or target gives the same formula with counts of 0. Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizes import numbered
from .common import byte_table, materialize, scope, text_chunks, word_spans

BUCKETS = 10_000
#: Most buckets: their gains are held by the driver and by each worker.
MOST_BUCKETS = 1 << 24
#: Spans still unfinished at which the steps of all spans at once end.
FEW = 8

_WORD, _LOW = byte_table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC states after data[start:end] of every span, one byte of all spans a step."""
    order = np.argsort(starts - ends, kind="stable")  # the longest first, so that the unfinished are a prefix
    at, size, c = starts[order], (ends - starts)[order], state[order]
    live = np.cumsum(np.bincount(size)[::-1])[::-1] if len(size) else np.zeros(1, np.int64)  # spans of at least k bytes
    k = 0
    while k + 1 < len(live) and (n := int(live[k + 1])) > FEW:
        head = c[:n]
        c[:n] = _CRC[(head ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ (head >> np.uint32(8))
        k += 1
    for i in range(int(live[k + 1]) if k + 1 < len(live) else 0):
        c[i] = zlib.crc32(data[at[i] + k : at[i] + size[i]], int(c[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(c)
    out[order] = c
    return out


def features(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS, most: int = 1) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each run length of 1 to ``most`` words: bucket and row of every run, in row order; and the words of each row."""
    mask = _WORD[_LOW[data]]
    starts, ends, first = word_spans(data, off, _WORD[_LOW])
    size = ends - starts
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    # words one after another, lower-cased, a space before each: a run is then a stretch of bytes
    new_ends = np.cumsum(size + 1)
    joined = np.full(int(new_ends[-1]) if len(size) else 0, 32, np.uint8)
    joined[np.flatnonzero(mask) + np.repeat(new_ends - ends, size)] = _LOW[data[mask]]
    out, state = [], np.full(len(size), 0xFFFFFFFF, np.uint32)
    begin, stop = new_ends - size, new_ends
    for n in range(1, most + 1):
        if len(size) < n:
            break
        if n > 1:  # from the state of the run before, over the space and the next word
            state, begin, stop = state[:-1], new_ends[n - 2 : -1], new_ends[n - 1 :]
        state = advance(state, joined, begin, stop)
        same = row[: len(state)] == row[n - 1 :]
        out.append((((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64)[same], row[: len(state)][same]))
    return out, np.diff(first)


def histogram(texts: DataFrame, buckets: int = BUCKETS, most: int = 1) -> np.ndarray:
    """Features of all ``texts`` (text) by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, off in text_chunks(batch["text"]):
                for bucket, _ in features(data, off, buckets, most)[0]:
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(at), "n": pa.array(total[at])})

    sums = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(all_docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share of the target over its share of all documents."""
    n = len(all_docs)
    up = (target + 1).astype(float) * float(all_docs.sum() + n)
    down = (all_docs + 1).astype(float) * float(target.sum() + n)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, most: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        for batch in batches:
            words, count, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for at, data, off in text_chunks(batch["text"]):
                found, n = features(data, off, len(gain), most)
                here = slice(at, at + len(n))
                words[here] = n
                for bucket, row in found:
                    ends = np.searchsorted(row, np.arange(len(n) + 1))
                    sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                    count[here] += np.diff(ends)
                    weight[here] += sums[ends[1:]] - sums[ends[:-1]]
            yield pa.record_batch({"doc_id": batch["doc_id"], "n_words": pa.array(words), "n_features": pa.array(count), "weight": pa.array(weight)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a seeded digest of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``; ``rank`` is null where a row is not drawn.

    ``percent`` of the rows with at least ``least_words`` words are drawn; ``target`` (text) sets the distribution.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be from 1 to {MOST_BUCKETS}")
    gain = gains(histogram(docs, buckets, most), histogram(target, buckets, most))
    with scope():
        rows = weighed(docs, gain, most).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        rows = materialize(rows, "weighed", result=True)
    may = rows.filter(F.col("n_words") >= least_words).drop("n_words")
    drawn = may.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), "n_features"]
    placed = numbered(may, order, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.filter(F.col("n_words") < least_words).drop("n_words").withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def sample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; ``settings`` as in resample(). doc_ids must be unique and not null."""
    chosen = resample(docs, target, **settings).filter("rank is not null").select("doc_id")
    return docs.join(chosen, "doc_id", "left_semi")
