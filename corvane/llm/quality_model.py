"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its hashed words (square roots of their counts, of unit length together) and a few scaled
statistics of its structure and length. The score is a logistic function of a bias, linear weights and low-rank
pairwise interactions, the last in linear time as half the sum over factors of (sum of v x) ** 2 - sum of
(v x) ** 2.

Training takes at most about ``most_rows`` labelled rows, a seeded hash sample (a documented bound), whose sparse
features come to the driver: at most that many rows of at most ``2 ** bits`` entries each. Scoring reads every text
whole. Labels, lang, source and doc_id are never inputs of a score.

Defined results: null or empty text has no words and is scored by the statistics alone. Without labelled rows of
both kinds every score is the share of label 1, 0.5 without any. Where labels repeat a doc_id, each row counts; a
null doc_id joins no label and is in no fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, span_hashes, text_chunks, word_spans
from .language_id import fold, sampled

BITS = 14
RANK = 8
MOST_ROWS = 8_000
EPOCHS = 8
THRESHOLD = 0.7
SPACED, LOW = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))
N_STATS = 11


def _stats(data: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, distinct: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Scaled statistics of each text: a row of N_STATS values, most of them shares."""
    n_bytes, n_words = np.diff(off).astype(float), np.diff(first).astype(float)

    def counted(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[off[1:]] - sums[off[:-1]]

    upper = counted((data >= 65) & (data <= 90))
    symbols = counted(np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8)))
    marks = counted(np.isin(data, np.frombuffer(b"!?;:", np.uint8)))
    stops = counted(np.isin(data, np.frombuffer(b".,", np.uint8)))
    digits = counted((data >= 48) & (data <= 57))
    lines = counted(data == 10) + 1
    length = np.concatenate([[0], np.cumsum(ends - starts)])
    chars = (length[first[1:]] - length[first[:-1]]).astype(float)
    words = np.maximum(n_words, 1)
    body = np.maximum(chars, 1)
    return np.column_stack([
        np.log1p(n_bytes) / 10, np.log1p(lines) / 5, chars / words / 10, np.minimum(distinct / words, 1), np.sqrt(most / words),
        np.sqrt(upper / body), np.sqrt(symbols / body), np.sqrt(marks / body), np.sqrt(stops / body), np.sqrt(digits / body), n_words < 20,
    ]).astype(np.float32)


def features(column: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For consecutive rows: entries (index, value) of all rows one after another, and the bounds of each row's.

    Indices from 2 ** bits on are the statistics.
    """
    for _, data, off in text_chunks(column):
        n = len(off) - 1
        starts, ends, first = word_spans(data, off, SPACED)
        h = (span_hashes(data, starts, ends, LOW) >> np.uint64(64 - bits)).astype(np.int64)
        row = np.repeat(np.arange(n), np.diff(first))
        keys, counts = np.unique(row << bits | h, return_counts=True)
        at = keys >> bits
        value = np.sqrt(counts.astype(np.float32))
        norm = np.sqrt(np.bincount(at, counts, minlength=n))
        distinct, most = np.bincount(at, minlength=n), np.zeros(n)
        np.maximum.at(most, at, counts)
        stats = _stats(data, off, starts, ends, first, distinct, most)
        bounds = np.concatenate([[0], np.cumsum(distinct + N_STATS)])
        index, x = np.empty(bounds[-1], np.int32), np.empty(bounds[-1], np.float32)
        place = np.arange(len(keys)) + at * N_STATS
        index[place], x[place] = keys & ((1 << bits) - 1), value / norm[at]
        tail = (bounds[1:, None] - N_STATS + np.arange(N_STATS)).ravel()
        index[tail], x[tail] = np.tile((1 << bits) + np.arange(N_STATS), n), stats.ravel()
        yield index, x, bounds


class Machine:
    """Bias, linear weights and factors."""

    def __init__(self, size: int, rank: int, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.bias, self.w = 0.0, np.zeros(size, np.float32)
        self.v = rng.normal(0, 0.05, (size, rank)).astype(np.float32)

    def raw(self, index: np.ndarray, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the logistic function, the sums of v x, and v x of each entry. Every row has entries."""
        at = bounds[:-1]
        vx = self.v[index] * x[:, None]
        sums = np.add.reduceat(vx, at, axis=0)
        pairs = 0.5 * (sums**2 - np.add.reduceat(vx**2, at, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.w[index] * x, at) + pairs, sums, vx

    def scores(self, index, x, bounds) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(index, x, bounds)[0].astype(np.float64), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, rank: int = RANK, epochs: int = EPOCHS, seed: int = 9) -> Machine:
    """A machine fitted by Adam on mini-batches."""
    m, rng = Machine(size, rank, seed), np.random.Generator(np.random.PCG64(seed))
    share = labels.mean() if len(labels) else 0.5
    m.bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if len(labels) == 0 or share in (0, 1):
        m.v[:] = 0
        return m
    params = [m.w, m.v]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, rate, decay = 0, 0.02, 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), 128):
            part = [rows[i] for i in order[a : a + 128]]
            index, x = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part])
            bounds = np.concatenate([[0], np.cumsum([len(r[0]) for r in part])])
            raw, sums, vx = m.raw(index, x, bounds)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[order[a : a + 128]]).astype(np.float32) / len(part)
            e = np.repeat(error, np.diff(bounds))
            own = np.repeat(sums, np.diff(bounds), axis=0)
            by = np.argsort(index, kind="stable")
            keys = index[by]
            cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            used = keys[cut]
            grads = [np.add.reduceat((e * x)[by], cut), np.add.reduceat((e[:, None] * x[:, None] * (own - vx))[by], cut, axis=0)]
            step += 1
            m.bias -= rate * float(error.sum())
            for p, g, f, s in zip(params, grads, first, second, strict=True):
                g = g + decay * p[used]
                f[used] = 0.9 * f[used] + 0.1 * g
                s[used] = 0.99 * s[used] + 0.01 * g * g
                p[used] -= rate * (f[used] / (1 - 0.9**step)) / (np.sqrt(s[used] / (1 - 0.99**step)) + 1e-7)
    return m


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, bits: int = BITS, rank: int = RANK) -> Machine:
    marked = labels.filter(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 2)).select(F.col("doc_id").alias("l_id"), F.col("quality").cast("int").alias("y"))
    marked = sampled(marked.withColumnRenamed("l_id", "doc_id"), most_rows).withColumnRenamed("doc_id", "l_id")
    rows = docs.select("doc_id", "text").join(marked, F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, x = [], []
            for i, v, b in features(batch["text"], bits):
                index += [i[p:q].tobytes() for p, q in zip(b[:-1], b[1:], strict=True)]
                x += [v[p:q].tobytes() for p, q in zip(b[:-1], b[1:], strict=True)]
            yield pa.record_batch({"doc_id": batch["doc_id"].cast(pa.int64()), "y": batch["y"], "index": pa.array(index, pa.binary()), "x": pa.array(x, pa.binary())})

    table = rows.mapInArrow(run, "doc_id long, y int, index binary, x binary").toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    made = [(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32)) for i, x in zip(table["index"].to_pylist(), table["x"].to_pylist(), strict=True)]
    return fit(made, table["y"].to_numpy().astype(np.float32), (1 << bits) + N_STATS, rank)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most_rows: int = MOST_ROWS, bits: int = BITS, rank: int = RANK) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, learnt from ``labels`` (doc_id, quality)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, most_rows, bits, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0)]
            for index, x, bounds in features(batch["text"], bits):
                parts.append(model.value.scores(index, x, bounds))
            score = np.concatenate(parts)
            yield pa.record_batch({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))})

    held = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInArrow(run, SCHEMA)
