"""What several corpus operators share: intermediate tables, Arrow helpers and a numpy word kernel.

Conventions that hold for every operator here:

* a null text counts as the empty text; a null doc_id is a row of its own: it is scored or measured as any
  other row and returned with a null doc_id, but never linked with another row;
* columns beside those an operator names are ignored, whatever they are called;
* repeated rows are returned as often as they are given.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import set_checkpoints, shared_dir
from ..tables import drop_path, keep_until_exit, materialize, scope

__all__ = ["arrow_rows", "byte_table", "checkpointed", "drop_path", "hash_word", "keep_until_exit", "materialize", "mix", "partitions", "scope", "shared_dir", "span_hashes", "text_buffers", "text_chunks", "word_spans"]


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python gets at most ``rows`` rows at once from what runs inside: for rows that hold much."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


# ------------------------------------------------------------------ arrow

def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def text_chunks(column: pa.Array, limit: int = 1 << 19):
    """Yield (first row, bytes, offsets) of consecutive rows of about ``limit`` bytes; a longer text is a chunk alone."""
    data, off = text_buffers(column)
    n, at = len(off) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        end = min(end, n)
        yield at, data[off[at] : off[end]], off[at : end + 1] - off[at]
        at = end


# ------------------------------------------------------------------ words

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                up, down = (np.full(size, np.uint64(x % (1 << 64))) for x in (_MULTIPLIER, _INVERSE))
                up[0] = down[0] = 1
                np.multiply.accumulate(up, out=up)
                np.multiply.accumulate(down, out=down)
            if n > 1 << 23:
                return up, down
            cls.up, cls.down = up, down
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def byte_table(is_word, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(word mask, byte map) of 256 entries; ``is_word`` is asked after lower-casing A-Z."""
    low = np.arange(256, dtype=np.uint8)
    if lower:
        low[65:91] += 32
    return np.array([is_word(int(b)) for b in low]), low


def word_spans(data: np.ndarray, off: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of word bytes, and the first word of each text (n + 1 entries).

    Separators are ASCII, so runs of bytes are runs of code points.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = mask[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = off[1:] - 1
    after[last[last >= 0]] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    up, down = _Powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(((low[data] if low is not None else data).astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_word(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as files in the shared folder with its partitions and their order kept."""
    set_checkpoints(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
