"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; whatever is no letter becomes a space, and runs of spaces one. N-grams of one to three
characters are hashed into one table. Training counts buckets per language in the tasks and sums them; the matrix
of log-probabilities (buckets x languages, so bounded by a parameter and the labels in use) is broadcast, and a
batch is scored in numpy: sparse counts of n-grams are gathered from the matrix and summed per document.

Training takes at most about ``most_rows`` labelled rows, a seeded hash sample (a documented bound); scoring reads
every text whole.

Defined results: a text that is null or holds no letter is ``und`` with score 0. Ties go to the language first in
code-point order. Without any labelled row every text is ``und``. Repeated rows and null doc_ids are scored as any
other; a null doc_id is in no fold and so neither held out nor learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16
ORDERS = (1, 2, 3)
MOST_ROWS = 20_000
NONE = "und"


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


_letters: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    out = _letters[0][np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        out[high] = [chr(x).isalpha() for x in points[high].tolist()]
    return out


def grams(texts: list[str], bits: int = BITS) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order, bucket and row of every n-gram in row order; and for each row whether it has a letter."""
    low = [t.lower() for t in texts]
    # a space before and after each text; an n-gram may hold it, but not reach into another text
    points = np.frombuffer("".join(f" {t} " for t in low).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) + 2 for t in low])
    starts = np.cumsum(size) - size
    letter = _is_letter(points)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of others the first stays
    keep[starts] = True
    row = np.repeat(np.arange(len(texts)), size)
    has = np.bincount(row[letter], minlength=len(texts)) > 0
    x = np.where(letter, points, np.uint32(32))[keep].astype(np.uint64)
    row = row[keep]
    out = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(x), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if len(x) < n:
                break
            h = h[: len(x) - n + 1] * np.uint64(0x100000001B3) + (x[n - 1 :] + np.uint64(n))
            if n in ORDERS:
                same = row[: len(h)] == row[n - 1 :]
                z = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                out.append(((z >> np.uint64(64 - bits)).astype(np.int64)[same], row[: len(h)][same]))
    return out, has


def _chunks(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    at, part, size = 0, [], 0
    for k, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= limit:
            yield at, part
            at, part, size = k + 1, [], 0
    if part:
        yield at, part


def sampled(rows: DataFrame, most_rows: int, seed: int = 5) -> DataFrame:
    """About ``most_rows`` rows of ``rows`` by a seeded hash of doc_id; all, if there are fewer."""
    n = rows.count()
    if n <= most_rows:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * most_rows / n))


def train(docs: DataFrame, most_rows: int = MOST_ROWS, bits: int = BITS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log prior, matrix of log-probabilities) from rows that are not held out and have text and lang."""
    rows = docs.filter((fold(F.col("doc_id")) != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].to_pylist()
            for at, texts in _chunks(batch["text"].to_pylist()):
                found, _ = grams(texts, bits)
                names = sorted(set(langs[at : at + len(texts)]))
                code = np.array([names.index(x) for x in langs[at : at + len(texts)]])
                for bucket, row in found:
                    n = np.bincount(code[row] << bits | bucket, minlength=len(names) << bits).reshape(len(names), -1)
                    for k, name in enumerate(names):
                        total.setdefault(name, np.zeros((1 << bits) + 1, np.int64))[:-1] += n[k]
                for k, name in enumerate(names):
                    total[name][-1] += int((code == k).sum())
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(n[at])})

    sums = sampled(rows, most_rows).select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
    table = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table["lang"].to_pylist()))
    counts = np.zeros((len(names), (1 << bits) + 1))
    code = {x: k for k, x in enumerate(names)}
    counts[[code[x] for x in table["lang"].to_pylist()], table["bucket"].to_numpy()] = table["n"].to_numpy()
    prior = np.log((counts[:, -1] + 1) / (counts[:, -1].sum() + len(names))) if names else np.zeros(0)
    smooth = counts[:, :-1] + 0.5
    return names, prior, np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def language_id(docs: DataFrame, most_rows: int = MOST_ROWS, bits: int = BITS) -> DataFrame:
    """doc_id, held_out, lang_pred and the posterior of lang_pred for every row of ``docs``."""
    names, prior, matrix = train(docs, most_rows, bits)
    model = docs.sparkSession.sparkContext.broadcast((names, prior, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, matrix = model.value
        for batch in batches:
            pred, score = [], []
            for _, texts in _chunks(batch["text"].to_pylist()):
                if not names:
                    pred += [NONE] * len(texts)
                    score += [0.0] * len(texts)
                    continue
                found, has = grams(texts, bits)
                total = np.tile(prior, (len(texts), 1))
                for bucket, row in found:
                    if len(row):
                        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                        total[row[first]] += np.add.reduceat(matrix[bucket], first, axis=0, dtype=np.float64)
                best = total.argmax(axis=1)
                p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                pred += [names[b] if ok else NONE for b, ok in zip(best, has, strict=True)]
                score += np.where(has, p, 0.0).tolist()
            yield pa.record_batch({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())})

    held = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInArrow(run, SCHEMA)
