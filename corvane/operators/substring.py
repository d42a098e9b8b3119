"""Substring search by trigrams: places of a text with two trigrams of a pattern, as far apart as there, are compared with it.

Patterns are lower-case texts in which ``_`` stands for any character and everything else for itself. All patterns pass
over a text at once. Where postings are stored, only documents that hold all trigrams of the literal parts of some
pattern are passed over.
Patterns without three literal characters in a row have no trigram and are compared with every text. Null contents are
empty; a null or empty pattern finds nothing; repeated patterns count once; doc_ids are unique.

Documents that are read together are a block, in which they are turned into postings without a shuffle: a row a trigram of
the block, with its documents as bytes. The postings that are asked for meet by block. No text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..tables import materialize, scope
from .sizes import if_small, in_blocks
from .sparse import MOST_PATTERNS, _spread

#: Trigrams asked for up to which they are broadcast to the texts or postings.
MOST_ASKED = 1_000_000
#: Hash buckets of the stored postings.
BUCKETS = 16
#: Characters, unless one text has more, and texts of a block, about.
MOST_CHARS, MOST_TEXTS = 1 << 21, 1 << 16
#: Bits of a code point: a trigram is a number of three of them.
BITS = 21
#: Pairs of a trigram and a document that are held at a time.
MOST_CELLS = 1 << 26

#: Ids of candidates up to which they are broadcast to pick out texts; with more all texts are passed over.
MOST_IDS = 2_000_000
#: How far apart two trigrams of a pattern are at most.
REACH = 12

POSTINGS = "gram long, n long, block long, least long, docs binary"


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text, by code points."""
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    join = lambda a, b: F.concat(a, b)
    later = lambda k: F.slice(chars, k, F.greatest(F.size(chars), F.lit(1)))
    runs = F.zip_with(F.zip_with(chars, later(2), join), later(3), join)
    return F.array_distinct(F.filter(runs, lambda x: x.isNotNull()))


@F.pandas_udf(ArrayType(StringType()))
def text_trigrams(texts: pd.Series) -> pd.Series:
    """As trigrams, for whole texts: an array of all its code points is costly to fold in an expression."""
    return texts.map(lambda t: None if t is None else list(dict.fromkeys(map("".join, zip(t, t[1:], t[2:], strict=False)))))


def postings(docs: DataFrame) -> DataFrame:
    """POSTINGS of ``docs`` (doc_id, content), lower-cased: ``n`` documents of a block hold the trigram, ``docs`` are their ids less the block's least one."""
    return docs.select("doc_id", F.coalesce(F.lower("content"), F.lit("")).alias("content")).mapInArrow(_postings, POSTINGS)


def _number(gram: Column) -> Column:
    """A trigram as in POSTINGS."""
    points = [F.ascii(F.substring(gram, k, 1)).cast("long") for k in (1, 2, 3)]
    return reduce(lambda a, b: F.shiftleft(a, BITS) + b, points)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts of a block and their ids."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("content").to_pylist(), strict=True):
            if len(text) < 3:
                continue
            if ids and (held + len(text) > MOST_CHARS or len(ids) >= MOST_TEXTS):
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(text)
            held += len(text)
    if ids:
        yield ids, texts


def _distinct(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)
    return numbers[np.append(True, numbers[1:] != numbers[:-1])] if len(numbers) else numbers


def _pairs(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The distinct (trigram, place of its text) by trigram, of as many texts at a time as their numbers have room; with the place of the first one."""
    if len(texts) == 1 and len(texts[0]) > 2 * MOST_CHARS:  # in parts, which share two characters
        gram = np.zeros(0, np.int64)
        for at in range(0, len(texts[0]) - 2, MOST_CHARS):
            gram = _distinct(np.concatenate([gram, *[g for _, g, _ in _pairs([texts[0][at : at + MOST_CHARS + 2]])]]))
        yield 0, gram, np.zeros(len(gram), np.int64)
        return
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(1 << BITS, bool)
    seen[code] = True
    letters = np.flatnonzero(seen)
    width, last = int(len(letters) - 1).bit_length(), int(len(texts) - 1).bit_length()
    if 3 * width + last > 63:  # never so for one text
        half = len(texts) // 2
        yield from _pairs(texts[:half])
        yield from ((half + first, gram, place) for first, gram, place in _pairs(texts[half:]))
        return
    place = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    rank = (np.cumsum(seen) - 1)[code]
    key = (((rank[:-2] << width | rank[1:-1]) << width | rank[2:]) << last | place[2:])[place[2:] == place[:-2]]
    key = _distinct(key)
    gram, mask = key >> last, (1 << width) - 1
    yield 0, letters[gram >> 2 * width] << 2 * BITS | letters[gram >> width & mask] << BITS | letters[gram & mask], key & (1 << last) - 1


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for ids, texts in _together(batches):
        ids = np.array(ids, np.int64)
        for first, gram, place in _pairs(texts):
            doc = ids[first + place]
            least = doc.min()
            offset = doc.view(np.uint64) - least.view(np.uint64)
            offset = offset.astype(np.min_scalar_type(offset.max()))
            starts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
            ends = np.append(starts, len(gram))
            rows = len(starts)
            docs = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((ends * offset.itemsize).astype(np.int32)), pa.py_buffer(offset)])
            yield pa.RecordBatch.from_arrays([pa.array(gram[starts]), pa.array(np.diff(ends)), pa.array(np.full(rows, block)), pa.array(np.full(rows, least)), docs], names=["gram", "n", "block", "least", "docs"])
            block += 1


def store(docs: DataFrame, path: str) -> None:
    """Write the postings of ``docs`` to ``path``, a folder a bucket of trigrams and sorted by trigram in each of its files."""
    rows = postings(_spread(docs, "doc_id")[0]).withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int"))
    rows.sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _holding(asked: list[list[int]]):
    """What turns the postings of a block into (doc_id): documents that hold all of some trigrams of ``asked``."""
    number = np.array([len(grams) for grams in asked])
    wanted = np.array([g for grams in asked for g in grams], np.int64)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("gram").combine_chunks()
        gram, n = rows.column("gram").to_numpy(), rows.column("n").to_numpy()
        least = rows.column("least").to_numpy()[:1]
        docs = b"".join(rows.column("docs").to_pylist())
        offset = np.frombuffer(docs, f"u{len(docs) // int(n.sum())}")
        if offset.itemsize < 4:
            seen = np.zeros(int(offset.max()) + 1, bool)
            seen[offset] = True
            ids, place = np.flatnonzero(seen), (np.cumsum(seen) - 1)[offset]
        else:
            ids, place = np.unique(offset, return_inverse=True)
        at = np.minimum(np.searchsorted(gram, wanted), len(gram) - 1)
        own = np.repeat(np.arange(len(number)), number)
        whole = np.bincount(own, gram[at] == wanted, len(number)) == number
        at, firsts = at[whole[own]], np.cumsum(number[whole]) - number[whole]
        row = np.repeat(np.arange(len(gram)), n)
        kept = np.zeros(len(ids), bool)
        step = max(1, MOST_CELLS // max(len(gram), len(at)))
        for a in range(0, len(ids) if len(at) else 0, step):
            here = (place >= a) & (place < a + step)
            holds = np.zeros((len(gram), min(step, len(ids) - a)), bool)
            holds[row[here], place[here] - a] = True
            kept[a : a + step] = np.logical_and.reduceat(holds[at], firsts, axis=0).any(axis=0)
        return pa.table({"doc_id": (ids[kept].astype(np.uint64) + least.view(np.uint64)).view(np.int64)})

    return run


def _hashes(code: np.ndarray) -> np.ndarray:
    """A hash of the three characters from each place on."""
    code = code.astype(np.uint32)
    return code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA77) ^ code[2:] * np.uint32(0xC2B2AE3D)


def _both(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two of _hashes."""
    mixed = first * np.uint32(0x27D4EB2F) + second
    return (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D)


class _Machine:
    """Patterns with a trigram, found in many texts at once.

    A pattern is known by its first trigram and the last one within REACH of it, and how far apart these are. Places of a text where hashes of both
    agree are compared with the pattern itself.
    """

    def __init__(self, patterns: list[str]):
        self.patterns = patterns
        self.machines = [re.compile("".join("." if c == "_" else re.escape(c) for c in p), re.S) for p in patterns]
        self.first = []
        by_distance: dict[int, list[tuple[int, int]]] = {}
        for k, p in enumerate(patterns):
            at = [i for i in range(len(p) - 2) if "_" not in p[i : i + 3]]
            other = max(i for i in at if i <= at[0] + REACH)
            one, two = (_hashes(np.array([ord(c) for c in p[i : i + 3]])) for i in (at[0], other))
            self.first.append(at[0])
            by_distance.setdefault(other - at[0], []).append((int(_both(one, two)[0]), k))
        self.tables = []
        for distance, pairs in sorted(by_distance.items()):
            keys, own = np.array(sorted(pairs), np.int64).T
            bits = np.uint32(32 - max(16, (8 * len(pairs)).bit_length()))
            table = np.zeros(1 << 32 - int(bits), bool)
            table[keys.astype(np.uint32) >> bits] = True
            self.tables.append((distance, keys.astype(np.uint32), own, table, bits))

    def found(self, ids: list[int], texts: list[str]) -> Iterator[tuple[int, str]]:
        """The (id, pattern) of texts that hold a pattern."""
        ends = np.cumsum([len(t) for t in texts])
        whole = "".join(texts)
        got = set()
        for at in range(0, len(whole), MOST_CHARS):
            part = whole[at : at + MOST_CHARS + REACH + 2]
            hashes = _hashes(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32))
            for distance, keys, own, table, bits in self.tables:
                both = _both(hashes[: max(0, len(hashes) - distance)], hashes[distance:])
                place = np.flatnonzero(table[both >> bits])
                a, b = (np.searchsorted(keys, both[place], side) for side in ("left", "right"))
                some = a < b
                for p, lo, hi, k in zip((place[some] + at).tolist(), a[some].tolist(), b[some].tolist(), np.searchsorted(ends, place[some] + at, "right").tolist(), strict=True):
                    start = int(ends[k]) - len(texts[k])
                    for m in own[lo:hi].tolist():
                        if (k, m) not in got and (begin := p - start - self.first[m]) >= 0 and self.machines[m].match(texts[k], begin):
                            got.add((k, m))
        return ((ids[k], self.patterns[m]) for k, m in got)


def _passed(patterns: list[str]):
    """What turns batches of (doc_id, content) into (doc_id, pattern)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _Machine(patterns)
        for ids, texts in _together(batches):
            found = list(machine.found(ids, texts))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([p for _, p in found], pa.string())], names=["doc_id", "pattern"])

    return run


def _candidates(rows: DataFrame, asked: list[list[int]], grams: DataFrame) -> DataFrame:
    """(doc_id) of stored postings: documents with all trigrams of some pattern; repeated ones count once."""
    wanted = [r.b for r in grams.select(F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).alias("b")).distinct().collect()]
    hit = rows.filter(F.col("bucket").isin(wanted)).drop("bucket").join(if_small(grams, MOST_ASKED), "gram")
    return materialize(hit.groupBy("block").applyInArrow(_holding(asked), "doc_id long"), "candidates", result=True)


def matches(docs: DataFrame, patterns: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, pattern) of the ``docs`` (doc_id, content) whose lower-cased content holds a pattern of ``patterns`` (pattern).

    With ``path`` the postings stored there tell which texts are passed over, else all are. Patterns are taken
    in blocks of about MOST_PATTERNS, each with a pass of its own.
    """
    low = docs.select("doc_id", F.lower(F.coalesce("content", F.lit(""))).alias("content"))
    grams = F.array_distinct(F.flatten(F.transform(F.split("pattern", "_"), trigrams)))
    with scope():
        asked = materialize(patterns.filter("pattern <> ''").select("pattern").distinct().withColumn("grams", F.transform(grams, _number)), "asked", result=True)
    found = low.limit(0).select("doc_id", F.col("content").alias("pattern"))
    long = asked.filter(F.size("grams") > 0)
    blocks = -(-long.count() // MOST_PATTERNS)
    for b in range(blocks):
        own = long.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b)
        told, some = own.collect(), low
        if path is not None:
            with scope():
                rows = docs.sparkSession.read.schema(f"{POSTINGS}, bucket int").parquet(path)
                candidates = _candidates(rows, [r.grams for r in told], own.select(F.explode("grams").alias("gram")).distinct())
            if candidates.count() <= MOST_IDS:
                some = low.join(F.broadcast(candidates), "doc_id", "left_semi")
        if told:
            found = found.unionByName(some.mapInArrow(_passed([r.pattern for r in told]), "doc_id long, pattern string"))
    short = asked.filter(F.size("grams") == 0).select("pattern")
    exact = F.expr(r"content like concat('%', replace(replace(pattern, '\\', '\\\\'), '%', '\\%'), '%')")
    for block in [] if short.isEmpty() else in_blocks(short, "pattern"):
        found = found.unionByName(low.join(block, exact).select("doc_id", "pattern"))
    return found
