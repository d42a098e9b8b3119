"""Best-fit packing of token sequences, after a Martello-Toth dominance reduction.

Only lengths matter to a packing, and they are at most the capacity: the instance is a histogram with one number
a length, whatever the number of documents. On it, dominance fixes small sets for good: a length with its exact
complement; a length beside which nothing fits; a length beside which only one more item fits, with the longest
that does; and, where at most two more fit, with the longest single item that is no shorter than any pair. The
rest is packed best fit, longest first, all items of one length at a time. The result is a list of patterns with
multiplicities, from which every length gets ranges of places. Its size depends on the capacity, not on the data.

Documents are tokenised once; each task numbers its pieces within their length, and a sum over (task, length)
counts makes these numbers global, so no length is gathered in one place, however frequent.

Defined results: null or empty text is the end id alone. Repeated rows are packed as often as they are given; a
null doc_id is packed as any other. An empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import json
import re
import sys
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

CAPACITY = 2048
END = 0
#: Cached words per Python worker, and code points in them; beyond, the later half goes.
CACHE, CACHE_CHARS = 400_000, 4_000_000
#: A longer word, such as a line of a script without spaces, is encoded each time it comes.
LONGEST = 64


# ------------------------------------------------------------------ tokens

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿĀ-ſ"
_SPACE = " \t\n\r\f\v"
#: Splits texts as the byte-level vocabularies do, for texts without characters outside the classes below.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^{_SPACE}{_LETTER}0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_OTHER = re.compile(r"[^\x00-\x7f¡¿«»À-ÖØ-öø-ÿ×÷Ā-ſ‐-‧]")


class ByteEncoder:
    """Little-endian 32-bit ids of whole texts; ids of words come from the library and are cached.

    Texts are split into words as the library splits them; words not seen before are given to it together, with its
    own splitting off. A text with other characters than those whose class is known here, or with an added token,
    is encoded whole by the library, and so is every text if the file asks for another splitting or normalising.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer, pre_tokenizers

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are written as native unsigned 32-bit numbers, which must be little-endian")
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        told = json.loads(self.library.to_str())
        split = told["pre_tokenizer"] or {}
        self.known = told["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        self.words_only = Tokenizer.from_file(path)
        self.words_only.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.limit, self.chars = cache, 0
        self.words: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            e = self.words_only.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = array("I", e.ids).tobytes()
            cuts = (4 * np.searchsorted(np.array(e.word_ids), np.arange(len(part) + 1))).tolist()
            self.words.update((w, ids[a:b]) for w, a, b in zip(part, cuts[:-1], cuts[1:], strict=True))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        split: list[tuple[int, list[str]]] = []
        for k, t in enumerate(texts):
            if not self.known or not t.isascii() and _OTHER.search(t) or any(a in t for a in self.added):
                out[k] = array("I", self.library.encode(t, add_special_tokens=False).ids).tobytes()
            elif t:
                split.append((k, _SPLIT.findall(t)))
        if len(self.words) > self.limit or self.chars > CACHE_CHARS:
            for w in list(islice(self.words, len(self.words) // 2, None)):  # what came first is mostly what comes often
                del self.words[w]
            self.chars = sum(map(len, self.words))
        new = list(set().union(*(w for _, w in split)).difference(self.words))
        self._learn(new)
        of = self.words.__getitem__
        for k, words in split:
            out[k] = b"".join(map(of, words))
        for w in new:
            if len(w) > LONGEST:
                del self.words[w]
            else:
                self.chars += len(w)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def encode_all(self, texts: Iterable[str], rows: int = 64, chars: int = 1 << 19) -> Iterator[bytes]:
        """``encode`` of each text, some of them at a time."""
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t)
            if len(part) >= rows or size >= chars:
                yield from self.encode_batch(part)
                part, size = [], 0
        yield from self.encode_batch(part)


@lru_cache(maxsize=1)
def encoder_for(path: str) -> ByteEncoder:
    """One encoder a Python worker: what it has learnt serves the tasks that follow."""
    return ByteEncoder(path)


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every row of ``docs``; ``nth`` numbers a task's pieces of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = encoder_for(path), TaskContext.get().partitionId(), Counter()
        end = np.asarray([END], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            texts = (t.as_py() or "" for t in batch["text"])
            for d, ids in zip(batch["doc_id"].to_pylist(), encoder.encode_all(texts), strict=True):
                ids += end
                n = len(ids) // 4
                start, length = 0, n % capacity or capacity
                for k in range(-(-n // capacity)):
                    out.append((d, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
                    start, length = start + length, capacity
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in PIECE_SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


# ------------------------------------------------------------------ packing of a histogram

Pattern = tuple[tuple[int, int], ...]


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Patterns that dominance fixes, and the lengths that remain."""
    left = {k: v for k, v in counts.items() if v > 0}
    fixed: list[tuple[Pattern, int]] = []

    def take(pattern: Counter, times: int) -> None:
        fixed.append((tuple(sorted(pattern.items(), reverse=True)), times))
        for length, k in pattern.items():
            left[length] -= k * times
            if not left[length]:
                del left[length]

    changed = True
    while changed:
        changed = False
        for long in sorted(left, reverse=True):
            while left.get(long):
                room = capacity - long
                rest = dict(left)
                rest[long] -= 1
                order = sorted(k for k, v in rest.items() if v > 0 and k <= room)
                if not order:
                    take(Counter([long]), left[long] if capacity < 2 * long else 1)
                elif rest.get(room, 0) > 0:
                    take(Counter([long, room]), left[long] // 2 if room == long else min(left[long], left[room]))
                else:
                    smallest = [k for k in order[:3] for _ in range(min(rest[k], 3))][:3]
                    best = order[-1]
                    if len(smallest) > 1 and sum(smallest[:2]) <= room:
                        if len(smallest) > 2 and sum(smallest) <= room:
                            break  # three more may fit: no small set is known to dominate
                        pair = max((a + b for i, a in enumerate(order) for b in (order[max(i, bisect.bisect_right(order, room - a) - 1)],) if a + b <= room and (a != b or rest[a] > 1)), default=0)
                        lone = max((2 * a for a in order if rest[a] > 1 and 2 * a <= room), default=0)
                        if best < max(pair, lone):
                            break
                    # one at a time near the end of either length, as what fits beside then changes
                    take(Counter([long, best]), 1 if best == long else min(left[long], left[best]))
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, all items of a length at once: patterns and how often each is used."""
    open_bins: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, times]
    rooms: list[int] = []

    def add(room: int, pattern: tuple, times: int) -> None:
        if room not in open_bins or not open_bins[room]:
            bisect.insort(rooms, room)
        open_bins[room].append([pattern, times])

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                k = capacity // length
                if n >= k:
                    add(capacity - k * length, ((length, k),), n // k)
                if n % k:
                    add(capacity - n % k * length, ((length, n % k),), 1)
                break
            room = rooms[at]
            pattern, times = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(at)
            k = min(room // length, n)
            used = min(times, n // k)
            n -= used * k
            if times > used:
                add(room, pattern, times - used)
            add(room - k * length, (*pattern, (length, k)), used)
    return [(p, t) for room in open_bins.values() for p, t in room]


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    fixed, left = reduced(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first number, first sequence, items a sequence, offset), by first number."""
    out: dict[int, list] = defaultdict(list)
    given: Counter = Counter()
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length, k in pattern:
            out[length].append((given[length], sequence, k, offset))
            given[length] += k * times
            offset += k * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def best_fit_packing(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``."""
    made = materialize(pieces(docs, path, capacity), "pieces")
    by_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    starts = by_task.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).drop("n")
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}
    known = docs.sparkSession.sparkContext.broadcast(places(pack(counts, capacity)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                table = known.value[int(length[rows[0]])]
                first, base, k, at = table[np.searchsorted(table[:, 0], number[rows], side="right") - 1].T
                sequence[rows] = base + (number[rows] - first) // k
                offset[rows] = at + (number[rows] - first) % k * length[rows]
            cols = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*cols, pa.array(sequence), pa.array(offset)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    wide = made.join(starts, ["length", "task"]).withColumn("number", F.col("before") + F.col("nth"))
    return wide.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(run, SCHEMA)
