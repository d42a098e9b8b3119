"""Token counts of a piece vocabulary by heap-and-linked-list byte-pair merging.

A segment starts as one symbol a code point (a code point outside the vocabulary counts as its UTF-8 bytes).
The lowest-rank adjacent pair is popped from a heap and merged in a doubly linked list until no pair is in the
vocabulary; the count is the initial symbols minus the merges. No identifiers are made.

No piece holds a space mark after another character, nor a line feed (both are checked on loading), so merges
never cross either place: texts are cut there and a bounded cache holds the counts of segments.

Defined results: null or empty text has 0 tokens. Repeated rows and null doc_ids are counted as any other.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_buffers

MARK = "▁"
#: Cached segments per Python worker, and code points in them; beyond, the later half goes.
CACHE, CACHE_CHARS = 700_000, 8_000_000
#: Longer segments, such as lines of a script without spaces, are not cached.
LONGEST = 64


class PieceCounter:
    """Counts the tokens of texts for one sentencepiece BPE model with byte fallback."""

    def __init__(self, model_path: str, cache: int = CACHE):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        order = {s: k for k, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        if len(pieces) > 0xFFFF or any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in pieces):
            raise ValueError("pieces reach over word or line ends")
        self.ids = {p: k for k, p in enumerate(pieces)}
        self.pairs: dict[int, int] = {}
        for piece, score in pieces.items():
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    self.pairs[a << 16 | b] = order[score] << 48 | self.ids[piece]
        if model.encode("a  a", out_type=str) != model.encode(f"a{MARK}{MARK}a", out_type=str) or model.encode("Ａ")[-1:] == model.encode("A")[-1:]:
            raise ValueError("the model normalises texts")
        self.limit = cache
        self.chars = 0
        self.after_space: dict[str, int] = {}
        self.bare: dict[str, int] = {}

    def merged(self, segment: str) -> int:
        """Initial symbols minus merges of one segment."""
        of, n = self.pairs.get, len(segment)
        symbols = [self.ids.get(c, -1) for c in segment]
        count = n if -1 not in symbols else sum(1 if s >= 0 else len(c.encode()) for s, c in zip(symbols, segment, strict=True))
        # an entry holds, from the high bits down, rank, left position and the merged symbol
        heap = [m | i << 16 for i in range(n - 1) if (m := of(symbols[i] << 16 | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            entry = heapq.heappop(heap)
            i, new = entry >> 16 & 0xFFFFFFFF, entry & 0xFFFF
            j = right[i]
            if j >= n or (m := of(symbols[i] << 16 | symbols[j])) is None or m & 0xFFFF != new:
                continue  # one of the two has been merged meanwhile
            symbols[i], count = new, count - 1
            k = right[i] = right[j]
            right[j] = n
            if k < n:
                left[k] = i
                if (m := of(new << 16 | symbols[k])) is not None:
                    heapq.heappush(heap, m | i << 16)
            if (h := left[i]) >= 0 and (m := of(symbols[h] << 16 | new)) is not None:
                heapq.heappush(heap, m | h << 16)
        return count

    def _make_room(self) -> None:
        if len(self.after_space) + len(self.bare) > self.limit or self.chars > CACHE_CHARS:
            for cache in (self.after_space, self.bare):
                for w in list(islice(cache, len(cache) // 2, None)):  # what came first is mostly what comes often
                    del cache[w]
            self.chars = sum(map(len, self.after_space)) + sum(map(len, self.bare))

    def _learn(self, words: list[str], cache: dict[str, int], prefix: str) -> int:
        """Tokens of ``words``; those that are not too long are cached."""
        new = set(words).difference(cache)
        long = {w for w in new if len(w) > LONGEST}
        for w in new - long:
            cache[w] = self.merged(prefix + w)
            self.chars += len(w)
        if not long:
            return sum(map(cache.__getitem__, words))
        return sum(self.merged(prefix + w) if w in long else cache[w] for w in words)

    def _odd_line(self, line: str) -> int:
        """A line, its first mark included, in which marks or spaces stand in runs."""
        return sum(map(self.merged, re.findall(f"^[^{MARK}]+|{MARK}+[^{MARK}]*", line)))

    def count(self, text: str) -> int:
        if not text:
            return 0
        lines = text.split("\n")
        total, words, firsts = len(lines) - 1, [], []
        for k, line in enumerate(lines):
            if MARK in line or "  " in line or line[:1] == " " or line[-1:] == " ":
                total += self._odd_line((MARK if k == 0 else "") + line.replace(" ", MARK))
                continue
            parts = line.split(" ")
            if k:
                if parts[0]:
                    firsts.append(parts[0])
                del parts[0]
            elif parts == [""]:
                total += self.merged(MARK)
                continue
            words += parts
        try:
            return total + sum(map(self.after_space.__getitem__, words)) + sum(map(self.bare.__getitem__, firsts))
        except KeyError:
            self._make_room()
            return total + self._learn(words, self.after_space, MARK) + self._learn(firsts, self.bare, "")


@lru_cache(maxsize=1)
def counter_for(model_path: str) -> PieceCounter:
    """One counter a Python worker: its cache serves the tasks that follow."""
    return PieceCounter(model_path)


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``; ``model_path`` must exist on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(model_path)
        for batch in batches:
            _, off = text_buffers(batch["text"])
            n = [counter.count(t) for t in (x.as_py() for x in batch["text"])]
            yield pa.record_batch({
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "n_bytes": pa.array(off[1:] - off[:-1], pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "over_limit": pa.array([x > limit for x in n], pa.bool_()),
            })

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
