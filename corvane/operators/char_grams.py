"""Character n-grams of texts, counted where a text is read.

Texts come in lower case; words are what stands between ASCII white space. A gram is a run of ``LEAST`` to ``MOST``
characters of a word with a space on both its sides; a shorter word gives no run of more characters than it has. Grams are
known by 64-bit hashes of their characters. The words of a few hundred texts at a time are told apart, so that each is cut
into grams once, and the texts' counts are those of its words. What is held grows with the sizes below, or with one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LEAST, MOST = 2, 5
#: Bytes of texts that are counted together, about; grams of words that are added up at a time; counts held in a table.
MOST_BYTES, MOST_PLACES, MOST_CELLS = 800_000, 4_000_000, 400_000
#: Grams whose frequencies a task holds.
MOST_HELD = 2_000_000
_C, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

Counts = tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _mixed(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (h ^ (c * _C)) * _M
    return h ^ (h >> np.uint64(32))


def hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, hash) of every gram of ``words``."""
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    ends = np.cumsum(size)
    word = np.repeat(np.arange(len(size)), size)
    left = ends[word] - np.arange(len(word))  # characters of the word from here on
    inner = np.ones(len(word), bool)
    inner[ends - 1] = inner[ends - size] = False
    chars = np.full(len(word), ord(" "), np.uint64)
    chars[inner] = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
    at = np.arange(len(word))
    h = _mixed(np.full(len(word), _C), chars)
    words_, hashes = [], []
    for n in range(2, MOST + 1):
        kept = left[at] >= n
        at, h = at[kept], h[kept]
        h = _mixed(h, chars[at + n - 1])
        if n >= LEAST:
            words_.append(word[at])
            hashes.append(h)
    return np.concatenate(words_), np.concatenate(hashes).view(np.int64)


def counted(texts: pa.Array) -> Iterator[Counts]:
    """(some, row, gram, times, grams) of some texts at a time: ``gram`` is a place in ``grams``, ``row`` one in ``some``, ascending."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + MOST_BYTES, "right")))
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.slice(a, b - a), ""))
        words = pc.list_flatten(lists)
        own = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty one
        row = np.repeat(np.arange(b - a), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        yield slice(a, b), *_counts(words.filter(pa.array(own)), row[own], b - a)
        a = b


def _counts(words: pa.Array, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, np.zeros(0), none
    words = words.dictionary_encode()
    width = len(words.dictionary)
    key, times = np.unique(row * width + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
    row, word = key // width, key % width
    of, grams = hashed(words.dictionary)
    grams = pa.array(grams).dictionary_encode()  # by a hash table, where np.unique sorts
    gram = grams.indices.to_numpy()[np.argsort(of, kind="stable")]
    grams = grams.dictionary.to_numpy()
    per = np.bincount(of, minlength=width)
    first, per = (np.cumsum(per) - per)[word], per[word]
    ends = np.cumsum(per)
    width = len(grams)

    def places(p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
        some = per[p:q]
        at = np.repeat(first[p:q] - (np.cumsum(some) - some), some) + np.arange(int(some.sum()))
        return np.repeat(row[p:q] * width, some) + gram[at], np.repeat(times[p:q], some)

    if n * width > 16 * ends[-1]:  # too few of the counts in a table would be used
        key, times = places(0, len(row))
        order = np.argsort(key)
        key, times = key[order], times[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key, times = key[starts], np.add.reduceat(times, starts)
        return key // width, key % width, times, grams
    step = max(1, MOST_CELLS // width)
    found, held = [], []
    for r in range(0, n, step):
        p, last = (int(x) for x in np.searchsorted(row, [r, r + step]))
        table = np.zeros(min(step, n - r) * width)
        while p < last:
            q = min(last, max(p + 1, int(np.searchsorted(ends, (ends[p - 1] if p else 0) + MOST_PLACES, "right"))))
            key, t = places(p, q)
            table += np.bincount(key - r * width, t, len(table))
            p = q
        own = np.flatnonzero(table != 0)
        found.append(own + r * width)
        held.append(table[own])
    key = np.concatenate(found)
    return key // width, key % width, np.concatenate(held), grams


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, df) of rows (text): the texts that hold a gram, added up over as much of a task as MOST_HELD allows."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        g, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return g, np.bincount(at, np.concatenate([p[1] for p in parts]), len(g))

    def rows(g: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(g), pa.array(df.astype(np.int64))], names=["g", "df"])

    for batch in batches:
        for _, _, gram, _, grams in counted(batch.column("text")):
            parts.append((grams, np.bincount(gram, minlength=len(grams))))
            if sum(len(p[0]) for p in parts) > MOST_HELD:
                parts = [merged()]
                if len(parts[0][0]) > MOST_HELD // 2:
                    yield rows(*parts.pop())
    if parts:
        yield rows(*merged())


def posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, g, tf) of rows (key, text)."""
    for batch in batches:
        for some, row, gram, times, grams in counted(batch.column("text")):
            key = batch.column("key").take(pa.array(row + some.start))
            yield pa.RecordBatch.from_arrays([key, pa.array(grams[gram]), pa.array(times.astype(np.int64))], names=["key", "g", "tf"])
