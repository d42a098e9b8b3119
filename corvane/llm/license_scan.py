"""License scan by a positional rare-token index.

Templates are word sequences with a label. Document frequencies of their words are counted over all documents. In a
file its licence words are taken rarest first: the places of a template's highest-IDF key word give the starts that the
template may have there, and the places of each next key word are intersected with them at their relative position,
until none is left or the whole mandatory key phrase stands. A short phrase (a base phrase) is its own key phrase. A
longer template may miss some of its other words, which are then looked up at their relative places: those that stand
there must hold ``LEAST_SHARE`` of the template's IDF.

Defined results: null or empty text has 0 words, no places, null first_word and last_word, empty labels and score
0. Repeated rows and null doc_ids are scanned as any other. Ties in IDF go to the earlier word of the template.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, hash_word, span_hashes, text_chunks, word_spans

#: Words: 0-9, a-z (after lower-casing A-Z) and every byte of a non-ASCII code point.
MASK, LOW = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: The mask on bytes before lower-casing.
MASK_RAW = MASK[LOW]

#: Base phrases and their labels. Fixed values.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: (label, words, mandatory key phrase) of longer templates, as their licences publish them. Fixed values.
LONGER = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "under the terms of the gnu lesser general public license"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "deal in the software without restriction"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products derived from this software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "any person or organization obtaining a copy"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("cc0", "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
)
#: Share of a longer template's words that must stand at their relative places.
LEAST_SHARE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key_at: int
    key_len: int
    base: bool


def templates(base=BASE, longer=LONGER) -> list[Template]:
    out = [Template(label, tuple(p.split()), 0, len(p.split()), True) for p, label in base]
    for label, words, key in longer:
        w, k = tuple(words.split()), tuple(key.split())
        at = next((i for i in range(len(w)) if w[i : i + len(k)] == k), None)
        if at is None:
            raise ValueError(f"the key phrase of {label} is not in its words")
        out.append(Template(label, w, at, len(k), False))
    return out


class Index:
    """Vocabulary of the templates, and per template its key words by document frequency."""

    def __init__(self, made: list[Template], df: dict[int, int] | None = None, n_docs: int = 0):
        self.templates = made
        words = sorted({w for t in made for w in t.words})
        self.ids = {w: k for k, w in enumerate(words)}
        hashes = np.array([hash_word(w) for w in words], np.uint64)
        self.order = np.argsort(hashes).astype(np.int16)
        self.hashes = hashes[self.order]
        self.idf = np.array([math.log((1 + n_docs) / (1 + (df or {}).get(k, 0))) + 1 for k in range(len(words))])
        self.codes = [np.array([self.ids[w] for w in t.words], np.int16) for t in made]
        # postings: per template the positions of its key phrase, the rarest word first
        self.postings = [t.key_at + np.argsort(-self.idf[c[t.key_at : t.key_at + t.key_len]], kind="stable") for t, c in zip(made, self.codes, strict=True)]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary id of each word, or -1."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, self.order[at], np.int16(-1))

    def matches(self, ids: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(template, document, start, share of matched idf) of every place where a template stands.

        ids: of all words; first: first word of each document, and the end.
        """
        hits = np.flatnonzero(ids >= 0)
        hits = hits[np.argsort(ids[hits], kind="stable")]
        bounds = np.searchsorted(ids[hits], np.arange(len(self.ids) + 1))
        for k, (t, codes) in enumerate(zip(self.templates, self.codes, strict=True)):
            start = None
            for j in self.postings[k]:
                there = hits[bounds[codes[j]] : bounds[codes[j] + 1]] - j
                start = there if start is None else start[np.isin(start, there, assume_unique=True)]
                if not len(start):
                    break
            if start is None or not len(start):
                continue
            d = np.searchsorted(first, start + t.key_at, side="right") - 1
            whole = start + t.key_at + t.key_len <= first[d + 1]
            start, d = start[whole], d[whole]
            p = start[:, None] + np.arange(len(codes))
            inside = (p >= first[d][:, None]) & (p < first[d + 1][:, None])
            same = inside & (ids[np.clip(p, 0, len(ids) - 1)] == codes)
            share = same @ self.idf[codes] / self.idf[codes].sum()
            ok = np.full(len(start), True) if t.base else share >= LEAST_SHARE
            if ok.any():
                yield k, d[ok], start[ok], share[ok]


def _words(data: np.ndarray, off: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(data, off, MASK_RAW)
    return index.lookup(span_hashes(data, starts, ends, LOW)), first


def document_frequencies(docs: DataFrame, made: list[Template]) -> tuple[dict[int, int], int]:
    """In how many rows each template word stands, and the number of rows: at most one row a word comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(made)
        df, n = np.zeros(len(index.ids), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, data, off in text_chunks(batch["text"]):
                ids, first = _words(data, off, index)
                hits = np.flatnonzero(ids >= 0)
                d = np.searchsorted(first, hits, side="right") - 1
                both = np.unique(d * len(df) + ids[hits])
                df += np.bincount(both % len(df), minlength=len(df))
        k = np.append(np.flatnonzero(df), -1)
        yield pa.record_batch({"word": pa.array(k.astype(np.int32)), "n": pa.array(np.append(df[k[:-1]], n))})

    rows = docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r.word: r.n for r in rows}
    return counts, counts.pop(-1, 0)


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def license_scan(docs: DataFrame, base=BASE, longer=LONGER) -> DataFrame:
    """One row for every row of ``docs``: words, places of base phrases, labels and the best matched share."""
    made = templates(base, longer)
    df, n_docs = document_frequencies(docs, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(made, df, n_docs)
        for batch in batches:
            size = batch.num_rows
            n_words, n_base = np.zeros(size, np.int64), np.zeros(size, np.int64)
            lo, hi = np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
            score = np.zeros(size)
            base_labels: dict[int, set] = {}
            labels: dict[int, set] = {}
            for row, data, off in text_chunks(batch["text"]):
                ids, first = _words(data, off, index)
                n_words[row : row + len(off) - 1] = np.diff(first)
                for k, d, start, share in index.matches(ids, first):
                    t = index.templates[k]
                    at = start - first[d]
                    d = d + row
                    np.maximum.at(score, d, share)
                    for x in set(d.tolist()):
                        labels.setdefault(x, set()).add(t.label)
                        if t.base:
                            base_labels.setdefault(x, set()).add(t.label)
                    if t.base:
                        np.add.at(n_base, d, 1)
                        np.minimum.at(lo, d, at)
                        np.maximum.at(hi, d, at)
            none = n_base == 0
            joined = lambda x: pa.array([",".join(sorted(x[i])) if i in x else "" for i in range(size)], pa.string())  # noqa: E731, B023
            yield pa.record_batch({
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "n_words": pa.array(n_words),
                "n_base": pa.array(n_base),
                "first_word": pa.array(lo, mask=none),
                "last_word": pa.array(hi, mask=none),
                "base_labels": joined(base_labels),
                "labels": joined(labels),
                "score": pa.array(np.minimum(score, 1.0)),
            })

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
