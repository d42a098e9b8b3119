"""Windows of a vocabulary's tokens, cut where tokens begin and mapped back to places in the text.

A text is tokenised once, with the code points each token stands for; a window ends at the last place within ``size``
tokens that splits no code point. A window's own text may be tokenised otherwise at its ends, as what stands before and
after it is gone: each is tokenised again, and one that has more than ``size`` tokens ends a place earlier. So every
window can be given to a model of that size, and windows cover the text in order, each but the last beginning at most
``overlap`` tokens before the one before it ends.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

#: Tokens that one code point may take, at most.
LEAST_SIZE = 8


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The tokenizer of a vocabulary file, one a Python worker; special strings in texts are ordinary text."""
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    return t


def windows(text: str | None, tokenizer, size: int, overlap: int) -> list[tuple[int, str, int]]:
    """(start, window, tokens) of the windows of one text; none of an empty one."""
    if not text:
        return []
    spans = tokenizer.encode(text, add_special_tokens=False).offsets
    # (token, place) where a token begins that shares no code point with the one before
    cuts = [(0, 0)] + [(k, spans[k][0]) for k in range(1, len(spans)) if spans[k - 1][1] <= spans[k][0]] + [(len(spans), len(text))]
    tokens = [token for token, _ in cuts]
    out, at, last = [], 0, 0
    while at < len(cuts) - 1:
        end = max(at + 1, bisect_right(tokens, tokens[at] + size) - 1)
        while True:
            window = text[cuts[at][1] : cuts[end][1]]
            n = len(tokenizer.encode_batch_fast([window], add_special_tokens=False)[0])  # without places
            if n <= size or end == at + 1:
                break
            end -= 1
        if end <= last:  # nothing that the window before hasn't
            at += 1
            continue
        out.append((cuts[at][1], window, n))
        last = end
        if end == len(cuts) - 1:
            break
        at = max(at + 1, bisect_left(tokens, tokens[end] - overlap))
    return out


def chunk_model_tokens(docs: DataFrame, vocabulary: str, size: int = 256, overlap: int = 32) -> DataFrame:
    """(doc_id, chunk_index, start_index, chunk, n_tokens) of every document (doc_id, content); the file ``vocabulary`` must exist on every executor."""
    if size < LEAST_SIZE or not 0 <= overlap < size:
        raise ValueError(f"size must be at least {LEAST_SIZE}, and overlap from 0 to below the size")

    spark = docs.sparkSession

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(vocabulary)
        for frame in frames:
            rows = [(d, i, *w) for d, t in zip(frame["doc_id"], frame["content"], strict=True) for i, w in enumerate(windows(t, tokenizer, size, overlap))]
            yield pd.DataFrame(rows, columns=["doc_id", "chunk_index", "start_index", "chunk", "n_tokens"])

    # tokenising costs far more than moving the texts, and a table of few row groups would be read by few tasks
    dealt = docs.select("doc_id", "content").repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), "doc_id")
    return dealt.mapInPandas(run, "doc_id long, chunk_index long, start_index long, chunk string, n_tokens long")
