"""Model providers: any callable from a batch of texts to vectors, scores or answers, with a fallback, retries and batches.

Without models, vectors are hashed features: deterministic, and the same on every executor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Parts of messages that mean a provider is out of reach, so that the fallback answers.
UNAVAILABLE = (
    "project_spend_limit_exceeded", "insufficient_quota", "rate limit", "ratelimit", "429", "authentication",
    "invalid_api_key", "connection", "timeout", "temporarily unavailable", "service unavailable", "503", "502", "401", "403",
)


def is_unavailable(error: BaseException) -> bool:
    said = f"{type(error).__name__} {error}".lower()
    return any(x in said for x in UNAVAILABLE)


def with_fallback(first: Callable, second: Callable | None = None, retries: int = 3) -> Callable:
    """Calls ``first``, again on failure, then ``second`` if the provider is out of reach."""

    def call(*args):
        for k in range(retries):
            try:
                return first(*args)
            except Exception as e:
                if second is not None and is_unavailable(e):
                    return second(*args)
                if k + 1 == retries:
                    raise
        raise ValueError("no tries")

    return call


def hashed_vectors(texts: list[str], size: int = 64) -> list[list[float]]:
    """Unit vectors of signed word hashes."""
    out = np.zeros((len(texts), size))
    for k, t in enumerate(texts):
        for w in (t or "").lower().split():
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
            out[k, h % size] += 1 if h >> 63 else -1
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=out, where=norm > 0).astype(np.float32).tolist()


def embed(texts: Column, model: Callable[[list[str]], list[list[float]]] = hashed_vectors, batch: int = 16) -> Column:
    """Vectors of a text column; the model must return one for each text."""

    @pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out: list = []
            for a in range(0, len(s), batch):
                part = s.iloc[a : a + batch].fillna("").tolist()
                got = model(part)
                if len(got) != len(part):
                    raise ValueError(f"{len(got)} vectors for {len(part)} texts")
                out += got
            yield pd.Series(out)

    return run(texts)


def relevance(question: Column, content: Column, model: Callable[[list[tuple[str, str]]], list[float]] | None = None) -> Column:
    """Scores of (question, content) pairs; by default the share of the question's words in the content."""

    def shared(pairs):
        out = []
        for q, c in pairs:
            a, b = set((q or "").lower().split()), set((c or "").lower().split())
            out.append(len(a & b) / len(a) if a else 0.0)
        return out

    score = model or shared

    @pandas_udf("double")
    def run(q: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(score(list(zip(q, c, strict=True))), dtype="float64")

    return run(question, content)


def answer(prompt: Column, model: Callable[[str], str]) -> Column:
    """A chat model's answer to each prompt."""

    @pandas_udf("string")
    def run(p: pd.Series) -> pd.Series:
        return p.map(lambda x: None if x is None else model(x))

    return run(prompt)


def guarded_prompt(system: str, prompt: Column) -> Column:
    """A system text before a prompt that doesn't try to change it; null, hence no answer, for one that does."""
    from .text import is_injection

    return F.when(~F.coalesce(is_injection(prompt), F.lit(False)), F.concat(F.lit(system + "\n\n"), prompt))


def rated(question: Column, content: Column, model: Callable[[str], str], longest: int = 3000) -> Column:
    """A model's number for each (question, content) pair, from the first ``longest`` characters it is shown; 0 where it fails or gives none."""
    from .text import llm_score

    return llm_score(answer(F.concat_ws("\n", question, F.substring(content, 1, longest)), lambda p: quietly(model, p)))


def quietly(model: Callable[[str], str], prompt: str) -> str | None:
    """The model's answer, or none where it fails."""
    try:
        return model(prompt)
    except Exception:
        return None


def captured(prompt: Column, model: Callable[[str], str]) -> Column:
    """struct(said, error): the model's answer, or what went wrong; neither for a null prompt."""

    @pandas_udf("said string, error string")
    def run(p: pd.Series) -> pd.DataFrame:
        rows = []
        for x in p:
            try:
                rows.append((None if x is None else model(x), None))
            except Exception as e:
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["said", "error"])

    return run(prompt)
