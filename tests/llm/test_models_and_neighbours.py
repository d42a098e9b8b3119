import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from corvane.llm import language_id, nearest, quality_model

SF = "/root/testdata/sf0.01"


def brute(rows, k):
    """{query: [(score, id)]} of the k largest inner products; rows (id, vector)."""
    ids = np.array([i for i, _ in rows])
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            score = np.array([np.dot(np.asarray(v, float), np.asarray(w, float)) if len(v) == len(w) else -np.inf for _, w in rows])
            keep = (ids != i) & np.isfinite(score)
            order = np.lexsort((ids[keep], -score[keep]))[:k]
            out[i] = list(zip(score[keep][order], ids[keep][order], strict=True))
    return out


def test_nearest_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 20)
    got = nearest.nearest(df, lambda c: c % 20 == 0).toPandas()
    assert set(got["query_id"]) == set(want)
    found = 0
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert rows["rank"].tolist() == list(range(1, 21)) and (np.diff(rows["score"]) <= 0).all()
        truth = {i: s for s, i in want[q]}
        found += len(set(rows["vec_id"]) & set(truth))
        assert all(math.isclose(s, truth[i], abs_tol=1e-12) for i, s in zip(rows["vec_id"], rows["score"], strict=True) if i in truth)
    assert found >= 0.95 * 20 * len(want)


def test_nearest_odd_rows(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=8).tolist()) for i in range(1, 61)]
    rows += [(100 + i, [1.0] * 8) for i in range(50)]  # one vector that many ids hold
    rows += [(200, None), (201, [0.0] * 8), (202, [math.nan] * 8), (203, [math.inf] * 8), (204, [1.0, None]), (None, [1.0] * 8), (220, [3.0, 4.0]), (221, [1.0, 1.0]), (240, []), (260, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = [(i, np.asarray(v, np.float32)) for i, v in rows if i is not None and v and not any(x is None or not math.isfinite(x) for x in v) and any(v)]
    want = brute(good, 20)
    got = {}
    for x in nearest.nearest(df, lambda c: c % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, round(x.score, 6)))
    assert got == {q: [(int(i), round(float(s), 6)) for s, i in v] for q, v in want.items() if v}
    assert got[120][0] == (100, 8.0) and len(got[120]) == 20 and got[220] == [(221, 7.0)] and 260 not in got
    assert nearest.nearest(df.limit(0), lambda c: c % 20 == 0).count() == 0


def test_graph_saves():
    v = np.random.default_rng(2).normal(size=(600, 16)).astype(np.float32)
    g = nearest.build(v)
    again = nearest.Graph.load(g.save())
    q = v[:20]
    assert (g.search(q, 40) == again.search(q, 40)).all()
    assert (g.search(q, 40)[:, 0] == np.arange(20)).mean() > 0.9


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def test_language_id(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = language_id.language_id(docs).collect()
    assert len(got) == len(truth) and all(r.held_out == (fold(r.doc_id) == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.98
    # held-out rows teach nothing
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert sorted(map(tuple, language_id.language_id(other).collect())) == sorted(map(tuple, got))
    odd = language_id.language_id(odd_docs).collect()
    assert len(odd) == 12 and {r.doc_id for r in odd if r.lang_pred == "und"} == {2, 3, 8, 9}
    assert language_id.language_id(no_docs).count() == 0
    blank = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_id(blank).collect()} == {"und"}


def buckets(text, bits):
    """Hashed 1- to 3-grams of a text, worked out a gram at a time with plain numbers."""
    x = []
    for k, c in enumerate(f" {text.lower()} "):
        if c.isalpha():
            x.append(ord(c))
        elif not k or x[-1] != 32:
            x.append(32)
    out = Counter()
    for n in range(1, max(language_id.ORDERS) + 1):
        if n in language_id.ORDERS:
            for i in range(len(x) - n + 1):
                h = 0
                for j in range(n):
                    # each step of the rolling hash adds its own number of characters so far
                    h = (h * 0x100000001B3 + x[i + j] + j + 1) % 2**64
                h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 % 2**64
                out[h >> 64 - bits] += 1
    return out


def test_language_id_against_plain_naive_bayes(spark):
    """Predictions and posteriors of a naive Bayes written out with dictionaries."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows, bits = docs.collect(), 10
    counts, n = {}, Counter()
    for r in rows:
        if fold(r.doc_id) != 2 and r.text is not None and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(buckets(r.text, bits))
            n[r.lang] += 1
    total = {k: sum(c.values()) + 0.5 * 2**bits for k, c in counts.items()}
    got = {r.doc_id: r for r in language_id.language_id(docs, bits=bits).collect()}
    for r in rows:
        text = r.text or ""
        if not any(c.isalpha() for c in text):
            assert got[r.doc_id].lang_pred == "und"
            continue
        own = buckets(text, bits)
        score = {k: math.log((n[k] + 1) / (sum(n.values()) + len(n))) + sum(m * math.log((c[b] + 0.5) / total[k]) for b, m in own.items()) for k, c in counts.items()}
        best = max(score, key=score.get)
        p = 1 / sum(math.exp(min(0.0, x - score[best])) for x in score.values())
        assert got[r.doc_id].lang_pred == best and abs(got[r.doc_id].score - p) < 1e-3


def test_grams_of_batches():
    """Documents scored together and alone have the same n-grams."""
    texts = ["Hello, world", "", "  ", "çé", "x", "a\x00b", "日本 語 𝒜"]
    together, has = language_id.grams(texts)
    assert has.tolist() == [True, False, False, True, True, True, True]
    for k, t in enumerate(texts):
        alone, _ = language_id.grams([t])
        for n, (bucket, row) in enumerate(together):
            want = sorted(alone[n][0].tolist()) if n < len(alone) else []
            assert sorted(bucket[row == k].tolist()) == want


def test_quality_model(spark, odd_docs, no_docs):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_model.quality_scores(docs, labels, most_rows=3000).collect()
    assert all(r.held_out == (fold(r.doc_id) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.97
    few = labels.limit(0)
    assert {round(r.score, 6) for r in quality_model.quality_scores(odd_docs, few).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (7, 1, 1), (7, 1, 0), (None, 1, 1), (3, None, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality_model.quality_scores(odd_docs.withColumnsRenamed({"pos": "y", "row": "l_id"}), some).count() == 12
    assert quality_model.quality_scores(no_docs, some).count() == 0


def test_machine_in_linear_time():
    """The sum-of-squares identity gives what the sum over pairs gives."""
    m = quality_model.Machine(50, 4, 1)
    m.w[:] = np.linspace(-1, 1, 50)
    index, x = np.array([3, 7, 20, 3, 4], np.int32), np.array([0.5, 1.0, -2.0, 1.0, 1.0], np.float32)
    raw, _, _ = m.raw(index, x, np.array([0, 3, 5]))
    for k, (a, b) in enumerate(((0, 3), (3, 5))):
        want = m.bias + sum(float(m.w[index[i]] * x[i]) for i in range(a, b))
        want += sum(float(m.v[index[i]] @ m.v[index[j]]) * float(x[i] * x[j]) for i in range(a, b) for j in range(i + 1, b))
        assert math.isclose(raw[k], want, abs_tol=1e-5)


def test_features_of_batches():
    texts = ["One two two", "", None, "x " * 3000, "é" * 100]
    index, x, bounds = next(quality_model.features(pa.array(texts), 10))
    assert len(bounds) == 6 and (np.diff(bounds) == [quality_model.N_STATS + n for n in (2, 0, 0, 1, 1)]).all()
    frame = pd.DataFrame({"i": index, "x": x})
    assert np.isfinite(frame["x"]).all()
