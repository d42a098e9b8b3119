import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corvane.operators import block_scores, char_grams, sparse

TEXTS = ["Haha banana  haha a", "\u00d1\u00e9 \U0001f600x x", "", None, "solo" * 9, "a", " \u00a0\u2003y ", "\n haha zz\ta x\f\v ", "banana b" * 30]


def grams(text):
    out = Counter()
    for w in filter(None, re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower())):
        w = f" {w} "
        out.update(w[i : i + n] for n in range(2, 6) for i in range(len(w) - n + 1))
    return out


@pytest.mark.parametrize("size, cells", [(1, 1), (5, 300), (100_000, 400_000)])
def test_counts(monkeypatch, size, cells):
    """Every text's grams with their numbers, however many texts, grams or counts are taken at a time."""
    monkeypatch.setattr(char_grams, "MOST_BYTES", size)
    monkeypatch.setattr(char_grams, "MOST_CELLS", cells)
    monkeypatch.setattr(char_grams, "MOST_PLACES", 40 * cells)
    monkeypatch.setattr(char_grams, "MOST_HELD", 50 * size)
    r = np.random.default_rng(3)
    texts = TEXTS + [" ".join("".join(chr(97 + c) for c in r.integers(0, 26, 30)) for _ in range(3)) for _ in range(40)]
    column = pa.array([None if t is None else t.lower() for t in texts], pa.string())
    got = [Counter() for _ in texts]
    for own, row, gram, times, known in char_grams.counted(column):
        assert (np.diff(row) >= 0).all()
        for i, g, t in zip(row.tolist(), known[gram].tolist(), times.tolist(), strict=True):
            assert g not in got[own.start + i]
            got[own.start + i][g] = int(t)
    names: dict = {}
    for text, counts in zip(texts, got, strict=True):
        want = grams(text)
        assert sorted(want.values()) == sorted(counts.values())
        for w in filter(None, re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower())):  # a word's grams have the same hashes in every text
            of, hashes = char_grams.hashed(pa.array([w]))
            padded = f" {w} "
            for g, h in zip((padded[i : i + n] for n in range(2, 6) for i in range(len(padded) - n + 1)), hashes.tolist(), strict=True):
                assert names.setdefault(g, h) == h and counts[h] == want[g]
    assert len(set(names.values())) == len(names)
    batches = [pa.RecordBatch.from_arrays([column.slice(k, 7)], names=["text"]) for k in range(0, len(column), 7)]
    df = Counter()
    for b in char_grams.frequencies(iter(batches)):
        df.update(dict(zip(*(c.to_pylist() for c in b.columns), strict=True)))
    assert df == Counter(h for c in got for h in c)


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_tfidf(spark, monkeypatch, most):
    """As by plain sums, with frequencies broadcast and joined; no text's grams leave its task in the first."""
    monkeypatch.setattr(sparse, "MOST_GRAMS", most)
    asked = [(1, "haha"), (2, "x banana"), (3, None), (4, "qqqq"), (5, "\u00c9 solo")]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, content string")
    rows = sparse.tfidf(spark.createDataFrame(asked, "query_id long, query string"), docs, 3)
    assert ("collect_list" in rows._jdf.queryExecution().optimizedPlan().toString()) == (most == 0)
    counts, n = [grams(t) for t in TEXTS], len(TEXTS)
    df = Counter(g for c in counts for g in c)
    vector = lambda c: {g: (1 + math.log(t)) * (math.log((1 + n) / (1 + df[g])) + 1) for g, t in c.items() if g in df}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = []
    for q, text in asked:
        v = vector(grams(text))
        found = [(round(sum(v[g] * w.get(g, 0) for g in v) / (length(v) * length(w)), 6), d) for d, w in enumerate(map(vector, counts)) if v and w]
        want += [(q, d, s, k) for k, (s, d) in enumerate(sorted((x for x in found if x[0] > 0), key=lambda x: (-x[0], x[1]))[:3])]
    got = sorted((r.query_id, r.doc_id, r.score, r["rank"]) for r in rows.collect())
    assert [x[:2] + x[3:] for x in got] == [x[:2] + x[3:] for x in sorted(want)] and np.allclose([x[2] for x in got], [x[2] for x in sorted(want)], atol=2e-6)


def test_few_row_groups_are_dealt(spark, tmp_path):
    spark.range(4000).selectExpr("id doc_id", "'a b' content").coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(4000).selectExpr("id doc_id", "'a b' content").repartition(16).write.parquet(f"{tmp_path}/many")
    for name in ("one", "many"):
        dealt, n = sparse._spread(spark.read.parquet(f"{tmp_path}/{name}"), "doc_id")
        assert n == 4000 and ("Exchange" in dealt._jdf.queryExecution().executedPlan().toString()) == (name == "one")


def test_products_of_matrices_give_the_same_sums(monkeypatch):
    r = np.random.default_rng(4)
    query, term = np.repeat(np.arange(6), 5).tolist(), np.tile(np.arange(5), 6).tolist()
    w = block_scores.Weights(query, term, r.normal(size=30).tolist())
    row, term = np.nonzero(r.random((50, 5)) < 0.7)
    found = []
    for cells in (1, 2_000_000):  # the first is under the weights' number, so that sums are added up one by one
        monkeypatch.setattr(block_scores, "MOST_CELLS", cells)
        best = block_scores.Best(w, 4, 6)
        best.add(np.arange(50), row, term, np.ones(len(row)), np.arange(1.0, 51))
        found.append(best.found())
    assert all(np.array_equal(a, b) for a, b in zip(*found, strict=True))
