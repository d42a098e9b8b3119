import random
import re

from pyspark.sql import functions as F

from corvane.operators import substring


def _brute(docs, patterns):
    machine = {p: re.compile("".join("." if c == "_" else re.escape(c) for c in p), re.S) for p in patterns if p}
    return {(d, p) for d, text in docs for p, m in machine.items() if m.search((text or "").lower())}


def test_matches(spark, tmp_path):
    """Wildcards, signs of LIKE, letters beyond the first plane, no trigram, nulls, empty and long texts, repeated patterns."""
    docs = [(1, "An Index of names"), (2, None), (3, ""), (4, "100% of a\\b c_d"), (5, "x😀yz 中文字符 index\nof"), (6, "ab " * 5000 + "needle"), (7, "an index of names"), (8, "ab")]
    patterns = ["index_of", "in_ex", "index", "100%", "a\\b", "😀yz", "中文_符", "nee_le", "ab", "_", "zzz", "0_ of", "", None, "index", "a__index", "100_ of a"]
    frame = spark.createDataFrame(docs, "doc_id long, content string")
    asked = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    want = sorted(_brute(docs, patterns))
    assert sorted(map(tuple, substring.matches(frame, asked).collect())) == want
    substring.store(frame, str(tmp_path / "grams"))
    assert sorted(map(tuple, substring.matches(frame, asked, str(tmp_path / "grams")).collect())) == want
    assert substring.matches(frame.limit(0), asked).isEmpty() and substring.matches(frame, asked.limit(0)).isEmpty()


def test_no_nested_loop(spark):
    frame = spark.createDataFrame([(1, "an index of names")], "doc_id long, content string")
    found = substring.matches(frame, spark.createDataFrame([("ind_x of",)], "pattern string"))
    assert found.count() == 1 and "NestedLoop" not in found._jdf.queryExecution().toString()


def test_trigrams_of_texts_as_of_patterns(spark):
    """Both ways to cut a text into trigrams agree, by code points."""
    rows = [(k, t) for k, t in enumerate([None, "", "ab", "abc", "aaaa", "a\nb\r\n c", "🙂é́🙂é́x", "편집 원칙 편집"])]
    df = spark.createDataFrame(rows, "id long, t string")
    both = df.orderBy("id").select(substring.text_trigrams("t").alias("a"), substring.trigrams(F.col("t")).alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both] and both[4].a == ["aaa"]


def test_no_text_is_shuffled(spark, tmp_path):
    """Neither postings nor matches move texts: they are made and compared where these are read."""
    docs = [(k, f"text {k} holds an index of names " + "word " * k) for k in range(40)]
    spark.createDataFrame(docs, "doc_id long, content string").write.parquet(str(tmp_path / "docs"))
    frame = spark.read.parquet(str(tmp_path / "docs"))
    asked = spark.createDataFrame([("ind_x of",), ("text 7_holds",), ("needle_s",)], "pattern string")
    substring.store(frame, str(tmp_path / "grams"))
    plans = [substring.postings(frame), substring.matches(frame, asked), substring.matches(frame, asked, str(tmp_path / "grams"))]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    for found in plans[1:]:
        assert sorted(map(tuple, found.collect())) == sorted(_brute(docs, ["ind_x of", "text 7_holds", "needle_s"]))


def test_passes_in_parts(monkeypatch):
    """Long texts in parts, many patterns that share their trigrams, patterns over the end of a text, signs of all sizes."""
    r = random.Random(5)
    texts = ["".join(r.choice("abz😀글_ ") for _ in range(n)) for n in (3, 4, 400, 17, 900, 5)]
    patterns = sorted({"".join(r.choice("abz😀글_") for _ in range(r.randrange(3, 22))) for _ in range(300)} | {t[i : i + 20] for t in texts for i in range(0, len(t), 7)} | {"abc", "zab"})
    patterns = [p for p in patterns if max(map(len, p.split("_"))) > 2]
    docs = list(enumerate(texts))
    want = _brute(docs, patterns)
    for chars in (5, 64, 1 << 21):
        monkeypatch.setattr(substring, "MOST_CHARS", chars)
        assert set(substring._Machine(patterns).found([d for d, _ in docs], texts)) == want
        for t in texts:
            [(_, gram, place)] = substring._pairs([t])
            assert gram.tolist() == sorted({(ord(a) << 42) + (ord(b) << 21) + ord(c) for a, b, c in zip(t, t[1:], t[2:], strict=False)}) and not place.any()
