import pytest
from pyspark.sql import functions as F

from corvane.operators import commits


def given(spark, rows):
    sources = spark.createDataFrame([(k, h) for k, h, _ in rows], "source_key string, source_hash string")
    chunks = spark.createDataFrame([(k, i, c) for k, _, cs in rows for i, c in enumerate(cs)], "source_key string, chunk_index long, chunk string")
    return sources, chunks


def now(spark, path):
    return sorted((r.source_key, r.version, r.source_hash, [c.chunk for c in r.chunks]) for r in commits.newest(commits.read(spark, path)).collect())


def test_versions_come_with_their_chunks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert now(spark, path) == []
    assert commits.commit(*given(spark, [("a", "1", ["x", "y"]), ("b", "1", []), ("c", None, ["n"])]), path, 0) == {"versions": 3, "chunks": 3}
    first = now(spark, path)
    assert first == [("a", 1, "1", ["x", "y"]), ("b", 1, "1", []), ("c", 1, None, ["n"])]
    again = given(spark, [("a", "2", ["z"]), ("b", "1", []), ("d", "1", ["w"])])
    broken = again[1].withColumn("chunk", F.when(F.col("chunk") == "w", F.raise_error("out of reach")).otherwise(F.col("chunk")))
    with pytest.raises(Exception, match="out of reach"):
        commits.commit(again[0], broken, path, 1)
    assert now(spark, path) == first  # a commit that fails leaves the state before
    for _ in range(2):  # and one that runs again counts once
        assert commits.commit(*again, path, 1) == {"versions": 2, "chunks": 2}
        assert now(spark, path) == [("a", 2, "2", ["z"]), ("b", 1, "1", []), ("c", 1, None, ["n"]), ("d", 1, "1", ["w"])]


def test_a_commit_that_cannot_be_read_back_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(commits.Observation, "get", property(lambda self: {"versions": 9, "chunks": 9}))
    with pytest.raises(RuntimeError, match="commit 0"):
        commits.commit(*given(spark, [("a", "1", ["x"])]), path, 0)
