import time

from corvane.operators import evaluation
from corvane.plans import queries


def test_truth_of_one_large_label(spark, tmp_path, monkeypatch):
    """Each question meets the rows of its label; these don't meet each other."""
    n = 60_000
    spark.range(n).selectExpr("id as vec_id", "array(1.0D, id) as embedding", "7 as label").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.range(20).selectExpr("id as doc_id", "'text' as text", "'s' as source", "'en' as lang").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(5).selectExpr("id as item_id", "'what' as text").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = []
    monkeypatch.setattr(evaluation, "experiment", lambda cases, retriever, truth, *rest: given.append(truth))
    queries.QUERIES["experiment_run"](spark, str(tmp_path))
    began = time.monotonic()
    assert given[0].count() == 5 * n
    assert time.monotonic() - began < 20
