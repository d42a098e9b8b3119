from pyspark.sql import functions as F

from corvane.operators import dense, vector_index
from corvane.operators.sparse import top_k
from corvane.plans import queries


def found(df):
    return {(r.query_id, r.doc_id) for r in df.collect()}


def test_recall_and_cells(spark, tmp_path):
    sf = "/root/testdata/sf0.1"
    q, v = queries.vector_questions(spark, sf), queries.vectors(spark, sf)
    cells = vector_index.build(v, str(tmp_path))
    exact = found(dense.vector_search(q, v))
    got = vector_index.search(q, str(tmp_path))
    assert len(found(got) & exact) >= 0.95 * len(exact)
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.count() == v.count() and rows.select("cell").distinct().count() <= cells
    one = vector_index.search(q.limit(1), str(tmp_path), probes=2)
    assert "PartitionFilters: [cell" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 12


def test_odd_vectors(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [2.0, 0.0]), (5, [-1.0, 0.5])]
    v = spark.createDataFrame(rows, "doc_id long, vector array<double>")
    q = v.select(F.col("doc_id").alias("query_id"), "vector")
    n = vector_index.build(v, str(tmp_path), cells=3)
    got = vector_index.search(q, str(tmp_path), probes=n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dense.vector_search(q, v).collect()))
    assert vector_index.build(v.limit(0), f"{tmp_path}/none") == 0 and vector_index.search(q, f"{tmp_path}/none").count() == 0


def test_blocks_meet_in_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(dense, "BLOCK", 40)
    monkeypatch.setattr(dense, "SLICE", 7)
    nan = float("nan")
    odd = [(900, None), (901, [0.0] * 4), (902, [1.0, None, 0.0, 0.0]), (903, [1.0, 2.0]), (904, []), (905, [nan, 0.0, 0.0, 1.0])]
    rows = [(i, [float(i % 5), float(i % 3), 1.0, float(i % 7)]) for i in range(200)] + odd
    v = spark.createDataFrame(rows, "doc_id long, vector array<float>")
    q = v.filter("doc_id % 3 = 0").withColumnRenamed("doc_id", "query_id")
    got = dense.vector_search(q, v, 15)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CoGroup" in plan
    pairs = q.filter("vector is not null").select("query_id", F.col("vector").alias("qv")).crossJoin(v.filter("vector is not null"))
    pairs = pairs.select("query_id", "doc_id", (F.round(1 - dense.cosine(F.col("qv"), F.col("vector")), 6) + 0.0).alias("distance"))
    want = top_k(pairs, 15, score="distance", descending=False)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
    assert dense.vector_search(q.limit(0), v).count() == 0 and dense.vector_search(q, v.limit(0)).count() == 0


def test_a_crowded_cell_is_searched_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK", 30)
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(100)] + [(i, [float(i % 7), 1.0, float(i % 11)]) for i in range(100, 180)]
    v = spark.createDataFrame(rows, "doc_id long, vector array<double>")
    q = v.filter("doc_id % 9 = 0").withColumnRenamed("doc_id", "query_id")
    n = vector_index.build(v, str(tmp_path), cells=5)
    got = vector_index.search(q, str(tmp_path), probes=n)
    assert "CoGroup" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dense.vector_search(q, v).collect()))
