from corvane.plans import retrieve


def test_vectors_beside_the_texts(spark):
    docs = [(1, "alpha Beta words", "h", [1.0, 0.0]), (2, "beta gamma words", "h", None), (3, "alpha gamma delta", "g", [0.0, 1.0]), (4, "omega beta", "g", [0.5, 0.5])]
    c = spark.createDataFrame(docs, "doc_id long, content string, heading string, vector array<double>")
    q = spark.createDataFrame([(1, "alpha beta", [1.0, 0.1]), (2, "delta omega", None)], "query_id long, query string, vector array<double>")
    texts, beside = c.drop("vector"), c.filter("vector is not null").select("doc_id", "vector")
    s = retrieve.Settings(tfidf=True, mmr=True)
    rows = lambda df: sorted(map(repr, df.collect()))
    both, apart = retrieve.routes(q, c, s, excluded=c.filter("doc_id = 4")), retrieve.routes(q, texts, s, excluded=c.filter("doc_id = 4"), vectors=beside)
    assert both.keys() == apart.keys() and {"vector", "mmr", "filter"} <= apart.keys()
    assert all(rows(both[k]) == rows(apart[k]) for k in ("vector", "mmr", "filter"))
    got = retrieve.answers(q, texts, lambda p: p, s, vectors=beside)
    # the routes have run by then, once, and are no part of the plan
    assert "MapInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(retrieve.answers(q, c, lambda p: p, s))
