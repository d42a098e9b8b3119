from pyspark.sql import functions as F

from corvane.operators import lexical, sizes, sparse

WORDS = "corpus filter index merge query shard token vector window".split()


def corpus(spark, n, seed=0):
    rows = [(k, " ".join(WORDS[(k * 7 + i * i + seed) % (3 + k % 7)] for i in range(1 + k % 40)) + f" w{k % 11}") for k in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, "")], "doc_id long, content string")


def asked(spark):
    return spark.createDataFrame([(1, "corpus w3"), (2, "merge merge query"), (3, "w10 Vector w4"), (4, "nowhere"), (5, None)], "query_id long, query string")


def plain(df):
    return sorted((r.query_id, r.doc_id, round(r.score, 5), r["rank"]) for r in df.collect())


def same(spark, docs, path, **settings):
    docs = docs.withColumn("content", F.coalesce("content", F.lit("")))
    got = plain(lexical.bm25_search(asked(spark), path, **settings))
    return got == plain(sparse.bm25(asked(spark), docs)) and bool(got)


def test_index_follows_its_corpus(spark, tmp_path):
    path, docs = str(tmp_path / "index"), corpus(spark, 700)
    assert lexical.update(docs, path) == 1 and same(spark, docs, path)
    assert lexical.update(docs, path) == 1  # nothing to do, nothing written
    changed = docs.filter("doc_id % 10 <> 4").withColumn("content", F.when(F.col("doc_id") % 9 == 0, F.concat("content", F.lit(" vector vector w3"))).otherwise(F.col("content")))
    changed = changed.unionByName(spark.createDataFrame([(9000, "corpus w3 w3 corpus")], docs.schema))
    assert lexical.update(changed, path, complete=True) == 2 and same(spark, changed, path)
    last = lexical.segments(spark, path).filter("segment = 2").first()
    assert (last.n_new, last.n_changed, last.n_gone) == (1, 70, 70)  # null and empty contents stay as they are
    assert lexical._read(spark, path, "documents", lexical.DOCUMENTS, [2]).filter("dl is not null").count() == 71
    assert same(spark, docs, path, version=1)  # an earlier version can still be searched
    assert lexical.update(docs, path, complete=True) == 3 and same(spark, docs, path)  # documents that come back


def test_unfinished_update_is_not_seen(spark, tmp_path):
    path, docs = str(tmp_path / "index"), corpus(spark, 60)
    lexical.update(docs, path)
    for kind in ("documents", "vocabulary", "postings"):  # as an update leaves them that ends before its last write
        spark.range(3).write.parquet(f"{path}/{kind}/segment=2")
    assert same(spark, docs, path)
    more = docs.unionByName(spark.createDataFrame([(900, "corpus corpus")], docs.schema))
    assert lexical.update(more, path) == 2 and same(spark, more, path)


def test_empty_index(spark, tmp_path):
    path = str(tmp_path / "index")
    assert lexical.bm25_search(asked(spark), path).count() == 0
    lexical.update(corpus(spark, 5).limit(0), path)
    assert lexical.bm25_search(asked(spark), path).count() == 0


def test_blocks_under_the_kth_score_stay_closed(spark, tmp_path, monkeypatch):
    """A rare word's few documents win: blocks without it can't reach them and aren't opened."""
    rows = [(k, ("common " * 20 + ("rare " * 5 if k % 500 == 0 else "filler " * (k % 30)))) for k in range(12_000)]
    path, docs = str(tmp_path / "index"), spark.createDataFrame(rows, "doc_id long, content string").repartition(4)
    lexical.update(docs, path)
    q = spark.createDataFrame([(1, "rare filler")], "query_id long, query string")
    opened, write = {}, lexical.materialize

    def counted(df, label, result=False):
        out = write(df, label, result)
        opened[label] = out.count()
        return out

    monkeypatch.setattr(lexical, "materialize", counted)
    assert plain(lexical.bm25_search(q, path, k=3)) == plain(sparse.bm25(q, docs, k=3))
    assert opened["open-blocks"] + opened["first-blocks"] < opened["bounds"] / 2


def test_plan_reads_asked_postings_only(spark, tmp_path):
    path = str(tmp_path / "index")
    lexical.update(corpus(spark, 300), path)
    plan = lexical.bm25_search(asked(spark), path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(token, [" in plan


def test_postings_and_scores_stay_in_their_task(spark, tmp_path, monkeypatch):
    """Postings are made where their documents are, and a search shuffles at most k rows a query and task."""
    path, docs = str(tmp_path / "index"), corpus(spark, 700).repartition(3)
    lexical.update(docs, path)
    own = spark.read.schema(lexical.DOCUMENTS).parquet(f"{path}/documents/segment=1").filter("dl is not null")
    assert "Exchange" not in lexical._blocks(own, 4)._jdf.queryExecution().executedPlan().toString()
    given, top_k = [], lexical.top_k

    def counted(df, k, **a):
        if "bound" not in df.columns:
            given.append(df.count() <= 2 * k * 3 * df.rdd.getNumPartitions())
        return top_k(df, k, **a)

    monkeypatch.setattr(lexical, "top_k", counted)
    assert lexical.bm25_search(asked(spark), path, k=2).count() == 6 and given and all(given)


def test_blocks_of_several_batches(spark, tmp_path):
    """A block's rows that come in several batches count together, and of a changed document the newest text alone."""
    path, docs = str(tmp_path / "index"), corpus(spark, 900)
    most = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        for size in (7, 150, 10_000):
            spark.conf.set(most, size)
            lexical.update(docs.filter(F.col("doc_id") < 600).withColumn("content", F.concat("content", F.lit(f" vector w3 w{size}"))), path)
            lexical.update(docs, path)
            assert same(spark, docs, path)
    finally:
        spark.conf.unset(most)


def test_texts_and_terms_of_many_changes_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Ids of changes are broadcast beyond the rows that other small sides have, so that texts and terms stay where they are."""
    path = str(tmp_path / "index")
    docs = spark.range(11_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word w"), F.col("id") % 50).alias("content"))
    lexical.update(docs.withColumn("content", F.concat("content", F.lit(" old"))), path)
    small, check = [], lexical.if_small
    monkeypatch.setattr(lexical, "if_small", lambda df, *most: small.append(df.count() <= (most or [sizes.MOST_ROWS])[0]) or check(df, *most))
    lexical.update(docs, path)
    assert small == [True, True] and lexical.segments(spark, path).filter("segment = 2").first().n_changed == 11_000
    assert lexical.postings(spark, path).filter("token = 'old'").count() == 0
    assert small == [True, True, True]
