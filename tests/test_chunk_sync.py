import hashlib
import random

from corvane.operators import versioning

CHUNKS = "source_versions_id long, created_at long, document_key string, chunk_hash string, content string, metadata map<string,string>"


def _sha(x):
    return hashlib.sha256(str(x).encode()).hexdigest()


def _brute(there, chunks, owners):
    places, seen, out = {t[:2] for t in there}, {t[2] for t in there if t[2] is not None}, []
    versions = {v: d for d, v in owners}
    for v in {c[0] for c in chunks} & versions.keys():
        own = sorted((c for c in chunks if c[0] == v), key=lambda c: (c[1], c[2].encode()))
        out += [(versions[v], k, c[3], c[4]) for k, c in enumerate(own) if (versions[v], k) not in places]
    first = {}
    for row in sorted(out, key=lambda r: r[:2]):
        if row[2] not in seen:
            first.setdefault(row[2], row)
    return sorted(first.values(), key=repr)


def test_chunks_are_numbered_and_told_apart_by_any_hash(spark):
    """Hashes of SHA-256, of other lengths and letters and null; chunks that repeat one, here or there; places that are taken."""
    r = random.Random(2)
    hashes = [*[_sha(k) for k in range(20)], _sha(3).upper(), _sha(3)[:62], "g" + _sha(3)[1:], "", "é" * 64, "ab", None]
    keys = [*[_sha(("key", k)) for k in range(150)], *[_sha(("key", k)).upper() for k in range(30)], *[f"{k:x}" for k in range(100)], "~", "é", ""]
    r.shuffle(keys)
    chunks = [(r.randrange(9), r.randrange(4), k, r.choice(hashes) if r.random() < 0.4 else f"{_sha(k)}", f"c{n}", {"page_number": "4"}) for n, k in enumerate(keys)]
    owners = [(1000 + v, v) for v in (0, 2, 3, 5, 8)]
    there = [(1002, 1, _sha(5)), (1003, 4, "ab"), (7, 0, _sha(6)), (1005, 0, None)]
    got = versioning.sync_chunks(
        spark.createDataFrame(there, "documents_id long, chunk_index long, chunk_hash string"),
        spark.createDataFrame(chunks, CHUNKS),
        spark.createDataFrame([(d, f'{{"source_versions_id":"{v}"}}') for d, v in owners], "documents_id long, metadata string"),
    )
    assert sorted(map(tuple, got.select("documents_id", "chunk_index", "chunk_hash", "chunk_text").collect()), key=repr) == _brute(there, chunks, owners)
    assert {r[0] for r in got.select("page_number").collect()} == {4}


def test_chunks_move_twice(spark):
    """To be numbered and by their hash, whatever the joins with what is there; without their metadata."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        there = spark.createDataFrame([(1, 1, "h")], "documents_id long, chunk_index long, chunk_hash string")
        chunks = spark.createDataFrame([(1, 1, "k", "h2", "text", {"page_number": "1"})], CHUNKS)
        owners = spark.createDataFrame([(1, '{"source_versions_id":"1"}')], "documents_id long, metadata string")
        df = versioning.sync_chunks(there, chunks, owners)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 1 and "SortMergeJoin" not in plan
        assert plan.count("REPARTITION_BY_COL") == 2
    finally:
        spark.conf.set(name, before)
