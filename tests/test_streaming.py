import random

import pandas as pd
from pyspark.sql import functions as F

from corvane.operators import versioning
from corvane.streaming import sync

SCHEMA = "collection_code string, source_key string, source_hash string, seq long"


def log(n, seed=3):
    r = random.Random(seed)
    return [("abc"[r.randrange(3)], str(r.randrange(12)), f"h{r.randrange(3)}", k) for k in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def run(spark, place, arrivals, policy="update_changed"):
    spark.createDataFrame(arrivals, SCHEMA).coalesce(1).write.mode("append").parquet(f"{place}/in")
    query = sync.sync_stream(spark.readStream.schema(SCHEMA).parquet(f"{place}/in"), f"{place}/out", f"{place}/mark", policy)
    query.awaitTermination()
    return query


def test_sync_goes_on_from_its_checkpoint(spark, tmp_path):
    every = log(400)
    provider = spark.conf.get(name := "spark.sql.streaming.stateStore.providerClass", None)
    for at in (0, 150, 300):
        run(spark, tmp_path, every[at : at + (150 if at < 300 else 100)])  # each a new query over the same checkpoint
    got = sync.synced(spark, f"{tmp_path}/out")
    want = versioning.snapshot(spark.createDataFrame(every, SCHEMA))
    assert rows(got) == rows(want.select(*got.columns))
    again = sync.sync_stream(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/mark")
    again.awaitTermination()
    assert rows(sync.synced(spark, f"{tmp_path}/out")) == rows(got)
    assert spark.conf.get(name, None) == provider


def test_a_batch_touches_the_state_of_its_arrivals_only(spark, tmp_path):
    run(spark, tmp_path, [("c", str(k), "h", k) for k in range(500)])
    query = run(spark, tmp_path, [("c", "7", "other", 1000), ("c", "8", "h", 1001)])
    last = [p for p in query.recentProgress if p["numInputRows"]][-1]
    assert last["numInputRows"] == 2 and last["stateOperators"][0]["numRowsTotal"] == 500 and last["stateOperators"][0]["numRowsUpdated"] <= 2


def test_policy_force_begins_equal_versions_anew(spark, tmp_path):
    run(spark, tmp_path, [("c", "1", "a", 0), ("c", "1", "a", 1), ("c", "1", "b", 2), ("c", "1", "b", 3)], "force")
    run(spark, tmp_path, [("c", "1", "b", 4)], "force")
    got = rows(sync.synced(spark, f"{tmp_path}/out").select("version", "source_hash", "valid_from", "superseded_at", F.col("is_active").cast("int")))
    assert got == [(1, "a", 0, 1, 0), (1, "a", 1, 2, 0), (2, "b", 2, 3, 0), (2, "b", 3, 4, 0), (2, "b", 4, None, 1)]


def test_sources_of_a_bucket_are_read_together():
    """Each call to the state waits for the JVM: many sources are read in one, and only those that have changed are written."""
    calls = []

    class State(dict):
        def getValue(self, key):
            calls.append("get")
            return self.get(key)

        def iterator(self):
            calls.append("all")
            return iter(list(self.items()))

        def updateValue(self, key, value):
            calls.append("update")
            self[key] = value

    bucket = sync.SourceVersions("update_changed")
    bucket.newest = State({("d", "gone"): (7, "z")})

    def arrived(rows):
        frames = [pd.DataFrame(rows[k::2], columns=["collection_code", "source_key", "source_hash", "seq"]) for k in (0, 1)]
        return [tuple(r) for f in bucket.handleInputRows((3,), iter(frames), None) for r in f.itertuples(index=False)]

    many = [("c", str(k), h, seq) for k in range(100) for seq, h in ((3, "b"), (1, "a"), (2, "a"))]
    assert sorted(arrived(many)) == sorted([("c", str(k), 1, "a", 1) for k in range(100)] + [("c", str(k), 2, "b", 3) for k in range(100)])
    assert calls == ["all"] + ["update"] * 100
    calls.clear()
    assert arrived([("c", str(k), "b", 4) for k in range(99)] + [("c", "99", None, 4)]) == [("c", "99", 3, None, 4)]
    assert calls == ["all", "update"]
    calls.clear()
    assert sorted(arrived([("c", "99", None, 5), ("d", "new", "h", 5), ("d", "gone", "y", 5)])) == [("d", "gone", 8, "y", 5), ("d", "new", 1, "h", 5)]
    assert calls == ["get"] * 3 + ["update"] * 2 and len(bucket.newest) == 102
    calls.clear()
    bucket.newest.update({("e", str(k)): (1, "h") for k in range(1000)})
    assert arrived([("e", str(k), "h", 6) for k in range(980, 1000)]) == []  # a batch reads no more of a bucket than its arrivals allow
    assert calls == ["all"] + ["get"] * 20


def test_a_bucket_read_as_a_whole(spark, tmp_path, monkeypatch):
    """The stream gives the snapshot's rows with all sources in few buckets, nulls among them."""
    monkeypatch.setattr(sync, "BUCKETS", 2)
    every = [*log(300), *[(None, f"n{k % 40}", None if k % 3 else "h", 300 + k) for k in range(200)]]
    for at in (0, 250):
        run(spark, tmp_path, every[at : at + 250])
    got = sync.synced(spark, f"{tmp_path}/out")
    want = versioning.snapshot(spark.createDataFrame(every, SCHEMA))
    assert rows(got) == rows(want.select(*got.columns))
