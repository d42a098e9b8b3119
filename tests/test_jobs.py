import json
import logging

import duckdb
import pytest

from jobs import ingest_stream, queries, retrieval_report, settings

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


def rows(df):
    return sorted((tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_job_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.sql(queries.ORACLES[name]), queries.QUERIES[name](spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    cols = ", ".join(got.columns)
    plain = [tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in con.sql(f"select {cols} from ({queries.ORACLES[name]})").fetchall()]
    assert rows(got) == sorted(plain, key=repr)


def test_ingest_takes_only_what_is_new(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO)
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    (tmp_path / "c.json").write_text(json.dumps({"size": 4, "overlap": 1, "files_per_batch": 1}))

    def arrive(*docs):
        spark.createDataFrame([(*d, "en", "s") for d in docs], DOCS).coalesce(1).write.mode("append").parquet(source)
        ingest_stream.run(spark, source, out, mark, str(tmp_path / "c.json"))
        return rows(ingest_stream.read(spark, out, "chunks").select("doc_id", "version", "chunk_index", "chunk")), rows(ingest_stream.read(spark, out, "documents").select("doc_id", "version", "n_chunks", "batch"))

    first = arrive((1, "a b c d e"), (2, None), (3, "x\0y"), (None, "lost"))
    assert first == ([(1, 1, 0, "a b c d"), (1, 1, 1, "d e"), (3, 1, 0, "xy")], [(1, 1, 2, 0), (2, 1, 0, 0), (3, 1, 1, 0)])
    assert "read 4 rows (1 without an id); wrote 3 new and 0 changed documents, 3 chunks" in caplog.text
    ingest_stream.run(spark, source, out, mark, str(tmp_path / "c.json"))  # no new file
    chunks, docs = arrive((1, "a b c d e"), (3, "z"), (4, "new"), (4, "new"))  # again, changed, twice
    assert chunks == sorted([*first[0], (3, 2, 0, "z"), (4, 1, 0, "new")]) and docs == sorted([*first[1], (3, 2, 1, 1), (4, 1, 1, 1)])
    batch = spark.createDataFrame([(3, "z", "en", "s"), (4, "new", "en", "s")], DOCS)
    ingest_stream.take(batch, 1, out, 4, 1)  # a batch that runs again after its writes counts once
    assert rows(ingest_stream.read(spark, out, "chunks").select("doc_id", "version", "chunk_index", "chunk")) == chunks
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_report_reruns_and_follows_the_corpus(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"alpha w{k} beta" if k % 3 else "gamma delta", "en" if k % 2 else None) for k in range(40)], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/d1")
    docs.filter("doc_id <> 4").unionByName(spark.createDataFrame([(99, "say alpha w4 beta w4", "de")], docs.schema)).write.parquet(f"{tmp_path}/d2")
    spark.createDataFrame([(1, "alpha w4 beta"), (2, "nothing here"), (3, None)], "item_id long, text string").write.parquet(f"{tmp_path}/q")

    def report(source):
        retrieval_report.run(spark, f"{tmp_path}/{source}", f"{tmp_path}/q", f"{tmp_path}/out")
        return rows(spark.read.schema(retrieval_report.RESULTS).parquet(f"{tmp_path}/out/results")), rows(spark.read.schema(retrieval_report.METRICS).parquet(f"{tmp_path}/out/metrics"))

    first = report("d1")
    assert first == report("d1")
    assert {r[1] for r in first[0] if r[4]} == {4} and first[1] == [(1, 1.0, 0.2, 1.0), (2, None, 0.0, None), (3, None, 0.0, None)]
    second = report("d2")
    assert {r[1] for r in second[0] if r[4]} == {99} and all(r[1] != 4 for r in second[0])


def test_settings(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"size": 7}')
    assert settings.read_settings(spark, str(tmp_path / "a.json"), {"size": 1, "k": 2}) == {"size": 7, "k": 2}
    with pytest.raises(ValueError, match="unknown settings: size"):
        settings.read_settings(spark, str(tmp_path / "a.json"), {"k": 2})
    for job in (ingest_stream, retrieval_report):
        name = job.__name__.split(".")[-1]
        assert settings.read_settings(spark, f"{job.__file__.rsplit('/', 1)[0]}/{name}.json", job.DEFAULTS) == job.DEFAULTS
