"""Every registered query against its SQL in DuckDB on small tables; queries without SQL must run and be stable."""

import duckdb
import pytest

from corvane.plans import ORACLES, QUERIES, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF)
    rows = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    if name in ORACLES:
        want = sql.sql(ORACLES[name])
        assert sorted(want.columns) == sorted(df.columns)
        at = [want.columns.index(c) for c in sorted(df.columns)]
        assert rows == sorted((tuple(plain(r[k]) for k in at) for r in want.fetchall()), key=repr)
    else:
        assert rows


def test_heading_lines_take_whole_texts(spark, tmp_path):
    rows = [(1, "plain text\n1.2 Scope of it\n\nmore", "en", "a"), (2, None, "en", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["heading_lines"](spark, str(tmp_path)).orderBy("doc_id", "line").collect()
    assert [tuple(r) for r in got] == [(1, 1, None), (1, 2, 2), (1, 3, None), (1, 4, None), (2, 1, None)]
