import pytest

#: Rows that every operator must take: nulls, empty and very long texts, repeats, ties.
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, "The MIT License (mit  license)", "en", "a", 5),
    (2, None, "en", None, None),
    (3, "", None, "a", 0),
    (4, "é" * 50 + "\n" + "same line of twenty chars or more\n\tSAME line of twenty chars or more ", "fr", "b", 9),
    (5, "same line of twenty chars or more", "fr", "b", 9),
    (6, "x\nsame line of twenty chars or more\n", "fr", "b", 9),
    (6, "x\nsame line of twenty chars or more\n", "fr", "b", 9),
    (7, LONG, "en", "a", len(LONG)),
    (None, "same line of twenty chars or more", "en", "a", 1),
    (8, " \t\n ", "en", "c", 4),
    (9, "=" * 3000, "de", "c", 3000),
    (10, "under the GNU General Public License, version 3. CC-BY cc by", "en", "a", 9),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The rows above with extra columns whose names operators may use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, pos int, kept string, n_words int, score string"
    return spark.createDataFrame([(*r, 1, 2, "x", 3, "y") for r in ROWS], schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
