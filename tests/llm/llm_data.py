"""Fixtures of these tests; imported by name, because the folder above has a conftest of its own."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    """The session of all tests, with the sources in its workers."""
    from tillbook.llm.shipping import ship

    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the smallest folder."""
    return duckdb.connect().execute(f"select doc_id, text from read_parquet('{SF}/documents.parquet') order by doc_id").fetchall()


CLASHING = "doc_id long, text string, fp long, digest string, row long, score double, mark string, runs string, spans string, kept string, __id string, node string, w string, n string"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, repeated rows, one id with two texts, long texts with and without spaces, ties."""
    words = " ".join(f"word{i % 997}" for i in range(30_000))
    return [
        (None, "a text without an id that says the same thing"),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "Short."),
        (5, "the same words in the same row, twice over. And once more, for good measure, it says so. Indeed it does so here."),
        (5, "the same words in the same row, twice over. And once more, for good measure, it says so. Indeed it does so here."),
        (6, "one id"),
        (6, "two texts"),
        (7, words),
        (8, "x" * 40_000),
        (9, "été 漢字 😀 naïve\r\nlines with spaces\x1c"),
    ]


@pytest.fixture(scope="session")
def odd(llm, odd_rows):
    """odd_rows with columns of names that operators use themselves."""
    extra = [None, 1, "d", 2, 0.5, "m", "r", "s", "k", "i", "n", "w", "n"]
    return llm.createDataFrame([(i, t, *extra[1:]) for i, t in odd_rows], CLASHING).repartition(3)


@pytest.fixture(scope="session")
def nothing(llm):
    return llm.createDataFrame([], "doc_id long, text string, lang string")
