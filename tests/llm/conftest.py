import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id int, _row string, label string"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta eta", "en", "a", 5),
        (2, "alpha  BETA gamma\tdelta epsilon zeta eta", "en", "b", 5),
        (2, "alpha  BETA gamma\tdelta epsilon zeta eta", "en", "b", 5),
        (3, None, None, None, None),
        (4, "", "fr", "a", 0),
        (5, " \n\t ", "fr", None, 0),
        (None, "alpha beta gamma delta epsilon zeta eta", None, None, None),
        (7, long, "en", "c", None),
        (8, long + " end", "en", "c", None),
        (9, "one two", "en", "a", 7),
        (10, "ONE two", "en", "d", 7),
        (11, "12 34 -- !!", "de", "a", 3),
    ]
    return [(*r, 0, "x", "y") for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sql():
    """Rows of SQL over the tables, as strings, and the same of a Spark result."""
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")

    def same(df, query):
        names = sorted(df.columns)
        theirs = con.execute(f"SELECT {', '.join(names)} FROM ({query})").fetchall()
        ours = [tuple(r) for r in df.select(*names).collect()]
        key = lambda row: tuple(map(str, row))
        assert sorted(ours, key=key) == sorted(theirs, key=key)

    return same
