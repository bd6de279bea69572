import os

import pytest

FOLDER = "/root/testdata/sf0.001"

ODD = [
    (1, "the same text of some words that go on for a while here"),
    (1, "the same text of some words that go on for a while here"),
    (2, "The same text of some words that go on for a while here"),
    (3, None),
    (4, ""),
    (None, "a text without an id\nand a line"),
    (5, " \n\t \n"),
    (6, "x" * 5000 + " " + "y@z.org " * 300),
]


@pytest.fixture
def docs(table):
    """(doc_id, text) rows to a documents table, with columns whose names clash with those inside the operators."""

    def made(rows):
        more = "lang string, fp bigint, hashes string, h int, line int, root int, gone int, next int, block int, key int, component_id int"
        return table(f"doc_id bigint, text string, {more}", *((i, t, "en", *range(10)) for i, t in rows))

    return made


@pytest.fixture
def odd(docs):
    return docs(ODD)


@pytest.fixture
def nothing(docs):
    return docs([])


@pytest.fixture(scope="session")
def sample(spark):
    """The sample documents, as a DataFrame and as a list of (doc_id, text)."""
    if not os.path.isdir(FOLDER):
        pytest.skip("sample data is not here")
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
