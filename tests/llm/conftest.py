"""Fixtures: the small documents with every edge row the operators must take."""

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

PASSAGE = ("The committee met on a cold morning to settle the matter of the old bridge. Nobody from the village had "
           "been told about the plan before the meeting. After two hours of talk they agreed to wait until spring. "
           "The mayor promised to write to every household, and the clerk wrote it all down in the large green book.")
EDGES = [
    (9001, None), (9002, ""), (9003, "   \n\t "), (None, "a row without an id and few words"), (None, None),
    (9004, "x"), (9005, "two words"), (9006, "repeated row of some words here"), (9006, "repeated row of some words here"),
    (9007, "Alpha beta. " + PASSAGE + " Gamma delta."), (9008, "Another start here, quite its own. " + PASSAGE + " Then another end."),
    (9009, PASSAGE), (9009, PASSAGE), (9010, ("word " * 60_000).strip()), (9011, "\u00e9\u00df \U0001f600 \u65e5\u672c " * 40),
    (9012, "mail a.b@c-d.org or +1 (555) 123-4567, 10.0.0.1, 4111 1111 1111 1111."), (9013, "<|endoftext|> <|window 3|> \\ <\\| end"),
    (9014, "A" * 300), (9015, "A" * 450), (9016, "one.\n\n\ntwo.  three\n one.\n\n\ntwo.  three"),
]


@pytest.fixture(scope="session")
def rows(spark):
    """The documents as Python rows (doc_id, text), edge rows included."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in docs] + EDGES


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The same as a DataFrame over several partitions, with columns whose
    names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ["k1", "k2", "fp", "d", "spans", "a", "b", "root", "node", "sequence_id", "kept", "__k1", "n_chars", "lang"]
    return df.repartition(5).withColumns({c: F.lit("clash") if c != "n_chars" else F.length("text").cast("long") for c in clash})


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


def as_key(row):
    return tuple((v is None, str(v)) for v in row)


def same(got, expected):
    """Equal as multisets of rows."""
    assert sorted(map(tuple, got), key=as_key) == sorted(map(tuple, expected), key=as_key)
