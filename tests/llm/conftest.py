import pytest
from pyspark.sql import functions as F

from tidemark.llm.registry import ship

# Null, empty and blank texts, repeated rows, ties, a very long text, a null id and host.
LONG = "\n".join(f"line {i} of one very long text that goes on and on, word{i % 97} word{i % 89}" for i in range(4000))
BASE = "the quick brown fox jumps over the lazy dog while seven wizards mix a potion of many strange colours today"
ODD = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE + " again", "en", "b"),
    (4, None, "en", "a"), (5, "", None, "a"), (6, " \t\n ", "en", None), (None, "no id here but some words", "en", "a"),
    (7, LONG, "en", "c"), (8, "é ẞ 漢字 🙂 one", "de", "c"), (9, "x", "en", "c"), (10, "A\nb\n\nA\n b ", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every odd case, and extra columns named like those the operators add or use."""
    ship(spark)
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string")
    extra = ["row", "id", "t", "node", "n_lines", "n_words", "kept", "score", "found", "key", "host", "a b", "ids"]
    return docs.withColumns({c: F.lit(c) for c in extra}).repartition(3, "text").cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    ship(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
