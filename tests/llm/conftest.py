import pytest
from pyspark.sql import functions as F

TABLES = "/root/testdata/sf0.001"

#: Ids and texts that every text operator has to stand: nulls, empties, blanks, repeated rows, a
#: very long line, a very long word, ties, and letters beyond ASCII.
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n\n "), (4, "one"), (4, "one"), (None, "one"), (5, "word " * 30_000),
    (6, "x" * 50_000), (7, "Ünïcödé ÇA “ŝ” 漢字 \U0001f600\nÜnïcödé"), (8, "a\nb\nc\na"),
    (9, "All rights reserved.\nCC BY cc-by"), (None, None), (10, "\x00\x7f\x85\xa0 tail"),
]
CLASHES = ("n", "h", "node", "score", "host", "path", "size", "ids", "best", "doc", "body", "at",
           "first", "place", "rank", "left", "line", "copies", "component", "spaced", "target")


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts, with extra columns that have the names operators may use."""
    docs = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string")
    docs = docs.withColumns({"source": F.when(F.col("doc_id") % 2 == 0, "s"), "lang": F.lit("en")})
    return docs.withColumns({name: F.lit(name) for name in CLASHES})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
