import pytest

LONG = " ".join(f"word{i % 4001}" for i in range(30_000))

#: Nulls in every column, empty and very long texts, ties and repeated rows.
EDGES = [
    (1, "a small text of some ten words is what this is", "en", "s", 4),
    (1, "a small text of some ten words is what this is", "en", "s", 4),
    (2, "", "en", None, 0),
    (3, None, "en", "s", None),
    (None, "no id but a text here", "en", "s", 1),
    (5, LONG, None, "s", 1),
    (6, LONG, "en", "s", 1),
    (7, " \n\t ", "en", "s", 3),
    (8, "x", "en", "s", 1),
    (9, "\x00   \U0001f600 ́", "en", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ("id", "node", "key", "comp", "n", "word", "doc", "fp", "ids", "spans", "score", "kept", "hub", "leader", "label", "shard", "order", "a", "b", "_keep_id", "bands", "class_id", "similarity")


@pytest.fixture(scope="session")
def edges(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, SCHEMA)
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
