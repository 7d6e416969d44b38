import pytest
from cases import ROWS, SCHEMA


@pytest.fixture(scope="session")
def rows():
    return [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = ["fp", "word", "n", "ids", "piece", "length", "sha", "id", "th", "at", "rank", "kept", "n_words", "hash", "norm", "found", "row", "salt", "text_sha256", "offset", "payload"]
    return docs.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
