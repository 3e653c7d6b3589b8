import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with internal ones."""
    def make(rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, name string, h int, pos int, names string"
        return spark.createDataFrame([Row(i, t, None, "s", None if t is None else len(t), "x", 1, 2, "y") for i, t in rows], schema)
    return make
