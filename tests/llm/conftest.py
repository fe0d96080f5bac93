import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with columns whose names operators might use themselves."""

    def make(rows, schema="doc_id BIGINT, text STRING"):
        return spark.createDataFrame(rows, schema)

    return make
