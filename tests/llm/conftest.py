import pytest


@pytest.fixture(scope="session")
def table(spark):
    """A DataFrame from rows and a schema."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make
