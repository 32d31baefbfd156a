import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A small DataFrame from rows and a schema, in a few partitions."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
