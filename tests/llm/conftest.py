import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """A DataFrame of ``(doc_id, text)`` pairs, several partitions, with an extra column."""

    def make(pairs, schema="doc_id long, text string", partitions=3):
        return spark.createDataFrame(list(pairs), schema).repartition(partitions)

    return make
