import pytest


@pytest.fixture
def documents(spark):
    def make(rows, columns="doc_id long, text string"):
        return spark.createDataFrame(rows, columns)
    return make
