import pytest


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def docs(spark):
    return lambda rows, schema="doc_id long, text string": table(spark, rows, schema)
