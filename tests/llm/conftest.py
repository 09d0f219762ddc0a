import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Build a documents table; extra columns have names that operators use themselves."""
    def make(rows, columns="doc_id long, text string, source string"):
        df = spark.createDataFrame(rows, columns)
        return df
    return make
