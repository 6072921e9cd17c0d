import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def docs(spark: SparkSession):
    """Makes a documents table from (doc_id, text, lang) rows, with a column whose name operators use themselves."""

    def make(rows):
        full = [(i, t, lang, 7) for i, t, lang in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, score int")

    return make
