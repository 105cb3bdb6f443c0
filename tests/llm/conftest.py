import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("n_tokens", T.StringType()),
                     T.StructField("row", T.StringType()), T.StructField("fingerprint", T.IntegerType())])


@pytest.fixture
def docs(spark):
    """Documents with further columns whose names clash with results or helpers."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "x", None, 1) for i, t in rows], DOCS)

    return make


@pytest.fixture
def empty(docs):
    return docs([])
