import pytest
from pyspark.sql import types as T

from tests.conftest import spark  # noqa: F401

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # names that operators use inside
    T.StructField("id", T.StringType()), T.StructField("h1", T.IntegerType()),
    T.StructField("toxicity", T.StringType()), T.StructField("ids", T.IntegerType()), T.StructField("a.b", T.StringType()),
])


@pytest.fixture(scope="session")
def docs_of(spark):  # noqa: F811
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1, "y", 2, "z") for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def labels_of(spark):  # noqa: F811
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    return make
