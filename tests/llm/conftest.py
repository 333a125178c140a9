import pytest
from pyspark.sql import types as T

# Extra columns carry names that operators use for their own.
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("spans", T.StringType()),
        T.StructField("ids", T.LongType()),
        T.StructField("rank", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("fp", T.StringType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Makes a table of documents from (id, text) pairs, in two partitions."""

    def make(pairs, lang="en"):
        rows = [(i, t, lang, None, None, "x", 7, "r", None, "f") for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(2) if rows else spark.createDataFrame([], DOCUMENTS)

    return make
