import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts (or (id, text) pairs), with columns whose names clash with internal ones."""
    from tripcast.llm.common import small_batches
    small_batches(spark)

    def make(texts, sources=None, clash=False):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", (sources or {}).get(i, f"s{(i or 0) % 3}"), None) for i, t in pairs]
        df = spark.createDataFrame(rows, DOC_SCHEMA)
        if clash:
            from pyspark.sql import functions as F
            for name in ("t", "key", "n", "id", "queue", "label", "range", "part", "size", "host"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make
