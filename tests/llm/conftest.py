import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(*r, *(None, None)[len(r) - 2:]) for r in rows]
        return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in full], DOCS)
    return make


@pytest.fixture(scope="session")
def text_of():
    """Distinct pseudo-random text: text_of(seed, words)."""
    import random

    def make(seed, n, vocabulary=4000):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))
    return make
