import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that operators use for themselves
                     T.StructField("id", T.StringType()), T.StructField("key", T.LongType()),
                     T.StructField("n_removed", T.LongType()), T.StructField("score", T.DoubleType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text[, source]) rows -> documents with extra, clashing columns."""
    def make(rows):
        out = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1, 2, 0.5) for r in rows]
        return spark.createDataFrame(out, DOCS)
    return make


@pytest.fixture(scope="session")
def prose():
    """Random words: ``prose(n, seed)``."""
    def make(n, seed):
        rnd = random.Random(seed)
        return " ".join("".join(rnd.choice(["th", "an", "on", "re", "ti", "ou"]) for _ in range(rnd.randint(1, 4)))
                        for _ in range(n))
    return make


@pytest.fixture(scope="session")
def vocabulary():
    from tidemark.llm.queries import vocabulary
    return vocabulary()
