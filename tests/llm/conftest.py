"""Small tables for the operators of ``imagelake.llm``."""

import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents from texts, with columns of clashing names added."""
    def make(texts, sources=None, ids=None, langs=None):
        n = len(texts)
        rows = [Row(doc_id=i, text=t, lang=g, source=s, digest="x", size=1, n=2, key="k", template="t")
                for i, t, s, g in zip(ids or range(n), texts, sources or ["a"] * n, langs or ["en"] * n)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, digest string, "
                                           "size int, n int, key string, template string")
    return make


@pytest.fixture()
def awkward(docs):
    """Nulls everywhere, blanks, repeated rows, one very long text."""
    long_text = " ".join(f"w{i}" for i in range(30_000))
    return docs([None, "", " \t\n", "one", "same text here", "same text here", "same text here", long_text],
                [None, "a", "b", None, "a", "b", "b", "c"], [1, 2, 3, 4, 5, 5, None, 7],
                [None, "en", "en", None, "en", "en", "en", "en"])
