from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text) as a table like ``documents``, plus clashing columns
    named like the operators' own."""
    from pyspark.sql import functions as F

    def make(rows, clash=True):
        df = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], SCHEMA)
        if clash:
            for c in ("key", "_key", "rep", "h1", "spans", "drops", "_marks", "shard", "n_words", "n_lines", "part"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return make


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t\n "), (4, "one"), (5, "one two"),
    (6, "Same line of more than twenty points\nother"), (7, "same LINE of more than twenty points \nelse"),
    (8, "éß 漢字 \U0001f600 words\r\nwith\x0bbreaks\x0c"),
    (None, "no id at all"), (None, "no id at all"),
    (9, " ".join(f"w{i % 977}" for i in range(30000))),
    (10, "x" * 200000), (11, "a b " * 400), (11, "a b " * 400),
]


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])
