import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents that hold the corner cases: nulls, empty and long texts, ties, repeated rows,
    and columns whose names clash with those of results."""
    long = "the quick brown fox jumps over the lazy dog and runs away. " * 800
    rows = [
        (1, "Plain words that say nothing much, but say it in a full sentence of more than twenty words so that rules keep it here.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, long, "en", "b"),
        (5, "Licensed under the Apache License, Version 2.0. All rights reserved. CC-BY", "en", "b"),
        (5, "Licensed under the Apache License, Version 2.0. All rights reserved. CC-BY", "en", "b"),
        (6, " \t\n ", "en", "a"),
        (7, "ünïcödé wörds \U0001f600 und mehr  davon \u00a0 x", "de", "c"),
    ]
    extra = [(*r, 0.5, 3, "x", True) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, score double, start int, ids string, kept boolean")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
