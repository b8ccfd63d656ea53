import pytest


@pytest.fixture
def docs(spark):
    """Documents from texts, numbered from 0, with columns whose names the operators use themselves."""

    def make(texts, **extra):
        shape = "doc_id bigint, text string, lang string, source string, n_chars int, score string, rep string, n string, id string"
        rows = [(i, t, extra.get("lang", [None] * len(texts))[i], "s", len(t or ""), "x", "y", "z", None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, shape)

    return make
