import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """``documents([(1, "text"), ...])`` as a table like ``documents``."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOC).repartition(3)

    return make


@pytest.fixture
def clash(spark):
    """A table with further columns whose names operators use themselves."""

    def add(frame):
        from pyspark.sql import functions as F

        names = ["score", "kept", "digest", "row", "node", "n", "class", "cluster", "batch", "offset", "host", "path", "rule", "verdict", "wrapper", "rank", "record", "place", "gram", "items", "lang_pred", "predicted", "held_out", "length", "piece", "formatted", "sequence"]
        return frame.withColumns({name: F.lit("x") for name in names if name not in frame.columns})

    return add
