import pytest


@pytest.fixture
def frame(spark):
    """documents from (doc_id, text) pairs, with columns that operators must ignore."""

    def make(rows):
        full = [(i, t, "en", "src", None if t is None else len(t), 0, "x") for i, t in rows]
        kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, bucket int, h string"
        return spark.createDataFrame(full, kinds)

    return make
