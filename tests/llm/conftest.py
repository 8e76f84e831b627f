import pytest


@pytest.fixture
def docs(spark):
    """Documents with extra columns that clash with names the operators use inside."""

    def make(*rows):
        full = [(i, t, "en", "src", len(t) if t is not None else None, 1, 2.0) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, row int, score double")

    return make
