import pytest

DOCS = "doc_id long, text string, lang string, n_lines int, component_id string, _key int, ids string, _rest double"


@pytest.fixture()
def docs(spark):
    """Makes a documents table that has columns with names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", 7, "c", 1, "x", 0.5) for i, t in rows], DOCS)

    return make
