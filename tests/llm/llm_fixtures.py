import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text, lang, source) -> a documents table in several partitions."""

    def build(rows, partitions=3):
        rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
        return spark.createDataFrame(rows, DOC_SCHEMA).repartition(partitions)

    return build
