import pytest


@pytest.fixture
def docs(spark):
    """Builds a documents table from (doc_id, text[, source]) rows with the usual columns and a clashing extra one."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, component string")
    return build
