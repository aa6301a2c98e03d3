"""Fixtures and folders of these tests (imported by name)."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture
def docs_of(spark):
    """documents(doc_id, text, lang, source, n_chars) from rows of (doc_id, text[, lang[, source]])."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture
def sf_of(spark, tmp_path, docs_of):
    """A folder with tables as Parquet; documents may carry extra columns."""

    def make(documents=None, **tables):
        if documents is not None:
            tables["documents"] = docs_of(documents) if isinstance(documents, list) else documents
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
