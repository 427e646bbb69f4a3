import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents():
    """All documents of the smallest table as ``(doc_id, text)``."""
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
