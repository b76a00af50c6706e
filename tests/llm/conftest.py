import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows(sf):
    """doc_id -> text of the small documents table."""
    import pyarrow.parquet as pq

    t = pq.read_table(f"{sf}/documents.parquet")
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))
