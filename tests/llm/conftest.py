import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_docs():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def sf_items():
    return duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet' order by item_id").fetchall()
