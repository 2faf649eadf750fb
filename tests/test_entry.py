"""Driver contract and oracle agreement at sf0.001 for a sample of queries."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["lineitem", "orders", "supplier"]
SAMPLE = ["receipts_normalized", "business_events", "postings", "ledger_summary",
          "account_rule_match_pivot", "unmatched_events", "case_sample",
          "snapshot_changes", "upsert_by_key", "csv_export_roundtrip"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    return format(v.normalize(), "f") if isinstance(v, decimal.Decimal) else v


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    s = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    idx = [ocols.index(c) for c in order]
    o = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert s == o


def test_entry_without_the_training_data_operators(monkeypatch):
    """The rest registers its queries where the optional subpackage is gone."""
    import importlib
    import sys
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("ledgerly.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ledgerly.llm", None)
    try:
        bare = importlib.reload(E)
        assert "ledger_summary" in bare.queries() and "pipeline" not in bare.queries()
        assert set(bare.oracle_sql()) <= set(bare.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(E)
