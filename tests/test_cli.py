"""Rule tables as files and the command-line run, batch and streaming."""

from ledgerly.__main__ import parse, run
from ledgerly.operators.rules import RuleSet
from ledgerly.plans.q_io import receipt_files
from ledgerly.session import scratch_path
from ledgerly.sources.fixtures import fixture_tables
from ledgerly.sources.rule_files import read_rule_tables, write_rule_tables


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rule_files_roundtrip(spark, layers):
    folder = write_rule_tables(fixture_tables(spark), scratch_path(spark, "rules"))
    tables = read_rule_tables(spark, folder)
    assert "accounting_events" not in tables
    assert tables["account_rules"].schema["COD_CUENTA"].dataType.simpleString() == "decimal(10,0)"
    from ledgerly.operators.postings import postings
    assert same(postings(layers.f1, RuleSet.from_tables(tables)), layers.postings)


def test_cli_batch_and_stream(spark, sf_small, layers):
    rules = write_rule_tables(fixture_tables(spark), scratch_path(spark, "rules"))
    receipts = receipt_files(spark, sf_small)
    for mode in ([], ["--stream", "--max-files", "8"]):
        out = scratch_path(spark, "cli")
        ps = run(spark, parse(["--receipts", receipts, "--rules", rules, "--out", out,
                               "--posting-date", layers.posting_date, "--export-csv", *mode]))
        assert same(spark.read.parquet(ps), layers.ledger)
