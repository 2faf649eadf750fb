"""Run the receipt ledger over files.

    python -m ledgerly --receipts <folder of pipe extracts> --rules <folder of
        rule CSVs> --out <folder> [--posting-date ddMMyyyy] [--export-csv]
        [--stream] [--resume] [--master local[8]]

Batch mode writes F0, F1, F2_CONT and PS as parquet under ``--out`` (each
layer computed from the stored previous one), plus the reject report;
``--resume`` keeps what an unfinished run over the same inputs has written.
``--stream`` instead ingests the receipt folder as a stream into the same layers,
batch by batch, with signed ledger partials under ``--out/ps_partials``, and
writes PS from them.
``--export-csv`` also writes PS as a ``;``-separated interface file.
"""

from __future__ import annotations

import argparse
import sys

from ledgerly import contracts as C
from ledgerly.operators.rejects import unmatched_events
from ledgerly.operators.rules import RuleSet
from ledgerly.plans.layers import publish_layers, run_pipeline
from ledgerly.session import build_session
from ledgerly.sinks import export_csv, full_refresh
from ledgerly.sources.csv import read_receipts
from ledgerly.sources.rule_files import read_rule_tables


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="ledgerly", description=__doc__.split("\n")[0])
    ap.add_argument("--receipts", required=True)
    ap.add_argument("--rules", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--posting-date", default=None, help="ddMMyyyy (default: today)")
    ap.add_argument("--export-csv", action="store_true")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--resume", action="store_true",
                    help="keep the layers an unfinished run over the same inputs has written")
    ap.add_argument("--max-files", type=int, default=1,
                    help="receipt files per micro-batch in --stream mode")
    ap.add_argument("--master", default=None)
    return ap.parse_args(argv)


def run(spark, args: argparse.Namespace) -> str:
    """Run one batch or streaming job; returns the PS path."""
    tables = read_rule_tables(spark, args.rules)
    missing = [k for k in ("event_master", "event_relation", "entry_structure",
                           "entry_amounts", "account_rules", "chart_of_accounts",
                           "product_dim") if k not in tables]
    if missing:
        raise SystemExit(f"missing rule tables: {missing}")
    rules = RuleSet.from_tables(tables).validate()
    out = args.out.rstrip("/")
    if args.stream:
        from ledgerly.operators.enrich import product_dimension
        from ledgerly.streaming import ingest as S
        partials = f"{out}/{S.PARTIALS_FOLDER}"
        S.stream_layers(S.stream_receipts(spark, args.receipts, max_files=args.max_files),
                        product_dimension(tables["product_dim"]), rules, out,
                        f"{out}/_checkpoints/stream")
        ps_path = full_refresh(S.read_ledger(spark, partials, args.posting_date), C.LEDGER,
                               f"{out}/ps")
    else:
        layers = run_pipeline(read_receipts(spark, args.receipts), rules,
                              tables["product_dim"], args.posting_date)
        paths = publish_layers(layers, out, resume=args.resume)
        ps_path = paths["PS"]
        f1 = spark.read.parquet(paths["F1"])
        unmatched_events(f1, rules).write.mode("overwrite").parquet(f"{out}/rejects")
    if args.export_csv:
        export_csv(spark.read.parquet(ps_path), f"{out}/ps_csv", sep=";")
    return ps_path


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    spark = build_session(args.master)
    try:
        print(run(spark, args))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
