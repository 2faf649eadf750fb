"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and materialises the full result with the ``noop``
sink (every row computed, nothing collected to the driver). After one warm-up of
the whole pipeline all queries run ``$BENCH_REPEAT`` times (default 5), each
round from another query on, so that no query always follows the same one; the
best time counts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerly.plans.registry import queries  # noqa: E402
from ledgerly.session import build_session  # noqa: E402

HEADLINE = [
    "receipts_normalized",
    "business_events",
    "postings",
    "ledger_summary",
    "account_rule_match",
    "account_rule_match_pivot",
    "supplier_account_rules",
    "unmatched_events",
    "case_sample",
    "snapshot_changes",
    "upsert_by_key",
    "ledger_end_to_end",
    "stream_ledger",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    qs = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("ledger_summary")  # warm-up: JVM, class loading, parquet footers
    best = dict.fromkeys(names, float("inf"))
    for i in range(repeat):
        at = i * len(names) // repeat
        for name in names[at:] + names[:at]:
            best[name] = min(best[name], run(name))
    times = {name: round(t, 3) for name, t in best.items()}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
