"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose input and cores.
``--all`` times every registered query once, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = (
    "cls_validate", "cls_triage", "ag_dedup_merge", "ag_upsert_merge", "ag_conflicts", "ag_pair_weight", "ag_dist",
    "ag_round", "jn_evidence", "jn_variants", "jn_pattern_tier", "job_migrate", "job_gate", "job_upsert",
    "job_extract_gate", "job_graph_edges", "snk_csv_company", "tx_chunk", "tx_html_text", "tx_reply_parse",
    "tx_batch_requests", "wn_last_n_rate", "wn_fail_streak", "st_process_tree", "st_ladder",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tieproof.catalog import QUERIES
    from tieproof.session import local_session

    every = "--all" in sys.argv
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or (list(QUERIES) if every else HEADLINE)
    spark = local_session("bench", cpus)
    rounds = 1 if every else 3

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("ag_dist")
    seconds = {}
    for name in names:
        if not every:
            run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(rounds)), 3)
        if "-v" in sys.argv:
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))


if __name__ == "__main__":
    main()
