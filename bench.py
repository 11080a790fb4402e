"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores of the
local session, BENCH_QUERIES an optional comma-separated list. Each query is built and
written to a sink that discards the rows; the first query runs once before the clock starts
so that the start of the JVM is not part of any number.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortwise.plans.queries import QUERIES  # noqa: E402
from cohortwise.session import local_session  # noqa: E402

HEADLINE = (
    "ab_metrics", "exp_user", "ab_product", "late_assign", "price_country", "cust_segment",
    "retention", "retention_wide", "retention_dq", "user_ctr", "ctr_summary", "ctr_smoothed",
    "ctr_buckets", "daily_mart", "service_overlap", "dq_dups", "dq_exact_dups", "dq_orphans",
    "dq_reconcile", "dq_chronology", "welch", "prop_ci", "chi2_balance", "kruskal",
    "mann_whitney", "effect_table", "poisson_boot", "test_summary", "intervention", "hist_density",
    "ecdf", "box_stats", "sessions", "stickiness", "rollback",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = os.environ.get("BENCH_QUERIES")
    chosen = names.split(",") if names else list(HEADLINE)
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(chosen[0])
    timings = {name: run(name) for name in chosen}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
