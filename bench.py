"""Times the whole pipeline and the headline queries; prints one JSON line.

The pipeline starts from the raw feed and ends with scored transactions. Each query then runs
on the finished lake, as it would every day. BENCH_SF_DIR names the tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from txnlake.config import Config  # noqa: E402
from txnlake.functions.jobs import together  # noqa: E402
from txnlake.operators import gold, quality, silver  # noqa: E402
from txnlake.operators.controls import run_controls  # noqa: E402
from txnlake.operators.quality import run_dq_checks  # noqa: E402
from txnlake.plans import queries, workspace  # noqa: E402
from txnlake.risk.scoring import run_risk_scoring  # noqa: E402
from txnlake.session import local_session  # noqa: E402
from txnlake.sources import feeds  # noqa: E402
from txnlake.sources.lake import Lake  # noqa: E402

HEADLINE = [
    "a01_daily_volume", "a02_status_mix", "a03_method_failures", "a04_top_merchants_value",
    "a05_top_merchants_failure", "a06_country_volume", "a07_country_failures", "a08_method_mix",
    "a09_segment_spend", "a10_hourly", "r4_reconciliation", "r5_rejection_reasons",
    "int_customer_metrics", "int_transaction_metrics", "dq_report", "ctl_report", "dup_lineitem",
    "psi_drift",
]


def timed(times: dict[str, float], name: str, work):
    start = time.perf_counter()
    result = work()
    times[name] = round(time.perf_counter() - start, 3)
    return result


def pipeline(spark, folder: str) -> dict[str, float]:
    """Seconds per stage of one batch, from the raw feed to scored transactions."""
    times: dict[str, float] = {}
    root, cfg = tempfile.mkdtemp(prefix="run-"), Config()
    lake = Lake(spark, root)
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    timed(times, "land", lambda: workspace.land_feeds(lake, folder, one_batch=True))
    timed(times, "silver", lambda: silver.build_silver(lake, "B1", cfg, feeds.AS_OF, feeds.AS_OF))
    timed(times, "gold", lambda: gold.build_gold(lake, cfg))
    timed(times, "checks_and_risk", lambda: together(
        lambda: run_dq_checks(spark, root, cfg, rows, feeds.AS_OF),
        lambda: run_controls(spark, root, "B1", cfg, feeds.AS_OF),
        lambda: run_risk_scoring(spark, root)))
    return times


def checks_one_by_one(spark, folder: str) -> None:
    """The fourteen checks as fourteen jobs, for comparison with the fused report."""
    context = queries.Context(spark, folder)
    rows = context.raw.count()
    for check in quality.standard_checks(context.lake, context.cfg, rows, feeds.AS_OF):
        quality.run_checks(context.silver, "silver.transactions", [check], "").collect()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g", "txnlake-bench")
    # The first run also compiles and warms up; the second is what a running session takes.
    first = pipeline(spark, folder)
    stages = pipeline(spark, folder)
    times = {f"pipeline_{name}": seconds for name, seconds in stages.items()}
    times["pipeline_first_run"] = round(sum(first.values()), 3)
    total = round(sum(stages.values()), 3)
    workspace.lake_for(spark, folder)
    for name in HEADLINE:
        queries.run(name, spark, folder).collect()
        timed(times, name, lambda name=name: queries.run(name, spark, folder).collect())
    timed(times, "dq_one_by_one", lambda: checks_one_by_one(spark, folder))
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    print(json.dumps({
        "metric": "pipeline_seconds", "value": total, "unit": "sec", "queries": times,
        "sf": folder.rsplit("/sf", 1)[-1], "transactions": rows,
        "transactions_per_second": round(rows / total),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
