"""One batch from raw files to checked, scored tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from txnlake.config import Config
from txnlake.functions.jobs import together
from txnlake.operators.bronze import ingest, utc_now
from txnlake.operators.controls import run_controls
from txnlake.operators.gold import build_warehouse
from txnlake.operators.quality import run_dq_checks
from txnlake.risk.gates import batch_gate
from txnlake.risk.scoring import run_risk_scoring

REPORT = "batch_id string, dq_score double, control_status string, reconciliation_delta long"
SUMMARY = "batch_id string, stage string, metric string, value string"


def flat(values: dict[str, Any], prefix: str = "") -> list[tuple[str, str]]:
    """Numbers and verdicts of a stage summary as (metric, value)."""
    out = []
    for name, value in values.items():
        if isinstance(value, dict):
            out += flat(value, f"{prefix}{name}.")
        elif name not in ("results", "batch_id"):
            out.append((f"{prefix}{name}", str(value)))
    return out


def gate(spark: SparkSession, batch_id: str, rows: list[tuple[str, str, str, str]]) -> dict[str, Any]:
    """Whether the finished batch may be promoted, and why, from what its stages have found."""
    found = {(stage, metric): value for _, stage, metric, value in rows}
    accounted = int(found["warehouse", "silver.silver_count"]) + int(found["warehouse", "silver.quarantine_count"])
    report = (batch_id, float(found["quality", "quality_score"]), found["controls", "overall_status"],
              int(found["ingest", "transactions.record_count"]) - accounted)
    verdict = batch_gate(spark.createDataFrame([report], REPORT)).first()
    return {"approved": verdict["approved"], "reason": verdict["reason"]}


def run_batch(spark: SparkSession, lake_root: str, transactions_path: str, customers_path: str,
              merchants_path: str, batch_id: str, cfg: Config | None = None,
              as_of: datetime | None = None, expected_transactions: int | None = None) -> DataFrame:
    """Land, validate, model, check and score one batch; returns (batch_id, stage, metric, value).

    Checks, controls and scoring only read the finished layers, so they run side by side. Then the
    gate decides on the batch from their score, verdict and the difference between the layers.
    Running a batch again replaces it.
    """
    cfg = cfg or Config()
    as_of = as_of or utc_now()
    rows: list[tuple[str, str, str, str]] = []

    def stage(name: str, work: Callable[[], dict[str, Any]]) -> list[tuple[str, str, str, str]]:
        start = time.monotonic()
        found = [(batch_id, name, metric, value) for metric, value in flat(work())]
        return [*found, (batch_id, name, "seconds", f"{time.monotonic() - start:.2f}")]

    rows += stage("ingest", lambda: ingest(
        spark, lake_root, transactions_path, customers_path, merchants_path, batch_id, cfg))
    rows += stage("warehouse", lambda: build_warehouse(spark, lake_root, batch_id, cfg, as_of))
    for part in together(
        lambda: stage("quality", lambda: run_dq_checks(
            spark, lake_root, cfg, expected_transactions, as_of)),
        lambda: stage("controls", lambda: run_controls(spark, lake_root, batch_id, cfg, as_of)),
        lambda: stage("risk", lambda: run_risk_scoring(spark, lake_root, scored_at=as_of)),
    ):
        rows += part
    rows += stage("gate", lambda: gate(spark, batch_id, rows))
    return spark.createDataFrame(rows, SUMMARY)
