"""Payment analytics on Spark: raw feeds to a checked star schema, reports, risk and drift."""

from txnlake.config import Config
from txnlake.operators.bronze import ingest
from txnlake.operators.controls import run_controls
from txnlake.operators.gold import build_warehouse
from txnlake.operators.quality import run_dq_checks
from txnlake.plans.run import run_batch
from txnlake.risk.scoring import run_risk_scoring
from txnlake.sources.lake import Lake

__all__ = [
    "Config", "Lake", "build_warehouse", "ingest", "run_batch", "run_controls", "run_dq_checks",
    "run_risk_scoring",
]
