"""Raw anomaly scores to a 0-100 risk score and a tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnlake.functions.lookup import is_small
from txnlake.functions.quantiles import WHOLE, quantiles

# Percentiles that bound the score, and upper ends of the tiers.
LOW_SHARE, HIGH_SHARE = 0.01, 0.99
LOW_LIMIT, MEDIUM_LIMIT = 45.0, 75.0


def score_bounds(scored: DataFrame, column: str = "anomaly_score") -> DataFrame:
    """One row: exact 1st and 99th percentile of the raw score of a stored frame."""
    found = quantiles(scored, column, [], [LOW_SHARE, HIGH_SHARE], small=is_small(scored, WHOLE))
    at = lambda share: F.max(F.when(F.col("share") == share, F.col("quantile")))
    return found.agg(at(LOW_SHARE).alias("low"), at(HIGH_SHARE).alias("high"))


def tier(score: Column) -> Column:
    return F.when(score <= LOW_LIMIT, "LOW").when(score <= MEDIUM_LIMIT, "MEDIUM").when(
        score.isNotNull(), "HIGH")


def calibrate(scored: DataFrame, column: str = "anomaly_score", bounds: DataFrame | None = None) -> DataFrame:
    """Add risk_score (100 is most anomalous) and risk_tier. Lower raw scores are riskier.

    `bounds` is one row of score_bounds, of the rows themselves by default.
    """
    found = score_bounds(scored, column) if bounds is None else bounds
    bounds = found.select(F.struct("low", "high").alias("b")).scalar()
    low, high = F.col("_bounds.low"), F.col("_bounds.high")
    clipped = F.least(F.greatest(F.col(column), low), high)
    share = (high - clipped) / (high - low + F.lit(1e-6)) * 100.0
    return (
        scored.withColumn("_bounds", bounds)
        .withColumn("risk_score", F.rint(share * 10.0) / 10.0)
        .drop("_bounds")
        .withColumn("risk_tier", tier(F.col("risk_score")))
    )
