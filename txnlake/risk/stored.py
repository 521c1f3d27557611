"""A fitted model that later batches are scored with, and the drift that says when to fit another.

A model is a version of three small tables: the nodes of its forest, the bounds of its raw scores
and the profile of the features it was fitted on. Its row in models.versions is written last, so a
fit that stops halfway leaves the version before it in force. Each scored batch leaves the counts of its
features in the bins of the profile; counts add up, so the drift of any set of batches is
read from at most (BINS + 1) rows for each feature and batch, and no scored row is read again.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, functions as F

from txnlake.functions.quantiles import unpivoted
from txnlake.operators.bronze import utc_now
from txnlake.risk import drift
from txnlake.risk.calibrate import calibrate, score_bounds
from txnlake.risk.explain import add_explanations
from txnlake.risk.features import extract_features
from txnlake.risk.iforest import ForestParams, fit, score
from txnlake.risk.scoring import tier_counts
from txnlake.sources.lake import Lake

VERSIONS, NODES, BOUNDS = "models.versions", "models.forest_nodes", "models.score_bounds"
PROFILE, COUNTS, SCORES = "models.drift_profile", "models.drift_counts", "gold.risk_by_batch"


def fit_model(lake: Lake, model_id: str, features: DataFrame, params: ForestParams | None = None,
              fitted_at: datetime | None = None) -> None:
    """Fit a version on stored features and put it in force. Fitting it again replaces it."""
    rows = features.count()
    if rows == 0:
        raise ValueError("a model cannot be fitted on no rows")
    lake.replace_batch(fit(features, rows, params), NODES, model_id)
    scored = lake.stage(score(features, lake.read(NODES, model_id)), f"fitted_{model_id}")
    lake.replace_batch(score_bounds(scored), BOUNDS, model_id)
    lake.replace_batch(drift.build_reference(lake, features, f"fitted_{model_id}"), PROFILE, model_id)
    version = lake.spark.range(1).select(
        F.lit(rows).cast("long").alias("training_rows"), F.lit(fitted_at or utc_now()).cast("timestamp_ntz").alias("fitted_at"))
    lake.replace_batch(version, VERSIONS, model_id)


def model_in_force(lake: Lake) -> str | None:
    """The version that was fitted last, of equal times the one with the greatest name; None before the first fit."""
    latest = lake.read(VERSIONS).agg(F.max(F.struct("fitted_at", "batch_id"))["batch_id"]).first()
    return latest[0]


def scored_with(lake: Lake, model_id: str, features: DataFrame) -> DataFrame:
    """Features with raw score, risk score and tier by a stored version; nothing is fitted."""
    return calibrate(score(features, lake.read(NODES, model_id)), bounds=lake.read(BOUNDS, model_id))


def keep_counts(lake: Lake, model_id: str, batch_id: str, features: DataFrame) -> None:
    """Store in which bins of the profile the features of a batch lie, over what was stored for it before."""
    edges = lake.read(PROFILE, model_id).select("feature", "edges")
    counts = drift.histogram(unpivoted(features, drift.WATCHED), edges)
    lake.replace_batch(counts.withColumn("model_id", F.lit(model_id)), COUNTS, batch_id)


def drift_of(lake: Lake, model_id: str, batches: Iterable[str] | None = None,
             threshold: float = drift.THRESHOLD) -> DataFrame:
    """(feature, psi, status, out_of_range) of a set of batches against a version, from stored counts alone.

    By default these are all batches that were counted against it. Batches that were counted
    against another version only, or never, add nothing.
    """
    counts = lake.read(COUNTS).filter(F.col("model_id") == model_id)
    if batches is not None:
        counts = counts.filter(F.col("batch_id").isin(*batches))
    summed = counts.groupBy("feature", "bin").agg(F.sum("rows").alias("rows"))
    return drift.verdicts(drift.stability_of_counts(summed, lake.read(PROFILE, model_id)), threshold)


def batch_features(lake: Lake, batch_id: str) -> DataFrame:
    """Features of the transactions of one batch, by the customers' and merchants' whole history, written."""
    return lake.stage(extract_features(lake, rows=lake.transactions(batch_id)), f"features_{batch_id}")


def score_batch(lake: Lake, batch_id: str, params: ForestParams | None = None,
                scored_at: datetime | None = None) -> dict[str, Any]:
    """Score one Silver batch into gold.risk_by_batch with the model in force.

    A model is fitted on all of Silver, named after the batch, when there is none yet or when
    the batch brings a watched feature to the drift threshold. Scoring a batch again replaces its rows.
    """
    scored_at = scored_at or utc_now()
    features, model_id = batch_features(lake, batch_id), model_in_force(lake)
    drifted: list[str] = []
    if model_id is not None:
        keep_counts(lake, model_id, batch_id, features)
        # One row for each watched feature.
        drifted = sorted(row.feature for row in drift_of(lake, model_id, [batch_id]).filter("status = 'DRIFT'").collect())
    refitted = model_id is None or bool(drifted)
    if refitted:
        model_id = batch_id
        fit_model(lake, model_id, lake.stage(extract_features(lake), "features"), params, scored_at)
        keep_counts(lake, model_id, batch_id, features)
    explained = add_explanations(scored_with(lake, model_id, features)).withColumns({
        "_scored_at": F.lit(scored_at).cast("timestamp_ntz"), "model_id": F.lit(model_id)})
    lake.replace_batch(explained, SCORES, batch_id)
    lake.clear_staging()
    found = tier_counts(lake.read(SCORES, batch_id)).first().asDict()
    return {**found, "model_id": model_id, "refitted": refitted, "drifted": drifted}
