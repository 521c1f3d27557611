"""Promotion gates over the model record and over batch reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Required fields and limits of both gates.
MODEL_FIELDS = ["feature_columns", "high_risk_rate", "model_name", "model_type", "training_rows"]
MODEL_TYPE = "IsolationForest"
LEAST_TRAINING_ROWS = 1000
HIGH_RATE = (0.005, 0.10)
FEATURE_COUNT = 8
BATCH_FIELDS = ["batch_id", "dq_score", "control_status", "reconciliation_delta"]
LEAST_DQ_SCORE = 95.0


def _missing(df: DataFrame, fields: list[str]) -> Column:
    """The absent or null fields of a row as the text of a list, or null when all are there."""
    absent = [F.when(F.col(f).isNull() if f in df.columns else F.lit(True), F.lit(f"'{f}'"))
              for f in fields]
    names = F.concat_ws(", ", *absent)
    return F.when(names != "", F.concat(F.lit("["), names, F.lit("]")))


def model_gate(metadata: DataFrame) -> DataFrame:
    """Add passed and message; the message lists every failed rule."""
    missing = _missing(metadata, MODEL_FIELDS)
    for field in MODEL_FIELDS:
        if field not in metadata.columns:
            metadata = metadata.withColumn(field, F.lit(None))
    failures = F.concat_ws(
        "; ",
        F.when(F.col("model_type") != MODEL_TYPE, "unexpected model type"),
        F.when(F.col("training_rows") < LEAST_TRAINING_ROWS, "insufficient training rows"),
        F.when(~F.col("high_risk_rate").between(*HIGH_RATE),
               "high-risk rate outside operational guardrail [0.5%, 10%]"),
        F.when(F.size(F.col("feature_columns").try_cast("array<string>")) != FEATURE_COUNT,
               "unexpected feature count"),
    )
    problem = F.when(missing.isNotNull(), F.concat(F.lit("missing metadata fields: "), missing)).when(
        failures != "", failures)
    return metadata.withColumns({
        "passed": problem.isNull(),
        "message": F.when(problem.isNull(), "MODEL_VALIDATION_PASSED").otherwise(
            F.concat(F.lit("MODEL_VALIDATION_FAILED: "), problem)),
    })


def gate_of_record(metadata: DataFrame | None, name: str) -> DataFrame:
    """(model_name, passed, message) for one stored record; one that is absent or empty fails.

    An absent record is no frame without rows, which nobody would read as a failure.
    """
    failed = f"Model metadata not found: {name}. Train a model first."
    if metadata is not None and not metadata.isEmpty():
        return model_gate(metadata).select("model_name", "passed", "message")
    session = SparkSession.active()
    return session.range(1).select(F.lit(name).alias("model_name"), F.lit(False).alias("passed"), F.lit(failed).alias("message"))


def batch_gate(reports: DataFrame) -> DataFrame:
    """(batch_id, approved, reason) for rows of batch_id, dq_score, control_status and delta.

    A report without one of the columns is an error; a row with a null field is not approved.
    """
    absent = [f for f in BATCH_FIELDS if f not in reports.columns]
    if absent:
        raise ValueError(f"Missing required fields: {absent}")
    missing = _missing(reports, BATCH_FIELDS)
    approved = (
        missing.isNull() & (F.col("dq_score") >= LEAST_DQ_SCORE)
        & (F.col("control_status") == "PASS") & (F.col("reconciliation_delta") == 0)
    )
    return reports.select(
        "batch_id", F.coalesce(approved, F.lit(False)).alias("approved"),
        F.when(missing.isNotNull(), F.concat(F.lit("Missing required fields: "), missing))
        .when(approved, "validation_passed")
        .otherwise("data_quality_or_control_gate_failed").alias("reason"))
