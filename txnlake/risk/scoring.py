"""The risk job and the record it keeps of the model."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlake import schemas
from txnlake.functions.money import rate
from txnlake.operators.bronze import utc_now
from txnlake.risk.calibrate import calibrate
from txnlake.risk.explain import add_explanations
from txnlake.risk.features import MODEL_INPUTS, extract_features
from txnlake.risk.gates import gate_of_record
from txnlake.risk.iforest import ForestParams, fit_and_score
from txnlake.sources.lake import Lake

MODEL_NAME = "txnlake-isolation-forest"
MODEL_TYPE = "IsolationForest"  # fixed value, tested by the gate


def tier_counts(scored: DataFrame) -> DataFrame:
    at = lambda name: F.count_if(F.col("risk_tier") == name)
    return scored.agg(F.count("*").alias("total_scored"), at("HIGH").alias("high_risk"),
                      at("MEDIUM").alias("medium_risk"), at("LOW").alias("low_risk"))


def scored_transactions(lake: Lake, params: ForestParams | None = None) -> DataFrame:
    """Features with raw score, risk score and tier."""
    features = lake.stage(extract_features(lake), "features")
    return calibrate(fit_and_score(lake, features, params))


def run_risk_scoring(spark: SparkSession, lake_root: str, params: ForestParams | None = None,
                     scored_at: datetime | None = None) -> dict[str, int]:
    """Score all Silver transactions into gold.fact_transactions_risk (full refresh)."""
    lake = Lake(spark, lake_root)
    explained = add_explanations(scored_transactions(lake, params)).withColumn(
        "_scored_at", F.lit(scored_at or utc_now()).cast("timestamp_ntz"))
    lake.replace(explained, "gold.fact_transactions_risk")
    lake.clear_staging()
    return tier_counts(lake.read("gold.fact_transactions_risk")).first().asDict()


def model_metadata(scored: DataFrame, params: ForestParams | None = None,
                   by: str | None = None) -> DataFrame:
    """One row about the model (or one per value of `by`): rows, share of HIGH, mean score."""
    params = params or ForestParams()
    high = F.count_if(F.col("risk_tier") == "HIGH")
    # Scores have one decimal, so tenths are whole numbers and their mean is exact.
    tenths = F.sum(F.round(F.col("risk_score") * 10).cast("long"))
    grouped = scored.groupBy(*([by] if by else [])).agg(
        F.count("*").alias("training_rows"), high.alias("_high"), tenths.alias("_tenths"))
    name = F.concat(F.lit(f"{MODEL_NAME}/"), F.col(by)) if by else F.lit(MODEL_NAME)
    return grouped.select(
        name.alias("model_name"), F.lit(MODEL_TYPE).alias("model_type"),
        F.array(*[F.lit(c) for c in MODEL_INPUTS]).alias("feature_columns"),
        F.lit(params.contamination).alias("contamination"),
        F.lit(params.seed).alias("random_state"), "training_rows",
        rate(F.col("_high"), F.col("training_rows"), 6).alias("high_risk_rate"),
        rate(F.col("_tenths"), F.col("training_rows") * 10, 4).alias("risk_score_mean"))


def write_metadata(lake: Lake, metadata: DataFrame) -> str:
    """Keep the model record as JSON; returns its path."""
    path = f"{lake.root}/models/{MODEL_NAME}"
    metadata.select(*schemas.MODEL_METADATA.names).write.mode("overwrite").json(path)
    return path


def stored_metadata(lake: Lake) -> DataFrame | None:
    """The stored model record, or None where none was written."""
    try:
        return lake.spark.read.schema(schemas.MODEL_METADATA).json(f"{lake.root}/models/{MODEL_NAME}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def validate_model(lake: Lake) -> DataFrame:
    """The gate over the stored model record: (model_name, passed, message)."""
    return gate_of_record(stored_metadata(lake), MODEL_NAME)


def train(lake: Lake, params: ForestParams | None = None) -> dict[str, Any]:
    """Fit and score, then write the model record and return it."""
    metadata = model_metadata(scored_transactions(lake, params), params)
    write_metadata(lake, metadata)
    return stored_metadata(lake).first().asDict()
