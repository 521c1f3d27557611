"""Column contracts of every table in the lake."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(),
    "b": T.BooleanType(), "date": T.DateType(), "ts": T.TimestampNTZType(),
    "dec": T.DecimalType(18, 6), "ds": T.ArrayType(T.DoubleType()),
}


def _struct(spec: str) -> T.StructType:
    """Build a schema from 'name:type' words; a missing type means string."""
    fields = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "s"], True))
    return T.StructType(fields)


# Raw files: every column is text.
RAW = {
    "transactions": _struct(
        "transaction_id customer_id merchant_id payment_method timestamp amount currency "
        "country channel device_type status batch_id"),
    "customers": _struct("customer_id name email segment country customer_since"),
    "merchants": _struct("merchant_id name category country risk_category"),
}

_LINEAGE = " _source_batch_id _row_seq:l _ingested_at:ts batch_id"

TABLES = {
    "bronze.raw_transactions": _struct(
        "transaction_id customer_id merchant_id payment_method timestamp amount currency "
        "country channel device_type status" + _LINEAGE),
    "bronze.raw_customers": _struct(
        "customer_id name email segment country customer_since" + _LINEAGE),
    "bronze.raw_merchants": _struct(
        "merchant_id name category country risk_category" + _LINEAGE),
    "bronze.ingestion_audit": _struct(
        "audit_id source_file table_name schema_version ingestion_timestamp:ts record_count:l "
        "success_count:l failure_count:l status error_detail batch_id"),
    "silver.customers_by_batch": _struct(
        "customer_id name email segment country customer_since:date _loaded_at:ts batch_id"),
    "silver.merchants_by_batch": _struct(
        "merchant_id name category country risk_category _loaded_at:ts batch_id"),
    # Silver and quarantine leave one job as one dataset, split by the route partition.
    "silver.routed": _struct(
        "transaction_id customer_id merchant_id payment_method ts:ts amount:d currency country "
        "channel device_type status raw_record rejection_reason _loaded_at:ts batch_id route"),
    "silver.repeated_ids": _struct("transaction_id first_seq:l copies:l batch_id"),
    "silver.id_filters": _struct(
        "n_blocks:l block:l w0:l w1:l w2:l w3:l w4:l w5:l w6:l w7:l batch_id"),
    "gold.dim_date": _struct(
        "date_sk:i full_date:date year:i quarter:i month:i month_name week_of_year:i "
        "day_of_month:i day_of_week:i day_name is_weekend:b"),
    "gold.dim_customer": _struct(
        "customer_sk:i customer_id name email segment country customer_since:date"),
    "gold.dim_merchant": _struct(
        "merchant_sk:i merchant_id name category country risk_category"),
    "gold.dim_payment_method": _struct("payment_method_sk:i payment_method method_group"),
    "gold.fact_transactions": _struct(
        "transaction_id customer_sk:i merchant_sk:i payment_method_sk:i ts:ts amount:d currency "
        "country channel device_type status is_success:b is_failed:b is_reversed:b batch_id "
        "date_sk:i"),
    "gold.fact_transactions_risk": _struct(
        "transaction_id amount:d risk_score:d risk_tier risk_reasons amount_ratio:d "
        "merchant_failure_rate:d country_mismatch:i _scored_at:ts"),
    "gold.risk_by_batch": _struct(
        "transaction_id amount:d anomaly_score:d risk_score:d risk_tier risk_reasons amount_ratio:d "
        "merchant_failure_rate:d country_mismatch:i _scored_at:ts model_id batch_id"),
    # Versions of the model; batch_id is the name of the version.
    "models.versions": _struct("training_rows:l fitted_at:ts batch_id"),
    "models.forest_nodes": _struct(
        "tree:i node:i feature:i threshold:d left_node:i right_node:i path_length:d sample_rows:i batch_id"),
    "models.score_bounds": _struct("low:d high:d batch_id"),
    "models.drift_profile": _struct("feature edges:ds ref_pct:ds batch_id"),
    "models.drift_counts": _struct("model_id feature bin:i rows:l batch_id"),
}

# Column order shown to readers, where it differs from the stored order.
SILVER_TRANSACTIONS = [
    "transaction_id", "customer_id", "merchant_id", "payment_method", "ts", "amount", "currency",
    "country", "channel", "device_type", "status", "batch_id", "_loaded_at",
]
SILVER_QUARANTINE = ["transaction_id", "raw_record", "rejection_reason", "batch_id",
                     "_quarantined_at"]
SILVER_CUSTOMERS = ["customer_id", "name", "email", "segment", "country", "customer_since",
                    "batch_id", "_loaded_at"]
SILVER_MERCHANTS = ["merchant_id", "name", "category", "country", "risk_category", "batch_id",
                    "_loaded_at"]
FACT = [
    "transaction_id", "customer_sk", "merchant_sk", "payment_method_sk", "date_sk", "ts",
    "amount", "currency", "country", "channel", "device_type", "status", "is_success",
    "is_failed", "is_reversed", "batch_id",
]

DQ_RESULT = _struct(
    "dataset check_name check_type records_checked:l records_failed:l failure_rate:d status "
    "execution_timestamp detail")
CONTROL_RESULT = _struct(
    "control_id control_name status detail records_checked:l records_failed:l "
    "execution_timestamp remediation")
MODEL_METADATA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("contamination", T.DoubleType()),
    T.StructField("random_state", T.IntegerType()),
    T.StructField("training_rows", T.LongType()),
    T.StructField("high_risk_rate", T.DoubleType()),
    T.StructField("risk_score_mean", T.DoubleType()),
])

# Columns the schema control expects in the three Gold tables it covers.
CONTROLLED_GOLD = {
    "gold.fact_transactions": FACT,
    "gold.dim_customer": TABLES["gold.dim_customer"].names,
    "gold.dim_merchant": TABLES["gold.dim_merchant"].names,
}
