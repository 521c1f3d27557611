"""Behavioural features of each Silver transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlake.functions.jobs import together
from txnlake.functions.lookup import BROADCAST_ROWS, hot_keys, lookup
from txnlake.functions.money import cents_average, micros, money_sum, rate, ratio
from txnlake.operators.gold import weekday
from txnlake.sources.lake import Lake

# Model inputs, in order.
MODEL_INPUTS = [
    "amount", "hour_of_day", "is_weekend", "customer_avg_amount", "customer_txn_count",
    "merchant_failure_rate", "country_mismatch", "amount_ratio",
]
FEATURES = [
    "transaction_id", "customer_id", "merchant_id", "amount", "status", "payment_method",
    "txn_country", "cust_country", "hour_of_day", "is_weekend", "customer_avg_amount",
    "customer_txn_count", "merchant_failure_rate", "country_mismatch", "amount_ratio",
]


def customer_profile(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer id seen in transactions: average amount, row count and home country."""
    stats = transactions.groupBy("customer_id").agg(
        money_sum("amount").alias("total"), F.count("amount").alias("priced"),
        F.count("*").alias("customer_txn_count"))
    return stats.join(customers.select("customer_id", F.col("country").alias("cust_country")),
                      "customer_id", "left").select(
        "customer_id", "cust_country", "customer_txn_count",
        cents_average(F.col("total"), F.col("priced")).alias("customer_avg_amount"))


def merchant_profile(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Failure rate per known merchant; a merchant without transactions has rate 0."""
    stats = transactions.groupBy("merchant_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "FAILED").alias("failed"))
    return merchants.select("merchant_id").join(stats, "merchant_id", "left").select(
        "merchant_id",
        F.coalesce(rate(F.col("failed"), F.col("n"), 4), F.lit(0.0)).alias("merchant_failure_rate"))


def extract_features(lake: Lake, transactions: DataFrame | None = None, scope: str = "all",
                     limit: int = BROADCAST_ROWS, rows: DataFrame | None = None) -> DataFrame:
    """Fifteen columns per transaction.

    Both profiles are summed and written first; each has one row per key, so the wide rows
    are joined twice and never meet a busy key unsalted. `scope` keeps the profiles of
    different sets of transactions apart. `rows` are the transactions that get features, when
    these are not all whose profiles are taken.
    """
    transactions = lake.transactions() if transactions is None else transactions
    customers, merchants = together(
        lambda: lake.stage(customer_profile(transactions, lake.customers()),
                           f"customer_profile_{scope}"),
        lambda: lake.stage(merchant_profile(transactions, lake.entity_ids("merchants")),
                           f"merchant_profile_{scope}"))
    rows = transactions if rows is None else rows
    df = rows
    for key, profile in (("customer_id", customers), ("merchant_id", merchants)):
        df = lookup(df, profile, key, salt_by="transaction_id", limit=limit,
                    hot=lambda key=key: hot_keys(rows, key))
    average = F.coalesce("customer_avg_amount", "amount")
    # amount / (average + 0.01) in whole numbers: millionths over hundredths.
    hundredths = F.round(average * 100).cast("long") + 1
    return df.select(
        "transaction_id", "customer_id", "merchant_id", "amount", "status", "payment_method",
        F.col("country").alias("txn_country"), "cust_country",
        F.hour("ts").alias("hour_of_day"),
        weekday(F.col("ts")).isin(0, 6).cast("int").alias("is_weekend"),
        average.alias("customer_avg_amount"),
        F.coalesce("customer_txn_count", F.lit(1)).alias("customer_txn_count"),
        F.coalesce("merchant_failure_rate", F.lit(0.0)).alias("merchant_failure_rate"),
        F.when(F.col("country") != F.col("cust_country"), 1).otherwise(0).alias("country_mismatch"),
        ratio(micros(F.col("amount")), hundredths * 100, 1, 100).alias("amount_ratio"),
    )


def model_inputs(features: DataFrame) -> DataFrame:
    """Model inputs as doubles, with nulls filled by 0."""
    return features.withColumns({c: F.col(c).cast("double") for c in MODEL_INPUTS}).na.fill(
        0.0, MODEL_INPUTS)
