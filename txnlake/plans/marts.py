"""Staging views, intermediate models, marts and the tests on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlake.functions.money import cents, cents_average, money_sum, percent
from txnlake.operators.gold import date_key, status_flags
from txnlake.sources.lake import Lake

# Columns under the two generic tests.
NOT_NULL = {
    "int_transaction_metrics": [
        "date_sk", "metric_date", "total_transactions", "successful_transactions",
        "failed_transactions", "pending_transactions", "reversed_transactions",
        "total_transaction_value"],
    "payment_daily_metrics": ["metric_date", "total_transactions", "total_volume_gbp"],
}
UNIQUE = {"int_transaction_metrics": ["metric_date"], "payment_daily_metrics": ["metric_date"]}


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", F.col("name").alias("customer_name"), F.col("email").alias("customer_email"),
        F.col("segment").alias("customer_segment"), F.col("country").alias("customer_country"),
        "customer_since", "batch_id")


def stg_merchants(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_id", F.col("name").alias("merchant_name"),
        F.col("category").alias("merchant_category"), F.col("country").alias("merchant_country"),
        "risk_category", "batch_id")


def stg_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("date_sk", date_key(F.col("ts"))).select(
        "transaction_id", "customer_id", "merchant_id", "payment_method", "ts", "date_sk",
        "amount", "currency", "country", "channel", "device_type", "status", "batch_id",
        "_loaded_at")


def _activity(transactions: DataFrame, key: str) -> DataFrame:
    """Sums per key, so that the entity table is joined to one row per key."""
    return transactions.groupBy(key).agg(
        F.count("transaction_id").alias("n"), F.count("amount").alias("priced"),
        money_sum("amount").alias("total"),
        F.count_if(F.col("status") == "SUCCESS").alias("succeeded"),
        F.count_if(F.col("status") == "FAILED").alias("failed"))


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def int_customer_metrics(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per customer; customers without transactions stay with zero counts."""
    return customers.join(_activity(transactions, "customer_id"), "customer_id", "left").select(
        "customer_id", "customer_name", "customer_segment", "customer_country",
        _or_zero("n").alias("total_transactions"),
        cents(F.col("total")).alias("total_spend_gbp"),
        cents_average(F.col("total"), F.col("priced")).alias("avg_transaction_amount"),
        _or_zero("succeeded").alias("successful_transactions"),
        _or_zero("failed").alias("failed_transactions"),
        percent(F.col("failed"), F.col("n")).alias("failure_rate_pct"))


def int_merchant_metrics(merchants: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per merchant; merchants without transactions stay with zero counts."""
    return merchants.join(_activity(transactions, "merchant_id"), "merchant_id", "left").select(
        "merchant_id", "merchant_name", "merchant_category", "merchant_country", "risk_category",
        _or_zero("n").alias("total_transactions"),
        cents(F.col("total")).alias("total_processed_gbp"),
        cents_average(F.col("total"), F.col("priced")).alias("avg_ticket_size_gbp"),
        _or_zero("failed").alias("failed_transactions"),
        percent(F.col("failed"), F.col("n")).alias("failure_rate_pct"))


def int_transaction_metrics(transactions: DataFrame) -> DataFrame:
    """One row per day."""
    status = lambda name: F.count_if(F.col("status") == name)
    daily = transactions.groupBy("date_sk", F.to_date("ts").alias("metric_date")).agg(
        F.count("*").alias("total_transactions"),
        status("SUCCESS").alias("successful_transactions"),
        status("FAILED").alias("failed_transactions"),
        status("PENDING").alias("pending_transactions"),
        status("REVERSED").alias("reversed_transactions"),
        status("INITIATED").alias("initiated_transactions"),
        money_sum("amount").alias("total"), F.count("amount").alias("priced"),
        F.min("amount").alias("low"), F.max("amount").alias("high"))
    share = lambda name: percent(F.col(name), F.col("total_transactions"))
    two_places = lambda name: cents(F.col(name).cast("decimal(18,6)"))
    return daily.select(
        "date_sk", "metric_date", "total_transactions", "successful_transactions",
        "failed_transactions", "pending_transactions", "reversed_transactions",
        "initiated_transactions",
        cents(F.col("total")).alias("total_transaction_value"),
        cents_average(F.col("total"), F.col("priced")).alias("average_transaction_value"),
        two_places("low").alias("minimum_transaction_value"),
        two_places("high").alias("maximum_transaction_value"),
        share("successful_transactions").alias("success_rate_pct"),
        share("failed_transactions").alias("failure_rate_pct"),
        share("reversed_transactions").alias("reversal_rate_pct"))


def fct_transactions(staged: DataFrame) -> DataFrame:
    return staged.withColumns(status_flags(F.col("status"))).select(
        "transaction_id", "customer_id", "merchant_id", "payment_method", "ts", "date_sk",
        "amount", "currency", "country", "channel", "device_type", "status", "is_success",
        "is_failed", "is_reversed", "batch_id")


def payment_daily_metrics(daily: DataFrame) -> DataFrame:
    return daily.select(
        "date_sk", "metric_date", "total_transactions", "successful_transactions",
        "failed_transactions", "pending_transactions", "reversed_transactions",
        "initiated_transactions",
        F.col("total_transaction_value").alias("total_volume_gbp"),
        F.col("average_transaction_value").alias("avg_transaction_amount"),
        "success_rate_pct", "failure_rate_pct", "reversal_rate_pct",
    ).orderBy(F.desc("metric_date"))


def models(lake: Lake) -> dict[str, DataFrame]:
    """All models over Silver, in dependency order."""
    customers = stg_customers(lake.customers())
    merchants = stg_merchants(lake.merchants())
    transactions = stg_transactions(lake.transactions())
    daily = int_transaction_metrics(transactions)
    return {
        "stg_customers": customers,
        "stg_merchants": merchants,
        "stg_transactions": transactions,
        "int_customer_metrics": int_customer_metrics(customers, transactions),
        "int_merchant_metrics": int_merchant_metrics(merchants, transactions),
        "int_transaction_metrics": daily,
        "fct_transactions": fct_transactions(transactions),
        "payment_daily_metrics": payment_daily_metrics(daily),
    }


def materialise(lake: Lake, wanted: tuple[str, ...] = ("fct_transactions", "payment_daily_metrics")) -> dict[str, DataFrame]:
    """Staging and intermediate models become temporary views, the wanted marts become tables."""
    frames = models(lake)
    for name, frame in frames.items():
        if name.startswith(("stg_", "int_")):
            frame.createOrReplaceTempView(name)
        elif name in wanted:
            by_date = ("date_sk",) if name == "fct_transactions" else ()
            frames[name] = lake.mart(frame.hint("rebalance", *by_date) if by_date else frame, name, by_date)
    return frames


def not_null_violations(model: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """(model, test_column, violations) for all columns in one pass."""
    counted = model.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "test_column", "violations").select(
        F.lit(name).alias("model"), "test_column", "violations")


def unique_violations(model: DataFrame, name: str, column: str) -> DataFrame:
    """(model, test_column, violations): values that occur more than once; nulls do not count."""
    repeated = model.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("model"), F.lit(column).alias("test_column"), "violations")


def unreconciled_days(daily: DataFrame) -> DataFrame:
    """Days whose five status counts do not add up to the total; none are expected."""
    parts = sum((F.col(f"{s}_transactions") for s in (
        "failed", "pending", "reversed", "initiated")), F.col("successful_transactions"))
    return daily.select("metric_date", "total_transactions", parts.alias("status_total")).filter(
        F.col("total_transactions") != F.col("status_total"))
