"""Named reports over Gold.

Each report first sums the fact table by a surrogate key, in partial sums, and joins the
dimension to the sums. So no join ever meets the rows of a busy key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.functions.lookup import is_small, lookup
from txnlake.functions.money import cents, cents_average, money_sum, percent
from txnlake.functions.quantiles import WHOLE, quantiles

MEASURES = ("rows", "transactions", "priced", "total", "succeeded", "failed")


def summed(fact: DataFrame, *keys: str | Column) -> DataFrame:
    """All measures of the fact table by some keys."""
    return fact.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count("transaction_id").alias("transactions"),
        F.count("amount").alias("priced"),
        money_sum("amount").alias("total"),
        F.count_if("is_success").alias("succeeded"),
        F.count_if("is_failed").alias("failed"))


def _total() -> Column:
    return cents(F.col("total"))


def _average() -> Column:
    return cents_average(F.col("total"), F.col("priced"))


def _failure_rate() -> Column:
    return percent(F.col("failed"), F.col("rows"))


def daily_volume(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return summed(fact, "date_sk").join(dates.select("date_sk", "full_date"), "date_sk").select(
        F.col("full_date").alias("transaction_date"),
        F.col("transactions").alias("total_transactions"),
        F.col("total").cast("double").alias("total_value_gbp"),
        _average().alias("avg_transaction_amount"),
        F.col("succeeded").alias("successful_transactions"),
        F.col("failed").alias("failed_transactions"),
    ).orderBy(F.desc("transaction_date"))


def weekend_volume(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Volume and value of weekend days.

    The days are known only when the date dimension was filtered; the scan of the fact table
    waits for them and reads the partitions of these days alone.
    """
    # Spark prunes by a comparison; a bare flag is not thought to be selective.
    days = dates.filter("day_of_week IN (0, 6)").select("date_sk", "full_date", "day_name")
    return summed(fact, "date_sk").join(days, "date_sk").select(
        "full_date", "day_name", F.col("transactions").alias("total_transactions"),
        F.col("total").cast("double").alias("total_value_gbp"), _average().alias("avg_transaction_amount"))


def status_mix(fact: DataFrame) -> DataFrame:
    # Silver admits five statuses, so the window runs over five rows.
    counted = fact.groupBy("status").agg(F.count("*").alias("transaction_count"))
    whole = F.sum("transaction_count").over(Window.partitionBy())
    return counted.select(
        "status", "transaction_count",
        percent(F.col("transaction_count"), whole).alias("percentage"),
    ).orderBy(F.desc("transaction_count"), "status")


def method_failures(fact: DataFrame, methods: DataFrame) -> DataFrame:
    return summed(fact, "payment_method_sk").join(
        F.broadcast(methods), "payment_method_sk"  # a fixed list of eight
    ).select(
        "payment_method", "method_group",
        F.col("rows").alias("total_transactions"),
        F.col("failed").alias("failed_transactions"),
        _failure_rate().alias("failure_rate_pct"),
        _average().alias("avg_amount_gbp"),
    ).orderBy(F.desc_nulls_last("failure_rate_pct"), "payment_method")


def top_merchants_by_value(fact: DataFrame, merchants: DataFrame, k: int = 10) -> DataFrame:
    return summed(fact, "merchant_sk").join(merchants, "merchant_sk").select(
        "merchant_id",
        F.col("name").alias("merchant_name"), F.col("category").alias("merchant_category"),
        "risk_category",
        F.col("transactions").alias("total_transactions"),
        _total().alias("total_value_gbp"),
        _average().alias("avg_transaction_value"),
        _failure_rate().alias("failure_rate_pct"),
    ).orderBy(F.desc_nulls_last("total_value_gbp"), "merchant_id").limit(k).drop("merchant_id")


def top_merchants_by_failure(fact: DataFrame, merchants: DataFrame, k: int = 10,
                             at_least: int = 10) -> DataFrame:
    busy = summed(fact, "merchant_sk").filter(F.col("transactions") >= at_least)
    return busy.join(merchants, "merchant_sk").select(
        "merchant_id",
        F.col("name").alias("merchant_name"), F.col("category").alias("merchant_category"),
        "risk_category", F.col("country").alias("merchant_country"),
        F.col("transactions").alias("total_transactions"),
        F.col("failed").alias("failed_transactions"),
        _failure_rate().alias("failure_rate_pct"),
    ).orderBy(F.desc_nulls_last("failure_rate_pct"), "merchant_id").limit(k).drop("merchant_id")


def country_volume(fact: DataFrame, k: int = 20) -> DataFrame:
    return summed(fact, "country").select(
        F.col("country").alias("transaction_country"),
        F.col("rows").alias("total_transactions"),
        _total().alias("total_value_gbp"),
        _average().alias("avg_value_gbp"),
        _failure_rate().alias("failure_rate_pct"),
    ).orderBy(F.desc("total_transactions"), F.asc_nulls_last("transaction_country")).limit(k)


def country_failures(fact: DataFrame, at_least: int = 50) -> DataFrame:
    return summed(fact, "country").filter(F.col("rows") >= at_least).select(
        "country",
        F.col("rows").alias("total_transactions"),
        F.col("failed"),
        _failure_rate().alias("failure_rate_pct"),
        _total().alias("total_value_gbp"),
    ).orderBy(F.desc_nulls_last("failure_rate_pct"), F.asc_nulls_last("country"))


def top_countries(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k countries with most rows, from counts by country and something else."""
    return counts.groupBy("country").agg(F.sum("transaction_count").alias("txn_count")).orderBy(
        F.desc("txn_count"), F.asc_nulls_last("country")).limit(k)


def method_mix_by_country(fact: DataFrame, methods: DataFrame, k: int = 10) -> DataFrame:
    counts = fact.groupBy("country", "payment_method_sk").agg(
        F.count("*").alias("transaction_count"))
    kept = counts.join(F.broadcast(top_countries(counts, k)), "country", "left_semi").join(
        F.broadcast(methods), "payment_method_sk")
    whole = F.sum("transaction_count").over(Window.partitionBy("country"))
    return kept.select(
        "country", "payment_method", "transaction_count",
        percent(F.col("transaction_count"), whole).alias("pct_within_country"),
    ).orderBy("country", F.desc("transaction_count"), "payment_method")


def segment_amount_medians(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """(segment, median_cents): exact median, rounded half up to whole cents."""
    segments = customers.select("customer_sk", "segment")
    amounts = lookup(fact.select("customer_sk", "transaction_id", "amount"), segments,
                     "customer_sk", how="inner", salt_by="transaction_id")
    # Millionths as whole numbers keep the mean of two middle values exact.
    amounts = amounts.withColumn("micros", F.round(F.col("amount") * 1_000_000))
    few = is_small(customers.select("segment").distinct(), 1_000)
    return quantiles(amounts, "micros", ["segment"], [0.5], few, is_small(fact, WHOLE)).select(
        "segment", F.floor((F.col("quantile") + 5_000) / 10_000).alias("median_cents"))


def segment_spend(fact: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = summed(fact, "customer_sk").join(
        customers.select("customer_sk", "segment"), "customer_sk")
    # One row per customer, so counting rows counts distinct customers.
    segments = per_customer.groupBy("segment").agg(
        F.count("*").alias("customers"),
        *[F.sum(name).alias(name) for name in MEASURES])
    medians = segment_amount_medians(fact, customers).withColumnRenamed("segment", "_segment")
    return segments.join(
        medians, F.col("segment").eqNullSafe(F.col("_segment")), "left"
    ).select(
        F.col("segment").alias("customer_segment"),
        F.col("customers").alias("customer_count"),
        F.col("transactions").alias("total_transactions"),
        _average().alias("avg_transaction_amount_gbp"),
        (F.col("median_cents") / 100.0).alias("median_transaction_amount_gbp"),
        _total().alias("total_spend_gbp"),
        _failure_rate().alias("failure_rate_pct"),
    ).orderBy(F.desc_nulls_last("avg_transaction_amount_gbp"), "customer_segment")


def hourly_volume(fact: DataFrame) -> DataFrame:
    timed = fact.filter(F.col("ts").isNotNull())
    return summed(timed, F.hour("ts").alias("hour_of_day")).select(
        "hour_of_day",
        F.col("rows").alias("total_transactions"),
        _total().alias("total_value_gbp"),
        F.col("failed").alias("failed_transactions"),
        _failure_rate().alias("failure_rate_pct"),
    ).orderBy("hour_of_day")


def daily_kpis(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily figures for dashboards, with a failure rate that is null on a day of no ids."""
    return summed(fact, "date_sk").join(dates.select("date_sk", "full_date"), "date_sk").select(
        F.col("full_date").alias("metric_date"),
        F.col("transactions").alias("total_transactions"),
        F.col("total").cast("double").alias("total_volume_gbp"),
        _average().alias("avg_ticket_size_gbp"),
        F.col("succeeded").alias("success_count"),
        F.col("failed").alias("failed_count"),
        percent(F.col("failed"), F.col("transactions")).alias("failure_rate_pct"),
    )


def merchant_performance(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    return summed(fact, "merchant_sk").join(merchants, "merchant_sk").select(
        F.col("name").alias("merchant_name"), F.col("category").alias("merchant_category"),
        "risk_category", F.col("country").alias("merchant_country"),
        F.col("transactions").alias("transaction_count"),
        _total().alias("total_processed_gbp"),
        percent(F.col("failed"), F.col("transactions")).alias("failure_rate_pct"),
    )
