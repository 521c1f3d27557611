"""Gold: a star schema over Silver."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlake import schemas
from txnlake.config import Config
from txnlake.functions.jobs import together
from txnlake.functions.keys import dense_keys
from txnlake.functions.lookup import BROADCAST_ROWS, hot_keys, lookup
from txnlake.operators.silver import build_silver
from txnlake.sources.lake import Lake


def date_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd").cast("int")


def weekday(moment: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(moment) - 1


def status_flags(status: Column) -> dict[str, Column]:
    return {"is_success": status == "SUCCESS", "is_failed": status == "FAILED",
            "is_reversed": status == "REVERSED"}


def dim_date(transactions: DataFrame) -> DataFrame:
    """One row per date that occurs in Silver."""
    day = F.col("full_date")
    days = transactions.filter(F.col("ts").isNotNull()).select(
        F.to_date("ts").alias("full_date")).distinct()
    return days.select(
        date_key(day).alias("date_sk"), "full_date",
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"), F.day(day).alias("day_of_month"),
        weekday(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        weekday(day).isin(0, 6).alias("is_weekend"),
    )


def dim_payment_method(spark: SparkSession, cfg: Config) -> DataFrame:
    """The fixed list of methods, numbered in alphabetical order."""
    rows = [(number, method, cfg.method_groups.get(method, "other"))
            for number, method in enumerate(sorted(cfg.payment_methods), start=1)]
    return spark.createDataFrame(rows, schemas.TABLES["gold.dim_payment_method"])


def dim_customer(lake: Lake) -> DataFrame:
    columns = [c for c in schemas.TABLES["gold.dim_customer"].names if c != "customer_sk"]
    return dense_keys(lake, lake.customers().select(*columns), "customer_id", "customer_sk")


def dim_merchant(lake: Lake) -> DataFrame:
    columns = [c for c in schemas.TABLES["gold.dim_merchant"].names if c != "merchant_sk"]
    return dense_keys(lake, lake.merchants().select(*columns), "merchant_id", "merchant_sk")


def fact_transactions(transactions: DataFrame, customers: DataFrame, merchants: DataFrame,
                      methods: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """One row per Silver row; a key without a dimension row stays null."""
    df = transactions
    for table, key, surrogate in ((customers, "customer_id", "customer_sk"),
                                  (merchants, "merchant_id", "merchant_sk")):
        df = lookup(df, table.select(key, surrogate), key, salt_by="transaction_id",
                    limit=limit,
                    hot=lambda key=key: hot_keys(transactions, key))
    # The list of methods is fixed.
    df = df.join(F.broadcast(methods.select("payment_method", "payment_method_sk")),
                 "payment_method", "left")
    return df.withColumn("date_sk", date_key(F.col("ts"))).withColumns(
        status_flags(F.col("status"))).select(*schemas.FACT)


def build_gold(lake: Lake, cfg: Config | None = None, limit: int = BROADCAST_ROWS) -> dict[str, int]:
    """Full refresh of all Gold tables from Silver of all batches.

    Surrogate keys depend on all ids, so the fact table follows the dimensions.
    """
    cfg = cfg or Config()
    together(
        lambda: lake.replace(dim_customer(lake), "gold.dim_customer"),
        lambda: lake.replace(dim_merchant(lake), "gold.dim_merchant"),
        lambda: lake.replace(dim_payment_method(lake.spark, cfg), "gold.dim_payment_method"),
        lambda: lake.replace(dim_date(lake.transactions()), "gold.dim_date"))
    fact = fact_transactions(
        lake.transactions(), lake.read("gold.dim_customer"), lake.read("gold.dim_merchant"),
        lake.read("gold.dim_payment_method"), limit)
    # Rows of a date meet in one place; a date with too many rows is split again.
    lake.replace(fact.hint("rebalance", "date_sk"), "gold.fact_transactions", ("date_sk",))
    names = ("fact_transactions", "dim_customer", "dim_merchant", "dim_date")
    counts = together(*[lake.read(f"gold.{name}").count for name in names])
    return dict(zip(names, counts, strict=True))


def build_warehouse(spark: SparkSession, lake_root: str, batch_id: str, cfg: Config | None = None,
                    as_of: datetime | None = None) -> dict[str, Any]:
    """Bronze to Silver for one batch, then a full refresh of Gold."""
    lake = Lake(spark, lake_root)
    return {"batch_id": batch_id, "silver": build_silver(lake, batch_id, cfg, as_of),
            "gold": build_gold(lake, cfg)}
