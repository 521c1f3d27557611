"""Raw payment feeds derived from the generic tables `events`, `customer` and `supplier`.

Every rule is plain arithmetic on the event number, so the feed can be rebuilt anywhere. Rules
marked as defects put in the rows that validation has to catch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlake import config

AS_OF = datetime(2024, 1, 31)
SECOND_BATCH = datetime(2024, 1, 16)
BATCHES = ("B1", "B2")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw transaction feed: twelve text columns and the row number."""
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn(
        "_k", F.get_json_object("props", "$.k").cast("long"))
    merchants = spark.read.parquet(f"{folder}/supplier.parquet").agg(F.count("*")).scalar()
    e, ts = F.col("event_id"), F.col("ts")
    k = F.col("_k")
    second = ts >= F.lit(SECOND_BATCH)
    amount = F.col("value").cast("decimal(18,2)")

    repeated = F.when(e % 125 == 3, e - 1).when((e % 500 == 254) & second, e % 500).otherwise(e)
    status = _pick(
        ("INITIATED", "SUCCESS", "FAILED", "PENDING", "REVERSED"),
        F.array_position(F.array(*[F.lit(t) for t in (
            "view", "purchase", "error", "click", "signup")]), F.col("event_type")) - 1)
    return events.select(
        _padded("T", repeated, 10).alias("transaction_id"),
        F.when(e % 200 == 11, "").when(e % 200 == 61, F.concat(F.lit("ORPHAN_"), e))
        .otherwise(_padded("C", F.col("user_id"), 8)).alias("customer_id"),
        F.when(e % 250 == 17, F.concat(F.lit("ORPHAN_"), e))
        .otherwise(_padded("M", (e * 7 + k) % merchants, 8)).alias("merchant_id"),
        _pick(sorted(config.PAYMENT_METHODS), k % 8).alias("payment_method"),
        F.when(e % 333 == 5, F.concat(F.lit("garbage"), e))
        .when(e % 500 == 23, "2999-01-01T00:00:00+00:00")
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("timestamp"),
        F.when((e % 333 == 7) | (e % 250 == 127), "")
        .when(e % 333 == 9, (-amount).cast("string"))
        .otherwise(amount.cast("string")).alias("amount"),
        F.when(e % 250 == 29, "ZZZZ").otherwise(_pick(config.CURRENCIES, e % 10)).alias("currency"),
        F.concat(F.lit("NATION_"), (e + k) % 25).alias("country"),
        _pick(config.CHANNELS, e % 5).alias("channel"),
        _pick(config.DEVICE_TYPES, k % 4).alias("device_type"),
        F.when(e % 333 == 13, "DECLINED").when(e % 10 == 0, F.lower(status))
        .otherwise(status).alias("status"),
        F.when(second, BATCHES[1]).otherwise(BATCHES[0]).alias("batch_id"),
        e.alias("_row_seq"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return spark.read.parquet(f"{folder}/customer.parquet").select(
        _padded("C", key, 8).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), key, F.lit("@example.com")).alias("email"),
        _pick(config.CUSTOMER_SEGMENTS, key % 5).alias("segment"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("country"),
        F.date_add(F.lit("2010-01-01").cast("date"), (key % 3000).cast("int")).cast("string")
        .alias("customer_since"),
        F.lit(BATCHES[0]).alias("batch_id"),
        key.alias("_row_seq"),
    )


def merchants(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return spark.read.parquet(f"{folder}/supplier.parquet").select(
        _padded("M", key, 8).alias("merchant_id"),
        F.col("s_name").alias("name"),
        _pick(config.MERCHANT_CATEGORIES, key % 10).alias("category"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey")).alias("country"),
        F.when(key % 10 == 0, "high").when(key % 10 <= 2, "medium").otherwise("low")
        .alias("risk_category"),
        F.lit(BATCHES[0]).alias("batch_id"),
        key.alias("_row_seq"),
    )
