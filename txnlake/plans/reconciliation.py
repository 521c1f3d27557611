"""Proof that every raw row of a batch ended in Silver or in quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnlake.functions.money import percent
from txnlake.sources.lake import Lake


def _layers(lake: Lake) -> dict[str, DataFrame]:
    return {
        "bronze.raw_transactions": lake.read("bronze.raw_transactions"),
        "silver.transactions": lake.transactions(),
        "silver.quarantine": lake.quarantine(),
    }


def layer_record_counts(lake: Lake, batch_id: str) -> DataFrame:
    """(layer, record_count) of one batch. Filters on partitions, so only footers are read."""
    counts = [
        rows.filter(F.col("batch_id") == batch_id).agg(F.count("*").alias("record_count")).select(
            F.lit(layer).alias("layer"), "record_count")
        for layer, rows in _layers(lake).items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def batch_counts(lake: Lake) -> DataFrame:
    """(batch_id, raw_count, silver_count, quarantine_count) of all batches in one pass."""
    tagged = [
        rows.select("batch_id", F.lit(layer).alias("layer")) for layer, rows in _layers(lake).items()]
    layer = F.col("layer")
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy("batch_id").agg(
        F.count_if(layer == "bronze.raw_transactions").alias("raw_count"),
        F.count_if(layer == "silver.transactions").alias("silver_count"),
        F.count_if(layer == "silver.quarantine").alias("quarantine_count"))


def reconcile(counts: DataFrame) -> DataFrame:
    """Add accounted_count, delta and the verdict to batch counts."""
    accounted = F.col("silver_count") + F.col("quarantine_count")
    delta = F.col("raw_count") - accounted
    return counts.withColumns({
        "accounted_count": accounted,
        "delta": delta,
        "reconciliation_status": F.when(delta == 0, "PASS — fully reconciled").otherwise(
            F.concat(F.lit("FAIL — unaccounted records: "), delta.cast("string"))),
    })


def reconciliation(lake: Lake, batch_id: str) -> DataFrame:
    """One row for one batch, also when the batch does not exist."""
    one = [
        rows.filter(F.col("batch_id") == batch_id).agg(F.count("*")).scalar()
        for rows in _layers(lake).values()]
    single = lake.spark.range(1).select(
        one[0].alias("raw_count"), one[1].alias("silver_count"), one[2].alias("quarantine_count"))
    return reconcile(single)


def top_rejections(quarantine: DataFrame, k: int = 20) -> DataFrame:
    """Most frequent reason texts with their share of all rejected rows."""
    # Texts name ids, so there may be as many of them as rows: the total is its own count.
    total = quarantine.agg(F.count("*")).scalar()
    return quarantine.groupBy("rejection_reason").agg(
        F.count("*").alias("occurrence_count")).orderBy(
        F.desc("occurrence_count"), "rejection_reason").limit(k).withColumn(
        "pct_of_quarantine", percent(F.col("occurrence_count"), total))
