"""Dense integer keys in key order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from txnlake.sources.lake import Lake


def dense_keys(lake: Lake, df: DataFrame, key: str, name: str) -> DataFrame:
    """Number the rows 1..n by `key` as column `name`.

    The rows are range-partitioned and sorted, then written with their partition and their
    place in it. Writing fixes both, so a lost executor cannot renumber anything. The counts
    per partition give each partition its offset; that table has one row per partition.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    sorted_rows = df.repartitionByRange(key).sortWithinPartitions(key)
    placed = lake.stage(
        sorted_rows.withColumns({"_part": F.spark_partition_id(), "_place": place}),
        f"{name}_order")
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(
        (F.col("_offset") + F.col("_place") + 1).cast("long").alias(name), *df.columns)
