"""Exact distinct counts that can be merged: bitmaps over dense keys, stored by group.

A bitmap covers 32,768 neighbouring keys in 4 KiB, so a stored group holds one row per range of
keys that occur in it. The distinct keys of any union of groups are the set bits of the OR of their
bitmaps; the rows themselves are not read again and no key is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def key_bits(rows: DataFrame, key: str, by: list[str]) -> DataFrame:
    """(*by, bucket, bits): which keys occur in each group; keys are whole numbers from 1.

    A group without any key keeps one row without bits, so it counts as 0 later on.
    """
    return rows.groupBy(*by, F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))


def distinct_keys(bits: DataFrame, by: list[str], name: str) -> DataFrame:
    """(*by, name): number of different keys in unions of the groups of key_bits."""
    united = bits.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_keys"))
    return united.groupBy(*by).agg(F.sum(F.when(F.col("bucket").isNull(), 0).otherwise(F.col("_keys"))).alias(name))
