"""Joins of many rows to one row per key, safe for a key that holds a large share of the rows.

A lookup side is broadcast only after its rows were counted. Past the limit both sides are
shuffled, and a key with more rows than a partition should hold is spread over as many
partitions as its share asks for: its rows get a salt, and only its lookup row is repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000
LEAST_PARTITIONS = 64


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True when df has at most `limit` rows. A stored table answers from its file footers."""
    return df.count() <= limit


def partitions_of(df: DataFrame) -> int:
    """Partitions of a shuffle in this session."""
    return max(LEAST_PARTITIONS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, _salts) of the keys with at least one partition's worth of rows.

    With P partitions that is 1/P of the rows, so there are at most P hot keys; and since a
    key gets salts by its share, all salts together are at most 2P.
    """
    partitions = partitions_of(rows)
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    weight = F.col("_n") * partitions
    total = rows.agg(F.count("*")).scalar()
    return counts.filter(weight >= total).select(
        key, F.ceil(weight / total).cast("int").alias("_salts"))


def lookup(
    rows: DataFrame, table: DataFrame, key: str, *, how: str = "left",
    salt_by: str, hot: Callable[[], DataFrame] | None = None, bound: DataFrame | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join `rows` to `table`, which has one row per key.

    `salt_by` names a column that spreads the rows of one key. `hot` may give hot_keys of a
    cheaper frame with the same keys, such as the scan below earlier joins. `bound` is a frame
    with no fewer rows than `table` that is cheaper to count.
    """
    if is_small(table if bound is None else bound, limit):
        return rows.join(F.broadcast(table), key, how)
    # At most one row per partition of the session, see hot_keys.
    hot = F.broadcast(hot_keys(rows, key) if hot is None else hot())
    # Null keys match nothing but would still meet in one partition.
    salts = F.when(F.col(key).isNull(), partitions_of(rows)).otherwise(
        F.coalesce("_salts", F.lit(1)))
    salted = rows.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(salt_by), salts).cast("int")).drop("_salts")
    repeated = table.join(hot, key, "left").withColumn("_salt", F.explode(
        F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
