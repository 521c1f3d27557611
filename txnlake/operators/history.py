"""Which ids of a large batch Silver already holds, without shuffling the ids of earlier batches.

Each batch leaves a filter of its ids beside its rows: blocks of eight words with one bit per id in
each, about sixteen ids to a block. A later batch meets only these blocks. What may be known is
then looked up in the rows themselves, so the filter decides what is read and never what is true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnlake.functions.jobs import written
from txnlake.functions.lookup import BROADCAST_ROWS, is_small
from txnlake.sources.lake import Lake

FILTERS = "silver.id_filters"
WORDS = [f"w{number}" for number in range(8)]
IDS_PER_BLOCK = 16
#: Filters of small batches are sparse instead of short, so that no block meets a large share of the ids.
LEAST_BLOCKS = 4096
#: Block number of the row that says how many blocks a filter has; an empty batch has no other.
SIZE_ROW = -1


def _bit(number: int) -> Column:
    """The bit of an id in one word: six bits of the second hash choose it."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_bits, {6 * number}) & 63L as int))")


def _hashed(ids: DataFrame) -> DataFrame:
    return ids.withColumns({"_at": F.xxhash64("transaction_id"), "_bits": F.xxhash64("transaction_id", F.lit(1))})


def blocks_for(rows: int) -> int:
    """A power of two, so that few different sizes exist however many batches there are."""
    return max(LEAST_BLOCKS, 1 << max(0, -(-rows // IDS_PER_BLOCK) - 1).bit_length())


def id_filter(ids: DataFrame, rows: int) -> DataFrame:
    """Filter of the column transaction_id; rows is its number of rows, or more.

    Bits are united by partial sums, so only blocks are shuffled. Null ids are in no filter.
    """
    blocks = blocks_for(rows)
    marked = _hashed(ids.filter(F.col("transaction_id").isNotNull()).select("transaction_id")).select(
        F.col("_at").bitwiseAND(blocks - 1).alias("block"), *[_bit(n).alias(word) for n, word in enumerate(WORDS)])
    united = marked.groupBy("block").agg(*[F.bit_or(word).alias(word) for word in WORDS]).select(
        F.lit(blocks).cast("long").alias("n_blocks"), "block", *WORDS)
    size = ids.sparkSession.range(1).select(
        F.lit(blocks).cast("long").alias("n_blocks"), F.lit(SIZE_ROW).cast("long").alias("block"),
        *[F.lit(0).cast("long").alias(word) for word in WORDS])
    return united.unionByName(size)


def write_filter(lake: Lake, batch_id: str) -> None:
    """Store the filter of a batch whose Silver rows are in place."""
    ids = lake.transactions(batch_id).select("transaction_id")
    lake.replace_batch(id_filter(ids, ids.count()), FILTERS, batch_id)


def possible(ids: DataFrame, filters: DataFrame) -> DataFrame:
    """(batch_id, transaction_id) of all ids that a batch may hold; none that it holds is missing."""
    # Powers of two: at most 52 values.
    sizes = [row.n_blocks for row in filters.filter(F.col("block") == SIZE_ROW).select("n_blocks").distinct().collect()]
    probes = _hashed(ids.select("transaction_id")).withColumn(
        "n_blocks", F.explode(F.array(*map(F.lit, sizes)).cast("array<long>"))).withColumn(
        "block", F.col("_at").bitwiseAND(F.col("n_blocks") - 1))
    found = probes.join(filters, ["n_blocks", "block"])
    for number, word in enumerate(WORDS):
        found = found.filter(F.col(word).bitwiseAND(_bit(number)) != 0)
    return found.select("batch_id", "transaction_id")


def known_ids(ids: DataFrame, earlier: DataFrame, filters: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Those of `ids`, each once, that `earlier` holds, as (transaction_id).

    Candidates are written and counted. Up to `limit` they are broadcast to the rows of the batches
    they may be in; beyond that a large part of the batch is known and both sides are shuffled.
    Batches without a filter, such as one whose writer stopped, are looked up directly.
    """
    candidates = written(possible(ids, filters), "candidates")
    few = is_small(candidates, limit)
    held = earlier.select("batch_id", "transaction_id").join(
        F.broadcast(candidates) if few else candidates, ["batch_id", "transaction_id"], "left_semi")
    # One row for each batch.
    covered = filters.filter(F.col("block") == SIZE_ROW).select("batch_id")
    uncovered = earlier.select("batch_id", "transaction_id").join(F.broadcast(covered), "batch_id", "left_anti").join(
        ids, "transaction_id", "left_semi")
    return held.select("transaction_id").unionByName(uncovered.select("transaction_id")).distinct()
