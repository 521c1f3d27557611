"""Histogram sort: shards of near equal bytes from counted key boundaries and one exchange."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.llm.common import stage

#: Bits of the key that one counting pass refines.
STEP = 12
#: A splitter may miss its place by this share of a shard before it is refined again.
TOLERANCE = 0.001
#: Bytes that one sorting task should hold.
SORT_BYTES = 64 << 20
#: Cuts that one exchange is planned with; beyond that, sorting tasks hold more and spill.
MAX_CUTS = 1024
KEY_BITS = 64


def _ordered(column: str) -> Column:
    """A long key whose bits, read without sign, sort as the value does."""
    return F.col(column).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


class _Probe:
    """One splitter on its way: the interval of keys it lies in and what lies below that."""

    def __init__(self, target: int):
        self.target, self.prefix, self.depth = target, 0, 0
        self.bytes_below = self.rows_below = 0
        self.done = False


def _prefix(keys: list[str], depth: int) -> list[Column]:
    """The first depth bits of the joined keys, as one column for each key that takes part."""
    parts = []
    for place, key in enumerate(keys):
        bits = min(KEY_BITS, depth - place * KEY_BITS)
        if bits > 0:
            parts.append(F.shiftrightunsigned(_ordered(key), KEY_BITS - bits))
    return parts


def _next_depth(depth: int) -> int:
    """STEP bits more, without reading across the end of a key."""
    end = (depth // KEY_BITS + 1) * KEY_BITS
    return min(depth + STEP, end)


def splitters(rows: DataFrame, size: str, keys: list[str], parts: int, tolerance: float
              ) -> list[tuple[tuple[int, ...] | None, int, int]]:
    """parts - 1 boundaries (key values, bytes below, rows below) that cut rows into equal bytes.

    Each pass counts bytes and rows exactly for 4,096 candidate boundaries inside every interval
    that still holds a splitter, as partial sums in the partitions, and keeps the candidate
    interval the splitter falls into. A splitter is done when one side of its interval is within
    tolerance of its place, or when the interval cannot be divided. The driver holds at most
    4,096 counts for each boundary. A boundary above all keys has None for its values.
    """
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    allowed = tolerance * total / parts
    probes = [_Probe(round(total * place / parts)) for place in range(1, parts)]
    while open_probes := [probe for probe in probes if not probe.done]:
        for depth in sorted({probe.depth for probe in open_probes}):
            group = [probe for probe in open_probes if probe.depth == depth]
            _refine(rows, size, keys, depth, group, allowed)
    result = []
    for probe in probes:
        if probe.prefix >> probe.depth:  # past the last key
            result.append((None, probe.bytes_below, probe.rows_below))
            continue
        lifted = probe.prefix << (KEY_BITS * len(keys) - probe.depth)
        values = tuple(_signed((lifted >> (KEY_BITS * (len(keys) - 1 - place)) & ((1 << 64) - 1)) ^ (1 << 63))
                       for place in range(len(keys)))
        result.append((values, probe.bytes_below, probe.rows_below))
    return result


def _refine(rows: DataFrame, size: str, keys: list[str], depth: int, probes: list[_Probe], allowed: float) -> None:
    """One counting pass for the probes whose intervals have a prefix of depth bits."""
    finer = _next_depth(depth)
    wanted = {probe.prefix for probe in probes}
    inside = rows
    if depth:
        own = _prefix(keys, depth)
        tests = []
        for prefix in wanted:
            parts = []
            for place, column in enumerate(own):
                bits = min(KEY_BITS, depth - place * KEY_BITS)
                value = prefix >> (depth - place * KEY_BITS - bits) & ((1 << bits) - 1)
                parts.append(column == F.lit(_signed(value)).cast("long"))
            tests.append(reduce(Column.__and__, parts))
        inside = rows.filter(reduce(Column.__or__, tests))
    found = inside.groupBy(*[part.alias(f"_p{place}") for place, part in enumerate(_prefix(keys, finer))]).agg(
        F.sum(size).alias("_bytes"), F.count("*").alias("_rows")).collect()
    counts = []
    for row in found:
        prefix = 0
        for place, value in enumerate(row[:-2]):
            bits = min(KEY_BITS, finer - place * KEY_BITS)
            prefix = prefix << bits | (value & ((1 << bits) - 1))
        counts.append((prefix, row[-2], row[-1]))
    counts.sort()
    for probe in probes:
        low, n = probe.bytes_below, probe.rows_below
        below = None
        for prefix, more, count in counts:
            if prefix >> (finer - depth) != probe.prefix:
                continue
            if low + more > probe.target:
                below = prefix, more, count
                break
            low, n = low + more, n + count
        if below is None:  # all bytes of the table lie below: the end of the interval
            probe.prefix, probe.depth, probe.done = (probe.prefix + 1) << (finer - depth), finer, True
            probe.bytes_below, probe.rows_below = low, n
            continue
        prefix, more, count = below
        probe.prefix, probe.depth, probe.bytes_below, probe.rows_below = prefix, finer, low, n
        last = finer == KEY_BITS * len(keys) or count == 1
        if probe.target - low <= allowed or last and probe.target - low <= low + more - probe.target:
            probe.done = True
        elif low + more - probe.target <= allowed or last:
            probe.prefix, probe.done = prefix + 1, True
            probe.bytes_below, probe.rows_below = low + more, n + count


def _reaches(keys: list[str], values: tuple[int, ...] | None) -> Column:
    """Rows whose key is not below a boundary."""
    if values is None:
        return F.lit(False)
    test = F.col(keys[-1]) >= values[-1]
    for key, value in zip(keys[-2::-1], values[-2::-1]):
        test = (F.col(key) > value) | ((F.col(key) == value) & test)
    return test


def _piece_of(keys: list[str], cuts: list, low: int, high: int) -> Column:
    """How many of cuts[low:high] a row reaches, plus low: a binary search written as conditions."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(_reaches(keys, cuts[middle][0]), _piece_of(keys, cuts, middle + 1, high)).otherwise(
        _piece_of(keys, cuts, low, middle))


def equal_shards(rows: DataFrame, size: str, keys: list[str], shards: int,
                 tolerance: float = TOLERANCE, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """Rows with shard (0 to shards - 1) and slot (its place in the shard, without gaps).

    Shards are ranges of the key with near equal sums of size: a cut misses its place by at most
    the tolerance or by half of a row that cannot be divided. keys are columns of longs without
    nulls, the first the most significant; the row number of a staged table is added as the last
    one, so that equal keys can be divided too. Within a shard, rows are numbered in key order.
    Each shard is cut further, so that one task sorts about sort_bytes; the counts below those
    cuts give the first slot of each piece, and rows are exchanged once. Columns named shard or
    slot are replaced; an empty table gives no rows.
    """
    rows = stage(rows.drop("shard", "slot", "_row").withColumn("_row", F.monotonically_increasing_id()), "shards")
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    pieces = max(math.ceil(total / shards / sort_bytes), math.ceil(8 * _cores(rows) / shards))
    pieces = max(1, min(pieces, MAX_CUTS // shards))
    ordered = [*keys, "_row"]
    cuts = splitters(rows, size, ordered, shards * pieces, tolerance * pieces)
    piece = _piece_of(ordered, cuts, 0, len(cuts))
    firsts = [0, *[below for _, _, below in cuts]]
    start = F.array(*[F.lit(firsts[place] - firsts[place // pieces * pieces]).cast("long")
                      for place in range(shards * pieces)])
    window = Window.partitionBy("_piece").orderBy(*ordered)
    return (rows.withColumn("_piece", piece).withColumn("_place", F.row_number().over(window))
            .withColumn("shard", F.floor(F.col("_piece") / pieces).cast("int"))
            .withColumn("slot", F.col("_place") - 1 + F.get(start, F.col("_piece")))
            .drop("_piece", "_place", "_row"))


def _cores(rows: DataFrame) -> int:
    return rows.sparkSession.sparkContext.defaultParallelism


def shard_documents(documents: DataFrame, shards: int = 24, text: str = "text", row_id: str = "doc_id",
                    keep_text: bool = True) -> DataFrame:
    """All columns of the rows, with size, text_crc32, law, shard, slot and grown_shard.

    Size is the number of UTF-8 bytes of the text plus 8; a null text has none. The key is the
    hash of the text and then the id, so rows with equal texts lie side by side: a group of
    copies is only divided where a cut falls into it. The law is `bytes`; grown_shard is null,
    because one more shard moves every cut. Ids may be null or repeated. Without keep_text the
    texts are read but neither stored nor exchanged. Columns named like the results are replaced.
    """
    result = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "_hash", "_id"]
    content = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    keyed = documents.drop(*[name for name in result if name not in (text, row_id)]).withColumns({
        "size": F.octet_length(content).cast("long") + 8, "text_crc32": F.crc32(content),
        "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int"),
        "_hash": F.xxhash64(content), "_id": F.coalesce(F.col(row_id).cast("long"), F.lit(-(1 << 63)).cast("long"))})
    keyed = keyed if keep_text else keyed.drop(text)
    return equal_shards(keyed, "size", ["_hash", "_id"], shards).drop("_hash", "_id")
