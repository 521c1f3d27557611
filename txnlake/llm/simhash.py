"""Near duplicates by SimHash, found with multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from txnlake.llm.common import stage, whole
from txnlake.llm.components import components

SEED = 42
BITS = 64
#: Hashes of one text that are counted at a time, which bounds the memory of very long texts.
CHUNK = 1 << 15
#: Fingerprints of a table bucket that are compared by a join; larger buckets are compared in tiles.
BUCKET = 64
#: Fingerprints in one side of a tile.
TILE = 2048


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many hashes have each bit set, lowest bit first."""
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint_of(text: str, words: int = 4) -> int:
    """Signed 64-bit SimHash of one text, see fingerprint()."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = max(1, len(tokens) - words + 1)
    first, last = starts[:count].tolist(), ends[min(words, len(tokens)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(BITS, np.int64)
    for low in range(0, count, CHUNK):
        totals += _bit_counts([digest(joined[a:b], SEED) for a, b in
                               zip(first[low:low + CHUNK], last[low:low + CHUNK])])
    return int(np.packbits(totals * 2 > count, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = 4) -> Column:
    """SimHash of a text over its word shingles, as a signed long.

    A-Z is lower-cased; words are runs without ASCII white space. All shingles count, repeats
    included. A text of fewer words is one shingle; a null text or one without words gets 0.
    """
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(text, words) for text in texts], dtype="int64")

    return run(whole(text))


def segments_for(rows: int, distance: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment for a number of fingerprints.

    Pigeonhole: if the radii add up to distance - segments + 1, two fingerprints within the
    distance agree in some segment up to its radius. More fingerprints get fewer and longer
    segments, so that buckets stay short; every choice finds the same links.
    """
    count = 4 if rows <= 1 << 18 else 3 if rows <= 1 << 24 else 2
    count = min(count, distance + 1)
    spare = distance - count + 1
    result, start = [], 0
    for place in range(count):
        width = (BITS - start) // (count - place)
        radius = spare // count + (place < spare % count)
        result.append((start, width, radius))
        start += width
    return result


def _ball(width: int, radius: int) -> list[int]:
    """All masks of a segment with at most radius bits set."""
    return [sum(1 << bit for bit in bits) for size in range(radius + 1)
            for bits in combinations(range(width), size)]


def _forest(codes: np.ndarray, others: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs within the distance between two lists of codes."""
    nodes = np.unique(np.concatenate([codes, others]))
    label = np.arange(len(nodes))
    found = []
    for code in codes:
        near = np.bitwise_count(others ^ code) <= distance
        own = label[np.searchsorted(nodes, code)]
        places = np.searchsorted(nodes, others[near])
        for group in np.unique(label[places]):
            if group != own:
                found.append((int(code), int(nodes[places[label[places] == group][0]])))
                label[label == group] = own
    return found


def _tile_links(hot: DataFrame, distance: int) -> DataFrame:
    """Links inside hot buckets (seg, key, fp, own), compared in tiles of bounded size.

    Members of a bucket meet its guests and each other. A tile returns a spanning forest of what
    it found, at most one row for each of its fingerprints, never all pairs.
    """
    sizes = hot.groupBy("seg", "key", "own").agg(F.count("*").alias("_n"))
    sizes = sizes.groupBy("seg", "key").agg(
        F.max(F.when(F.col("own"), F.col("_n"))).alias("_in"),
        F.max(F.when(~F.col("own"), F.col("_n"))).alias("_out"))
    parts = lambda n: F.greatest(F.lit(1), F.ceil(F.coalesce(n, F.lit(0)) / TILE).cast("int"))
    sizes = sizes.select("seg", "key", parts(F.col("_in")).alias("_rows"), parts(F.col("_out")).alias("_cols"))
    dealt = hot.join(sizes, ["seg", "key"]).withColumn(
        "_part", F.pmod(F.xxhash64("fp"), F.when(F.col("own"), F.col("_rows")).otherwise(F.col("_cols"))))
    # Member part i is the left side of tiles (i, j) for j >= i, and the right side for j <= i;
    # guest part g is the right side of the tiles (i, -1 - g).
    left = dealt.filter("own").withColumn("side", F.lit(0)).withColumn("i", F.col("_part")).withColumn(
        "j", F.explode(F.sequence(-F.col("_cols").cast("long"), F.col("_rows").cast("long") - 1))).filter("j < 0 OR j >= i")
    right = dealt.filter("own").withColumn("side", F.lit(1)).withColumn("j", F.col("_part")).withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_part"))))
    guests = dealt.filter("NOT own").withColumn("side", F.lit(1)).withColumn(
        "j", -1 - F.col("_part")).withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows").cast("long") - 1)))
    columns = ["seg", "key", "i", "j", "side", "fp"]
    tiles = left.select(columns).unionByName(right.select(columns)).unionByName(guests.select(columns))

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        codes = tile["fp"].to_numpy(np.int64)
        sides = tile["side"].to_numpy()
        found = _forest(np.unique(codes[sides == 0]), np.unique(codes[sides == 1]), distance)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return tiles.groupBy("seg", "key", "i", "j").applyInPandas(compare, "a long, b long")


def links(fingerprints: DataFrame, distance: int = 4) -> DataFrame:
    """Links a, b between different fingerprints (column fp) that connect all near ones.

    Each segment of a fingerprint has a table by its bits. Every fingerprint looks up a small
    Hamming ball around its own bits and verifies the complete distance of what it meets. In
    short buckets every link is returned; in buckets of over 64 members a spanning forest, so
    that a large group of near copies gives as many rows as members and not all pairs. Components
    are the same either way.
    """
    codes = stage(fingerprints.select("fp").distinct(), "fingerprints")
    segments = segments_for(codes.count(), distance)
    probe = None
    for seg, (start, width, radius) in enumerate(segments):
        key = F.shiftrightunsigned("fp", start).bitwiseAND((1 << width) - 1)
        masks = F.array(*[F.lit(mask).cast("long") for mask in _ball(width, radius)])
        part = codes.select("fp", key.alias("key"), F.explode(masks).alias("mask")).select(
            "fp", F.lit(seg).alias("seg"), F.col("key").bitwiseXOR(F.col("mask")).alias("key"),
            (F.col("mask") == 0).alias("own"))
        probe = part if probe is None else probe.unionByName(part)
    member = probe.filter("own").drop("own")
    # Hot buckets are few, but can hold many rows; both kinds are told apart by a join.
    hot = stage(member.groupBy("seg", "key").agg(F.count("*").alias("_n")).filter(F.col("_n") > BUCKET)
                .select("seg", "key"), "hot")
    cool = member.join(hot, ["seg", "key"], "left_anti").withColumnRenamed("fp", "other")
    met = probe.join(cool, ["seg", "key"]).filter(
        (F.col("fp") != F.col("other"))
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance))
    single = met.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    if hot.isEmpty():
        return single
    inside = probe.join(hot, ["seg", "key"], "left_semi")
    return single.unionByName(_tile_links(inside, distance))


def near_duplicates(rows: DataFrame, row_id: str = "doc_id", distance: int = 4) -> DataFrame:
    """Rows with a fingerprint, and component_id: the smallest id each is linked with.

    Fingerprints link at distance or fewer differing bits, and links chain. group_fp is a
    fingerprint that stands for the group. Ids that are null do not count; a group without any id
    gets null. Repeated rows are all returned. Columns of the input named component_id or group_fp
    are replaced, others pass through. An empty table gives no rows.
    """
    rows = rows.drop("component_id", "group_fp")
    marked = stage(rows, "marked")
    first = stage(marked.groupBy(F.col("fingerprint").alias("fp")).agg(
        F.min(row_id).alias("first_id")), "firsts")
    found = components(links(first, distance), "a", "b")
    rooted = stage(first.join(found.withColumnRenamed("node", "fp"), "fp", "left")
                   .select("fp", F.coalesce("root", "fp").alias("root"), "first_id"), "rooted")
    groups = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = stage(rooted.select("fp", "root").join(groups, "root").select(
        F.col("fp").alias("fingerprint"), "component_id", F.col("root").alias("group_fp")), "groups")
    return marked.join(of, "fingerprint").select(*rows.columns, "component_id", "group_fp")


def first_of_groups(rows: DataFrame, row_id: str = "doc_id", distance: int = 4) -> DataFrame:
    """One row of each group of rows with a fingerprint: the one with the smallest id.

    Null ids come after all others; of rows with the same id, the first in the written table stays.
    """
    rows = stage(rows.drop("_row_number").withColumn("_row_number", F.monotonically_increasing_id()), "numbered")
    grouped = near_duplicates(rows.select(row_id, "fingerprint", "_row_number"), row_id, distance)
    order = F.struct(F.col(row_id).isNull(), F.col(row_id), F.col("_row_number").alias("number"))
    kept = grouped.groupBy("group_fp").agg(F.min(order).alias("first")).select(F.col("first.number").alias("_row_number"))
    return rows.join(kept, "_row_number", "left_semi").drop("_row_number")
