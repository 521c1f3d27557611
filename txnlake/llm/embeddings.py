"""Near duplicates among embeddings: int8 tile products with error bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from txnlake.llm.common import stage
from txnlake.llm.components import components

#: Vectors in one side of a tile.
TILE = 4096
#: Rows of a tile that are multiplied at a time.
STRIP = 1024
#: Products of int8 codes are added up in float32 exactly as long as the sums stay below 2^24.
EXACT_DIMS = (1 << 24) // (127 * 127)
#: Allowance for rounding in the bound itself.
SLACK = 1e-6


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scales, lengths of the coded vectors and lengths of what the codes miss.

    vectors are unit vectors in double precision. For codes a, b with scales s, t, misses e, f and
    coded lengths m, n, the product of two vectors differs from s*t*(a.b) by at most m*f + n*e + e*f.
    """
    scale = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(vectors - coded, axis=1)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of int8 codes; long vectors are added up in parts."""
    total = np.zeros((len(left), len(right)))
    for low in range(0, left.shape[1], EXACT_DIMS):
        part = slice(low, low + EXACT_DIMS)
        total += left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return total


def tile_links(left: np.ndarray, right: np.ndarray, threshold: float):
    """Index pairs of unit vectors whose cosine reaches the threshold, strip by strip.

    Pairs that cannot reach it by the quantised product plus its error bound are left out; all
    others are multiplied in double precision.
    """
    right_codes, right_scale, right_length, right_miss = quantised(right)
    for low in range(0, len(left), STRIP):
        strip = left[low:low + STRIP]
        codes, scale, length, miss = quantised(strip)
        bound = np.outer(scale, right_scale) * _products(codes, right_codes)
        bound += np.outer(length, right_miss) + np.outer(miss, right_length + right_miss) + SLACK
        rows, columns = np.nonzero(bound >= threshold)
        for part in range(0, len(rows), 1 << 18):
            a, b = rows[part:part + (1 << 18)], columns[part:part + (1 << 18)]
            near = np.einsum("ij,ij->i", strip[a], right[b]) >= threshold
            yield a[near] + low, b[near]


def _forest(size: int, pairs) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Smallest connected index for each of size nodes, from batches of index pairs."""
    label = np.arange(size)
    for a, b in pairs:
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
            if (label == before).all():
                break
    while (label != label[label]).any():
        label = label[label]
    return label


def usable(vector: Column) -> Column:
    """Vectors that can link: not null, not empty, all components finite, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_embeddings(rows: DataFrame, vector: str = "embedding", label: str = "label", row_id: str = "vec_id",
                    threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """All rows with n_links, component_id and kept.

    Two rows link if their labels are equal and not null, their vectors have equal length and the
    cosine in double precision reaches the threshold. Vectors that are null, empty, zero or hold a
    null or non-finite component link with nothing: their component is their own id. n_links
    counts other rows, equal vectors included. component_id is the smallest id reachable by links;
    null ids do not count. kept is whether that is the row's own id. Columns of the input with
    the names of the results are replaced.

    Equal vectors are counted first and compared once. A label is dealt into blocks of about
    `tile` vectors, and each pair of blocks is one task that returns counts and at most one link
    for each vector, never the pairs themselves.
    """
    rows = rows.drop("n_links", "component_id", "kept")
    able = rows.filter(F.col(label).isNotNull() & usable(F.col(vector)))
    distinct = stage(able.groupBy(F.col(label).alias("_label"), F.col(vector).alias("_vector")).agg(
        F.count("*").alias("_copies"), F.min(row_id).alias("_first"))
        .withColumn("_node", F.monotonically_increasing_id()), "vectors")
    sized = distinct.withColumn("_dims", F.size("_vector"))
    blocks = stage(sized.groupBy("_label", "_dims").agg(
        F.ceil(F.count("*") / tile).cast("int").alias("_blocks")), "blocks")
    dealt = sized.join(blocks, ["_label", "_dims"]).withColumn(
        "_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    # Block b is the left side of the tiles (b, j) with j >= b and the right side of (i, b), i < b.
    left = dealt.withColumn("_i", F.col("_block")).withColumn(
        "_j", F.explode(F.sequence(F.col("_block"), F.col("_blocks") - 1)))
    right = dealt.filter("_block > 0").withColumn("_j", F.col("_block")).withColumn(
        "_i", F.explode(F.sequence(F.lit(0), F.col("_block") - 1)))

    def compare(sides: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(sides["_vector"].to_numpy()).astype(np.float64)
        values /= np.abs(values).max(axis=1)[:, None]
        values /= np.linalg.norm(values, axis=1)[:, None]
        nodes, copies = sides["_node"].to_numpy(), sides["_copies"].to_numpy()
        i, j = int(sides["_i"].iloc[0]), int(sides["_j"].iloc[0])
        first = sides["_block"].to_numpy() == i
        a, b = np.nonzero(first)[0], np.nonzero(~first)[0] if i != j else np.arange(len(sides))
        counts = np.zeros(len(sides), np.int64)

        def found():
            for x, y in tile_links(values[a], values[b], threshold):
                x, y = a[x], b[y]
                if i == j:
                    x, y = x[x < y], y[x < y]
                np.add.at(counts, x, copies[y])
                np.add.at(counts, y, copies[x])
                yield x, y

        label = _forest(len(sides), found())
        return pd.DataFrame({"node": nodes, "root": nodes[label], "n": counts})

    columns = ["_label", "_dims", "_i", "_j", "_block", "_node", "_copies", "_vector"]
    parts = stage(left.select(columns).unionByName(right.select(columns)).groupBy("_label", "_dims", "_i", "_j")
                  .applyInPandas(compare, "node long, root long, n long"), "tiles")
    counted = parts.groupBy(F.col("node").alias("_node")).agg(F.sum("n").alias("_n"))
    found = components(parts, "node", "root").withColumnRenamed("node", "_node").withColumnRenamed("root", "_root")
    rooted = stage(distinct.join(counted, "_node").join(found, "_node", "left").select(
        "_label", "_vector", "_copies", "_first", "_n", F.coalesce("_root", "_node").alias("_root")), "rooted")
    firsts = rooted.groupBy("_root").agg(F.min("_first").alias("_component"))
    of = stage(rooted.join(firsts, "_root").select("_label", "_vector", (F.col("_n") + F.col("_copies") - 1).alias("_links"),
                                                   "_component"), "groups")
    able = rows.withColumn("_able", F.col(label).isNotNull() & usable(F.col(vector)))
    joined = able.filter("_able").join(of, [F.col(label) == F.col("_label"), F.col(vector) == F.col("_vector")])
    alone = able.filter("NOT _able").withColumn("_links", F.lit(0).cast("long")).withColumn("_component", F.col(row_id))
    result = [*rows.columns, F.col("_links").alias("n_links"), F.col("_component").cast("long").alias("component_id"),
              F.coalesce(F.col(row_id) == F.col("_component"), F.lit(False)).alias("kept")]
    return joined.select(result).unionByName(alone.select(result))
