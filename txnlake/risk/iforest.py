"""Isolation forest (Liu, Ting and Zhou, 2008) on Spark.

Each tree is grown in its own group from at most `per_tree` rows. Rows and splits are drawn by MD5
of the seed, the tree and the node, so the forest does not depend on partitions, order or retries,
and SQL can grow the same one. The grown forest is a small
table of nodes (trees x at most 2*per_tree - 1 rows), which is why scoring may broadcast it.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.risk.features import MODEL_INPUTS, model_inputs
from txnlake.sources.lake import Lake

NODES = (
    "tree int, node int, feature int, threshold double, left_node int, right_node int, "
    "path_length double, sample_rows int"
)

# Functions of this module travel to the workers themselves, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    per_tree: int = 256
    seed: int = 42
    contamination: float = 0.03  # kept with the model; scores and tiers do not use it

    def __post_init__(self) -> None:
        if not 2 <= self.per_tree <= 4096 or not 1 <= self.trees <= 1000:
            raise ValueError("a forest has 1..1000 trees of 2..4096 rows")


#: Draws of rows are places modulo this prime.
PRIME = (1 << 31) - 1
#: Parts of a unit that path lengths are counted in, so that their sums are exact, and decimals of a score.
PATH_UNITS, SCORE_DECIMALS = 10**9, 9


def drawn(*parts: object) -> int:
    """A number below 2^52 from the MD5 of some values joined by colons."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16)


def sample_rows(inputs: DataFrame, rows: int, params: ForestParams, key: str = "transaction_id") -> DataFrame:
    """Rows (tree, place, inputs...): `per_tree` rows per tree, drawn without replacement.

    A row has one hash; each tree turns it into a place of its own, by a factor and a shift modulo
    a prime, and takes the rows with its lowest places. Every row is open to every tree, however
    many there are. Only places below a bound that about four times the wanted rows reach are sorted,
    so a tree falls short practically never.
    """
    bound = F.lit(PRIME if rows <= 4 * params.per_tree else 4 * params.per_tree * PRIME // rows + 1)
    numbers = [(1 + drawn(params.seed, tree, "factor") % (PRIME - 1), drawn(params.seed, tree, "shift") % PRIME)
               for tree in range(params.trees)]
    factors, shifts = (F.array(*[F.lit(pair[at]).cast("long") for pair in numbers]) for at in (0, 1))
    digest = F.md5(F.concat_ws(":", F.lit("row"), F.col(key).cast("string")))
    hashed = inputs.select(key, *MODEL_INPUTS, F.pmod(
        F.conv(F.substring(digest, 1, 13), 16, 10).cast("long"), F.lit(PRIME)).alias("_hash"))
    place = lambda tree: (F.col("_hash") * F.get(factors, tree) + F.get(shifts, tree)) % PRIME
    trees = F.array(*[F.lit(tree) for tree in range(params.trees)])
    open_to = hashed.withColumn("tree", F.explode(F.filter(trees, lambda tree: place(tree) < bound))).withColumn(
        "_at", place(F.col("tree")))
    lowest = Window.partitionBy("tree").orderBy("_at", key)
    return open_to.withColumn("place", F.row_number().over(lowest)).filter(
        F.col("place") <= params.per_tree).select("tree", "place", *MODEL_INPUTS)


def expected_path(rows: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among so many rows."""
    n = np.maximum(np.asarray(rows, dtype=float), 2.0)
    long = 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n
    rows = np.asarray(rows)
    return np.where(rows > 2, long, np.where(rows == 2, 1.0, 0.0))


def grow_tree(data: np.ndarray, tree: int, seed: int) -> list[tuple]:
    """Nodes of one tree over at most a few thousand rows; the root is 1, node n has the children 2n and 2n + 1."""
    limit = int(np.ceil(np.log2(max(len(data), 2))))
    nodes: list[tuple] = []
    open_nodes = [(1, np.arange(len(data)), 0)]
    while open_nodes:
        node, members, depth = open_nodes.pop()
        part = data[members]
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(members) <= 1 or len(splittable) == 0:
            path = round(depth + float(expected_path(len(members))), 9)
            nodes.append((tree, node, -1, 0.0, -1, -1, path, len(data)))
            continue
        feature = int(splittable[drawn(seed, tree, node, "feature") % len(splittable)])
        share = drawn(seed, tree, node, "cut") / float(1 << 52)
        cut = float(low[feature] + (high[feature] - low[feature]) * share)
        goes_left = part[:, feature] <= cut
        nodes.append((tree, node, feature, cut, 2 * node, 2 * node + 1, 0.0, len(data)))
        open_nodes += [(2 * node, members[goes_left], depth + 1), (2 * node + 1, members[~goes_left], depth + 1)]
    return nodes


def fit(features: DataFrame, rows: int, params: ForestParams | None = None) -> DataFrame:
    """Node table of a forest over `features`, which has `rows` rows."""
    params = params or ForestParams()

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        nodes = grow_tree(group[MODEL_INPUTS].to_numpy(float), int(group["tree"].iloc[0]),
                          params.seed)
        return pd.DataFrame(nodes, columns=[f.split()[0] for f in NODES.split(", ")])

    return sample_rows(model_inputs(features), rows, params).groupBy("tree").applyInPandas(
        grow, NODES)


def node_arrays(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """The node table as one array per column, with a row per tree."""
    trees = {tree: number for number, tree in enumerate(sorted(nodes["tree"].unique()))}
    place = (nodes["tree"].map(trees).to_numpy(), nodes["node"].to_numpy())
    arrays = {}
    for column in ("feature", "threshold", "left_node", "right_node", "path_length"):
        values = nodes[column].to_numpy()
        arrays[column] = np.zeros((len(trees), int(nodes["node"].max()) + 1), values.dtype)
        arrays[column][place] = values
    # Paths in whole units, so that their sums do not depend on the order.
    arrays["path_length"] = np.rint(arrays["path_length"] * PATH_UNITS).astype(np.int64)
    arrays["sample_rows"] = nodes["sample_rows"].max()
    return arrays


def score_rows(forest: dict[str, np.ndarray], data: np.ndarray) -> np.ndarray:
    """Raw score of each row of `data`; all rows walk down all trees level by level."""
    sample = int(forest["sample_rows"])
    row = np.arange(len(data))[:, None]
    tree = np.arange(len(forest["feature"]))[None, :]
    node = np.ones((len(data), tree.shape[1]), dtype=int)
    for _ in range(int(np.ceil(np.log2(max(sample, 2))))):
        feature = forest["feature"][tree, node]
        inner = feature >= 0
        goes_left = data[row, np.where(inner, feature, 0)] <= forest["threshold"][tree, node]
        child = np.where(goes_left, forest["left_node"][tree, node], forest["right_node"][tree, node])
        node = np.where(inner, child, node)
    depth = forest["path_length"][tree, node].sum(axis=1) / (float(PATH_UNITS) * tree.shape[1])
    return np.round(-np.exp2(-depth / max(float(expected_path(sample)), 1e-12)), SCORE_DECIMALS)


def score(features: DataFrame, nodes: DataFrame, column: str = "anomaly_score") -> DataFrame:
    """Add the raw score: minus 2^(-mean path / normal path), so lower is more anomalous.

    All rows of an Arrow batch walk down all trees together, which takes about a tenth of the
    time of higher-order functions over the node table.
    """
    # The forest has a fixed largest size, see ForestParams.
    forest = features.sparkSession.sparkContext.broadcast(node_arrays(nodes.toPandas()))

    @F.pandas_udf("double")
    def scorer(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            data = np.column_stack([c.to_numpy(float) for c in columns])
            yield pd.Series(score_rows(forest.value, np.nan_to_num(data, nan=0.0)))

    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in MODEL_INPUTS]
    return features.withColumn(column, scorer(*filled))


def fit_and_score(lake: Lake, features: DataFrame, params: ForestParams | None = None) -> DataFrame:
    """Features with raw scores, written once. The node table is kept beside them."""
    nodes = lake.stage(fit(features, features.count(), params), "iforest_nodes")
    return lake.stage(score(features, nodes), "anomaly_scores")
