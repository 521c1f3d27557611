"""The isolation forest in SQL: rows and splits are drawn by MD5, one level of all trees after the other."""

from __future__ import annotations

import re

from oracle.prelude import CTES, quantile_rows

TREES, PER_TREE, SEED, DEPTH = 100, 256, 42, 8
PRIME = 2**31 - 1
INPUTS = ("amount hour_of_day is_weekend customer_avg_amount customer_txn_count merchant_failure_rate "
          "country_mismatch amount_ratio").split()
LEVELS = "abcdefghi"


def _draw(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


# Mean path of an unsuccessful search among n rows.
PATH = """CASE WHEN n > 2 THEN 2.0::DOUBLE * (ln(n - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE)
  - 2.0::DOUBLE * (n - 1) / n WHEN n = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"""


def _splits(level: int) -> str:
    """Nodes of one level: rows, and the feature and cut of those that are split."""
    low, high = (", ".join(f"{end}(x[{at}])" for at in range(1, len(INPUTS) + 1)) for end in ("min", "max"))
    return f"""
    SELECT *, low[feature] + (high[feature] - low[feature])
        * (CAST({_draw(f"'{SEED}:' || tree || ':' || node || ':cut'")} AS DOUBLE) / 4503599627370496.0::DOUBLE) AS cut
    FROM (SELECT *, CASE WHEN n > 1 AND len(wide) > 0 AND {level} < (SELECT ceil(log2(greatest(max(rows), 2))) FROM forest_size)
            THEN wide[1 + {_draw(f"'{SEED}:' || tree || ':' || node || ':feature'")} % len(wide)] END AS feature
        FROM (SELECT *, list_filter(range(1, {len(INPUTS) + 1}), lambda i: high[i] > low[i]) AS wide
            FROM (SELECT tree, node, count(*) AS n, [{low}] AS low, [{high}] AS high
                FROM forest_members_{LEVELS[level]} GROUP BY tree, node)))"""


CTES["forest_rows"] = f"""
    SELECT transaction_id, [{", ".join(f"CAST(COALESCE({name}, 0) AS DOUBLE)" for name in INPUTS)}] AS x,
      {_draw("'row:' || transaction_id")} % {PRIME} AS hash FROM features"""
CTES["forest_trees"] = f"""
    SELECT tree, 1 + {_draw(f"'{SEED}:' || tree || ':factor'")} % {PRIME - 1} AS factor,
      {_draw(f"'{SEED}:' || tree || ':shift'")} % {PRIME} AS shift FROM (SELECT unnest(range({TREES})) AS tree)"""
CTES["forest_members_a"] = f"""
    SELECT tree, CAST(1 AS BIGINT) AS node, x FROM (SELECT tree, x, row_number() OVER (
        PARTITION BY tree ORDER BY (hash * factor + shift) % {PRIME}, transaction_id) AS place
      FROM forest_rows CROSS JOIN forest_trees) WHERE place <= {PER_TREE}"""
CTES["forest_size"] = "SELECT tree, count(*) AS rows FROM forest_members_a GROUP BY tree"
for at in range(DEPTH + 1):
    CTES[f"forest_splits_{LEVELS[at]}"] = _splits(at)
    if at < DEPTH:
        CTES[f"forest_members_{LEVELS[at + 1]}"] = f"""
    SELECT m.tree, 2 * m.node + CASE WHEN m.x[s.feature] <= s.cut THEN 0 ELSE 1 END AS node, m.x
    FROM forest_members_{LEVELS[at]} m JOIN forest_splits_{LEVELS[at]} s ON m.tree = s.tree AND m.node = s.node
    WHERE s.feature IS NOT NULL"""
CTES["forest_nodes"] = " UNION ALL ".join(
    f"SELECT tree, node, feature, cut, CAST(round(({at} + {PATH}) * 1000000000) AS BIGINT) AS path FROM forest_splits_{LEVELS[at]}"
    for at in range(DEPTH + 1))
CTES["forest_walk_a"] = "SELECT transaction_id, x, tree, CAST(1 AS BIGINT) AS node FROM forest_rows CROSS JOIN forest_trees"
for at in range(DEPTH):
    CTES[f"forest_walk_{LEVELS[at + 1]}"] = f"""
    SELECT w.transaction_id, w.x, w.tree, CASE WHEN f.feature IS NULL THEN w.node
      WHEN w.x[f.feature] <= f.cut THEN 2 * w.node ELSE 2 * w.node + 1 END AS node
    FROM forest_walk_{LEVELS[at]} w JOIN forest_nodes f ON f.tree = w.tree AND f.node = w.node"""
CTES["forest_scored"] = f"""
    SELECT f.*, s.anomaly_score FROM features f JOIN (
      SELECT transaction_id, round(-pow(2.0::DOUBLE, -(CAST(sum(path) AS DOUBLE) / (1000000000.0::DOUBLE * {TREES}))
        / (SELECT any_value({PATH}) FROM (SELECT max(rows) AS n FROM forest_size))), 9) AS anomaly_score
      FROM forest_walk_{LEVELS[DEPTH]} w JOIN forest_nodes n ON n.tree = w.tree AND n.node = w.node
      GROUP BY transaction_id) s ON s.transaction_id = f.transaction_id"""
CTES["forest_quantiles"] = quantile_rows("forest_scored", "anomaly_score", "one", [0.01, 0.99]).replace(
    "SELECT one AS grp", "SELECT 1 AS grp").replace("PARTITION BY one", "PARTITION BY 1")
CTES["forest_calibrated"] = CTES["calibrated"].replace("score_quantiles", "forest_quantiles").replace(
    "FROM scored s", "FROM forest_scored s")

# The same forest over the rows of the first batch; it scores these, whose scores give the bounds, and the second batch.
for name in [name for name in CTES if name.startswith("forest_")]:
    CTES[f"first_{name}"] = re.sub(r"\bforest_", "first_forest_", CTES[name])
CTES["walked_features"] = """
    SELECT *, TRUE AS fitted FROM first_features UNION ALL SELECT *, FALSE AS fitted FROM second_features"""
CTES["walked_rows"] = CTES["forest_rows"].replace("FROM features", "FROM walked_features")
CTES["first_forest_rows"] = CTES["forest_rows"].replace("FROM features", "FROM first_features")
CTES["first_forest_walk_a"] = CTES["first_forest_walk_a"].replace("FROM first_forest_rows", "FROM walked_rows")
CTES["first_forest_scored"] = CTES["first_forest_scored"].replace("FROM features f", "FROM walked_features f")
CTES["first_forest_quantiles"] = CTES["first_forest_quantiles"].replace(
    "FROM first_forest_scored WHERE", "FROM first_forest_scored WHERE fitted AND")
