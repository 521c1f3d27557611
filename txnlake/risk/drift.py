"""Population stability index of features against a reference profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.functions.lookup import is_small
from txnlake.functions.quantiles import WHOLE, quantiles, unpivoted
from txnlake.sources.lake import Lake

# Watched features, number of bins, least share of a bin, drift threshold.
WATCHED = ["amount", "amount_ratio", "customer_txn_count", "merchant_failure_rate", "hour_of_day"]
BINS = 10
LEAST_SHARE = 1e-6
THRESHOLD = 0.20


def reference_edges(features: DataFrame) -> DataFrame:
    """(feature, edges): distinct deciles of each watched feature of a stored frame."""
    shares = [i * (1 / BINS) for i in range(BINS)] + [1.0]
    cut = quantiles(unpivoted(features, WATCHED), "value", ["feature"], shares, True,
                    is_small(features, WHOLE // len(WATCHED)))
    return cut.groupBy("feature").agg(
        F.array_sort(F.collect_set("quantile")).alias("edges"))  # at most BINS + 1 values


def _bin(value: Column, edges: Column) -> Column:
    """Bin number from 0; the last bin is closed, values outside all bins are null."""
    last = F.element_at(edges, -1)
    inside = F.size(F.filter(edges, lambda edge: edge <= value)) - 1
    return F.when(value == last, F.size(edges) - 2).when(
        (value >= F.element_at(edges, 1)) & (value < last), inside)


def histogram(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """(feature, bin, rows); bin is null for values outside the edges."""
    # `edges` has one row per watched feature.
    return rows.filter(F.col("value").isNotNull()).join(F.broadcast(edges), "feature").groupBy(
        "feature", _bin(F.col("value"), F.col("edges")).alias("bin")).agg(
        F.count("*").alias("rows"))


def bin_shares(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """(feature, edges, bin, share, out_of_range) of a histogram, one row for every bin, empty ones included."""
    # At most BINS + 1 rows per feature from here on.
    feature, binned = Window.partitionBy("feature"), F.col("bin").isNotNull()
    over = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("rows"))).over(feature), F.lit(0))
    bins = edges.withColumn("bin", F.explode(
        F.sequence(F.lit(0), F.greatest(F.size("edges") - 2, F.lit(0)))))
    every = counts.unionByName(bins.select("feature", "bin", F.lit(0).cast("long").alias("rows")))
    summed = every.groupBy("feature", "bin").agg(F.sum("rows").alias("rows")).withColumns(
        {"total": over(binned), "out_of_range": over(~binned)}).filter(binned)
    share = F.col("rows") / F.greatest(F.col("total"), F.lit(1))
    return summed.join(F.broadcast(edges), "feature").select(
        "feature", "edges", "bin", share.alias("share"), "out_of_range")


def build_reference(lake: Lake, features: DataFrame, name: str = "drift") -> DataFrame:
    """(feature, edges, ref_pct) of a stored frame: bin edges and bin shares, nothing else.

    The profile is kept in the lake under `name`.
    """
    edges = lake.stage(reference_edges(features), f"{name}_edges")
    shares = bin_shares(histogram(unpivoted(features, WATCHED), edges), edges).groupBy("feature", "edges").agg(
        F.array_sort(F.collect_list(F.struct("bin", "share"))).alias("bins"))  # at most BINS
    return lake.stage(shares.select("feature", "edges", F.col("bins.share").alias("ref_pct")),
                      f"{name}_profile")


def stability(features: DataFrame, profile: DataFrame) -> DataFrame:
    """(feature, psi, out_of_range) with the exact index. Fewer than three edges give 0."""
    return stability_of_counts(histogram(unpivoted(features, WATCHED), profile.select("feature", "edges")), profile)


def stability_of_counts(counts: DataFrame, profile: DataFrame) -> DataFrame:
    """The same from a histogram (feature, bin, rows) over the bins of the profile."""
    current = bin_shares(counts, profile.select("feature", "edges"))
    reference = profile.select(
        "feature", F.posexplode("ref_pct").alias("bin", "ref_share"))
    now = F.greatest(F.col("share"), F.lit(LEAST_SHARE))
    then = F.greatest(F.col("ref_share"), F.lit(LEAST_SHARE))
    term = (now - then) * F.log(now / then)
    terms = current.join(reference, ["feature", "bin"]).groupBy("feature").agg(
        F.array_sort(F.collect_list(F.struct("bin", term.alias("term")))).alias("terms"),
        F.max(F.size("edges")).alias("n_edges"), F.max("out_of_range").alias("out_of_range"))
    total = F.aggregate(F.col("terms.term"), F.lit(0.0), lambda a, b: a + b)
    return terms.select("feature", F.when(F.col("n_edges") < 3, 0.0).otherwise(total).alias("psi"),
                        "out_of_range")


def monitor(features: DataFrame, profile: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(feature, psi, status, out_of_range): DRIFT from the threshold on."""
    return verdicts(stability(features, profile), threshold)


def verdicts(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return found.select(
        "feature", F.round("psi", 4).alias("psi"),
        F.when(F.col("psi") >= threshold, "DRIFT").otherwise("STABLE").alias("status"),
        "out_of_range")
