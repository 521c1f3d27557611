"""Lookups, dense keys and exact quantiles."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.functions import quantiles as Q
from txnlake.functions.keys import dense_keys
from txnlake.functions.lookup import LEAST_PARTITIONS, hot_keys, lookup


def skewed(spark):
    """A third of the rows share one key, some have none."""
    return spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("key"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_broadcast_lookup(spark, how):
    rows = skewed(spark)
    table = rows.select("key").distinct().filter("key IS NOT NULL AND key <> 'k5'").withColumn(
        "value", F.length("key"))
    small = lookup(rows, table, "key", how=how, salt_by="id")
    salted = lookup(rows, table, "key", how=how, salt_by="id", limit=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_salt_spreads_the_hot_key(spark):
    rows = skewed(spark)
    table = rows.select("key").distinct().filter("key IS NOT NULL")
    plan = lookup(rows, table, "key", salt_by="id", limit=0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = lookup(rows, table, "key", salt_by="id", limit=0)
        sizes = [r["count"] for r in plan.filter("key = 'hot'").groupBy(
            F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 6 and max(sizes) < 1000


def test_hot_keys_are_few(spark):
    found = {r.key: r._salts for r in hot_keys(skewed(spark), "key").collect()}
    assert found == {"hot": -(-LEAST_PARTITIONS // 3)}
    uniform = spark.range(6400).withColumn("key", F.col("id") % LEAST_PARTITIONS)
    assert {r._salts for r in hot_keys(uniform, "key").collect()} == {1}
    assert hot_keys(uniform, "key").count() == LEAST_PARTITIONS


def test_dense_keys_follow_key_order(lake):
    df = lake.spark.range(5000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("name"), (F.col("id") * 2).alias("twice"))
    rows = dense_keys(lake, df.repartition(13), "name", "sk").orderBy("name").collect()
    assert [r.sk for r in rows] == list(range(1, 5001))


def test_dense_keys_of_nothing(lake):
    df = lake.spark.createDataFrame([], "name string")
    assert dense_keys(lake, df, "name", "sk").count() == 0


SHARES = [0.0, 0.01, 0.1, 0.30000000000000004, 0.5, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["normal", "ties", "one", "two"])
@pytest.mark.parametrize("path", ["small", "refined", "few bins"])
def test_quantiles_equal_numpy(spark, monkeypatch, kind, path):
    random = np.random.default_rng(5)
    data = {"normal": random.normal(size=40_000), "ties": random.integers(0, 7, 40_000) / 4,
            "one": np.array([3.25]), "two": np.array([1.0, 2.0])}[kind]
    if path == "few bins":
        monkeypatch.setattr(Q, "BINS", 64)  # more passes
    df = spark.createDataFrame([(float(v),) for v in data], "v double").repartition(5)
    found = Q.quantiles(df, "v", [], SHARES, small=path == "small")
    got = {r.share: r.quantile for r in found.collect()}
    assert [got[s] for s in SHARES] == list(np.quantile(data, SHARES))


@pytest.mark.parametrize("small", [True, False])
def test_quantiles_per_group_with_a_null_group(spark, small):
    df = spark.sql("SELECT if(id % 3 = 0, null, id % 3) AS g, double(id) AS v FROM range(300)")
    got = {r.g: r.quantile for r in Q.quantiles(df, "v", ["g"], [0.5], small=small).collect()}
    assert got == {None: 148.5, 1: 149.5, 2: 150.5}


def test_refinement_of_ties_infinities_and_nulls(spark):
    values = [float("-inf")] * 40 + [float("inf")] * 30 + [1e308, -1e308, 0.0, -0.0] * 20 + [0.25] * 50
    data = [(g, v) for g in ("a", None) for v in [*values, *[float(i) for i in range(500)]]] + [("a", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    got = {(r.g, r.share): r.quantile for r in Q.quantiles(df, "v", ["g"], [0.0, 0.3, 0.9, 1.0]).collect()}
    ordered = sorted(v for g, v in data if g is None)
    for share in (0.3, 0.9):
        place = share * (len(ordered) - 1)
        low, high = ordered[int(place)], ordered[int(place) + 1]
        for g in ("a", None):
            assert got[g, share] == pytest.approx(low + (high - low) * (place - int(place)))


@pytest.mark.parametrize("kind", ["tiny", "wide", "below zero", "both signs", "subnormal"])
def test_refinement_of_any_range(spark, kind):
    """Values hundreds of decades apart end in single values after a few passes."""
    random = np.random.default_rng(3)
    powers = 10.0 ** random.uniform(-300, 300, 3000)
    data = {"tiny": random.uniform(size=3000) * 1e-12 + 1.0, "wide": powers, "below zero": -powers,
            "both signs": powers[:1500].tolist() + (-powers[1500:]).tolist(), "subnormal": np.arange(3000) * 5e-324}[kind]
    df = spark.createDataFrame([(float(v),) for v in data], "v double").repartition(4)
    got = {r.share: r.quantile for r in Q.quantiles(df, "v", [], [0.0, 0.25, 0.5, 1.0]).collect()}
    ordered = sorted(map(float, data))
    assert got[0.0] == ordered[0] and got[1.0] == ordered[-1]
    for share in (0.25, 0.5):
        place = share * 2999
        assert ordered[int(place)] <= got[share] <= ordered[int(place) + 1]


def test_bins_never_fall(spark):
    random = np.random.default_rng(8)
    for low, high in ((-1.0, 5.0), (1e-9, 1e7), (-1e200, -1e-200), (float("-inf"), 3.0), (-1.7e308, 1.7e308)):
        inside = sorted({*np.clip(random.normal(size=500) * 10.0 ** random.integers(-9, 9, 500), max(low, -1e300), min(high, 1e300)).tolist(), low, high})
        rows = spark.createDataFrame([(low, high, v) for v in inside], "low double, high double, _v double")
        bins = [r.bin for r in rows.select("_v", F.struct("low", "high").alias("_b")).select("_v", Q._bin().alias("bin")).orderBy("_v").collect()]
        assert bins == sorted(bins) and bins[0] == 0 and bins[-1] == Q.BINS - 1 and max(bins[1:-1]) < Q.BINS - 1 and min(bins[1:-1]) > 0


def test_a_pass_moves_no_rows_but_bins(spark):
    """The plan of a pass has partial counts below every exchange of the rows."""
    rows = spark.range(200_000).select(F.struct(F.lit(1).alias("all")).alias("_g"), F.rand(3).alias("_v"))
    found = Q._refined(rows, ["floor(0.5D * (_n - 1))"], F.broadcast)
    assert found.first()["_at"][99_999] == sorted(r._v for r in rows.select("_v").collect())[99_999]


def test_distinct_keys_of_unions(spark):
    """Bitmaps of days give the distinct keys of any set of days; null keys and far keys are counted right."""
    from txnlake.functions.distinct import distinct_keys, key_bits
    rows = [(day, key) for day in range(6) for key in (1, 32768, 32769, day + 2, 10**6 * day + 40000, None)] + [(9, None), (None, 5)]
    df = spark.createDataFrame(rows, "day int, key int")
    bits = key_bits(df, "key", ["day"])
    for ranges in ([0, 1], [2, 3, 4, 5, 9], [9], list(range(10))):
        picked = distinct_keys(bits.filter(bits.day.isin(ranges)), [], "n").first().n
        assert picked == len({key for day, key in rows if day in ranges and key is not None})
    each = {row.day: row.n for row in distinct_keys(bits, ["day"], "n").collect()}
    assert each == {day: len({key for d, key in rows if d == day and key is not None}) for day in {day for day, _ in rows}}


def test_weekend_report_prunes_dates_at_run_time(spark, folder):
    from txnlake.plans import reports
    from txnlake.plans.workspace import lake_for
    lake = lake_for(spark, folder)
    found = reports.weekend_volume(lake.fact(), lake.read("gold.dim_date"))
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert any("dynamicpruning" in line and "date_sk" in line for line in scans)
