"""Forest, calibration, reasons, drift and gates."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.risk import calibrate, drift, explain, gates, iforest, scoring, stored
from txnlake.risk.features import FEATURES, MODEL_INPUTS

SMALL = iforest.ForestParams(trees=25, per_tree=64)


def feature_rows(spark, n=2000):
    """Ordinary rows and one extreme row."""
    u = lambda name, low, high: (
        F.pmod(F.xxhash64("id", F.lit(name)), F.lit(10_000)) / 10_000.0 * (high - low) + low)
    df = spark.range(n).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), u("a", 5, 100).alias("amount"),
        F.floor(u("h", 8, 20)).cast("int").alias("hour_of_day"), F.lit(0).alias("is_weekend"),
        u("c", 40, 60).alias("customer_avg_amount"), F.floor(u("n", 30, 60)).alias("customer_txn_count"),
        u("m", 0.01, 0.08).alias("merchant_failure_rate"), F.lit(0).alias("country_mismatch"),
        u("r", 0.2, 1.9).alias("amount_ratio"), F.lit("GB").alias("cust_country"),
        F.lit("FR").alias("txn_country"))
    odd = {"amount": 5200.0, "hour_of_day": 3, "customer_txn_count": 2, "merchant_failure_rate": 0.45,
           "country_mismatch": 1, "amount_ratio": 130.0}
    return df.withColumns({
        c: F.when(F.col("transaction_id") == "T7", F.lit(v)).otherwise(F.col(c)) for c, v in odd.items()})


def test_path_length_of_a_random_tree():
    assert list(iforest.expected_path(np.array([0, 1, 2]))) == [0.0, 0.0, 1.0]
    assert iforest.expected_path(256) == pytest.approx(10.244770920116851)


def test_tree_isolates_every_distinct_row():
    nodes = iforest.grow_tree(np.arange(8.0).reshape(-1, 1), 0, 1)
    leaves = [n for n in nodes if n[2] == -1]
    assert len(nodes) == 2 * len(leaves) - 1
    assert max(n[6] for n in leaves) <= 3 + iforest.expected_path(8)


def test_constant_rows_make_one_leaf():
    assert len(iforest.grow_tree(np.ones((50, 3)), 0, 1)) == 1


def test_forest_does_not_depend_on_partitions(spark):
    rows = feature_rows(spark)
    first = iforest.fit(rows, 2000, SMALL).orderBy("tree", "node").collect()
    again = iforest.fit(rows.repartition(7, F.rand(3)), 2000, SMALL).orderBy("tree", "node").collect()
    assert first == again
    sizes = {r.tree: r.sample_rows for r in first}
    assert set(sizes) == set(range(25)) and set(sizes.values()) == {64}


def test_draws_are_the_lowest_places(spark):
    """The bound on places changes nothing: at any size, a tree has the rows of its lowest places."""
    inputs = iforest.model_inputs(feature_rows(spark))
    ids = [r.transaction_id for r in inputs.select("transaction_id").collect()]
    params = iforest.ForestParams(trees=4, per_tree=16)
    found = iforest.sample_rows(inputs, 2000, params).collect()
    amounts = {r.transaction_id: r.amount for r in inputs.collect()}
    for tree in range(4):
        factor = 1 + iforest.drawn(42, tree, "factor") % (iforest.PRIME - 1)
        shift = iforest.drawn(42, tree, "shift") % iforest.PRIME
        place = {one: (iforest.drawn("row", one) % iforest.PRIME * factor + shift) % iforest.PRIME for one in ids}
        expected = [amounts[one] for one in sorted(ids, key=lambda one: (place[one], one))[:16]]
        assert [r.amount for r in sorted((r for r in found if r.tree == tree), key=lambda r: r.place)] == expected
    whole = iforest.sample_rows(inputs, 1, params).select("tree", "place", "amount").collect()
    assert {tuple(r) for r in whole} == {(r.tree, r.place, r.amount) for r in found}


def test_other_seed_gives_another_forest(spark):
    rows = feature_rows(spark, 300)
    params = iforest.ForestParams(trees=5, per_tree=64, seed=1)
    other = iforest.ForestParams(trees=5, per_tree=64, seed=2)
    assert iforest.fit(rows, 300, params).collect() != iforest.fit(rows, 300, other).collect()


def test_scoring_end_to_end(lake):
    rows = lake.stage(feature_rows(lake.spark), "rows")
    scored = calibrate.calibrate(iforest.fit_and_score(lake, rows, SMALL))
    raw = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert -1 < raw[0] < raw[1] < 0
    risk = scored.selectExpr("min(risk_score)", "max(risk_score)", "count_if(risk_tier IS NULL)").first()
    assert (risk[0], risk[1], risk[2]) == (0.0, 100.0, 0)
    odd = explain.add_explanations(scored).filter("transaction_id = 'T7'").first()
    assert odd.risk_tier == "HIGH"
    # Most trees have not seen the odd row; to them it is one corner of the data among others.
    assert scored.filter(F.col("anomaly_score") < odd.anomaly_score).count() < 20
    assert odd.risk_reasons.count(" | ") == 2
    record = scoring.model_metadata(scored, SMALL).first()
    assert (record.training_rows, record.feature_columns) == (2000, MODEL_INPUTS)
    counts = scoring.tier_counts(scored).first()
    assert counts.high_risk + counts.medium_risk + counts.low_risk == counts.total_scored == 2000


def test_outlier_is_the_most_anomalous_when_every_tree_sees_it(lake):
    rows = lake.stage(feature_rows(lake.spark, 100), "rows")
    scored = iforest.fit_and_score(lake, rows, iforest.ForestParams(trees=50))
    assert scored.orderBy("anomaly_score").first().transaction_id == "T7"


def test_equal_scores_are_all_low(lake):
    flat = lake.spark.range(10).select(F.lit(-0.5).alias("anomaly_score"))
    assert {(r.risk_score, r.risk_tier) for r in calibrate.calibrate(flat).collect()} == {(0.0, "LOW")}


def test_tier_limits(spark):
    df = spark.createDataFrame([(45.0,), (45.1,), (75.0,), (75.1,)], "s double")
    assert [r[0] for r in df.select(calibrate.tier(F.col("s"))).collect()] == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH"]


BASE = {"amount": 10.0, "amount_ratio": 1.0, "customer_avg_amount": 10.0, "country_mismatch": 0,
        "cust_country": "GB", "txn_country": "FR", "merchant_failure_rate": 0.0,
        "customer_txn_count": 50, "hour_of_day": 12, "risk_tier": "HIGH"}


@pytest.fixture(scope="module")
def reasons_of(spark):
    def reasons(**changes):
        row = {**BASE, **changes}
        kinds = {float: "double", int: "int", str: "string"}
        schema = ", ".join(f"{k} {kinds[type(BASE[k])]}" for k in row)
        return spark.createDataFrame([tuple(row.values())], schema).select(
            explain.risk_reasons()).first()[0]

    return reasons


@pytest.mark.parametrize(("change", "text"), [
    ({"amount": 4200.0, "amount_ratio": 6.5, "customer_avg_amount": 646.15},
     "Transaction amount (4200.00) is 6.5x customer historical average (646.15)"),
    ({"amount": 5000.01}, "Unusually high absolute transaction amount (5000.01)"),
    ({"country_mismatch": 1},
     "Cross-border anomaly: customer country (GB) differs from transaction country (FR)"),
    ({"merchant_failure_rate": 0.2},
     "Elevated merchant risk profile (20.0% historical payment failure rate)"),
    ({"customer_txn_count": 5, "amount": 500.01},
     "Sparse customer history: high value transaction on nascent account"),
    ({"hour_of_day": 4, "amount": 1000.5},
     "Off-peak execution window (04:00 UTC) with substantial value"),
    ({}, "Multi-dimensional multivariate outlier detected by Isolation Forest"),
    ({"risk_tier": "MEDIUM"}, "Standard risk profile within baseline expectations"),
    ({"risk_tier": "LOW", "country_mismatch": 1}, "Within standard baseline behavior"),
])
def test_reasons(reasons_of, change, text):
    assert reasons_of(**change) == text


def test_first_three_of_five_reasons(reasons_of):
    found = reasons_of(amount=6000.0, country_mismatch=1, cust_country="A | B",
                       merchant_failure_rate=0.385, customer_txn_count=1, hour_of_day=2)
    assert found == (
        "Unusually high absolute transaction amount (6000.00) | Cross-border anomaly: customer "
        "country (A | B) differs from transaction country (FR) | Elevated merchant risk profile "
        "(38.5% historical payment failure rate)")


def watched(spark, shift=0.0, seed=1, n=20_000, constant=False):
    """Five watched features, the first of them shifted by some standard deviations."""
    draws = {c: F.randn(seed + i) for i, c in enumerate(drift.WATCHED)}
    draws["amount"] = F.lit(1.0) if constant else draws["amount"] + shift
    return spark.range(n).select(*[c.alias(name) for name, c in draws.items()])


def numpy_psi(reference, current):
    edges = np.unique(np.quantile(reference, np.linspace(0, 1, 11)))
    if len(edges) < 3:
        return 0.0
    ref, cur = (np.histogram(x, bins=edges)[0] for x in (reference, current))
    ref, cur = (np.clip(h / max(h.sum(), 1), 1e-6, None) for h in (ref, cur))
    return float(((cur - ref) * np.log(cur / ref)).sum())


def test_psi(lake):
    spark = lake.spark
    reference = lake.stage(watched(spark), "reference")
    profile = drift.build_reference(lake, reference)

    def psi(frame):
        return {r.feature: r for r in drift.monitor(frame, profile).collect()}

    assert all(r.psi == 0 and r.out_of_range == 0 for r in psi(reference).values())
    shifted = lake.stage(watched(spark, shift=1.5, seed=50), "shifted")
    found = psi(shifted)
    assert {f for f, r in found.items() if r.status == "DRIFT"} == {"amount"}
    assert all(r.psi < 0.05 for f, r in found.items() if f != "amount")
    a, b = (np.array([r.amount for r in df.select("amount").collect()]) for df in (reference, shifted))
    exact = {r.feature: r.psi for r in drift.stability(shifted, profile).collect()}["amount"]
    assert exact == pytest.approx(numpy_psi(a, b), rel=1e-9)
    outside = psi(spark.range(100).select(*[F.lit(99.0).alias(c) for c in drift.WATCHED]))
    assert outside["amount"].out_of_range == 100 and outside["amount"].status == "DRIFT"


def test_psi_of_a_constant_reference(lake):
    reference = lake.stage(watched(lake.spark, constant=True, n=500), "reference")
    profile = drift.build_reference(lake, reference, "flat")
    found = {r.feature: r.psi for r in drift.monitor(
        lake.stage(watched(lake.spark, n=500), "now"), profile).collect()}
    assert found["amount"] == 0.0 and set(found) == set(drift.WATCHED)


RECORD = {"model_name": "m", "model_type": "IsolationForest", "feature_columns": ["x"] * 8,
          "training_rows": 72_053, "high_risk_rate": 0.045}


@pytest.mark.parametrize(("change", "message"), [
    ({}, "MODEL_VALIDATION_PASSED"),
    ({"high_risk_rate": 0.005, "training_rows": 1000}, "MODEL_VALIDATION_PASSED"),
    ({"model_type": "Other"}, "MODEL_VALIDATION_FAILED: unexpected model type"),
    ({"training_rows": 999}, "MODEL_VALIDATION_FAILED: insufficient training rows"),
    ({"high_risk_rate": 0.101}, "MODEL_VALIDATION_FAILED: high-risk rate outside operational "
                                "guardrail [0.5%, 10%]"),
    ({"feature_columns": ["x"] * 7, "training_rows": 1},
     "MODEL_VALIDATION_FAILED: insufficient training rows; unexpected feature count"),
    ({"training_rows": None, "model_name": None},
     "MODEL_VALIDATION_FAILED: missing metadata fields: ['model_name', 'training_rows']"),
])
def test_model_gate(spark, change, message):
    schema = ("model_name string, model_type string, feature_columns array<string>, "
              "training_rows long, high_risk_rate double")
    df = spark.createDataFrame([tuple({**RECORD, **change}.values())], schema)
    row = gates.model_gate(df).first()
    assert (row.message, row.passed) == (message, message.endswith("PASSED"))


def test_model_gate_without_a_column(spark):
    df = spark.createDataFrame([("m", "IsolationForest", 5000, 0.05)],
                               "model_name string, model_type string, training_rows long, high_risk_rate double")
    assert gates.model_gate(df).first().message.endswith("fields: ['feature_columns']")


def test_batch_gate(spark):
    rows = [("a", 95.0, "PASS", 0), ("b", 94.9, "PASS", 0), ("c", 100.0, "FAIL", 0),
            ("d", 100.0, "PASS", 1), ("e", None, "PASS", 0)]
    df = spark.createDataFrame(
        rows, "batch_id string, dq_score double, control_status string, reconciliation_delta long")
    found = {r.batch_id: (r.approved, r.reason) for r in gates.batch_gate(df).collect()}
    bad = (False, "data_quality_or_control_gate_failed")
    assert found == {"a": (True, "validation_passed"), "b": bad, "c": bad, "d": bad,
                     "e": (False, "Missing required fields: ['dq_score']")}
    with pytest.raises(ValueError, match="Missing required fields"):
        gates.batch_gate(df.drop("dq_score"))


def test_feature_names():
    assert len(FEATURES) == 15 and len(MODEL_INPUTS) == 8


@pytest.fixture
def two_batches(lake):
    """Silver of two batches; the second one has other amounts when `shift` is given."""
    def make(shift=0.0):
        for batch, start in (("B1", 0), ("B2", 600)):
            k = F.col("id")
            rows = lake.spark.range(start, start + 600).select(
                F.concat(F.lit("T"), k).alias("transaction_id"), F.concat(F.lit("C"), k % 40).alias("customer_id"),
                F.concat(F.lit("M"), k % 15).alias("merchant_id"), F.lit("debit_card").alias("payment_method"),
                (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=k % 480)).cast("timestamp_ntz").alias("ts"),
                (F.pmod(F.xxhash64("id"), F.lit(5000)) / 100 + F.lit(shift if start else 0.0)).alias("amount"),
                F.lit("GBP").alias("currency"), F.lit("GB").alias("country"), F.lit("SUCCESS").alias("status"),
                F.lit("silver").alias("route"))
            lake.replace_batch(rows, "silver.routed", batch, ("route",))
        return lake
    return make


AT = datetime(2024, 2, 1)


def test_a_second_batch_is_scored_without_a_fit(two_batches):
    lake = two_batches()
    first = stored.score_batch(lake, "B1", SMALL, AT)
    nodes = lake.read(stored.NODES).collect()
    assert (first["model_id"], first["refitted"], first["total_scored"]) == ("B1", True, 600)
    second = stored.score_batch(lake, "B2", SMALL, AT)
    assert (second["model_id"], second["refitted"], second["drifted"]) == ("B1", False, [])
    assert lake.read(stored.NODES).collect() == nodes and lake.read(stored.VERSIONS).count() == 1
    # All of Silver was fitted, so the same rows get the same raw score in one go.
    features = stored.batch_features(lake, "B2")
    by_hand = {r.transaction_id: (r.anomaly_score, r.risk_score) for r in stored.scored_with(lake, "B1", features).collect()}
    kept = lake.read(stored.SCORES, "B2")
    assert {r.transaction_id: (r.anomaly_score, r.risk_score) for r in kept.collect()} == by_hand and len(by_hand) == 600
    # A rerun replaces the rows and the counts of its batch only.
    stored.score_batch(lake, "B2", SMALL, AT)
    assert lake.read(stored.SCORES).count() == 1200
    counts = lake.read(stored.COUNTS).filter("feature = 'amount'").groupBy("batch_id").agg(F.sum("rows").alias("n"))
    assert {r.batch_id: r.n for r in counts.collect()} == {"B1": 600, "B2": 600}


def test_drift_of_stored_counts_equals_drift_of_the_rows(two_batches):
    lake = two_batches()
    parts = {batch: stored.batch_features(lake, batch) for batch in ("B1", "B2")}
    stored.fit_model(lake, "M", parts["B1"], SMALL, AT)
    for batch, rows in parts.items():
        stored.keep_counts(lake, "M", batch, rows)
    profile = lake.read(stored.PROFILE, "M")
    both = parts["B1"].unionByName(parts["B2"])
    for batches, rows in ((["B2"], parts["B2"]), (["B1", "B2"], both), (None, both)):
        assert sorted(stored.drift_of(lake, "M", batches).collect()) == sorted(drift.monitor(rows, profile).collect())
    files = stored.drift_of(lake, "M").inputFiles()
    assert files and all("/models/drift_" in file for file in files)


def test_drift_fits_another_version(two_batches):
    lake = two_batches(shift=400.0)
    stored.score_batch(lake, "B1", SMALL, AT)
    # The first fit saw all of Silver; here the model knows the first batch only.
    stored.fit_model(lake, "B1", stored.batch_features(lake, "B1"), SMALL, AT)
    found = stored.score_batch(lake, "B2", SMALL, datetime(2024, 2, 2))
    assert found["refitted"] and "amount" in found["drifted"] and stored.model_in_force(lake) == "B2"
    assert {r.model_id for r in lake.read(stored.SCORES, "B2").select("model_id").distinct().collect()} == {"B2"}
    assert lake.read(stored.COUNTS, "B2").select("model_id").distinct().collect()[0][0] == "B2"


def test_a_fit_that_stops_halfway_leaves_the_model_in_force(two_batches, monkeypatch):
    lake = two_batches()
    stored.score_batch(lake, "B1", SMALL, AT)
    monkeypatch.setattr(drift, "build_reference", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        stored.fit_model(lake, "B9", stored.batch_features(lake, "B1"), SMALL, datetime(2024, 3, 1))
    assert stored.model_in_force(lake) == "B1"
    with pytest.raises(ValueError):
        stored.fit_model(lake, "B8", stored.batch_features(lake, "none"), SMALL)
