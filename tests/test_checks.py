"""Checks, controls, reconciliation and model tests on small frames."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txnlake import schemas
from txnlake.config import Config
from txnlake.operators import controls, quality
from txnlake.plans import marts, reconciliation

AS_OF = datetime(2024, 6, 2)
COLUMNS = ("transaction_id string, customer_id string, merchant_id string, payment_method string, "
           "ts timestamp_ntz, amount double, currency string, status string")


def frame(spark, n=100, **changes):
    """n good rows; a change maps a column to {row: value}."""
    rows = []
    for i in range(n):
        row = {"transaction_id": f"T{i}", "customer_id": "C1", "merchant_id": "M1",
               "payment_method": "debit_card", "ts": AS_OF - timedelta(hours=1), "amount": 5.0,
               "currency": "GBP", "status": "SUCCESS"}
        row.update({c: v[i] for c, v in changes.items() if i in v})
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, COLUMNS)


def one(df, check):
    return quality.run_checks(df, "t", [check], "now").first()


@pytest.mark.parametrize(("bad", "n", "status", "rate"), [
    (3, 100, "WARN", 0.03), (50, 100, "FAIL", 0.5), (1, 100, "PASS", 0.01), (5, 100, "WARN", 0.05),
    (0, 10, "PASS", 0.0), (6, 100, "FAIL", 0.06),
])
def test_thresholds_are_strict(spark, bad, n, status, rate):
    df = frame(spark, n, customer_id={i: (None, "", "  ")[i % 3] for i in range(bad)})
    row = one(df, quality.not_null("customer_id", 0.01, 0.05))
    assert (row.records_checked, row.records_failed, row.failure_rate, row.status) == (n, bad, rate, status)
    assert row.detail == f"Column 'customer_id' has {bad} null/empty values"


def test_blank_means_spaces_only(spark):
    assert one(frame(spark, 10, customer_id={0: "\t"}),
               quality.not_null("customer_id", 0, 0)).records_failed == 0


def test_empty_table_passes_rates_but_is_not_fresh(spark):
    df = frame(spark, 1).limit(0)
    assert one(df, quality.not_null("amount", 0.01, 0.05)).status == "PASS"
    row = one(df, quality.freshness("ts", 24, AS_OF))
    assert (row.status, row.records_failed, row.failure_rate, row.detail) == (
        "FAIL", 0, 1.0, "No records found in table")


def test_uniqueness_counts_surplus_and_null_as_a_value(spark):
    df = frame(spark, 10, transaction_id={1: "T0", 2: "T0", 3: None, 4: None})
    row = one(df, quality.uniqueness("transaction_id"))
    assert (row.records_failed, row.status) == (3, "FAIL")


def test_null_is_neither_inside_nor_outside_a_set(spark):
    df = frame(spark, 10, status={0: None, 1: "ODD"})
    assert one(df, quality.valid_values("status", Config().statuses, 0, 0)).records_failed == 1
    fact = df.selectExpr("*", "1 AS customer_sk", "1 AS merchant_sk", "1 AS payment_method_sk")
    row = controls.fact_controls(fact, Config(), "now").filter("control_id = 'CTL-04'").first()
    assert (row.status, row.records_failed) == ("FAIL", 1)


def test_amounts(spark):
    df = frame(spark, 10, amount={0: None, 1: 0.0, 2: -50.0})
    assert one(df, quality.amount_positive(0.01, 0.05)).records_failed == 3


def test_references_count_null_keys(spark):
    df = frame(spark, 10, customer_id={0: None, 1: "X", 2: "X"})
    parent = spark.createDataFrame([("C1",)], "customer_id string")
    row = one(df, quality.referential_integrity("t", "customer_id", parent, "p", "customer_id", 0, 0))
    assert (row.records_failed, row.check_name) == (3, "ref_integrity__customer_id__p")
    assert row.detail == "3 rows in t.customer_id with no match in p"


@pytest.mark.parametrize(("hours", "status"), [(1, "PASS"), (0, "FAIL")])
def test_freshness_cutoff_is_inclusive(spark, hours, status):
    assert one(frame(spark, 3), quality.freshness("ts", hours, AS_OF)).status == status
    row = controls.freshness_control(frame(spark, 3), hours, AS_OF, "now").first()
    assert (row.status, row.records_checked) == (status, 1)


def test_freshness_control_without_rows(spark):
    row = controls.freshness_control(frame(spark, 1).limit(0), 24, AS_OF, "now").first()
    assert (row.status, row.records_checked, row.records_failed, row.detail) == (
        "FAIL", 0, 0, "No transactions in Silver layer")


@pytest.mark.parametrize(("n", "status"), [(7, "PASS"), (13, "PASS"), (6, "FAIL"), (14, "FAIL")])
def test_volume_band_is_inclusive(spark, n, status):
    row = one(frame(spark, n), quality.volume(10, 0.30))
    assert (row.status, row.records_failed) == (status, 0)
    assert row.detail.endswith("expected range [7, 13]")


def test_score(spark):
    def score(*verdicts):
        df = spark.createDataFrame([(v,) for v in verdicts], "status string")
        return quality.quality_score(df).first().quality_score

    assert score("PASS", "PASS") == 100.0 and score("FAIL") == 0.0
    assert score("PASS", "WARN", "FAIL") == 50.0
    assert score("PASS", "PASS", "WARN") == 83.3
    assert quality.quality_score(spark.createDataFrame([], "status string")).first().quality_score == 0.0


def test_checks_by_group_equal_checks_of_each_group(spark):
    """Groups are measured together; one without rows counts as an empty table."""
    df = frame(spark, 30, transaction_id={1: "T4", 7: "T10"}, customer_id={3: "C9", 5: None}, amount={8: -1.0},
               currency={0: "X"}).withColumn("g", F.when(F.substring("transaction_id", 2, 9).cast("int") % 3 == 1, "a").otherwise("b"))
    groups = spark.createDataFrame([("a", 12), ("b", 90), ("none", 5)], "g string, expected int")
    parent = spark.createDataFrame([("C1",)], "customer_id string")

    def checks(expected):
        return [quality.not_null("customer_id", 0.01, 0.05), quality.uniqueness("transaction_id"), quality.amount_positive(0, 0),
                quality.valid_values("currency", ("GBP",), 0, 0), quality.freshness("ts", 24, AS_OF), quality.volume(expected, 0.3),
                quality.referential_integrity("t", "customer_id", parent, "p", "customer_id", 0, 0)]

    found = quality.run_checks_by(df, "g", groups, "t", checks(F.col("expected")), "now")
    rows = found.collect()
    for group, expected in (("a", 12), ("b", 90), ("none", 5)):
        alone = quality.run_checks(df.filter(F.col("g") == group), "t", checks(expected), "now").collect()
        assert sorted(r[1:] for r in rows if r.g == group) == sorted(tuple(r) for r in alone)
    scores = {r.g: r.quality_score for r in quality.quality_score(found, ["g"]).collect()}
    assert set(scores) == {"a", "b", "none"} and scores["none"] == quality.quality_score(
        quality.run_checks(df.limit(0), "t", checks(5), "now")).first().quality_score


def test_shared_checks_take_one_scan(spark, lake):
    path = f"{lake.root}/t"
    frame(spark, 50).write.parquet(path)
    df = spark.read.parquet(path)
    checks = [quality.not_null(c, 0.01, 0.05) for c in ("transaction_id", "customer_id", "amount")]
    checks += [quality.amount_positive(0, 0), quality.valid_values("status", ("A",), 0, 0),
               quality.freshness("ts", 24, AS_OF), quality.volume(50, 0.3)]
    result = quality.run_checks(df, "t", checks, "now")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and result.count() == 7


def test_fact_controls(spark):
    fact = frame(spark, 10, transaction_id={1: "T0"}, amount={2: 2e6}, status={3: "ODD"}).selectExpr(
        "*", "if(transaction_id = 'T4', null, 1) AS customer_sk", "1 AS merchant_sk",
        "1 AS payment_method_sk")
    rows = {r.control_id: r for r in controls.fact_controls(fact, Config(), "now").collect()}
    assert {k: (r.status, r.records_checked, r.records_failed) for k, r in rows.items()} == {
        f"CTL-0{i}": ("FAIL", 10, 1) for i in range(1, 5)}
    assert rows["CTL-03"].detail == (
        "1 transactions with invalid amount (null, <=0, or >1000000)")


def test_schema_control_reads_the_stored_columns(spark, lake):
    row = lambda: controls.control_report(
        lake, "B1", Config(), AS_OF).filter("control_id = 'CTL-06'").first()
    assert row().status == "FAIL"
    for table in schemas.CONTROLLED_GOLD:
        lake.replace(spark.createDataFrame([], schemas.TABLES[table]), table)
    assert row().status == "PASS"
    spark.range(1).withColumnRenamed("id", "customer_sk").write.mode("overwrite").parquet(
        lake.path("gold.dim_customer"))
    assert row().status == "FAIL"


def test_schema_control(spark):
    gold = {t: spark.createDataFrame([], schemas.TABLES[t]) for t in schemas.CONTROLLED_GOLD}
    assert controls.schema_control(gold, "now").first().detail == "All expected columns present"
    gold["gold.dim_merchant"] = gold["gold.dim_merchant"].drop("name", "country")
    row = controls.schema_control(gold, "now").first()
    assert (row.status, row.records_checked, row.records_failed, row.detail) == (
        "FAIL", 3, 1, "gold.dim_merchant: missing ['name', 'country']")


def test_unbalanced_batch(spark):
    counts = spark.createDataFrame(
        [("B1", 10, 7, 2)], "batch_id string, raw_count long, silver_count long, quarantine_count long")
    reconciled = reconciliation.reconcile(counts)
    assert reconciled.first().reconciliation_status == "FAIL — unaccounted records: 1"
    row = controls.reconciliation_control(reconciled, "now").first()
    assert (row.status, row.records_failed) == ("FAIL", 1) and row.remediation
    assert row.detail == "Raw=10 | Silver=7 | Quarantine=2 | Delta=1 (UNACCOUNTED RECORDS)"


def test_overall_verdict(spark):
    def verdict(*states):
        df = spark.createDataFrame([(s,) for s in states], "status string")
        return controls.overall(df).first().overall_status

    assert verdict("PASS", "PASS") == "PASS" and verdict("PASS", "FAIL") == "FAIL"


def test_model_tests_find_violations(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, null), (2, 'b'), (null, 'c') AS t(k, v)")
    found = {r.test_column: r.violations for r in marts.not_null_violations(df, "m", ["k", "v"]).collect()}
    assert found == {"k": 1, "v": 1}
    assert marts.unique_violations(df, "m", "k").first().violations == 1


def test_unreconciled_days(spark):
    df = spark.range(2).select(
        F.col("id").alias("metric_date"), F.lit(5).alias("total_transactions"),
        *[F.lit(1).alias(f"{s}_transactions") for s in ("failed", "pending", "reversed", "initiated")],
        (F.col("id") + 1).alias("successful_transactions"))
    assert [tuple(r) for r in marts.unreconciled_days(df).collect()] == [(1, 5, 6)]


def test_config_bounds():
    with pytest.raises(ValueError, match="max_amount"):
        Config(max_amount=10**12)
    assert quality.expected_volume(75_000, Config()) == int(75_000 * Config().clean_share)
