"""Validation rules, duplicates, routing and reruns."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txnlake.config import Config
from txnlake.operators import bronze, gold, history, silver

AS_OF = datetime(2024, 6, 1)
GOOD = {
    "transaction_id": "T1", "customer_id": "C1", "merchant_id": "M1", "payment_method": "credit_card",
    "timestamp": "2024-01-01T10:00:00+00:00", "amount": "10.50", "currency": "GBP", "country": "gb",
    "channel": "Online", "device_type": "Mobile", "status": "success",
}


def land(lake, rows, batch="B1"):
    spark = lake.spark
    data = [(*[{**GOOD, "transaction_id": f"T{i}", **row}[c] for c in GOOD], batch, i)
            for i, row in enumerate(rows)]
    schema = ", ".join(f"{c} string" for c in [*GOOD, "batch_id"]) + ", _row_seq long"
    bronze.land(lake, spark.createDataFrame(data, schema), "transactions", batch, AS_OF)


def land_entities(lake, batch="B1", customers=("C1",), merchants=("M1",)):
    spark = lake.spark
    people = [(c, "n", "e", "retail", "GB", "2020-01-01", i) for i, c in enumerate(customers)]
    shops = [(m, "n", "travel", "GB", "low", i) for i, m in enumerate(merchants)]
    bronze.land(lake, spark.createDataFrame(
        people, "customer_id string, name string, email string, segment string, country string, "
        "customer_since string, _row_seq long"), "customers", batch, AS_OF)
    bronze.land(lake, spark.createDataFrame(
        shops, "merchant_id string, name string, category string, country string, "
        "risk_category string, _row_seq long"), "merchants", batch, AS_OF)


def reasons(lake, batch="B1"):
    rows = lake.quarantine(batch).select("raw_record", "rejection_reason").collect()
    return sorted(r.rejection_reason for r in rows)


def build(lake, rows, batch="B1", **options):
    land(lake, rows, batch)
    if batch == "B1":
        land_entities(lake)
    return silver.build_silver(lake, batch, as_of=AS_OF, loaded_at=AS_OF, **options)


RULES = [
    ({"transaction_id": " "}, "null/empty transaction_id"),
    ({"amount": ""}, "unparseable amount: ''"),
    ({"amount": None}, "unparseable amount: None"),
    ({"amount": "nan"}, "unparseable amount: 'nan'"),
    ({"amount": "-0.0001"}, "non-positive amount: -0.0001"),
    ({"amount": "0"}, "non-positive amount: 0.0"),
    ({"amount": "2.5e7"}, "amount exceeds threshold: 25000000.0"),
    ({"amount": "inf"}, "amount exceeds threshold: inf"),
    ({"timestamp": "it's"}, 'unparseable timestamp: "it\'s"'),
    ({"timestamp": ""}, "unparseable timestamp: ''"),
    ({"timestamp": "2999-01-01T00:00:00+05:30"}, "future timestamp: 2999-01-01T00:00:00+05:30"),
    ({"timestamp": "2024-06-01T00:00:00.000001"}, "future timestamp: 2024-06-01T00:00:00.000001+00:00"),
    ({"currency": "zzz "}, "invalid currency: 'ZZZ'"),
    ({"status": "declined"}, "invalid status: 'DECLINED'"),
    ({"payment_method": "Cheque"}, "invalid payment_method: 'cheque'"),
    ({"customer_id": " "}, "null customer_id"),
    ({"customer_id": "C9"}, "orphan customer_id: C9"),
    ({"merchant_id": None}, "null merchant_id"),
    ({"merchant_id": "M9"}, "orphan merchant_id: M9"),
] + [({}, None)]


def test_one_reason_per_rule(lake):
    counts = build(lake, [change for change, _ in RULES])
    assert counts["silver_count"] == 1
    ids = [change.get("transaction_id", f"T{i}").strip() for i, (change, _) in enumerate(RULES)]
    expected = {name or None: reason for name, (_, reason) in zip(ids, RULES, strict=True) if reason}
    found = lake.quarantine().select("transaction_id", "rejection_reason").collect()
    assert {r.transaction_id: r.rejection_reason for r in found} == expected


def test_all_reasons_in_rule_order(lake):
    build(lake, [{}, {"transaction_id": "T0", "amount": "x", "timestamp": "y", "currency": "?",
                      "status": "?", "payment_method": "?", "customer_id": "", "merchant_id": "Q"}])
    assert reasons(lake) == [
        "duplicate transaction_id: T0; unparseable amount: 'x'; unparseable timestamp: 'y'; "
        "invalid currency: '?'; invalid status: '?'; invalid payment_method: '?'; "
        "null customer_id; orphan merchant_id: Q"]


def test_limits_are_inclusive(lake):
    counts = build(lake, [{"amount": "1000000"}, {"amount": "1000000.01"},
                          {"timestamp": "2024-06-01T00:00:00Z"}])
    assert (counts["silver_count"], counts["quarantine_count"]) == (2, 1)


def test_values_are_typed_and_tidy(lake):
    build(lake, [{"payment_method": "\tCREDIT_card ", "status": " success", "country": " gb\n",
                  "timestamp": "2024-01-01T10:00:00.25+02:00", "amount": "1_000"}])
    row = lake.transactions().first()
    assert (row.payment_method, row.status, row.country, row.channel, row.device_type) == (
        "credit_card", "SUCCESS", "GB", "online", "mobile")
    assert (row.ts, row.amount) == (datetime(2024, 1, 1, 8, 0, 0, 250000), 1000.0)


def test_first_copy_wins_even_when_it_is_rejected(lake):
    build(lake, [{"transaction_id": "A", "amount": ""}, {"transaction_id": "A"},
                 {"transaction_id": " A "}, {}])
    assert [r.transaction_id for r in lake.transactions().collect()] == ["T3"]
    assert reasons(lake) == ["duplicate transaction_id: A", "duplicate transaction_id: A",
                             "unparseable amount: ''"]


def test_second_empty_id_is_also_a_duplicate(lake):
    build(lake, [{"transaction_id": ""}, {"transaction_id": None}])
    assert reasons(lake) == ["null/empty transaction_id",
                             "null/empty transaction_id; duplicate transaction_id: "]


@pytest.mark.parametrize("limit", [0, 1000])
def test_id_in_silver_of_another_batch_is_a_duplicate(lake, limit):
    build(lake, [{"transaction_id": "A"}, {"transaction_id": "B", "amount": ""}], limit=limit)
    land_entities(lake, "B2", (), ())
    build(lake, [{"transaction_id": "A"}, {"transaction_id": "B"}], "B2", limit=limit)
    assert reasons(lake, "B2") == ["duplicate transaction_id: A"]
    assert [r.transaction_id for r in lake.transactions("B2").collect()] == ["B"]


def test_customers_of_all_batches_are_known(lake):
    build(lake, [{}])
    land_entities(lake, "B2", ("C2",), ())
    counts = build(lake, [{"transaction_id": "X", "customer_id": "C2"},
                          {"transaction_id": "Y", "customer_id": "C1"}], "B2")
    assert counts["silver_count"] == 2


def test_rerun_replaces_the_batch(lake):
    build(lake, [{}, {"amount": ""}])
    first = sorted(map(str, lake.transactions().collect()))
    build(lake, [{}, {"amount": ""}])
    assert sorted(map(str, lake.transactions().collect())) == first
    assert build(lake, [{}])["quarantine_count"] == 0  # an emptied route is emptied on disk too
    assert lake.quarantine().count() == 0


def test_salted_joins_give_the_same_rows(lake):
    rows = [{"transaction_id": "H" if i % 3 == 0 else f"T{i}", "customer_id": "" if i % 4 else "C1"}
            for i in range(300)]
    build(lake, rows)
    broadcast = sorted(map(str, lake.read("silver.routed").collect()))
    build(lake, rows, limit=0)
    assert sorted(map(str, lake.read("silver.routed").collect())) == broadcast


def test_result_does_not_depend_on_partitions(lake):
    rows = [{"transaction_id": f"T{i % 40}"} for i in range(200)]
    build(lake, rows)
    expected = sorted(map(str, lake.transactions().collect()))
    spread = lake.read("bronze.raw_transactions", "B1").repartition(7, F.rand(1))
    lake.replace_batch(lake.stage(spread, "spread"), "bronze.raw_transactions", "B1")
    silver.build_silver(lake, "B1", as_of=AS_OF, loaded_at=AS_OF)
    assert sorted(map(str, lake.transactions().collect())) == expected


def test_raw_record_holds_the_whole_row(lake):
    build(lake, [{"amount": None, "channel": 'a"b'}])
    record = json.loads(lake.quarantine().first().raw_record)
    assert record["amount"] == "None" and record["channel"] == 'a"b' and record["batch_id"] == "B1"
    assert set(record) == {*GOOD, "batch_id", "_ingested_at"}


def test_latest_version_of_a_customer(lake):
    land_entities(lake, "B1", ("C1", "C1", "C2"))
    build(lake, [{}])
    land_entities(lake, "B2", ("C1",), ())
    land(lake, [], "B2")
    silver.build_silver(lake, "B2", as_of=AS_OF, loaded_at=datetime(2024, 7, 1))
    assert {(r.customer_id, r.batch_id) for r in lake.customers().collect()} == {("C1", "B2")}


@pytest.mark.parametrize("limit", [0, 1000])
def test_star_schema(lake, limit):
    build(lake, [{}, {"timestamp": "2024-01-06"}, {"amount": ""}])
    counts = gold.build_gold(lake, Config(), limit)
    assert counts == {"fact_transactions": 2, "dim_customer": 1, "dim_merchant": 1, "dim_date": 2}
    fact = lake.fact().orderBy("ts").first()
    assert (fact.customer_sk, fact.merchant_sk, fact.payment_method_sk, fact.date_sk) == (
        1, 1, 3, 20240101)
    saturday = lake.read("gold.dim_date").filter("date_sk = 20240106").first()
    assert (saturday.day_of_week, saturday.day_name, saturday.is_weekend) == (6, "Saturday", True)


def test_fact_keeps_rows_without_a_dimension(lake):
    build(lake, [{}])
    empty = lake.read("gold.dim_merchant")
    customers = lake.spark.createDataFrame([(1, "C1")], "customer_sk int, customer_id string")
    methods = gold.dim_payment_method(lake.spark, Config())
    row = gold.fact_transactions(lake.transactions(), customers, empty, methods).first()
    assert (row.customer_sk, row.merchant_sk) == (1, None)


def test_large_lookups_do_not_move_the_wide_rows(lake):
    """Only different keys meet the large tables; rows and reasons are the same as with small ones."""
    people = [f"C{i}" for i in range(40)]
    rows = [{"customer_id": f"C{i % 50}" if i % 7 else "", "merchant_id": "M1" if i % 11 else f"X{i}"} for i in range(300)]
    land(lake, rows)
    land_entities(lake, customers=people, merchants=["M1", *[f"M{i}" for i in range(2, 60)]])
    silver.build_silver(lake, "B1", as_of=AS_OF, loaded_at=AS_OF)
    raw = lake.read("bronze.raw_transactions", "B1")
    given = (raw, lake.read("silver.repeated_ids", "B1").drop("batch_id"), lake.entity_ids("customers"),
             lake.entity_ids("merchants"), Config(), AS_OF)
    picked = lambda df: sorted((r._row_seq, r._reasons) for r in df.collect())
    small, large = silver.annotate(*given), silver.annotate(*given, limit=30)
    assert picked(small) == picked(large) and any(reason for _, reason in picked(large))
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    assert picked(silver.annotate(*given, limit=0)) == picked(small)


def known(df):
    return sorted(row.transaction_id for row in df.collect())


def test_history_is_met_through_filters(lake):
    """Only candidates among earlier ids are read, and a wrong filter bit changes no result."""
    spark = lake.spark
    build(lake, [{"transaction_id": f"A{i}"} for i in range(500)])
    build(lake, [{"transaction_id": f"B{i}"} for i in range(300)], "B2")
    ids = spark.createDataFrame([(f"A{i}",) for i in range(490, 520)] + [("B7",), ("C1",), ("",)], "transaction_id string")
    earlier, filters = lake.transactions(), lake.read(history.FILTERS)
    expected = sorted([f"A{i}" for i in range(490, 500)] + ["B7"])
    # Eight bits in a sparse filter: what the batches hold is all that is read.
    assert sorted(map(tuple, history.possible(ids, filters).collect())) == sorted(("B2" if one == "B7" else "B1", one) for one in expected)
    found = history.known_ids(ids, earlier, filters)
    assert known(found) == expected
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    every = filters.select("n_blocks", "batch_id").distinct().withColumn("block", F.explode(F.sequence(F.lit(-1).cast("long"), F.lit(4095).cast("long"))))
    forced = every.select("n_blocks", "block", *[F.lit(-1).cast("long").alias(word) for word in history.WORDS], "batch_id")
    assert history.possible(ids, forced).count() == 2 * 33
    assert known(history.known_ids(ids, earlier, forced)) == expected
    assert known(history.known_ids(ids, earlier, forced, limit=0)) == expected
    assert known(history.known_ids(ids, earlier, filters.filter("batch_id = 'B2'"))) == expected
    assert known(history.known_ids(ids, earlier, filters.filter("batch_id = 'none'"))) == expected


def test_shuffled_rows_do_not_grow_with_the_history(lake):
    """The rows of earlier batches are scanned where they lie; only the ids that are found move."""
    build(lake, [{"transaction_id": f"A{i}"} for i in range(400)])
    ids = lake.spark.createDataFrame([(f"A{i}",) for i in range(395, 405)], "transaction_id string")
    found = history.known_ids(ids, lake.transactions(), lake.read(history.FILTERS))
    assert len(found.collect()) == 5
    final = found._jdf.queryExecution().executedPlan()
    moved = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            moved.append(node.metrics().get("shuffleRecordsWritten").get().value())
        below = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
        children = node.children()
        for child in below + [children.apply(place) for place in range(children.size())]:
            walk(child)

    walk(final)
    assert moved and sum(moved) < 100


def test_rerun_and_empty_batches_keep_filters_right(lake):
    build(lake, [{"transaction_id": "A"}, {"transaction_id": "B"}])
    build(lake, [{"transaction_id": "C"}])
    land_entities(lake, "B2", (), ())
    build(lake, [{"transaction_id": one} for one in "ABC"], "B2", limit=0)
    assert known(lake.transactions("B2")) == ["A", "B"]
    build(lake, [{"transaction_id": "D", "amount": ""}])
    build(lake, [{"transaction_id": one} for one in "ABCD"], "B2", limit=0)
    assert known(lake.transactions("B2")) == ["A", "B", "C", "D"]
    lake.drop_batch(history.FILTERS, "B2")
    build(lake, [{"transaction_id": "D"}, {"transaction_id": "E"}], limit=0)
    assert known(lake.transactions("B1")) == ["E"]


def test_filter_sizes():
    assert [history.blocks_for(rows) for rows in (0, 1, 65536, 65537, 10**9)] == [4096, 4096, 4096, 8192, 1 << 26]
