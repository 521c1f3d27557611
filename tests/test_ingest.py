"""Reading files, contracts, audit rows and reruns."""

from __future__ import annotations

import csv
import random
import tempfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txnlake import schemas, session
from txnlake.operators.bronze import ingest
from txnlake.plans.run import gate, run_batch
from txnlake.risk.scoring import train, validate_model
from txnlake.sources.defects import inject_defects
from txnlake.sources.files import UnreadableFile, read_csv, validate_schema
from txnlake.sources.lake import Lake

AS_OF = datetime(2024, 6, 1)
TRANSACTIONS = ("transaction_id,customer_id,merchant_id,payment_method,timestamp,amount,currency,"
                "country,channel,device_type,status,batch_id\n")
CUSTOMERS = "customer_id,name,email,segment,country,customer_since\n"
MERCHANTS = "merchant_id,name,category,country,risk_category\n"


def line(i, amount="5.00"):
    return f"T{i},C1,M1,debit_card,2024-05-31T10:00:00,{amount},GBP,GB,pos,tablet,SUCCESS,SRC\n"


@pytest.fixture
def files():
    root = Path(tempfile.mkdtemp(prefix="run-"))

    def write(name, text):
        (root / name).write_text(text)
        return str(root / name)

    return write


@pytest.fixture
def good(files):
    return {
        "transactions_path": files("t.csv", TRANSACTIONS + "".join(line(i) for i in range(20))),
        "customers_path": files("c.csv", CUSTOMERS + 'C1,"Doe, ""J""",j@x,retail,GB,2020-01-01\n'),
        "merchants_path": files("m.csv", MERCHANTS + "M1,Shop,travel,GB,low\n"),
    }


def test_columns_are_text_and_empty_stays_empty(spark, files):
    df = read_csv(spark, files("x.csv", 'a,b,c\n1,,"x ""y"""\nNA,null,\n'))
    assert [tuple(r)[:3] for r in df.orderBy("_row_seq").collect()] == [
        ("1", "", 'x "y"'), ("NA", "null", "")]
    assert dict(df.dtypes)["a"] == "string"


def test_row_numbers_follow_the_file(spark, files):
    path = files("x.csv", "a\n" + "".join(f"{i}\n" for i in range(500)))
    assert [r.a for r in read_csv(spark, path).orderBy("_row_seq").collect()] == [
        str(i) for i in range(500)]


def test_row_numbers_follow_splits_and_files(spark, files):
    body = "a\n" + "".join(f"{i:06d}\n" for i in range(30_000))
    folder = Path(files("one", "")).parent / "many"
    folder.mkdir()
    (folder / "p2.csv").write_text("a\n" + "".join(f"{i:06d}\n" for i in range(30_000, 60_000)))
    (folder / "p1.csv").write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = read_csv(spark, str(folder))
        assert df.rdd.getNumPartitions() > 4
        values = [r.a for r in df.orderBy("_row_seq").collect()]
        assert df.select("_row_seq").distinct().count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert values == [f"{i:06d}" for i in range(60_000)]


def test_quoted_line_ends_stay_in_their_field(spark, files):
    df = read_csv(spark, files("x.csv", 'a,b\n1,"two\nlines"\n2,x\n'))
    assert [r.b for r in df.orderBy("_row_seq").collect()] == ["two\nlines", "x"]


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def untidy_rows(seed, rows):
    """Rows of fields with line ends, quotes, commas and empty lines inside."""
    draw = random.Random(seed)
    parts = ["\n", "\n\n", '"', ",", '","', "x", "a b", "", '"\n"', "\n,\n", "\r", " "]
    return [[str(i), "".join(draw.choices(parts, k=draw.choice([0, 1, 3, 9, 400 if i % 90 == 7 else 2]))),
             draw.choice(["", "z", "tail"])] for i in range(rows)]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("always", [True, False])
def test_quoted_line_ends_are_read_by_many_tasks(spark, tmp_path, small_splits, line_end, always):
    rows = {name: untidy_rows(name, 600) for name in ("p1", "p2")}
    for name, values in rows.items():
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator=line_end, quoting=csv.QUOTE_ALL if always else csv.QUOTE_MINIMAL)
            writer.writerows([["a", "b\nc", "d"], *values])
    read = read_csv(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4 and read.columns == ["a", "b\nc", "d", "_row_seq"]
    found = read.orderBy("_row_seq").collect()
    assert [list(row)[:3] for row in found] == [*rows["p1"], *rows["p2"]]
    assert len({row._row_seq for row in found}) == 1200


def test_quotes_inside_plain_fields_open_nothing(spark, files):
    text = 'a,b\n1,5" pipe\n2,"two\nlines"\n3,x"y,\n\n4,"q""\n"" r"\n'.replace('x"y,', 'x"y')
    assert [tuple(r)[:2] for r in read_csv(spark, files("x.csv", text)).orderBy("_row_seq").collect()] == [
        ("1", '5" pipe'), ("2", "two\nlines"), ("3", 'x"y'), ("4", 'q"\n" r')]


def test_a_quote_that_is_never_closed_is_unreadable(spark, files):
    with pytest.raises(UnreadableFile, match="not closed"):
        read_csv(spark, files("x.csv", 'a,b\n1,"two\nlines\n2,x\n'))


def test_too_many_fields_and_other_headers_beside_quoted_line_ends(spark, tmp_path):
    (tmp_path / "p1.csv").write_text('a,b\n1,"two\nlines"\n2,x,y\n')
    with pytest.raises(PySparkException, match="more fields than columns"):
        read_csv(spark, str(tmp_path)).collect()
    (tmp_path / "p1.csv").write_text('a,b\n1,"two\nlines"\n2\n')
    assert [tuple(r)[:2] for r in read_csv(spark, str(tmp_path)).orderBy("_row_seq").collect()] == [
        ("1", "two\nlines"), ("2", "")]
    (tmp_path / "p2.csv").write_text('a,c\n3,y\n')
    with pytest.raises(PySparkException, match="header differs"):
        read_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("text", ["", None])
def test_unreadable_files(spark, files, text):
    path = files("x.csv", text) if text is not None else files("x.csv", "") + ".missing"
    with pytest.raises(UnreadableFile):
        read_csv(spark, path)


def test_contract(spark, files):
    df = read_csv(spark, files("x.csv", "merchant_id,name,extra\n1,2,3\n"))
    assert validate_schema(df, "merchants") == (False, ["category", "country", "risk_category"])
    assert validate_schema(df, "anything") == (True, [])


def test_ingest_lands_and_audits(lake, good):
    summary = ingest(lake.spark, lake.root, **good, batch_id="B1", ingested_at=AS_OF)
    assert {k: summary[k]["status"] for k in ("transactions", "customers", "merchants")} == {
        "transactions": "SUCCESS", "customers": "SUCCESS", "merchants": "SUCCESS"}
    raw = lake.read("bronze.raw_transactions")
    assert raw.count() == 20
    assert {(r.batch_id, r._source_batch_id, r._ingested_at) for r in raw.collect()} == {
        ("B1", "SRC", AS_OF)}
    assert lake.read("bronze.raw_customers").first().name == 'Doe, "J"'
    audit = lake.read("bronze.ingestion_audit").collect()
    assert len(audit) == 3 and all(r.schema_version == "1.0" for r in audit)
    first = sorted(map(str, raw.drop("_ingested_at").collect()))
    ingest(lake.spark, lake.root, **good, batch_id="B1")
    assert sorted(map(str, lake.read("bronze.raw_transactions").drop("_ingested_at").collect())) == first
    assert lake.read("bronze.ingestion_audit").count() == 3


def test_bad_files_do_not_stop_the_others(lake, files, good):
    bad = {**good, "transactions_path": files("bad.csv", "transaction_id,amount\nT1,5\n"),
           "customers_path": files("zero.csv", "")}
    ingest(lake.spark, lake.root, **bad, batch_id="B1")
    audit = {r.table_name: r for r in lake.read("bronze.ingestion_audit").collect()}
    assert audit["transactions"].status == "SCHEMA_ERROR"
    assert audit["transactions"].error_detail.startswith("Missing columns: ['batch_id', 'channel'")
    assert (audit["transactions"].record_count, audit["transactions"].failure_count) == (1, 1)
    assert audit["customers"].status == "READ_ERROR" and audit["merchants"].status == "SUCCESS"
    assert lake.read("bronze.raw_transactions").count() == 0


def test_row_with_too_many_fields_is_a_read_error(lake, files, good):
    long = files("long.csv", MERCHANTS + "M1,Shop,travel,GB,low\nM2,Shop,travel,GB,low,more\n")
    summary = ingest(lake.spark, lake.root, **{**good, "merchants_path": long}, batch_id="B1")
    assert summary["merchants"]["status"] == "READ_ERROR"


def test_extra_columns_are_ignored_and_noted(lake, files, good):
    wide = files("wide.csv", "extra," + MERCHANTS + "z,M1,Shop,travel,GB,low\n")
    ingest(lake.spark, lake.root, **{**good, "merchants_path": wide}, batch_id="B1")
    assert lake.read("bronze.raw_merchants").first().merchant_id == "M1"
    note = lake.read("bronze.ingestion_audit").filter("table_name = 'merchants'").first()
    assert note.error_detail == "Ignored columns: ['extra']"


def test_batch_names_are_checked(lake):
    with pytest.raises(ValueError, match="batch id"):
        lake.path("bronze.raw_customers", "../x")


def test_whole_batch(lake, good):
    rows = run_batch(lake.spark, lake.root, **good, batch_id="B1", as_of=AS_OF,
                     expected_transactions=20).collect()
    found = {(r.stage, r.metric): r.value for r in rows}
    assert found["ingest", "transactions.record_count"] == "20"
    assert found["warehouse", "silver.silver_count"] == "20"
    assert found["warehouse", "gold.fact_transactions"] == "20"
    assert found["quality", "quality_score"] == "100.0"
    assert found["controls", "overall_status"] == "PASS"
    assert found["risk", "total_scored"] == "20"
    assert (found["gate", "approved"], found["gate", "reason"]) == ("True", "validation_passed")
    gate_of = lambda stage, metric, value: gate(lake.spark, "B1", [
        (r.batch_id, r.stage, r.metric, value if (r.stage, r.metric) == (stage, metric) else r.value) for r in rows])
    bad = {"approved": False, "reason": "data_quality_or_control_gate_failed"}
    assert gate_of("quality", "quality_score", "94.9") == gate_of("controls", "overall_status", "FAIL") == bad
    assert gate_of("warehouse", "silver.silver_count", "19") == bad
    absent = validate_model(lake).first()
    assert not absent.passed and absent.message.startswith("Model metadata not found")
    assert lake.read("gold.fact_transactions_risk").count() == 20
    record = train(lake)
    assert (record["training_rows"], record["model_type"]) == (20, "IsolationForest")
    assert "insufficient training rows" in validate_model(lake).first().message
    assert len(record["feature_columns"]) == 8 and 0 <= record["high_risk_rate"] <= 1


def clean_feed(spark, rows=20_000):
    seq = F.col("id")
    return spark.range(rows).select(
        F.concat(F.lit("T"), seq).alias("transaction_id"), F.lit("C1").alias("customer_id"),
        F.lit("M1").alias("merchant_id"), F.lit("debit_card").alias("payment_method"),
        F.lit("2024-01-01").alias("timestamp"), F.lit("5.00").alias("amount"),
        F.lit("GBP").alias("currency"), F.lit("SUCCESS").alias("status"), seq.alias("_row_seq"))


def test_defects_come_at_their_rates(spark):
    rates = {"null_amount": 0.02, "invalid_currency": 0.01, "orphan_customer_id": 0.0,
             "duplicate_transaction_id": 0.01, "negative_amount": 0.02}
    dirty = inject_defects(clean_feed(spark), rates, seed=3)
    row = dirty.selectExpr(
        "count_if(amount = '')", "count_if(currency <> 'GBP')", "count_if(customer_id <> 'C1')",
        "count(*) - count(DISTINCT transaction_id)", "count_if(amount LIKE '-%')",
        "count(*)").first()
    empty, currency, orphan, surplus, negative, rows = row
    assert 330 < empty < 470 and 140 < currency < 260 and orphan == 0 and rows == 20_000
    assert 140 < surplus < 260 and 320 < negative < 470
    again = inject_defects(clean_feed(spark).repartition(7), rates, seed=3)
    assert dirty.exceptAll(again).count() == 0


def test_repeated_ids_are_spread_over_many_donors(spark):
    dirty = inject_defects(clean_feed(spark), {"duplicate_transaction_id": 0.1}, seed=3)
    copies = dirty.groupBy("transaction_id").count().filter("count > 1").selectExpr("count(*)", "max(count)").first()
    assert copies[0] > 250 and copies[1] < 30


def test_at_least_one_defect(spark):
    rates = {"null_amount": 1e-9, "null_customer_id": 0.0}
    small = clean_feed(spark, 50)
    assert inject_defects(small, rates).filter("amount = ''").count() == 0
    one = inject_defects(small, rates, at_least_one=True)
    assert (one.filter("amount = ''").count(), one.filter("customer_id = ''").count()) == (1, 0)


def test_a_failed_replacement_keeps_the_old_batch(spark, lake):
    schema = schemas.TABLES["bronze.ingestion_audit"]
    row = tuple("a" if f.dataType.simpleString() == "string" else None for f in schema.fields)
    good = spark.createDataFrame([row, row], schema)
    lake.replace_batch(good, "bronze.ingestion_audit", "B1")
    bad = good.withColumn(schema.names[0], F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(PySparkException):
        lake.replace_batch(bad, "bronze.ingestion_audit", "B1")
    assert lake.read("bronze.ingestion_audit", "B1").count() == 2
    lake.replace_batch(good.limit(1), "bronze.ingestion_audit", "B1")
    assert lake.read("bronze.ingestion_audit", "B1").count() == 1


@pytest.mark.parametrize("batch", ["B1", None])
def test_a_writer_that_stops_between_the_moves_leaves_the_old_rows(lake, monkeypatch, batch):
    """The old folder lies aside, and every reader finds it there; the next writer goes on as ever."""
    table = "silver.customers_by_batch" if batch else "gold.dim_merchant"
    key = "customer_id" if batch else "merchant_id"

    def write(value, where):
        rows = lake.spark.createDataFrame([(value,)], f"{key} string")
        lake.replace_batch(rows, table, where) if where else lake.replace(rows, table)

    write("old", batch)
    if batch:
        write("other", "B2")
    move = Lake._move

    def stop(self, path, target):
        if "/fresh-" in path:
            raise KeyboardInterrupt
        move(self, path, target)

    monkeypatch.setattr(Lake, "_move", stop)
    with pytest.raises(KeyboardInterrupt):
        write("new", batch)
    monkeypatch.undo()
    values = lambda where=None: sorted(r[0] for r in Lake(lake.spark, lake.root).read(table, where).select(key).collect())
    assert values() == (["old", "other"] if batch else ["old"]) and lake.exists(table)
    if batch:
        assert (values("B1"), values("B2")) == (["old"], ["other"])
    write("new", batch)
    assert values() == (["new", "other"] if batch else ["new"])


def test_runs_on_one_lake_do_not_share_staging(lake):
    other, one = Lake(lake.spark, lake.root), lake.spark.range(3)
    first, second = lake.stage(one, "x"), other.stage(one.filter("id = 1"), "x")
    assert (first.count(), second.count()) == (3, 1)
    other.clear_staging()
    assert first.count() == 3


def test_work_folder_without_the_setting(monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

        def set(self, name, value):
            raise AssertionError("a running session cannot be changed")

    class Context:
        master, applicationId = "local[2]", "app-of-a-test"

    class Session:
        conf, sparkContext = Conf(), Context()

    folder = session.work_folder(Session())
    assert folder == session.work_folder(Session())
    Context.master, Context.applicationId = "spark://far", "other"
    with pytest.raises(ValueError, match="checkpoint"):
        session.work_folder(Session())
