"""Grammar of amounts, timestamps, dates and number text, against Python's own parsers."""

from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from txnlake.functions import money, parse, text

AMOUNTS = [
    "", " 2 ", "1_000", "1.5d", "0x1p3", "inf", "-Infinity", "1e7", "0", "-1", "1000000",
    "1000000.01", "1__0", "_1", "1.", ".5", "1e5_0", "+3", "1e999", ".", "e5", "1_", None, "1.5f",
    "\t7\n", "12345678901234567890", "1,5", "--1", "1 2",
]
TIMESTAMPS = [
    "2024-01-01", "2024-1-5", "20240101", "2024-W01-1", "2024W011", "2024-W01", "2024-W011",
    "2024-W53-1", "2020-W53-7", "2024-W01-8", "2024", "2024-01", "10:30", "now", "epoch", "None",
    "nan", "", None, " 2024-01-01 ", "2024-01-01T00:00:00+00:00", "2024-01-01 01:02:03.5",
    "2024-01-01x10:20", "2024-01-01T1020", "2024-01-01T10:20:30,5", "2024-01-01T10:20:30.1234567",
    "2024-01-01T10:20:30+0530", "2024-01-01T10:20:30+05", "2024-01-01T10:20:30+05:30:15.5",
    "20240101T102030Z", "20240101 10:20", "2024-01-01T", "2024-01-01T10:20:30z",
    "2024-01-01T10:20+24:00", "2024-01-01T10:20:30.", "2024-01-01T10:2030", "2024-01-01T24:00:00",
    "20240101T10:20:30-00:00", "2024-1-5T1:2:3", "2024-1-5 1:2:3", "2024-1-5T1:2:3Z",
    "2024-1-5T1:2:3.25-0330", "2024-1-5 1:2:3Z", "2024-1-5T1:2", "2024-02-30", "2024-13-01",
    "0000-01-01", "garbage5", "2999-01-01T00:00:00+00:00", "2024-01-01T10-05:00", "2024/01/01",
    "2024-01-01T25:00", "2024-01-01+05:00", "20240101+0500", "2024-01-01T10:20:30+05:99",
    "2024-01-01T00:00:00-00:30", "24-01-01", "2024-01-01T12+0530", "2024-01-01T10:20:61",
]
LAYOUTS = ["%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S",
           "%Y-%m-%d %H:%M:%S", "%Y-%m-%d"]


def expected_amount(value):
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def expected_time(value):
    value = (value or "").strip()
    if value in ("", "None", "nan"):
        return None
    for reader in [datetime.fromisoformat] + [
            lambda v, f=f: datetime.strptime(v, f) for f in LAYOUTS]:
        try:
            found = reader(value)
        except ValueError:
            continue
        return found if found.tzinfo else found.replace(tzinfo=UTC)
    return None


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]


def test_amounts(spark):
    assert column(spark, AMOUNTS, parse.parse_amount(F.col("s"))) == [
        expected_amount(a) for a in AMOUNTS]


def test_not_a_number_is_no_amount(spark):
    assert column(spark, ["nan", "NaN"], parse.parse_amount(F.col("s"))) == [None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789._eE+- ", max_size=8), min_size=40, max_size=60))
def test_amount_grammar(spark, values):
    assert column(spark, values, parse.parse_amount(F.col("s"))) == [
        expected_amount(a) for a in values]


def times(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    df = parse.with_timestamp(df, "s", "utc", "east")
    return df.select("i", F.col("utc").cast("string").alias("utc"),
                     F.expr(parse.offset_iso_text("utc", "east")).alias("iso")).orderBy("i").collect()


def check_times(spark, values):
    for value, row in zip(values, times(spark, values), strict=True):
        want = expected_time(value)
        assert row.iso == (want.isoformat() if want else None), value
        if want:
            at = want.astimezone(UTC).replace(tzinfo=None)
            assert datetime.fromisoformat(row.utc) == at, value


def test_timestamps(spark):
    check_times(spark, TIMESTAMPS)


@settings(max_examples=4, deadline=None)
@given(st.lists(
    st.tuples(st.datetimes(min_value=datetime(1900, 1, 1), max_value=datetime(2200, 1, 1)),
              st.sampled_from(["", "Z", "+00:00", "-0330", "+05", "+23:59"]),
              st.sampled_from(["T", " ", "_"]), st.booleans()).map(
        lambda v: (v[0].strftime("%Y%m%d" if v[3] else "%Y-%m-%d") + v[2]
                   + v[0].time().isoformat() + v[1])),
    min_size=30, max_size=50))
def test_timestamp_grammar(spark, values):
    check_times(spark, values)


def test_dates(spark):
    values = ["2024-01-05", "2024/1/5", "2024 01 05", "2024-01-05 10:00:00", "20240105", "2024-01",
              "2024-02-30", "2024-01/05", "today", "", None, " 2024-01-05 "]
    day = date(2024, 1, 5)
    assert column(spark, values, parse.parse_date(F.col("s"))) == [
        day, day, day, day, None, None, None, None, None, None, None, day]


@pytest.mark.parametrize("value", [
    0.0, -0.0001, 2.5e7, -12.3, 12.0, 1e-5, 1e16, 1.5e16, 123456789.125, 0.0005, float("inf"),
    float("-inf"), 1e100, 2e-200])
def test_float_text(spark, value):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(F.expr(text.float_text("x"))).first()[0] == repr(value)


@pytest.mark.parametrize("value", ["it's", 'a"b', "a'b\"c", "a\tb\\c", None, "\n", "", "plain"])
def test_quoted(spark, value):
    df = spark.createDataFrame([(value,)], "x string")
    assert df.select(F.expr(text.quoted("x"))).first()[0] == repr(value)


def test_strip_takes_every_kind_of_space(spark):
    values = [" \t\r\n a b \x1c 　", None, "\xa0"]
    assert column(spark, values, text.stripped(F.col("s"))) == ["a b", "", ""]


def test_halves_go_up(spark):
    row = spark.sql("SELECT 1L AS p, 8L AS w, 0L AS z").select(
        money.percent(F.col("p"), F.col("w")), money.rate(F.col("p"), F.col("w") * 2, 3),
        money.percent(F.col("p"), F.col("z"))).first()
    assert list(row) == [12.5, 0.063, None]


def test_money_is_exact_in_any_order(spark):
    df = spark.range(1000).select((F.col("id") * 0.01).alias("amount"))
    sums = {df.repartition(n).agg(money.money_sum("amount")).first()[0] for n in (1, 7, 16)}
    assert [str(s) for s in sums] == ["4995.000000"]
    average = df.agg(money.cents_average(money.money_sum("amount"), F.count("amount"))).first()[0]
    assert average == 5.0  # 4.995 rounded up


def test_iso_text_drops_empty_fraction(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05' a, timestamp_ntz'2024-01-02 03:04:05.5' b")
    assert list(df.select(parse.iso_text(F.col("a"), "T"), parse.iso_text(F.col("b"), " ")).first()) == [
        "2024-01-02T03:04:05", "2024-01-02 03:04:05.500000"]
