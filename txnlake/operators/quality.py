"""Threshold checks on a table, with a verdict per check and a score over all of them.

All checks that only look at single rows share one scan. A check that needs its own shuffle
(uniqueness, references) is a scalar subquery beside that scan, and shuffles counted keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlake import schemas
from txnlake.config import Config
from txnlake.functions.money import rate, ratio
from txnlake.functions.parse import hours_before, iso_text
from txnlake.operators.bronze import utc_now
from txnlake.sources.lake import Lake

@dataclass(frozen=True)
class Check:
    """One check: what it measures on the table and how it reads its measures."""

    name: str
    kind: str
    failed: Column
    detail: Column
    verdict: Callable[[Column], Column]
    shared: dict[str, Column] = field(default_factory=dict)
    own: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = field(default_factory=dict)
    failure_rate: Column | None = None

    def result(self, dataset: str, executed_at: str) -> Column:
        exact = F.coalesce(self.failed / F.nullif(F.col("_total"), F.lit(0)), F.lit(0.0))
        shown = F.coalesce(rate(self.failed, F.col("_total"), 6), F.lit(0.0))
        return F.struct(
            F.lit(dataset).alias("dataset"), F.lit(self.name).alias("check_name"),
            F.lit(self.kind).alias("check_type"), F.col("_total").alias("records_checked"),
            self.failed.cast("long").alias("records_failed"),
            (shown if self.failure_rate is None else self.failure_rate).cast("double")
            .alias("failure_rate"),
            self.verdict(exact).alias("status"),
            F.lit(executed_at).alias("execution_timestamp"), self.detail.alias("detail"))


def threshold(warn: float, fail: float) -> Callable[[Column], Column]:
    """FAIL above one rate, WARN above the other; a rate on the limit does not count."""
    return lambda exact: F.when(exact > fail, "FAIL").when(exact > warn, "WARN").otherwise("PASS")


def _counted(words_before: str, failed: Column, words_after: str) -> Column:
    return F.concat(F.lit(words_before), failed.cast("string"), F.lit(words_after))


def not_null(column: str, warn: float, fail: float) -> Check:
    """Null or blank values. Blank means spaces only."""
    name = f"not_null__{column}"
    empty = F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")
    return Check(name, "COMPLETENESS", F.col(name),
                 _counted(f"Column '{column}' has ", F.col(name), " null/empty values"),
                 threshold(warn, fail), {name: F.count_if(empty)})


def surplus_rows(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each value of `column`. Null is a value of its own.

    One row, or with `by` one row for each group that has such rows.
    """
    by = by or []
    counts = df.groupBy(*by, column).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)
    return counts.groupBy(*by).agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).alias("surplus"))


def uniqueness(column: str, warn: float = 0.0, fail: float = 0.0) -> Check:
    name = f"unique__{column}"
    return Check(name, "UNIQUENESS", F.col(name),
                 _counted(f"Column '{column}' has ", F.col(name), " duplicate extra rows"),
                 threshold(warn, fail), own={name: lambda df, by: surplus_rows(df, column, by)})


def amount_positive(warn: float, fail: float) -> Check:
    name = "amount_positive"
    bad = F.col("amount").isNull() | (F.col("amount") <= 0)
    return Check(name, "VALIDITY", F.col(name),
                 _counted("", F.col(name), " rows with null or non-positive amount"),
                 threshold(warn, fail), {name: F.count_if(bad)})


def valid_values(column: str, allowed: tuple[str, ...], warn: float, fail: float) -> Check:
    """Values outside a set. A null is neither inside nor outside, so it does not count."""
    name = f"valid_values__{column}"
    return Check(name, "VALIDITY", F.col(name),
                 _counted("", F.col(name), f" rows where '{column}' is not in allowed set"),
                 threshold(warn, fail), {name: F.count_if(~F.col(column).isin(*allowed))})


def unmatched_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                   by: list[str] | None = None) -> DataFrame:
    """Child rows without a parent, null keys included.

    One row, or with `by` one row for each group that has such rows. Child rows are counted per
    key first, so the join sees each key once in a group.
    """
    by = by or []
    keys = child.groupBy(*by, F.col(column).alias("_key")).agg(F.count("*").alias("_n"))
    parents = parent.select(F.col(parent_column).alias("_key"))
    return keys.join(parents, "_key", "left_anti").groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("unmatched"))


def referential_integrity(dataset: str, column: str, parent: DataFrame, parent_name: str,
                          parent_column: str, warn: float, fail: float) -> Check:
    name = f"ref_integrity__{column}__{parent_name}"
    measure = f"unmatched__{column}"
    return Check(
        name, "REFERENTIAL_INTEGRITY", F.col(measure),
        _counted("", F.col(measure), f" rows in {dataset}.{column} with no match in {parent_name}"),
        threshold(warn, fail),
        own={measure: lambda df, by: unmatched_rows(df, column, parent, parent_column, by)})


def freshness(column: str, sla_hours: int, as_of: datetime) -> Check:
    """The latest value must not lie more than `sla_hours` before `as_of`."""
    latest = F.col("_latest")
    cutoff = hours_before(F.lit(as_of).cast("timestamp_ntz"), sla_hours)
    stale = latest.isNull() | (latest < cutoff)
    shown = F.concat(iso_text(latest, " "), F.lit("+00:00"))
    return Check(
        "pipeline_freshness", "FRESHNESS",
        F.when(latest.isNull(), F.col("_total")).when(stale, 1).otherwise(0),
        F.when(latest.isNull(), "No records found in table")
        .when(stale, F.concat(F.lit("Latest record at "), shown,
                              F.lit(f" is older than SLA ({sla_hours}h)")))
        .otherwise(F.concat(F.lit("Latest record at "), shown, F.lit(" is within SLA"))),
        lambda _: F.when(stale, "FAIL").otherwise("PASS"),
        {"_latest": F.max(column)},
        failure_rate=F.when(stale, 1.0).otherwise(0.0))


def volume(baseline: int | Column, share: float) -> Check:
    """The row count must lie within baseline ± share, both ends included."""
    base = F.lit(baseline) if isinstance(baseline, int) else baseline
    lower, upper = base * F.lit(1 - share), base * F.lit(1 + share)
    outside = ~F.col("_total").between(lower, upper)
    whole = lambda c: F.floor(c).cast("string")
    return Check(
        "volume_anomaly", "VOLUME", F.lit(0),
        F.concat(F.lit("Count "), F.col("_total").cast("string"),
                 F.when(outside, " outside").otherwise(" within"), F.lit(" expected range ["),
                 whole(lower), F.lit(", "), whole(upper), F.lit("]")),
        lambda _: F.when(outside, "FAIL").otherwise("PASS"),
        failure_rate=F.when(outside, 1.0).otherwise(0.0))


def run_checks(df: DataFrame, dataset: str, checks: list[Check], executed_at: str) -> DataFrame:
    """One result row per check, in the order given."""
    shared: dict[str, Column] = {}
    for check in checks:
        shared.update(check.shared)
    measured = df.agg(F.count("*").alias("_total"), *[m.alias(n) for n, m in shared.items()])
    own = {name: make(df, []).scalar() for check in checks for name, make in check.own.items()}
    if own:
        measured = measured.withColumns(own)
    results = F.array(*[check.result(dataset, executed_at) for check in checks])
    return measured.select(F.explode(results).alias("r")).select(
        *[F.col(f"r.{name}") for name in schemas.DQ_RESULT.names])


def run_checks_by(df: DataFrame, by: str, groups: DataFrame, dataset: str, checks: list[Check],
                  executed_at: str) -> DataFrame:
    """run_checks for every row of `groups`, as result rows with the column `by` in front.

    `groups` has one row per group; its other columns can be used by the checks. All groups are
    measured together, so the number of jobs does not depend on how many there are. A group
    without rows is measured as an empty table.
    """
    shared: dict[str, Column] = {}
    for check in checks:
        shared.update(check.shared)
    counted = {"_total", *(name for name in shared if name != "_latest")}
    measured = groups.join(df.groupBy(by).agg(
        F.count("*").alias("_total"), *[m.alias(n) for n, m in shared.items()]), by, "left")
    for check in checks:
        for name, make in check.own.items():
            measured = measured.join(make(df, [by]).toDF(by, name), by, "left")
            counted.add(name)
    measured = measured.fillna(0, sorted(counted))
    results = F.array(*[check.result(dataset, executed_at) for check in checks])
    return measured.select(by, F.explode(results).alias("r")).select(
        by, *[F.col(f"r.{name}") for name in schemas.DQ_RESULT.names])


def expected_volume(rows: int | Column, cfg: Config) -> int | Column:
    """Rows expected in Silver out of so many raw rows."""
    if isinstance(rows, int):
        return int(rows * cfg.clean_share)
    return F.floor(rows * F.lit(cfg.clean_share))


def standard_checks(lake: Lake, cfg: Config, raw_rows: int | Column, as_of: datetime) -> list[Check]:
    """The fourteen checks on Silver transactions."""
    warn, fail = cfg.warn_rate, cfg.fail_rate
    table = "silver.transactions"
    return [
        *[not_null(c, warn, fail) for c in (
            "transaction_id", "customer_id", "merchant_id", "amount", "ts")],
        uniqueness("transaction_id"),
        amount_positive(warn, fail),
        valid_values("status", cfg.statuses, warn, fail),
        valid_values("currency", cfg.currencies, warn, fail),
        valid_values("payment_method", cfg.payment_methods, warn, fail),
        referential_integrity(table, "customer_id", lake.entity_ids("customers"),
                              "silver.customers", "customer_id", warn, fail),
        referential_integrity(table, "merchant_id", lake.entity_ids("merchants"),
                              "silver.merchants", "merchant_id", warn, fail),
        freshness("ts", cfg.freshness_sla_hours, as_of),
        volume(expected_volume(raw_rows, cfg), cfg.volume_threshold),
    ]


def quality_score(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., quality_score, pass_count, warn_count, fail_count); a WARN counts half."""
    status, by = F.col("status"), by or []
    counted = results.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(status == "PASS").alias("pass_count"),
        F.count_if(status == "WARN").alias("warn_count"),
        F.count_if(status == "FAIL").alias("fail_count"))
    halves = F.col("pass_count") * 2 + F.col("warn_count")
    return counted.select(
        *by, F.coalesce(ratio(halves, F.col("n") * 2, 1000, 10), F.lit(0.0)).alias("quality_score"),
        "pass_count", "warn_count", "fail_count")


def run_dq_checks(spark: SparkSession, lake_root: str, cfg: Config | None = None,
                  baseline_txn_count: int | None = None,
                  as_of: datetime | None = None) -> dict[str, Any]:
    """Run the fourteen checks and return their rows, the score and the counts."""
    lake = Lake(spark, lake_root)
    cfg = cfg or Config()
    as_of = as_of or utc_now()
    checks = standard_checks(lake, cfg, baseline_txn_count or cfg.expected_transactions, as_of)
    rows = run_checks(lake.transactions(), "silver.transactions", checks, as_of.isoformat())
    results = rows.collect()  # fourteen rows
    score = quality_score(spark.createDataFrame(results, schemas.DQ_RESULT)).first()
    return {"results": [r.asDict() for r in results], **score.asDict()}
