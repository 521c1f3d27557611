"""Seven pass-or-fail controls over the finished layers."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlake import schemas
from txnlake.config import Config
from txnlake.functions.parse import hours_before, iso_text
from txnlake.operators.bronze import utc_now
from txnlake.operators.quality import surplus_rows
from txnlake.plans.reconciliation import reconciliation
from txnlake.sources.lake import Lake

# Names of the controls and advice given with them.
CONTROLS = {
    "CTL-01": ("Transaction Uniqueness",
               "Re-run Silver deduplication step; investigate Bronze source for duplicate injection."),
    "CTL-02": ("Referential Integrity",
               "Check Silver→Gold join logic; ensure dim tables are populated before facts."),
    "CTL-03": ("Amount Validation",
               "Quarantine amount-invalid records in Silver; investigate source system."),
    "CTL-04": ("Status Validity",
               "Review Silver status-validation logic; ensure bad-status records are quarantined."),
    "CTL-05": ("Pipeline Freshness",
               "Investigate pipeline delays; check ingestion schedule and source availability."),
    "CTL-06": ("Schema Validation",
               "Re-run warehouse build; check DDL for schema drift."),
    "CTL-07": ("Reconciliation",
               "Investigate Silver transformation for record loss. "
               "Check quarantine logic for records dropped without logging."),
}
EMPTY_SILVER_ADVICE = "Run ingestion pipeline. Check generator and ingest steps."


def _result(control: str, passed: Column, detail: Column, checked: Column, failed: Column,
            executed_at: str, advice: Column | None = None) -> Column:
    name, usual = CONTROLS[control]
    return F.struct(
        F.lit(control).alias("control_id"), F.lit(name).alias("control_name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"), detail.alias("detail"),
        checked.cast("long").alias("records_checked"), failed.cast("long").alias("records_failed"),
        F.lit(executed_at).alias("execution_timestamp"),
        (F.lit(usual) if advice is None else advice).alias("remediation"))


def _rows(one: DataFrame, results: list[Column], by: list[str] | None = None) -> DataFrame:
    by = by or []
    return one.select(*by, F.explode(F.array(*results)).alias("r")).select(
        *by, *[F.col(f"r.{name}") for name in schemas.CONTROL_RESULT.names])


def _zero_failures(control: str, failed: Column, words: str, executed_at: str) -> Column:
    return _result(control, failed == 0, F.concat(failed.cast("string"), F.lit(words)),
                   F.col("_total"), failed, executed_at)


def fact_controls(fact: DataFrame, cfg: Config, executed_at: str) -> DataFrame:
    """CTL-01 to CTL-04: one scan of the fact table beside the count of repeated ids."""
    c = F.col
    ceiling = cfg.max_amount
    measured = fact.agg(
        F.count("*").alias("_total"),
        F.count_if(c("customer_sk").isNull() | c("merchant_sk").isNull()
                   | c("payment_method_sk").isNull()).alias("_unresolved"),
        F.count_if(c("amount").isNull() | (c("amount") <= 0) | (c("amount") > ceiling))
        .alias("_amounts"),
        # A null status is neither inside nor outside the set.
        F.count_if(~c("status").isin(*cfg.statuses)).alias("_statuses"),
    ).withColumn("_surplus", surplus_rows(fact, "transaction_id").scalar())
    return _rows(measured, [
        _zero_failures("CTL-01", c("_surplus"),
                       " duplicate transaction_id(s) found in gold.fact_transactions", executed_at),
        _zero_failures("CTL-02", c("_unresolved"), " fact rows with NULL dimension key(s)",
                       executed_at),
        _zero_failures("CTL-03", c("_amounts"),
                       f" transactions with invalid amount (null, <=0, or >{ceiling})", executed_at),
        _zero_failures("CTL-04", c("_statuses"), " transactions with non-approved status value",
                       executed_at),
    ])


def freshness_control(transactions: DataFrame, sla_hours: int, as_of: datetime,
                      executed_at: str) -> DataFrame:
    """CTL-05: the latest Silver transaction lies within the agreed hours before `as_of`."""
    latest = F.col("_latest")
    cutoff = hours_before(F.lit(as_of).cast("timestamp_ntz"), sla_hours)
    fresh = F.coalesce(latest >= cutoff, F.lit(False))
    detail = F.concat(F.lit("Latest transaction at "), iso_text(latest, "T"), F.lit("+00:00 — "),
                      F.when(fresh, "within").otherwise("OUTSIDE"), F.lit(f" {sla_hours}h SLA"))
    return _rows(transactions.agg(F.max("ts").alias("_latest")), [_result(
        "CTL-05", fresh,
        F.when(latest.isNull(), "No transactions in Silver layer").otherwise(detail),
        F.when(latest.isNull(), 0).otherwise(1),
        F.when(latest.isNull() | fresh, 0).otherwise(1), executed_at,
        F.when(latest.isNull(), EMPTY_SILVER_ADVICE).otherwise(CONTROLS["CTL-05"][1]))])


def schema_control(gold: dict[str, DataFrame], executed_at: str) -> DataFrame:
    """CTL-06: expected columns are there. Only schemas are looked at, no rows are read."""
    gaps = []
    for table, expected in schemas.CONTROLLED_GOLD.items():
        missing = [c for c in expected if c not in gold[table].columns]
        if missing:
            gaps.append(f"{table}: missing {missing}")
    spark = next(iter(gold.values())).sparkSession
    return _rows(spark.range(1), [_result(
        "CTL-06", F.lit(not gaps), F.lit("; ".join(gaps) or "All expected columns present"),
        F.lit(len(schemas.CONTROLLED_GOLD)), F.lit(len(gaps)), executed_at)])


def reconciliation_control(reconciled: DataFrame, executed_at: str,
                           by: list[str] | None = None) -> DataFrame:
    """CTL-07: no raw row of the batch is unaccounted for. Columns in `by` are kept in front."""
    c = F.col
    balanced = c("delta") == 0
    text = lambda name: c(name).cast("string")
    detail = F.concat(
        F.lit("Raw="), text("raw_count"), F.lit(" | Silver="), text("silver_count"),
        F.lit(" | Quarantine="), text("quarantine_count"), F.lit(" | Delta="), text("delta"),
        F.when(balanced, " (balanced)").otherwise(" (UNACCOUNTED RECORDS)"))
    return _rows(reconciled, [_result(
        "CTL-07", balanced, detail, c("raw_count"), F.abs("delta"), executed_at,
        F.when(balanced, "").otherwise(CONTROLS["CTL-07"][1]))], by)


def table_controls(lake: Lake, cfg: Config, as_of: datetime, executed_at: str) -> DataFrame:
    """CTL-01 to CTL-06, which look at whole tables."""
    gold = {table: lake.as_stored(table) for table in schemas.CONTROLLED_GOLD}
    return (
        fact_controls(lake.fact(), cfg, executed_at)
        .unionByName(freshness_control(lake.transactions(), cfg.freshness_sla_hours, as_of,
                                       executed_at))
        .unionByName(schema_control(gold, executed_at))
    )


def batch_verdicts(lake: Lake, reconciled: DataFrame, cfg: Config, as_of: datetime,
                   executed_at: str) -> DataFrame:
    """(batch_id, control_status) over all seven controls, for each reconciled batch."""
    failing = overall(table_controls(lake, cfg, as_of, executed_at)).select("fail_count").scalar()
    own = F.col("status") == "PASS"
    return reconciliation_control(reconciled, executed_at, ["batch_id"]).select(
        "batch_id", F.when(own & (failing == 0), "PASS").otherwise("FAIL").alias("control_status"))


def control_report(lake: Lake, batch_id: str, cfg: Config, as_of: datetime,
                   executed_at: str | None = None) -> DataFrame:
    """The seven control rows."""
    executed_at = executed_at or as_of.isoformat()
    return table_controls(lake, cfg, as_of, executed_at).unionByName(
        reconciliation_control(reconciliation(lake, batch_id), executed_at))


def overall(report: DataFrame) -> DataFrame:
    """(pass_count, fail_count, overall_status): PASS only without any FAIL."""
    failing = F.col("fail_count")
    return report.agg(
        F.count_if(F.col("status") == "PASS").alias("pass_count"),
        F.count_if(F.col("status") == "FAIL").alias("fail_count"),
    ).withColumn("overall_status", F.when(failing == 0, "PASS").otherwise("FAIL"))


def run_controls(spark: SparkSession, lake_root: str, batch_id: str, cfg: Config | None = None,
                 as_of: datetime | None = None) -> dict[str, Any]:
    """Run the seven controls for a batch and return their rows and the overall verdict."""
    lake = Lake(spark, lake_root)
    cfg = cfg or Config()
    results = control_report(lake, batch_id, cfg, as_of or utc_now()).collect()  # seven rows
    verdict = overall(spark.createDataFrame(results, schemas.CONTROL_RESULT)).first()
    return {"results": [r.asDict() for r in results], **verdict.asDict()}
