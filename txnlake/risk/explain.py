"""Readable reasons for a risk tier, as one column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnlake.functions.text import fixed_text

TOP = 3
_GAP = "\x01"  # never part of a reason


def reasons() -> list[Column]:
    """Reasons in order of importance; a reason that does not apply is null.

    Wording, limits and order are fixed values.
    """
    c = F.col
    amount, ratio = c("amount"), c("amount_ratio")
    say = lambda *parts: F.concat(*[
        F.lit(p) if isinstance(p, str) else p for p in parts])
    country = lambda name: F.coalesce(c(name), F.lit("None"))
    large = (
        F.when(ratio >= 3.0, say(
            "Transaction amount (", fixed_text(amount, 2), ") is ", fixed_text(ratio, 1),
            "x customer historical average (", fixed_text(c("customer_avg_amount"), 2), ")"))
        .when(amount > 5000, say(
            "Unusually high absolute transaction amount (", fixed_text(amount, 2), ")"))
    )
    abroad = F.when(c("country_mismatch") == 1, say(
        "Cross-border anomaly: customer country (", country("cust_country"),
        ") differs from transaction country (", country("txn_country"), ")"))
    failing = F.when(c("merchant_failure_rate") >= 0.20, say(
        "Elevated merchant risk profile (",
        fixed_text(c("merchant_failure_rate").cast("decimal(20,12)") * 100, 1),
        "% historical payment failure rate)"))
    sparse = F.when((c("customer_txn_count") <= 5) & (amount > 500), F.lit(
        "Sparse customer history: high value transaction on nascent account"))
    hour = c("hour_of_day")
    night = F.when(hour.isin(1, 2, 3, 4) & (amount > 1000), say(
        "Off-peak execution window (", F.lpad(hour.cast("int").cast("string"), 2, "0"),
        ":00 UTC) with substantial value"))
    return [large, abroad, failing, sparse, night]


def risk_reasons() -> Column:
    """The first three reasons, or a sentence for rows that have none."""
    first = F.substring_index(F.concat_ws(_GAP, *reasons()), _GAP, TOP)
    found = F.replace(first, F.lit(_GAP), F.lit(" | "))
    none = F.when(
        F.col("risk_tier") == "HIGH",
        "Multi-dimensional multivariate outlier detected by Isolation Forest",
    ).otherwise("Standard risk profile within baseline expectations")
    return F.when(
        F.col("risk_tier").isin("HIGH", "MEDIUM"), F.when(found == "", none).otherwise(found)
    ).otherwise("Within standard baseline behavior")


def add_explanations(scored: DataFrame) -> DataFrame:
    return scored.withColumn("risk_reasons", risk_reasons())
