"""Planted defects in a clean raw feed, for trials of the validation rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from txnlake.config import DEFECT_RATES

# Statuses that validation has to reject.
BAD_STATUSES = ("DECLINED", "UNKNOWN", "ERR", "null", "CANCELLED")
ROWS_PER_DONOR = 64


def _hash(kind: str, seed: int) -> Column:
    """Sixty bits of an MD5, which any SQL engine can repeat."""
    key = F.concat_ws("|", F.col("_row_seq").cast("string"), F.lit(kind), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _number(kind: str, seed: int, below: int) -> Column:
    return F.pmod(_hash(f"{kind} value", seed), F.lit(below))


def inject_defects(df: DataFrame, rates: dict[str, float] | None = None, seed: int = 42,
                   as_of: datetime | None = None, at_least_one: bool = False) -> DataFrame:
    """Overwrite fields of about `rate` of the rows for each kind of defect.

    Rows are picked per kind by a hash of `_row_seq`, so kinds may meet in one row and the
    pick does not depend on partitions. A rate of 0 picks nothing. `at_least_one` also picks
    the row with the smallest hash, for every kind that has a rate.
    """
    rates = DEFECT_RATES if rates is None else rates
    as_of = as_of or datetime(2024, 1, 31)
    original = df.columns

    def picked(kind: str) -> Column:
        rate = rates.get(kind, 0.0)
        if rate <= 0:
            return F.lit(False)
        place = F.pmod(_hash(kind, seed), F.lit(1 << 40))
        chosen = place < int(rate * (1 << 40))
        if at_least_one:
            chosen = chosen | (place == df.agg(F.min(place)).scalar())
        return chosen

    df_flags = df.withColumns({f"_{kind}": picked(kind) for kind in rates})
    flag = lambda kind: F.col(f"_{kind}") if kind in rates else F.lit(False)
    token = lambda kind: F.lower(F.lpad(F.hex(_number(kind, seed, 1 << 32)), 8, "0"))

    # A repeated id is taken from a clean row of the same hash class. Classes grow with the rows,
    # so no id is repeated often and the join has no hot key.
    classes = df.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / ROWS_PER_DONOR))).scalar()
    by_class = F.pmod(_hash("donor", seed), classes).alias("_class")
    donors = df_flags.filter(~flag("duplicate_transaction_id")).groupBy(by_class).agg(
        F.min("transaction_id").alias("_donor"))
    df_flags = df_flags.withColumn("_class", by_class).join(donors, "_class", "left")

    later = F.lit(as_of).cast("timestamp_ntz") + F.make_dt_interval(
        days=(_number("future_timestamp", seed, 30) + 1).cast("int"))
    below_zero = -(_number("negative_amount", seed, 50_000) + 1).cast("decimal(12,2)") / 100
    changes = {
        "transaction_id": F.when(flag("duplicate_transaction_id"),
                                 F.coalesce("_donor", "transaction_id")),
        "customer_id": F.when(flag("null_customer_id"), "")
        .when(flag("orphan_customer_id"), F.concat(F.lit("ORPHAN_"), token("orphan_customer_id"))),
        "merchant_id": F.when(flag("orphan_merchant_id"),
                              F.concat(F.lit("ORPHAN_"), token("orphan_merchant_id"))),
        "timestamp": F.when(flag("malformed_timestamp"),
                            F.concat(F.lit("bad-"), token("malformed_timestamp")))
        .when(flag("future_timestamp"), F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")),
        "amount": F.when(flag("null_amount"), "")
        .when(flag("negative_amount"), below_zero.cast("decimal(12,2)").cast("string")),
        "currency": F.when(flag("invalid_currency"), F.upper(F.concat(
            F.lit("Z"), F.substring(token("invalid_currency"), 1, 3)))),
        "status": F.when(flag("invalid_status"), F.element_at(
            F.array(*[F.lit(s) for s in BAD_STATUSES]),
            (_number("invalid_status", seed, len(BAD_STATUSES)) + 1).cast("int"))),
    }
    return df_flags.select(*[
        F.coalesce(changes[c], F.col(c)).alias(c) if c in changes else F.col(c) for c in original])
