"""Silver: typed rows and quarantined rows from one pass over a raw batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from txnlake import schemas
from txnlake.config import Config
from txnlake.functions.jobs import together, written
from txnlake.functions.lookup import BROADCAST_ROWS, hot_keys, is_small, lookup
from txnlake.functions.parse import (
    offset_iso_text, parse_amount, parse_date, with_timestamp,
)
from txnlake.functions.text import float_text, quoted, stripped
from txnlake.operators.bronze import utc_now
from txnlake.operators.history import FILTERS, known_ids, write_filter
from txnlake.sources.lake import Lake, first_by_key

RAW_COLUMNS = [*schemas.RAW["transactions"].names, "_ingested_at"]


def clean_customers(raw: DataFrame) -> DataFrame:
    """One row per non-empty customer id: the first in file order."""
    return first_by_key(_with_id(raw, "customer_id"), "customer_id", F.col("_row_seq")).withColumn(
        "customer_since", parse_date(F.col("customer_since")))


def clean_merchants(raw: DataFrame) -> DataFrame:
    """One row per non-empty merchant id: the first in file order."""
    return first_by_key(_with_id(raw, "merchant_id"), "merchant_id", F.col("_row_seq"))


def _with_id(raw: DataFrame, key: str) -> DataFrame:
    return raw.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def repeated_ids(raw: DataFrame, earlier: DataFrame | None = None,
                 small_batch: bool = False, filters: DataFrame | None = None,
                 limit: int = BROADCAST_ROWS) -> DataFrame:
    """Ids that occur more than once: (transaction_id, first_seq, copies).

    `first_seq` is the row that keeps the id, or null when Silver holds the id from another
    batch. Only ids and row numbers are shuffled, and the counts are partial before that. With
    `filters` of the earlier batches a large batch reads only candidates among their ids.
    """
    ids = raw.select(stripped(F.col("transaction_id")).alias("transaction_id"), "_row_seq").groupBy(
        "transaction_id").agg(F.min("_row_seq").alias("first_seq"), F.count("*").alias("copies"))
    if earlier is None:
        return ids.filter(F.col("copies") > 1)
    known = earlier.select("transaction_id")
    if small_batch:
        # The caller counted the batch: its ids are few, so the history is not shuffled.
        known = known.join(F.broadcast(ids.select("transaction_id")), "transaction_id", "left_semi").distinct()
    elif filters is not None:
        known = known_ids(ids.select("transaction_id"), earlier, filters, limit)
    else:
        known = known.distinct()
    known = known.withColumn("_known", F.lit(True))
    marked = ids.join(known, "transaction_id", "left")
    return marked.filter((F.col("copies") > 1) | F.col("_known")).select(
        "transaction_id", F.when(F.col("_known").isNull(), F.col("first_seq")).alias("first_seq"),
        "copies")


def normalise(raw: DataFrame) -> DataFrame:
    """Trimmed and case-folded codes beside the raw text."""
    text = lambda name: stripped(F.col(name))
    return raw.withColumns({
        "_id": text("transaction_id"),
        "_customer": text("customer_id"),
        "_merchant": text("merchant_id"),
        "_currency": F.upper(text("currency")),
        "_status": F.upper(text("status")),
        "_method": F.lower(text("payment_method")),
    })


def rule_reasons(cfg: Config, as_of: datetime) -> dict[str, str]:
    """SQL of the reason text per rule, null where the rule holds; in the order of reporting."""
    def outside(column: str, allowed: tuple[str, ...], words: str) -> str:
        listed = ", ".join(f"'{value}'" for value in allowed)
        return f"CASE WHEN {column} NOT IN ({listed}) THEN concat('{words}: ', {quoted(column)}) END"

    def unknown(column: str, found: str, words: str) -> str:
        return (f"CASE WHEN {column} = '' THEN 'null {words}' "
                f"WHEN {found} IS NULL THEN concat('orphan {words}: ', {column}) END")

    return {
        "id_present": "CASE WHEN _id = '' THEN 'null/empty transaction_id' END",
        "id_first": "CASE WHEN _repeated AND (_first_seq IS NULL OR _row_seq <> _first_seq) "
                    "THEN concat('duplicate transaction_id: ', _id) END",
        "amount": f"""CASE
            WHEN _amount IS NULL THEN concat('unparseable amount: ', {quoted('amount')})
            WHEN _amount <= 0 THEN concat('non-positive amount: ', {float_text('_amount')})
            WHEN _amount > double({cfg.max_amount})
                THEN concat('amount exceeds threshold: ', {float_text('_amount')}) END""",
        "timestamp": f"""CASE
            WHEN _ts IS NULL THEN concat('unparseable timestamp: ', {quoted('timestamp')})
            WHEN _ts > TIMESTAMP_NTZ '{as_of.isoformat(sep=" ")}'
                THEN concat('future timestamp: ', {offset_iso_text('_ts', '_ts_east')}) END""",
        "currency": outside("_currency", cfg.currencies, "invalid currency"),
        "status": outside("_status", cfg.statuses, "invalid status"),
        "payment_method": outside("_method", cfg.payment_methods, "invalid payment_method"),
        "customer": unknown("_customer", "_customer_known", "customer_id"),
        "merchant": unknown("_merchant", "_merchant_known", "merchant_id"),
    }


def annotate(raw: DataFrame, repeated: DataFrame, customers: DataFrame, merchants: DataFrame,
             cfg: Config, as_of: datetime, limit: int = BROADCAST_ROWS,
             bounds: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every raw row with its typed values and `_reasons`, which is '' for a valid row.

    `customers` and `merchants` hold each known id once. `bounds` may name, for `_customer`
    and `_merchant`, stored frames with at least as many rows, which are cheaper to count. Of tables
    above `limit` rows only the keys that the batch lacks there are joined to the wide rows, which
    are shuffled only if those are more than `limit` as well.
    """
    df = base = normalise(raw)
    tables = {
        "_id": repeated.select(F.col("transaction_id").alias("_id"),
                               F.col("first_seq").alias("_first_seq"),
                               F.lit(True).alias("_repeated")),
        "_customer": customers.select(F.col("customer_id").alias("_customer"),
                                      F.lit(True).alias("_customer_known")),
        "_merchant": merchants.select(F.col("merchant_id").alias("_merchant"),
                                      F.lit(True).alias("_merchant_known")),
    }
    for key, table in tables.items():
        bound = (bounds or {}).get(key)
        if key == "_id" or is_small(table if bound is None else bound, limit):
            df = lookup(df, table, key, salt_by="_row_seq", limit=limit,
                        hot=lambda key=key: hot_keys(base, key), bound=bound)
            continue
        # A large table meets the different keys of the batch alone; the wide rows meet only its misses.
        known = f"{key}_known"
        missing = written(base.select(key).filter(F.col(key).isNotNull()).distinct().join(
            table.select(key), key, "left_anti"), "misses")
        df = lookup(df, missing.withColumn("_missed", F.lit(True)), key, salt_by="_row_seq", limit=limit,
                    hot=lambda key=key: hot_keys(base, key)).withColumn(
            known, F.when(F.col(key).isNotNull() & F.col("_missed").isNull(), F.lit(True))).drop("_missed")
    df = df.withColumn("_amount", parse_amount(F.col("amount")))
    df = with_timestamp(df, "timestamp", "_ts", "_ts_east")
    reasons = ", ".join(rule_reasons(cfg, as_of).values())
    return df.withColumn("_reasons", F.expr(f"concat_ws('; ', {reasons})"))


def raw_json(columns: list[str]) -> Column:
    """The raw row as JSON text; nulls are spelled None so that no key goes missing."""
    return F.to_json(F.struct(*[
        F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in columns]))


def route(annotated: DataFrame, loaded_at: datetime) -> DataFrame:
    """Rows of silver.routed: typed values for valid rows, raw record and reasons for others."""
    valid = F.col("_reasons") == ""
    text = lambda name: stripped(F.col(name))
    typed = {
        "customer_id": F.col("_customer"),
        "merchant_id": F.col("_merchant"),
        "payment_method": F.col("_method"),
        "ts": F.col("_ts"),
        "amount": F.col("_amount"),
        "currency": F.col("_currency"),
        "country": F.upper(text("country")),
        "channel": F.lower(text("channel")),
        "device_type": F.lower(text("device_type")),
        "status": F.col("_status"),
    }
    return annotated.select(
        F.nullif(F.col("_id"), F.lit("")).alias("transaction_id"),
        *[F.when(valid, value).alias(name) for name, value in typed.items()],
        F.when(~valid, raw_json(RAW_COLUMNS)).alias("raw_record"),
        F.when(~valid, F.col("_reasons")).alias("rejection_reason"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("_loaded_at"),
        "batch_id",
        F.when(valid, "silver").otherwise("quarantine").alias("route"),
    )


def build_silver(lake: Lake, batch_id: str, cfg: Config | None = None,
                 as_of: datetime | None = None, loaded_at: datetime | None = None,
                 limit: int = BROADCAST_ROWS) -> dict[str, int]:
    """Turn one raw batch into Silver entities, Silver transactions and quarantine.

    Running a batch again replaces it. `as_of` is the clock for the rule on future timestamps.
    """
    cfg = cfg or Config()
    loaded_at = loaded_at or utc_now()
    as_of = as_of or utc_now()
    loaded = F.lit(loaded_at).cast("timestamp_ntz")
    raw = lake.read("bronze.raw_transactions", batch_id)

    def write_entity(name: str, clean: Callable[[DataFrame], DataFrame]) -> None:
        rows = clean(lake.read(f"bronze.raw_{name}", batch_id)).withColumn("_loaded_at", loaded)
        lake.replace_batch(rows, f"silver.{name}_by_batch", batch_id)

    def write_repeated_ids() -> None:
        earlier, filters = None, None
        if lake.exists("silver.routed"):
            earlier = lake.transactions().filter(F.col("batch_id") != batch_id)
            filters = lake.read(FILTERS).filter(F.col("batch_id") != batch_id)
        # Written, so that its size is known before the wide rows are joined to it.
        lake.replace_batch(repeated_ids(raw, earlier, raw.count() <= limit, filters, limit),
                           "silver.repeated_ids", batch_id)

    together(lambda: write_entity("customers", clean_customers),
             lambda: write_entity("merchants", clean_merchants), write_repeated_ids)
    annotated = annotate(
        raw, lake.read("silver.repeated_ids", batch_id).drop("batch_id"),
        lake.entity_ids("customers"), lake.entity_ids("merchants"), cfg, as_of, limit,
        {"_customer": lake.read("silver.customers_by_batch"),
         "_merchant": lake.read("silver.merchants_by_batch")})
    # A filter never stands beside other rows than its own: without one the rows are read instead.
    lake.drop_batch(FILTERS, batch_id)
    lake.replace_batch(route(annotated, loaded_at), "silver.routed", batch_id, ("route",))
    *counts, _ = together(lake.transactions(batch_id).count, lake.quarantine(batch_id).count,
                          lake.read("silver.customers_by_batch", batch_id).count,
                          lambda: write_filter(lake, batch_id))
    return dict(zip(("silver_count", "quarantine_count", "customer_count"), counts, strict=True))
