"""Bronze: raw feeds landed as text, batch by batch, with an audit row per file."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime
from functools import partial
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnlake import schemas
from txnlake.config import Config
from txnlake.functions.jobs import together
from txnlake.sources.files import UnreadableFile, missing_columns, read_csv
from txnlake.sources.lake import Lake


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def stamp(df: DataFrame, table: str, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Contract columns plus batch, source batch and landing time.

    The batch named by the caller wins; a batch id inside the file is kept beside it.
    """
    source = F.col("batch_id") if "batch_id" in df.columns else F.lit(None)
    columns = [c for c in schemas.RAW[table].names if c != "batch_id"]
    return df.select(
        *columns,
        source.cast("string").alias("_source_batch_id"),
        F.col("_row_seq").cast("long").alias("_row_seq"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(batch_id).alias("batch_id"),
    )


def land(lake: Lake, df: DataFrame, table: str, batch_id: str,
         ingested_at: datetime | None = None) -> None:
    """Replace one batch of a raw table."""
    stamped = stamp(df, table, batch_id, ingested_at or utc_now())
    lake.replace_batch(stamped, f"bronze.raw_{table}", batch_id)


def ingest(
    spark: SparkSession,
    lake_root: str,
    transactions_path: str,
    customers_path: str,
    merchants_path: str,
    batch_id: str | None = None,
    cfg: Config | None = None,
    ingested_at: datetime | None = None,
    multi_line: bool | None = None,
) -> dict[str, Any]:
    """Land the three raw files of a batch and write their audit rows.

    A file that cannot be read, or lacks columns, is recorded and skipped; the others go on.
    """
    cfg = cfg or Config()
    lake = Lake(spark, lake_root)
    batch_id = batch_id or str(uuid.uuid4())
    ingested_at = ingested_at or utc_now()
    summary: dict[str, Any] = {"batch_id": batch_id}
    audit = []
    paths = {"transactions": transactions_path, "customers": customers_path,
             "merchants": merchants_path}
    outcomes = together(*[
        partial(_ingest_file, lake, table, str(path), batch_id, ingested_at, multi_line)
        for table, path in paths.items()])
    for (table, path), outcome in zip(paths.items(), outcomes, strict=True):
        summary[table] = {k: v for k, v in outcome.items() if v is not None}
        loaded = outcome["status"] == "SUCCESS"
        rows = outcome.get("record_count", 0)
        detail = outcome.get("error") or outcome.get("detail")
        audit.append((
            str(uuid.uuid4()), str(path), table, cfg.schema_version, ingested_at, rows,
            rows if loaded else 0, 0 if loaded else rows, outcome["status"], detail, batch_id))
    lake.replace_batch(
        spark.createDataFrame(audit, schemas.TABLES["bronze.ingestion_audit"]),
        "bronze.ingestion_audit", batch_id)
    return summary


def _ingest_file(lake: Lake, table: str, path: str, batch_id: str, ingested_at: datetime,
                 multi_line: bool | None) -> dict[str, Any]:
    try:
        df = read_csv(lake.spark, path, multi_line)
        missing = missing_columns(df, table)
        if missing:
            return {"status": "SCHEMA_ERROR", "record_count": df.count(),
                    "missing_columns": missing, "detail": f"Missing columns: {missing}"}
        land(lake, df, table, batch_id, ingested_at)
    except (UnreadableFile, PySparkException) as error:
        return {"status": "READ_ERROR", "record_count": 0, "error": str(error)}
    extra = sorted(set(df.columns) - set(schemas.RAW[table].names) - {"_row_seq", "batch_id"})
    rows = lake.read(f"bronze.raw_{table}", batch_id).count()
    return {"status": "SUCCESS", "record_count": rows,
            "detail": f"Ignored columns: {extra}" if extra else None}
