"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlake.session import apply_settings, work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared work folder."""
    return f"{work_folder(spark)}/txnlake/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared work folder and read them back, which also cuts the lineage."""
    folder = fresh_folder(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def id_text(column: Column | str) -> Column:
    """An id as text; no id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def held_out(column: Column | str) -> Column:
    """Rows no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.encode(id_text(column), "UTF-8")) % 4 == 2


def whole(text: Column | str) -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
