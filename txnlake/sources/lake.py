"""Parquet layout of the lake: <root>/<layer>/<table>[/batch_id=<batch>]."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from txnlake import schemas

_BATCH = re.compile(r"^[A-Za-z0-9_.\-]+$")


class Lake:
    """Tables under one root folder, which every executor must be able to reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        # Intermediate tables of this run; two runs on one lake never share a name.
        self.run = uuid.uuid4().hex[:12]

    def path(self, table: str, batch_id: str | None = None) -> str:
        path = f"{self.root}/{table.replace('.', '/')}"
        if batch_id is None:
            return path
        if not _BATCH.match(batch_id):
            raise ValueError(f"batch id may hold letters, digits, _ . and -: {batch_id!r}")
        return f"{path}/batch_id={batch_id}"

    def _stored(self, table: str, batch_id: str | None = None) -> DataFrame | None:
        # Reading the folder of one batch lists the files of that batch only.
        reader = self.spark.read.schema(schemas.TABLES[table])
        try:
            found = reader.option("basePath", self.path(table)).parquet(self.path(table, batch_id))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = None
        lost = self._lost(table, batch_id)
        if not lost:
            return found
        kept = reader.option("basePath", self._aside(self.path(table))).parquet(*lost)
        return kept if found is None else found.unionByName(kept)

    def _aside(self, path: str) -> str:
        """Where the old folder of a path lies while a new one takes its place."""
        return f"{self.root}/staging/aside{path.removeprefix(self.root)}"

    def _lost(self, table: str, batch_id: str | None) -> list[str]:
        """Old folders of a table, or of one batch, whose writer stopped before the new one was in place."""
        top = self._aside(self.path(table))
        files, _ = self._files(top)
        if not self._exists(top):
            return []
        names = [one.getPath().getName() for one in files.listStatus(self._files(top)[1])]
        batches = [name for name in names if name.startswith("batch_id=")]
        if len(batches) < len(names):  # the table was replaced as a whole
            return [] if self._exists(self.path(table)) else [top]
        wanted = batches if batch_id is None else [name for name in batches if name == f"batch_id={batch_id}"]
        return [f"{top}/{name}" for name in wanted if not self._exists(f"{self.path(table)}/{name}")]

    def _files(self, path: str) -> tuple:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        files, where = self._files(path)
        return files.exists(where)

    def exists(self, table: str) -> bool:
        return self._stored(table) is not None

    def read(self, table: str, batch_id: str | None = None) -> DataFrame:
        """A stored table, or one batch of it, with its fixed schema.

        It is empty when nothing was written yet.
        """
        schema = schemas.TABLES[table]
        df = self._stored(table, batch_id)
        if df is None:
            df = self.spark.createDataFrame([], schema)
        return df.select(*schema.names)

    def as_stored(self, table: str) -> DataFrame:
        """A table with the columns its files have; without any when nothing was written."""
        try:
            return self.spark.read.parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return self.spark.createDataFrame([], T.StructType([]))
            raise

    def replace_batch(self, df: DataFrame, table: str, batch_id: str,
                      partition_by: tuple[str, ...] = ()) -> None:
        """Write one batch over whatever this batch held before, and nothing else."""
        columns = [f.name for f in schemas.TABLES[table].fields if f.name != "batch_id"]
        self._swap(_typed(df, table).select(*columns).write.partitionBy(*partition_by),
                   self.path(table, batch_id))

    def replace(self, df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
        """Full refresh of a table."""
        self._swap(_typed(df, table).write.partitionBy(*partition_by), self.path(table))

    def mart(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Full refresh of a mart, read back with its columns in the same order."""
        path = f"{self.root}/marts/{name}"
        self._swap(df.write.partitionBy(*partition_by), path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def drop_batch(self, table: str, batch_id: str) -> None:
        """Delete one batch of a table, also an old one that lies aside."""
        for path in (self._aside(self.path(table, batch_id)), self.path(table, batch_id)):
            files, where = self._files(path)
            files.delete(where, True)

    def _swap(self, writer: DataFrameWriter, path: str) -> None:
        """Write to a fresh folder and put it in the place of path only when that has worked.

        Rows that cannot be read or computed leave the old folder as it was; a replacement also
        clears partitions that became empty. The old folder is moved aside, the new one moved in,
        and only then is the old one deleted. Who reads in between, or after a writer that stopped
        there, reads the old one where it lies aside.
        """
        fresh = f"{self.root}/staging/fresh-{uuid.uuid4().hex}"
        writer.parquet(fresh)
        aside = self._aside(path)
        if self._exists(path):
            files, old = self._files(aside)
            files.delete(old, True)
            self._move(path, aside)
        self._move(fresh, path)
        files, old = self._files(aside)
        files.delete(old, True)

    def _move(self, path: str, target: str) -> None:
        files, source = self._files(path)
        goal = self._files(target)[1]
        files.mkdirs(goal.getParent())
        if not files.rename(source, goal):
            raise OSError(f"cannot move {path} to {target}")

    def append_missing(self, df: DataFrame, table: str, key: str) -> None:
        """Insert the rows whose key the table does not hold yet; of equal keys the smallest row."""
        new = first_by_key(df, key, F.struct(*df.columns)).join(self.read(table).select(key), key, "left_anti")
        _typed(new, table).write.mode("append").parquet(self.path(table))

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate table and read it back, so that its size is known."""
        path = f"{self.root}/staging/{self.run}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear_staging(self) -> None:
        """Delete the intermediate tables of this run, when nothing will read them any more."""
        files, where = self._files(f"{self.root}/staging/{self.run}")
        files.delete(where, True)

    # Views over stored tables.

    def transactions(self, batch_id: str | None = None) -> DataFrame:
        return self.read("silver.routed", batch_id).filter(F.col("route") == "silver").select(
            *schemas.SILVER_TRANSACTIONS)

    def quarantine(self, batch_id: str | None = None) -> DataFrame:
        return self.read("silver.routed", batch_id).filter(
            F.col("route") == "quarantine").withColumnRenamed(
            "_loaded_at", "_quarantined_at").select(*schemas.SILVER_QUARANTINE)

    def customers(self) -> DataFrame:
        return self._latest("silver.customers_by_batch", "customer_id", schemas.SILVER_CUSTOMERS)

    def merchants(self) -> DataFrame:
        return self._latest("silver.merchants_by_batch", "merchant_id", schemas.SILVER_MERCHANTS)

    def entity_ids(self, entity: str) -> DataFrame:
        """Ids of `customers` or `merchants` of all batches, each once."""
        return self.read(f"silver.{entity}_by_batch").select(f"{entity[:-1]}_id").distinct()

    def fact(self) -> DataFrame:
        return self.read("gold.fact_transactions").select(*schemas.FACT)

    def _latest(self, table: str, key: str, columns: list[str]) -> DataFrame:
        """The version of each key that was loaded last."""
        return latest_by_key(self.read(table), key, F.struct("_loaded_at", "batch_id")).select(
            *columns)


def latest_by_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: the one with the highest order. Partial maxima travel, not all rows."""
    return _one_by_key(df, key, F.max_by, order)


def first_by_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: the one with the lowest order."""
    return _one_by_key(df, key, F.min_by, order)


def _one_by_key(df: DataFrame, key: str, pick, order: Column) -> DataFrame:
    chosen = df.groupBy(key).agg(pick(F.struct(*df.columns), order).alias("_row"))
    return chosen.select("_row.*")


def _typed(df: DataFrame, table: str) -> DataFrame:
    """Columns in stored order, with missing ones as null."""
    fields = schemas.TABLES[table].fields
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields
    ])

