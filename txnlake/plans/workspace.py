"""A lake built once per session and input folder, for the registered queries."""

from __future__ import annotations

import hashlib
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from txnlake.config import Config
from txnlake.functions.jobs import together
from txnlake.operators import bronze, gold, silver
from txnlake.session import apply_settings, work_folder
from txnlake.sources import feeds
from txnlake.sources.lake import Lake

_built: dict[tuple[str, str], Lake] = {}


def _spread(rows: DataFrame) -> DataFrame:
    """Spread a feed of few files over all cores; a feed of many files stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if len(rows.inputFiles()) >= cores else rows.repartition(cores, "_row_seq")


def land_feeds(lake: Lake, folder: str, one_batch: bool = False) -> None:
    """Land the feeds side by side, transactions in their two batches or in one."""
    first = feeds.BATCHES[0]
    landings = []
    for table, feed in (("transactions", feeds.transactions), ("customers", feeds.customers),
                        ("merchants", feeds.merchants)):
        rows = _spread(feed(lake.spark, folder))
        split = table == "transactions" and not one_batch
        for batch in feeds.BATCHES if split else [first]:
            part = rows.filter(rows.batch_id == batch) if split else rows
            landings.append(partial(bronze.land, lake, part, table, batch, feeds.AS_OF))
    together(*landings)


def build(spark: SparkSession, folder: str, root: str) -> Lake:
    """Land the feeds of both batches, then build Silver and Gold."""
    lake, cfg = Lake(spark, root), Config()
    land_feeds(lake, folder)
    for batch in feeds.BATCHES:
        silver.build_silver(lake, batch, cfg, feeds.AS_OF, feeds.AS_OF)
    gold.build_gold(lake, cfg)
    return lake


def lake_for(spark: SparkSession, folder: str) -> Lake:
    """The lake of an input folder; all of its tables are written to the shared work folder."""
    apply_settings(spark)
    key = (spark.sparkContext.applicationId, folder)
    if key not in _built:
        name = hashlib.sha256(folder.encode()).hexdigest()[:12]
        root = f"{work_folder(spark)}/txnlake/{key[0]}/{name}"
        _built[key] = build(spark, folder, root)
    return _built[key]
