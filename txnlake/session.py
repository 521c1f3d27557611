"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts are long: a worker holds a batch of them as Arrow, as Python objects and as arrays.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2500",
    # Tasks keep one open file per partition value instead of sorting their rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def local_session(cores: str = "*", memory: str = "8g", name: str = "txnlake") -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Work folders of local sessions that name none, by application.
_local_folders: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in spark.checkpoint.dir. Only a local session may fall back to a
    temporary folder, because only there do all tasks see the same disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    # The setting is fixed once a session runs, so the folder is kept here.
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="run-")
    return _local_folders[application]


def apply_settings(spark: SparkSession) -> None:
    """Set the runtime settings that results and plans rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
