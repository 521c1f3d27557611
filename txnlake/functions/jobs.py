"""Independent jobs side by side, and tables between jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame

from txnlake.session import work_folder


def together(*jobs: Callable[[], Any]) -> list[Any]:
    """Start independent jobs at the same time; results in order, the first error is raised.

    Each job is an ordinary Spark action, so the cluster shares its cores among them and small
    jobs do not wait for each other.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]


def written(df: DataFrame, name: str) -> DataFrame:
    """A small intermediate table in the shared work folder, which fixes its rows and cuts its lineage."""
    path = f"{work_folder(df.sparkSession)}/txnlake/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
