"""Cutting lineage: small result tables (models, node tables) are written once to
the shared folder named by ``spark.checkpoint.dir`` and read back.

One job computes and writes them (``DataFrame.checkpoint`` of an unpersisted plan
would compute it twice); afterwards a lost executor re-reads the files instead of
refitting. ``job_tables`` deletes those of a job when its results are stored elsewhere.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.session import shared_dir

_local = threading.local()


def materialize(df: DataFrame, tag: str = "tables") -> DataFrame:
    spark = df.sparkSession
    path = shared_dir(spark, "materialized", tag, unique=True)
    jobs = getattr(_local, "jobs", None)
    if jobs:  # noted first: a write that fails may leave files too
        jobs[-1].append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the folders that ``materialize`` writes inside the block in this thread, also when it fails.

    DataFrames built inside read these folders, so store their results before the block ends. Blocks
    may be nested and run beside each other in threads; each deletes its own folders only. Yields the
    list of the folders.

    >>> with job_tables(spark):
    ...     forecast.arima_forecast(forecast.arima_fit(df), 48).write.parquet(path)
    """
    if not hasattr(_local, "jobs"):
        _local.jobs = []
    mine: list[str] = []
    _local.jobs.append(mine)
    try:
        yield mine
    finally:
        _local.jobs.pop()
        for name in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
