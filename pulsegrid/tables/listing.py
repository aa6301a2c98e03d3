"""Reading small append-only tables for a listing."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def readable(read: Callable[[bool], DataFrame], path: str) -> DataFrame:
    """``read(False)``, or ``read(True)``, which passes over corrupt files, with a warning if there are any. Only listings do this: loads fail."""
    strict = read(False)
    try:
        strict.write.format("noop").mode("overwrite").save()
        return strict
    except (PySparkException, Py4JJavaError) as error:
        warnings.warn(f"unreadable files under {path} are not listed: {str(error).splitlines()[0]}", stacklevel=3)
        return read(True)


def read_listing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` (empty if there is none). Unreadable files are skipped with a warning, only here: loads fail on them."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return readable(lambda skip: spark.read.schema(schema).option("ignoreCorruptFiles", str(skip).lower()).parquet(path), path)
