"""SET-01/02 and JOI-01: unions with a tag column and full outer alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY


def union_series(named: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """SET-01: stack several frames into one long table, tagged by name."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in named.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def overlay(parts: dict[str, DataFrame]) -> DataFrame:
    """SET-02: train, test and forecasts stacked with a ``role`` column."""
    return union_series(parts, tag="role")


def align_outer(named: dict[str, DataFrame], on: tuple[str, ...] = (KEY, "ts"), col: str = "value") -> DataFrame:
    """JOI-01: full outer alignment of several series on ``(series_id, ts)``.

    Each input must hold one row per key. Implemented as a single union plus
    ``groupBy(key).pivot(name, names)``: one shuffle, however many inputs.
    """
    names = list(named)
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(*on, F.lit(n).alias("_name"), F.col(col).cast("double").alias("_v")) for n, df in named.items()],
    )
    return stacked.groupBy(*on).pivot("_name", names).agg(F.first("_v"))
