"""Series as runs: one sorted stream of rows in which every run is led by a row of its own parameters.

A run is a series or, under the blocked plan, a block of a long series with the rows before it that its
parameters ask for. The parameters of a run (an array of doubles) come as its first row, so
nothing is joined to the rows and a series pays for its own parameters only, whatever others need.
``each_run`` hands the runs of a partition one by one to numpy code; a run is at most a plain series or a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER
from pulsegrid.operators.gram import add_packed
from pulsegrid.plans.blocked import blocked_ordinal, default_block_rows, join_null_safe
from pulsegrid.session import ship_package

SUMS = f"{KEY} string, v array<double>"


def series_scale(clean: DataFrame) -> DataFrame:
    """Per series: ``_n``, mean, scale (population deviation, 1 if that is 0), first and last value."""
    sd = F.stddev_pop("value")
    at = F.struct(*ORDER)
    return clean.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg("value").alias("_mean"),
        F.when(sd > 0, sd).otherwise(1.0).alias("_std"),
        F.min_by("value", at).alias("_first"),
        F.max_by("value", at).alias("_last"),
    )


def stream(clean: DataFrame, heads: DataFrame, plan: str, block_rows: int | None = None) -> DataFrame:
    """``heads``: series_id, ``_n`` (its rows), ``_reach`` (rows a block needs from before it), ``_head`` array<double>.

    Rows (series_id, _ord, value, _head) sorted by run: the head row, whose ``_ord`` is where the run's own rows begin,
    then the rows from ``_reach`` before that on."""
    return lead(run_rows(clean, heads, plan, block_rows), heads, plan, block_rows)


def run_rows(clean: DataFrame, heads: DataFrame, plan: str, block_rows: int | None = None) -> DataFrame:
    """The rows of all runs, each with the block (``_blk``) it is for; reads ``_n`` and ``_reach`` of ``heads``."""
    if plan == "plain":
        return clean.select(KEY, F.lit(0).cast("long").alias("_blk"), *ORDER, F.lit(0).cast("long").alias("_ord"), "value")
    size = block_rows or default_block_rows()
    x = join_null_safe(blocked_ordinal(clean.select(KEY, *ORDER, "value"), size, "_ord"), heads.select(KEY, "_n", "_reach"), [KEY])
    until = F.floor(F.least(F.col("_ord") + F.col("_reach"), F.col("_n") - 1) / size).cast("long")
    x = x.withColumn("_blk", F.explode(F.sequence(F.floor(F.col("_ord") / size).cast("long"), until)))
    return x.select(KEY, "_blk", *ORDER, "_ord", "value")


def lead(rows: DataFrame, heads: DataFrame, plan: str, block_rows: int | None = None) -> DataFrame:
    """``run_rows`` sorted by run, each run behind a row with its ``_head``; reads ``_n`` and ``_head`` of ``heads``."""
    if plan == "plain":
        begin, first = F.lit(0).cast("long"), heads.select(KEY, F.lit(0).cast("long").alias("_blk"), F.col("_head"))
    else:
        size = block_rows or default_block_rows()
        blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / size).cast("long"))
        begin, first = F.col("_blk") * size, heads.where("_n > 0").select(KEY, F.explode(blocks).alias("_blk"), "_head")
    types = dict(rows.select(*ORDER).dtypes)
    led = first.select(KEY, "_blk", *[F.lit(None).cast(t).alias(c) for c, t in types.items()], begin.alias("_ord"), F.lit(None).cast("double").alias("value"), "_head")
    every = rows.withColumn("_head", F.lit(None).cast("array<double>")).unionByName(led).withColumn("_row", F.col("_head").isNull())
    sort = [KEY, "_blk", "_row", *ORDER]
    # a run costs far more than its bytes, so small partitions are not merged
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return every.repartition(tasks, KEY, "_blk").sortWithinPartitions(*sort).select(KEY, "_ord", "value", "_head")


def each_run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, int, int, np.ndarray]]:
    """(series, head, place of the first value in the series, values that belong to the run before, values)."""
    key, head, begin, first, held = None, None, 0, None, []
    for b in batches:
        heads = b.column("_head")
        led = np.flatnonzero(heads.is_valid().to_numpy(zero_copy_only=False))
        values, places = b.column("value").to_numpy(zero_copy_only=False), b.column("_ord").to_numpy(zero_copy_only=False)
        for at, stop in zip([-1, *led], [*led, b.num_rows]):
            if at >= 0:
                if head is not None:
                    yield key, head, begin if first is None else first, 0 if first is None else begin - first, np.concatenate(held) if held else np.empty(0)
                key, head, begin, first, held = b.column(KEY)[int(at)].as_py(), np.asarray(heads[int(at)].as_py(), float), int(places[at]), None, []
            if stop > at + 1:
                first = int(places[at + 1]) if first is None else first
                held.append(values[at + 1 : stop])
    if head is not None:
        yield key, head, begin if first is None else first, 0 if first is None else begin - first, np.concatenate(held) if held else np.empty(0)


def summed(rows: DataFrame, sums: Callable[[np.ndarray, int, int, np.ndarray], np.ndarray], plan: str) -> DataFrame:
    """One array of sums a series: ``sums(head, first place, before, values)`` of its runs, added up."""
    ship_package(rows.sparkSession)

    def run(batches):
        keys, found = [], []
        for key, *of in each_run(batches):
            keys.append(key)
            found.append(np.asarray(sums(*of), float))
            if len(keys) >= 1000:
                yield _rows(keys, found)
                keys, found = [], []
        yield _rows(keys, found)

    parts = rows.mapInArrow(run, SUMS)
    return parts if plan == "plain" else add_packed(parts, [KEY])


def _rows(keys: list, found: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in found]))).astype(np.int32)
    values = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0)))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), values], names=[KEY, "v"])


def lag_products(x: np.ndarray, start: int, lags: int) -> np.ndarray:
    """``sum of x[t] x[t-k]`` over ``t >= start`` with ``t - k >= 0``, for k = 0..lags."""
    n = len(x)
    out = np.zeros(lags + 1)
    if start <= 0 and 0 < n <= 256:
        full = np.correlate(x, x, "full")[n - 1 : n + lags]
        out[: len(full)] = full
        return out
    for k in range(min(lags, n - 1) + 1):
        at = max(start, k)
        out[k] = x[at:] @ x[at - k : n - k]
    return out


def placed(x: np.ndarray, first: int, own: int, begin: int, size: int) -> np.ndarray:
    """The values at places ``begin .. begin + size`` of the series that this run owns; zeros elsewhere.

    ``x`` starts at place ``first``; the run owns places from ``own`` on. Arrays of all runs add up to the values."""
    out = np.zeros(size)
    lo, hi = max(begin, own, first), min(begin + size, first + len(x))
    if hi > lo:
        out[lo - begin : hi - begin] = x[lo - first : hi - first]
    return out
