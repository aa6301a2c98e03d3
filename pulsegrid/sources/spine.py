"""SRC-04: regular time grid per series, and gap filling by a left join onto it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY
from pulsegrid.sources.steps import grid_index, grid_point, step_of


#: Grid points that one row may expand to at once.
CHUNK = 10_000


def count_out(df: DataFrame, n: str, name: str) -> DataFrame:
    """Rows repeated with ``name`` = 1..n. First coarse chunks, then the numbers of each, so no row holds them all."""
    chunks = df.where(F.col(n) > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK))))
    first = F.col("_chunk") * CHUNK + 1
    return chunks.withColumn(name, F.explode(F.sequence(first, F.least(first + CHUNK - 1, F.col(n).cast("long"))))).drop("_chunk")


def _bounds(df: DataFrame, start, end) -> DataFrame:
    bounds = df.groupBy(KEY).agg(F.min("ts").alias("_lo"), F.max("ts").alias("_hi"))
    if start is not None:
        bounds = bounds.withColumn("_lo", F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        bounds = bounds.withColumn("_hi", F.lit(end).cast("timestamp_ntz"))
    return bounds


def time_spine(df: DataFrame, every: str = "1 hour", start=None, end=None) -> DataFrame:
    """One row per grid point between each series' first and last ``ts``.

    ``start``/``end`` (timestamps) override the per-series bounds. The bounds are a
    tiny per-series aggregate; the grid itself is generated on the executors, in chunks,
    and grows only with the span, not with the input rows. ``every`` is a fixed or a calendar
    step (``steps``).
    """
    step = step_of(every)
    lo, hi = F.col("_lo"), F.col("_hi")
    inside = grid_point(lo, F.lit(0), step) <= hi
    points = _bounds(df, start, end).withColumn("_n", F.when(inside, grid_index(lo, hi, step) + 1).otherwise(0))
    return count_out(points, "_n", "_k").select(KEY, grid_point(lo, F.col("_k") - 1, step).alias("ts"))


def fill_on_spine(df: DataFrame, every: str = "1 hour") -> DataFrame:
    """Data on its spine: missing grid points get NULL value, seq 0.

    A row between two grid points counts for the earlier one (before the first point: for the first); the
    values of a grid point are averaged (NULLs left out), so no row is lost."""
    step = step_of(every)
    spine = time_spine(df, every)
    data = df.select(KEY, "ts", "value").join(_bounds(df, None, None).select(KEY, "_lo"), KEY)
    data = data.select(KEY, grid_point(F.col("_lo"), grid_index(F.col("_lo"), F.col("ts"), step), step).alias("ts"), "value")
    data = data.groupBy(KEY, "ts").agg(F.avg("value").alias("value"))
    return spine.join(data, [KEY, "ts"], "left").select(
        KEY, "ts", F.lit(0).cast("long").alias("seq"), "value"
    )
