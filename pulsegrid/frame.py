"""Canonical frame: ``series_id STRING, ts TIMESTAMP_NTZ, seq LONG, value DOUBLE``.

Order inside a series is always ``(ts, seq)``. NaN is turned into NULL once on
ingest so that ``avg``/``max`` are never poisoned (Spark orders NaN above every
number and propagates it through sums).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "series_id"
ORDER = ("ts", "seq")

SCHEMA = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def clean_double(c: Column) -> Column:
    """NaN and +/-infinity become NULL (SEM-1)."""
    c = c.cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def canonical(
    df: DataFrame,
    series_id: str | Column = KEY,
    ts: str | Column = "ts",
    value: str | Column = "value",
    seq: str | Column | None = None,
) -> DataFrame:
    """Project any table onto the canonical frame; extra columns are dropped."""

    def as_col(c):
        return F.col(c) if isinstance(c, str) else c

    seq_col = F.lit(0).cast("long") if seq is None else as_col(seq).cast("long")
    return df.select(
        as_col(series_id).cast("string").alias("series_id"),
        as_col(ts).cast("timestamp_ntz").alias("ts"),
        seq_col.alias("seq"),
        clean_double(as_col(value)).alias("value"),
    )


def series_window(*partition: str) -> Window:
    """``Window.partitionBy(series_id[, extra...]).orderBy(ts, seq)``."""
    return Window.partitionBy(KEY, *partition).orderBy(*ORDER)


def value_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (KEY, *ORDER)]
