"""Panels built from the driver tables (FIXTURES P1..P4).

Only the needed columns are selected so the parquet scan prunes to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.frame import canonical
from pulsegrid.plans.lineage import materialize
from pulsegrid.sources.spine import fill_on_spine


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1: one irregular series per user; seq = event_id."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return canonical(ev, series_id=F.col("user_id"), ts="ts", value="value", seq="event_id")


def hourly_by_type(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """P2: hourly mean value per event_type, left-joined on each series' hourly spine.

    The panel is an aggregate (event types x hours, tiny next to ``events``): it
    is written once to the shared folder so that every later use reads it back
    instead of re-scanning the events table."""
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    hourly = ev.groupBy(
        F.col("event_type").alias("series_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
    ).agg(F.avg("value").alias("value"))
    out = fill_on_spine(canonical(hourly), "1 hour")
    return materialize(out, "panel_hourly") if materialized else out


def daily_orders(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """P3: one series of daily order revenue (materialised like P2)."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    daily = o.groupBy(F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("ts")).agg(
        F.sum("o_totalprice").alias("value")
    )
    out = canonical(daily, series_id=F.lit("orders"))
    return materialize(out, "panel_daily") if materialized else out


def single_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4: all events as one long series ``'all'``; seq = event_id."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return canonical(ev, series_id=F.lit("all"), seq="event_id")


def masked(df: DataFrame, every: int = 7) -> DataFrame:
    """Deterministic missing data: value NULL where ``seq % every == 0``."""
    return df.withColumn("value", F.when(F.col("seq") % every != 0, F.col("value")))
