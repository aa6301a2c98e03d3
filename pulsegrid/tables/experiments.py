"""EXP-01..05: experiment log as an append-only event table.

Events: ``start`` (payload: description and parameters), ``metric`` (name, value,
step), ``result`` (payload: where the result table was written), ``finish``
(payload: final results). The latest state is derived by aggregation, never by a
read-modify-write of a file; ``event_log`` keeps the number of files small.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.sources.files import write_frame
from pulsegrid.tables.event_log import compact, compact_if_many, read_events
from pulsegrid.tables.listing import readable

EVENTS = T.StructType(
    [
        T.StructField("experiment_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("payload", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
    ]
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _append(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    # one row: one file
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{root}/events")
    compact_if_many(spark, root, EVENTS)


def compact_log(spark: SparkSession, root: str) -> bool:
    """Merge the log's small files (appends do so by themselves now and then)."""
    return compact(spark, root, EVENTS)


def start_experiment(spark: SparkSession, root: str, name: str, description: str = "", parameters: dict | None = None) -> str:
    """EXP-01: id = name + start time + a short uuid (same-second starts differ)."""
    now = _now()
    exp_id = f"{name}_{now.strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:8]}"
    payload = json.dumps({"description": description, "parameters": parameters or {}}, default=str)
    _append(spark, root, [(exp_id, "start", name, None, None, payload, now)])
    return exp_id


def log_metric(spark: SparkSession, root: str, exp_id: str, name: str, value: float, step: int | None = None) -> None:
    """EXP-02 (one value)."""
    _append(spark, root, [(exp_id, "metric", name, float(value), step, None, _now())])


def log_metrics(metrics: DataFrame, root: str, exp_id: str) -> None:
    """EXP-02 for many metrics at once: ``metrics`` has name, value[, step]; the
    rows are appended by the executors, nothing passes through the driver."""
    step = F.col("step").cast("int") if "step" in metrics.columns else F.lit(None).cast("int")
    metrics.select(
        F.lit(exp_id).alias("experiment_id"),
        F.lit("metric").alias("kind"),
        F.col("name").cast("string").alias("name"),
        F.col("value").cast("double").alias("value"),
        step.alias("step"),
        F.lit(None).cast("string").alias("payload"),
        F.lit(_now().isoformat(sep=" ")).cast("timestamp_ntz").alias("event_time"),  # UTC like all events, whatever the session's zone
    ).write.mode("append").parquet(f"{root}/events")


def save_result(spark: SparkSession, root: str, exp_id: str, name: str, data: DataFrame, fmt: str = "json") -> str:
    """EXP-03: write a result table (JSON or Parquet) and log where it is."""
    path = f"{root}/results/{exp_id}/{name}"
    write_frame(data, path, fmt)
    _append(spark, root, [(exp_id, "result", name, None, None, json.dumps({"path": path, "format": fmt}), _now())])
    return path


def finish_experiment(spark: SparkSession, root: str, exp_id: str, final_results: dict | None = None) -> None:
    """EXP-04."""
    _append(spark, root, [(exp_id, "finish", None, None, None, json.dumps(final_results or {}, default=str), _now())])


def metrics_of(spark: SparkSession, root: str, exp_id: str) -> DataFrame:
    ev = read_events(spark, root, EVENTS, exp_id)
    return ev.filter(F.col("kind") == "metric").select("name", "value", "step", "event_time")


def list_experiments(spark: SparkSession, root: str) -> DataFrame:
    """EXP-05: latest state of every experiment, newest first."""
    ev = readable(lambda skip: read_events(spark, root, EVENTS, skip_corrupt=skip), f"{root}/events")
    return (
        ev.groupBy("experiment_id")
        .agg(
            F.min_by("name", F.when(F.col("kind") == "start", F.col("event_time"))).alias("name"),
            F.min("event_time").alias("started"),
            F.max("event_time").alias("updated"),
            F.when(F.max(F.col("kind") == "finish"), "completed").otherwise("running").alias("status"),
            F.count_if(F.col("kind") == "metric").alias("n_metrics"),
            F.count_if(F.col("kind") == "result").alias("n_results"),
            F.max_by("payload", F.when(F.col("kind") == "finish", F.col("event_time"))).alias("final_results"),
        )
        .orderBy(F.col("started").desc(), "experiment_id")
    )
