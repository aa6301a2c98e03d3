"""Registered queries of typed streaming state and of the replay by rows (imported by ``suite``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid import sqlparts as S
from pulsegrid import streaming
from pulsegrid.session import shared_dir
from pulsegrid.streaming import replay_rows, rolling_state, typed_state
from pulsegrid.suite import _STREAM_ROLL_SQL, p1m, p3, register

_CHUNKS_SQL = f"""
SELECT CAST(no // 50 AS BIGINT) AS batch, count(*) AS n_rows, min(no) AS first_row, max(no) AS last_row, max(ts) AS last_ts, sum(value) AS total
FROM (SELECT row_number() OVER (ORDER BY ts, seq, series_id) - 1 AS no, ts, value FROM ({S.P3}) _p) _q GROUP BY 1"""


@register("stream_replay_chunks", _CHUNKS_SQL, ["total"], bits=4)
def q_stream_replay_chunks(spark, d):
    """SRC-05: the daily order series replayed in micro-batches of exactly 50 rows."""
    root = shared_dir(spark, "streams", "chunks", unique=True)
    replay_rows.stage_rows(p3(spark, d), f"{root}/staged")

    def note(batch, batch_id: int) -> None:
        seen = batch.agg(F.count(F.lit(1)).alias("n_rows"), F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row"), F.max("ts").alias("last_ts"), F.sum("value").alias("total"))
        seen.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("append").parquet(f"{root}/seen")

    replay_rows.run_slices(replay_rows.replay_rows(spark, f"{root}/staged", 50), f"{root}/chk", foreach=note)
    return spark.read.parquet(f"{root}/seen").select("batch", "n_rows", "first_row", "last_row", "last_ts", "total")


@register("stream_typed_state", _STREAM_ROLL_SQL, S.ROLLING_DOUBLES)
def q_stream_typed_state(spark, d):
    """STR-01 with typed list state: trailing-30 stats over five replayed micro-batches (equals WIN-01)."""
    root = shared_dir(spark, "streams", "typed", unique=True)
    rolling_state.stage_for_replay(p1m(spark, d).withColumn("is_reset", F.lit(False)), f"{root}/in", 5)
    out = typed_state.stream_trailing(streaming.replay_source(spark, f"{root}/in"), 30)
    streaming.run_to_table(out, f"{root}/out", f"{root}/chk", state_store=rolling_state.ROCKSDB)
    return spark.read.parquet(f"{root}/out").select("series_id", "ts", "seq", "mean", "std", "min", "max", "median", "current", "window_size", "late")
