import time
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, frame, rows
from pulsegrid import streaming
from pulsegrid.operators import rolling
from pulsegrid.session import shared_dir
from pulsegrid.sources import panels
from pulsegrid.streaming import replay_rows, rolling_state, typed_state

STATS = ["series_id", "ts", "seq", "mean", "std", "min", "max", "median", "current", "window_size"]
T0 = datetime(2024, 1, 1)
SCHEMA = "series_id string, ts timestamp_ntz, seq long, value double, is_reset boolean"


def _source(spark, path):
    return spark.readStream.schema(rolling_state.INPUT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def _push(spark, data, path):
    frame(spark, data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_equals_batch_over_micro_batches_and_a_restart(spark, monkeypatch):
    df = panels.masked(panels.user_series(spark, SF_SMALL))
    root = shared_dir(spark, "test-typed", uuid.uuid4().hex)
    staged = df.withColumn("is_reset", F.lit(False))
    cuts = df.selectExpr("percentile(unix_micros(cast(ts as timestamp)), array(0.2, 0.4, 0.6, 0.8)) as q").first()["q"]
    us = "unix_micros(cast(ts as timestamp))"
    parts = [staged.where(f"{us} > {lo} and {us} <= {hi}") for lo, hi in zip([-1, *cuts], [*cuts, 1 << 62])]
    for run in (parts[:3], parts[3:]):  # the second run starts from the checkpoint
        for p in run:
            p.coalesce(1).write.mode("append").parquet(f"{root}/in")
            out = typed_state.stream_trailing(_source(spark, f"{root}/in"), 30)
            streaming.run_to_table(out, f"{root}/out", f"{root}/chk")
    got = spark.read.parquet(f"{root}/out")
    assert got.where("late").count() == 0
    assert rows(got.select(*STATS), digits=8) == rows(rolling.rolling_stats(df, 30, plan="plain").select(*STATS), digits=8)


def test_late_rows_resets_and_slices(spark):
    data = [("a", T0 + timedelta(minutes=i), i, float(i), False) for i in range(6)]
    more = [("a", T0 + timedelta(minutes=3, seconds=30), 99, 100.0, False), ("a", T0 + timedelta(minutes=10), 100, None, True), ("a", T0 + timedelta(minutes=11), 101, 7.0, False)]
    root = shared_dir(spark, "test-typed", uuid.uuid4().hex)
    for part in (data, more):
        _push(spark, part, f"{root}/in")
        streaming.run_to_table(typed_state.stream_trailing(_source(spark, f"{root}/in"), 3), f"{root}/out", f"{root}/chk")
    got = {r["seq"]: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert got[99]["late"] and got[99]["mean"] is None and 100 not in got
    assert got[101]["window_size"] == 1 and got[101]["mean"] == 7.0 and got[5]["mean"] == 4.0


def test_an_idle_key_is_forgotten_after_its_ttl(spark):
    root = shared_dir(spark, "test-typed", uuid.uuid4().hex)
    for n, wait in ((0, 0), (1, 0), (2, 25)):
        time.sleep(wait)
        _push(spark, [("a", T0 + timedelta(minutes=n), n, float(n), False)], f"{root}/in")
        streaming.run_to_table(typed_state.stream_trailing(_source(spark, f"{root}/in"), 5, ttl_ms=20_000), f"{root}/out", f"{root}/chk")
    got = {r["seq"]: r["window_size"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {0: 1, 1: 2, 2: 1}


def test_replay_in_exact_slices_with_a_restart(spark):
    df = panels.user_series(spark, SF_SMALL)
    root = shared_dir(spark, "test-replay", uuid.uuid4().hex)
    replay_rows.stage_rows(df, f"{root}/staged", file_rows=130)
    seen = []

    def note(batch, i):
        if i == 4 and len(seen) == 4:
            raise RuntimeError("stopped here")  # the fifth slice is lost and comes again
        r = batch.agg(F.count(F.lit(1)), F.min("row_no"), F.max("row_no")).first()
        seen.append(tuple(r))

    for attempt in range(2):
        stream = replay_rows.replay_rows(spark, f"{root}/staged", 70, f"{root}/chk")
        if attempt:
            replay_rows.run_slices(stream, f"{root}/chk", foreach=note)
        else:
            with pytest.raises(Exception, match="stopped here"):
                replay_rows.run_slices(stream, f"{root}/chk", foreach=note)
            seen.append(None)
    done = [s for s in seen if s]
    n = df.count()
    assert done == [(min(70, n - at), at, min(n, at + 70) - 1) for at in range(0, n, 70)]
    back = spark.read.parquet(f"{root}/staged/rows")
    first = back.orderBy("row_no").select("series_id", "ts", "seq").limit(40).collect()
    assert first == df.orderBy("ts", "seq", "series_id").select("series_id", "ts", "seq").limit(40).collect()


def test_replay_of_an_empty_table(spark):
    root = shared_dir(spark, "test-replay", uuid.uuid4().hex)
    replay_rows.stage_rows(panels.user_series(spark, SF_SMALL).where("false"), f"{root}/staged")
    assert replay_rows.replay_rows(spark, f"{root}/staged", 50).isStreaming


def test_runs_in_a_session_with_another_state_store(spark):
    from pulsegrid import suite

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        got = suite.QUERIES["stream_typed_state"](spark, SF_SMALL)
        assert "HDFSBacked" in spark.conf.get(name)
    finally:
        spark.conf.set(name, before)
    df = panels.masked(panels.user_series(spark, SF_SMALL))
    want = rolling.rolling_stats(df, 30, plan="plain")
    # the query rounds its doubles
    assert rows(got.select("series_id", "ts", "seq", "window_size", F.round("mean", 4).alias("m"))) == rows(want.select("series_id", "ts", "seq", "window_size", F.round("mean", 4).alias("m")))
