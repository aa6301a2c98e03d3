"""Stream = batch: the stateful operator reproduces WIN-01/02/05 over micro-batches."""

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF_SMALL, frame, rows
from pulsegrid import streaming
from pulsegrid.operators import rolling
from pulsegrid.session import shared_dir
from pulsegrid.sources import panels
from pulsegrid.streaming import rolling_state

STATS = ["series_id", "ts", "seq", "mean", "std", "min", "max", "median", "current", "window_size"]


def _run(spark, df, chunks=4, **kw):
    root = shared_dir(spark, "test-streams", uuid.uuid4().hex)
    x = df if "is_reset" in df.columns else df.withColumn("is_reset", F.lit(False))
    rolling_state.stage_for_replay(x, f"{root}/in", chunks)
    out = rolling_state.stream_rolling(streaming.replay_source(spark, f"{root}/in", 1), **kw)
    streaming.run_to_table(out, f"{root}/out", f"{root}/chk")
    return spark.read.parquet(f"{root}/out"), root


def test_stream_equals_batch_over_micro_batches(spark):
    df = panels.masked(panels.user_series(spark, SF_SMALL))
    got, _ = _run(spark, df, chunks=4, window=30)
    assert got.filter("late").count() == 0
    assert rows(got.select(*STATS), digits=8) == rows(rolling.rolling_stats(df, 30, plan="plain").select(*STATS), digits=8)


def test_stream_band_and_zero_pad_equal_batch(spark):
    df = panels.masked(panels.user_series(spark, SF_SMALL))
    got, _ = _run(spark, df, chunks=3, window=30, band_window=50)
    zp = rolling.rolling_mean_zero_pad(df, 30, plan="plain").select("series_id", "ts", "seq", "mean_zero_pad")
    assert rows(got.select("series_id", "ts", "seq", "mean_zero_pad"), digits=8) == rows(zp, digits=8)
    band = rolling.rolling_band(df, 50, plan="plain").select("series_id", "ts", "seq", F.col("mean").alias("band_mean"), "band_lo", "band_hi")
    assert rows(got.select("series_id", "ts", "seq", "band_mean", "band_lo", "band_hi"), digits=8) == rows(band, digits=8)


def test_restart_from_checkpoint_continues_state(spark):
    df = panels.user_series(spark, SF_SMALL)
    root = shared_dir(spark, "test-streams", uuid.uuid4().hex)
    x = df.withColumn("is_reset", F.lit(False))
    mid = df.select(F.expr("percentile(unix_micros(cast(ts as timestamp)), 0.5)")).first()[0]
    first = x.filter(F.expr(f"unix_micros(cast(ts as timestamp)) <= {mid}"))
    second = x.filter(F.expr(f"unix_micros(cast(ts as timestamp)) > {mid}"))
    first.coalesce(1).write.parquet(f"{root}/in/part=1")
    src = spark.readStream.schema(rolling_state.INPUT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/part=1")
    streaming.run_to_table(rolling_state.stream_rolling(src, window=30), f"{root}/out", f"{root}/chk")
    second.coalesce(1).write.parquet(f"{root}/in2")
    # new files appear in the same source folder; the restarted query resumes its state
    spark.read.parquet(f"{root}/in2").coalesce(1).write.mode("append").parquet(f"{root}/in/part=1")
    src = spark.readStream.schema(rolling_state.INPUT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/part=1")
    streaming.run_to_table(rolling_state.stream_rolling(src, window=30), f"{root}/out", f"{root}/chk")
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == df.count()
    assert rows(got.select(*STATS), digits=8) == rows(rolling.rolling_stats(df, 30, plan="plain").select(*STATS), digits=8)


def test_late_rows_flagged_and_reset_clears(spark):
    t0 = datetime(2024, 1, 1)
    data = [("a", t0 + timedelta(minutes=i), i, float(i), False) for i in range(6)]
    data.append(("a", t0 + timedelta(minutes=3, seconds=30), 99, 100.0, False))  # late: older than last kept
    data.append(("a", t0 + timedelta(minutes=10), 100, None, True))  # reset
    data.append(("a", t0 + timedelta(minutes=11), 101, 7.0, False))
    df = frame(spark, data, "series_id string, ts timestamp_ntz, seq long, value double, is_reset boolean")
    root = shared_dir(spark, "test-streams", uuid.uuid4().hex)
    # two files: the late row arrives in the second micro-batch
    df.filter("seq < 6").coalesce(1).write.parquet(f"{root}/in/a")
    df.filter("seq >= 6").coalesce(1).write.parquet(f"{root}/in/b")
    src = spark.readStream.schema(rolling_state.INPUT_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    streaming.run_to_table(rolling_state.stream_rolling(src, window=3), f"{root}/out", f"{root}/chk")
    got = {r["seq"]: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert got[99]["late"] and got[99]["mean"] is None
    assert 100 not in got
    assert got[101]["window_size"] == 1 and got[101]["mean"] == 7.0
    assert got[5]["mean"] == 4.0


def test_parallel_staging_keeps_time_order(spark):
    df = panels.user_series(spark, SF_SMALL)
    root = shared_dir(spark, "test-streams", uuid.uuid4().hex)
    rolling_state.stage_for_replay(df.withColumn("is_reset", F.lit(False)), f"{root}/in", 3, files_per_chunk=4)
    out = rolling_state.stream_rolling(streaming.replay_source(spark, f"{root}/in", 4), window=30)
    streaming.run_to_table(out, f"{root}/out", f"{root}/chk")
    got = spark.read.parquet(f"{root}/out")
    assert got.filter("late").count() == 0
    assert rows(got.select(*STATS), digits=8) == rows(rolling.rolling_stats(df, 30, plan="plain").select(*STATS), digits=8)


def test_slices_of_a_long_micro_batch(spark, monkeypatch):
    import glob

    from pulsegrid.session import local_path

    monkeypatch.setattr(rolling_state, "SLICE", 7)
    df = panels.masked(panels.user_series(spark, SF_SMALL))
    root = shared_dir(spark, "test-streams", uuid.uuid4().hex)
    rolling_state.stage_for_replay(df.withColumn("is_reset", F.lit(False)), f"{root}/in", 2)
    assert all(len(glob.glob(f"{f}/*/part-*")) >= 4 for f in glob.glob(f"{local_path(root)}/in/_range=*"))
    out = rolling_state.stream_rolling(streaming.replay_source(spark, f"{root}/in"), window=30)
    streaming.run_to_table(out, f"{root}/out", f"{root}/chk")
    got = spark.read.parquet(f"{root}/out")
    assert rows(got.select(*STATS), digits=8) == rows(rolling.rolling_stats(df, 30, plan="plain").select(*STATS), digits=8)


def test_reordered_rows_inside_a_micro_batch(spark):
    df = panels.masked(panels.user_series(spark, SF_SMALL))
    root = shared_dir(spark, "test-streams", uuid.uuid4().hex)
    shuffled = df.withColumn("is_reset", F.lit(False)).orderBy(F.xxhash64("seq"))
    shuffled.coalesce(1).write.parquet(f"{root}/in")
    out = rolling_state.stream_rolling(streaming.replay_source(spark, f"{root}/in", 1), window=30)
    streaming.run_to_table(out, f"{root}/out", f"{root}/chk")
    got = spark.read.parquet(f"{root}/out")
    assert got.filter("late").count() == 0
    assert rows(got.select(*STATS), digits=8) == rows(rolling.rolling_stats(df, 30, plan="plain").select(*STATS), digits=8)


def test_series_of_one_group_keep_their_own_buffers(spark, monkeypatch):
    monkeypatch.setattr(rolling_state, "GROUPS", 1)  # one state row holds all series
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    one = [("a", at(1), 1, 1.0, False), ("a", at(2), 2, None, False), (None, at(1), 3, 5.0, False), ("b", at(1), 4, 8.0, False), ("c", at(1), 5, 2.0, False)]
    two = [("a", at(3), 11, 3.0, False), ("a", at(1), 12, 9.0, False), (None, at(2), 13, 7.0, False), ("b", at(2), 14, None, True), ("b", at(2), 15, 4.0, False), ("d", at(1), 16, 6.0, False), ("d", at(1), 16, 6.5, False)]
    three = [("a", at(4), 21, 5.0, False), ("a", at(5), 22, 7.0, False), (None, at(3), 23, 9.0, False), ("b", at(3), 24, 6.0, False), ("c", at(2), 25, 4.0, False), ("d", at(1), 26, None, True), ("d", at(1), 15, 2.0, False)]
    root = shared_dir(spark, "test-streams", uuid.uuid4().hex)
    for part in (one, two, three):
        df = frame(spark, part, "series_id string, ts timestamp_ntz, seq long, value double, is_reset boolean")
        df.coalesce(1).write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(rolling_state.INPUT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        streaming.run_to_table(rolling_state.stream_rolling(src, window=3, band_window=2), f"{root}/out", f"{root}/chk")
    got = {(r["series_id"], r["seq"], r["current"]): (r["mean"], r["window_size"], r["band_mean"], r["late"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {
        ("a", 1, 1.0): (1.0, 1, 1.0, False), ("a", 2, None): (None, 2, 1.0, False), ("a", 11, 3.0): (None, 3, 3.0, False),
        ("a", 12, 9.0): (None, 2, None, True), ("a", 21, 5.0): (None, 3, 4.0, False), ("a", 22, 7.0): (5.0, 3, 6.0, False),
        (None, 3, 5.0): (5.0, 1, 5.0, False), (None, 13, 7.0): (6.0, 2, 6.0, False), (None, 23, 9.0): (7.0, 3, 8.0, False),
        ("b", 4, 8.0): (8.0, 1, 8.0, False), ("b", 15, 4.0): (4.0, 1, 4.0, False), ("b", 24, 6.0): (5.0, 2, 5.0, False),
        ("c", 5, 2.0): (2.0, 1, 2.0, False), ("c", 25, 4.0): (3.0, 2, 3.0, False),
        ("d", 16, 6.0): (6.0, 1, 6.0, False), ("d", 16, 6.5): (None, 0, None, True), ("d", 15, 2.0): (None, 1, None, True),
    }
