"""STR-01..05: trailing-row statistics kept live over a Structured Streaming source.

ROWS windows are refused on streams, so the buffer is explicit keyed state:
series are dealt into ``GROUPS`` hash groups and ``applyInPandasWithState`` holds the last N
values (and, for the band, the last M means) of every series of a group in the state store,
which is checkpointed, so a restarted query (or a lost executor) resumes exactly. The rows that
a micro-batch brings for a group are worked on together, as runs laid one after another: what a
call, a frame and a state row cost is paid by the group, not by the series.

Rules (ours, because a real stream can be out of order):
* inside a micro-batch the rows of a series are sorted by ``(ts, seq)`` across
  all frames handed to the function;
* a row not after the last row kept in state is emitted with ``late = true``,
  NULL statistics, and is not buffered;
* a row with ``is_reset = true`` clears the buffers (the control row itself
  emits nothing);
* a NULL inside the buffer makes mean/std/min/max/median NULL until it leaves
  (same as the batch operator WIN-01); ``window_size`` counts rows.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsegrid.frame import KEY, SCHEMA
from pulsegrid.plans.blocked import epoch_micros

INPUT_SCHEMA = T.StructType([*SCHEMA.fields, T.StructField("is_reset", T.BooleanType(), True)])

OUT_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("median", T.DoubleType()),
        T.StructField("current", T.DoubleType()),
        T.StructField("window_size", T.LongType()),
        T.StructField("mean_zero_pad", T.DoubleType()),
        T.StructField("band_mean", T.DoubleType()),
        T.StructField("band_lo", T.DoubleType()),
        T.StructField("band_hi", T.DoubleType()),
        T.StructField("late", T.BooleanType()),
    ]
)

#: Groups that the series of a stream are dealt into. The state of a checkpoint is kept by group, so this stays as it is.
GROUPS = 1024

#: A series a place of ``keys``; its last values are the next ``n_vals`` of ``vals`` (NaN: NULL), its last means likewise.
STATE_SCHEMA = T.StructType(
    [
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("last_ts", T.ArrayType(T.LongType())),
        T.StructField("last_seq", T.ArrayType(T.LongType())),
        T.StructField("n_vals", T.ArrayType(T.LongType())),
        T.StructField("vals", T.ArrayType(T.DoubleType())),
        T.StructField("n_means", T.ArrayType(T.LongType())),
        T.StructField("means", T.ArrayType(T.DoubleType())),
    ]
)


#: Rows whose windows are laid out, and handed on, at once.
SLICE = 20_000


def _window_stats(vals: np.ndarray, n_new: int, window: int, void_nulls: bool = True):
    """Statistics of the trailing ``window`` values ending at each of the last
    ``n_new`` positions of ``vals`` (NaN = NULL value), vectorised. With
    ``void_nulls`` a NULL in the window voids mean/std/min/max/median (WIN-01);
    without, NULLs are skipped (WIN-05 band)."""
    pad = np.full(window - 1, np.nan)
    real = np.concatenate([np.zeros(window - 1, bool), np.ones(len(vals), bool)])
    v = np.concatenate([pad, vals])
    wv = sliding_window_view(v, window)[-n_new:]
    wm = sliding_window_view(real, window)[-n_new:]
    rows = wm.sum(axis=1)
    has_null = (wm & np.isnan(wv)).any(axis=1)
    return _stats(np.where(wm, wv, np.nan), rows, has_null, window, void_nulls)


def _stats(x: np.ndarray, rows: np.ndarray, has_null: np.ndarray, window: int, void_nulls: bool):
    with np.errstate(all="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        mean = np.nanmean(x, axis=1)
        std = np.nanstd(x, axis=1)
        mn = np.nanmin(x, axis=1)
        mx = np.nanmax(x, axis=1)
        med = np.nanmedian(x, axis=1)
        zero = np.nansum(x, axis=1) / window
    if void_nulls:
        for arr in (mean, std, mn, mx, med):
            arr[has_null] = np.nan
    return rows, mean, std, mn, mx, med, zero


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start .. start + length`` of every place, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class _Runs:
    """Values of many runs, one after another: what is held of each, then its ``n_new`` new ones (filled in later)."""

    def __init__(self, held: np.ndarray, held_at: np.ndarray, n_held: np.ndarray, n_new: np.ndarray):
        self.lengths = n_held + n_new
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.values = np.full(self.lengths.sum(), np.nan)
        self.values[_ranges(self.starts, n_held)] = held[_ranges(held_at, n_held)]
        self.place = _ranges(np.zeros_like(self.lengths), self.lengths)
        self.new = _ranges(self.starts + n_held, n_new)

    def windows(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(values, which of them are rows of the run) of the trailing windows that end at ``at``."""
        back = np.arange(window - 1, -1, -1)
        inside = self.place[at][:, None] >= back
        return np.where(inside, self.values[np.maximum(at[:, None] - back, 0)], np.nan), inside

    def last(self, runs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(how many, which) of the last ``n`` values of some runs."""
        size = np.minimum(self.lengths[runs], n)
        return size, self.values[_ranges(self.starts[runs] + self.lengths[runs] - size, size)]


def _whole(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(which are NULL, the values as int64, the least one for NULL)"""
    null = column.isna().to_numpy(bool)
    return null, column.where(~null, np.iinfo(np.int64).min).to_numpy(np.int64) if null.any() else column.to_numpy(np.int64)


def _processor(window: int, band_window: int, margin: float):
    keep = max(window, band_window)
    cols = OUT_SCHEMA.fieldNames()
    nothing = dict.fromkeys(("mean", "std", "min", "max", "median", "mean_zero_pad", "band_mean", "band_lo", "band_hi"), np.nan)

    def fn(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(frames), ignore_index=True)
        code, names = pd.factorize(np.asarray(pdf[KEY], object), use_na_sentinel=False)
        names = np.asarray([None if pd.isna(x) else x for x in names] + [None], object)[:-1]
        (no_ts, ts), (no_seq, seq) = _whole(pdf["ts_us"]), _whole(pdf["seq"])
        order = np.lexsort((seq, no_seq, ts, no_ts, code))
        code, ts, seq = code[order], ts[order], seq[order]
        value = pdf["value"].to_numpy(float, na_value=np.nan)[order]
        reset = pdf["is_reset"].fillna(False).to_numpy(bool)[order]

        held_keys, *held = state.get if state.exists else ([], [], [], [], [], [], [])
        held_ts, held_seq, n_vals, n_means = (np.asarray(held[i], np.int64) for i in (0, 1, 2, 4))
        vals, means = np.asarray(held[3], float), np.asarray(held[5], float)
        vals_at, means_at = np.cumsum(n_vals) - n_vals, np.cumsum(n_means) - n_means
        place = {k: i for i, k in enumerate(held_keys)}
        held_no = np.asarray([place.get(k, -1) for k in names], np.int64)

        # a run: the rows of a series up to a reset row, or after one; only the first goes on from the state
        begins = np.ones(len(code), bool)
        begins[1:] = code[1:] != code[:-1]
        ends = np.append(begins[1:], True)[: len(code)]
        run = np.cumsum(begins | reset) - 1
        resets = np.cumsum(reset)
        first = resets == np.repeat((resets - reset)[begins], np.diff(np.append(np.flatnonzero(begins), len(code))))
        last_run, goes_on = run[ends], first[ends]  # of every series, in the order of its code

        code, run, first, t, q, v = (x[~reset] for x in (code, run, first, ts, seq, value))
        from_held = np.where(first, held_no[code], -1)
        late = np.zeros(len(t), bool)
        late[1:] = (run[1:] == run[:-1]) & (t[1:] == t[:-1]) & (q[1:] == q[:-1])
        if len(held_keys):
            mark_ts, mark_seq = held_ts[from_held], held_seq[from_held]
            late |= (from_held >= 0) & ((t < mark_ts) | ((t == mark_ts) & (q <= mark_seq)))

        def rows_of(at: np.ndarray, out: dict) -> pd.DataFrame:
            return pd.DataFrame({KEY: names[code[at]], "ts_us": t[at], "seq": q[at], "current": v[at]} | nothing | out)[cols].astype({"current": float})

        if late.any():
            at = np.flatnonzero(late)
            size = np.where(from_held[at] >= 0, np.minimum(n_vals[from_held[at]], window), 0) if len(held_keys) else 0
            yield rows_of(at, {"window_size": size, "late": True})

        ok = np.flatnonzero(~late)
        starts = np.flatnonzero(np.diff(run[ok], prepend=-1))  # of each run with rows to count
        n_new = np.diff(np.append(starts, len(ok)))
        source = from_held[ok][starts]
        take = lambda x: np.where(source >= 0, x[source], 0) if len(held_keys) else np.zeros(len(source), np.int64)
        values = _Runs(vals, take(vals_at), take(n_vals), n_new)
        values.values[values.new] = v[ok]
        averages = _Runs(means, take(means_at), take(n_means), n_new) if band_window > 0 else None
        # a long micro-batch goes through in slices: the window matrices stay small
        for cut in range(0, len(ok), SLICE):
            at = values.new[cut : cut + SLICE]
            x, inside = values.windows(at, window)
            size = inside.sum(axis=1)
            _, mean, std, mn, mx, med, zero = _stats(x, size, (inside & np.isnan(x)).any(axis=1), window, True)
            out = {"mean": mean, "std": std, "min": mn, "max": mx, "median": med, "window_size": size, "mean_zero_pad": zero, "late": False}
            if band_window > 0:
                x, inside = values.windows(at, band_window)
                with np.errstate(all="ignore"), warnings.catch_warnings():
                    warnings.simplefilter("ignore", RuntimeWarning)
                    bmean = np.nanmean(x, axis=1)
                    averages.values[averages.new[cut : cut + SLICE]] = bmean
                    m, _ = averages.windows(averages.new[cut : cut + SLICE], band_window)
                    lo_b = np.fmin(np.nanmin(x, axis=1), np.nanmin(m, axis=1))
                    hi_b = np.fmax(np.nanmax(x, axis=1), np.nanmax(m, axis=1))
                padw = (hi_b - lo_b) * margin
                bad = np.isnan(bmean)
                out.update(band_mean=bmean, band_lo=np.where(bad, np.nan, lo_b - padw), band_hi=np.where(bad, np.nan, hi_b + padw))
            yield rows_of(ok[cut : cut + SLICE], out)

        # of each series: the last run is held if it has rows that count; else what was held, unless a reset came
        runs = run[ok][starts]
        series = code[ok][starts]
        held_on = np.flatnonzero(runs == last_run[series])
        stays = np.ones(len(held_keys), bool)
        gone = ~goes_on
        gone[series[held_on]] = True
        stays[held_no[gone & (held_no >= 0)]] = False
        old, end = np.flatnonzero(stays), ok[(starts + n_new - 1)[held_on]] if len(ok) else np.empty(0, np.int64)
        size, tail = values.last(held_on, keep)
        m_size, m_tail = averages.last(held_on, band_window) if band_window > 0 else (np.zeros(len(held_on), np.int64), np.empty(0))
        state.update(
            (
                [held_keys[i] for i in old] + names[series[held_on]].tolist(),
                np.concatenate([held_ts[old], t[end]]).tolist(),
                np.concatenate([held_seq[old], q[end]]).tolist(),
                np.concatenate([n_vals[old], size]).tolist(),
                np.concatenate([vals[_ranges(vals_at[old], n_vals[old])], tail]).tolist(),
                np.concatenate([n_means[old], m_size]).tolist(),
                np.concatenate([means[_ranges(means_at[old], n_means[old])], m_tail]).tolist(),
            )
        )

    return fn


def stream_rolling(stream: DataFrame, window: int = 30, band_window: int = 0, margin: float = 0.1) -> DataFrame:
    """STR-01/03/04 over a streaming (or batch) canonical frame, optional ``is_reset``."""
    cols = [KEY, epoch_micros("ts").alias("ts_us"), "seq", "value"]
    cols.append(F.col("is_reset") if "is_reset" in stream.columns else F.lit(False).alias("is_reset"))
    x = stream.select(F.pmod(F.xxhash64(KEY), F.lit(GROUPS)).alias("_group"), *cols)
    out = x.groupBy("_group").applyInPandasWithState(
        _processor(window, band_window, margin), OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
    ts = F.expr("timestampadd(MICROSECOND, ts_us, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return out.withColumn("ts", ts).drop("ts_us")


def replay_source(spark: SparkSession, path: str, files_per_trigger: int = 4, schema: T.StructType = INPUT_SCHEMA) -> DataFrame:
    """SRC-05 / STR-05: rows staged by ``stage_for_replay`` as micro-batches of some files each."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stage_for_replay(df: DataFrame, path: str, chunks: int = 4, files_per_chunk: int = 4) -> None:
    """Write a frame once, as ``chunks`` consecutive time ranges of ``files_per_chunk`` files each.

    Range cuts are quantiles of ``ts`` from one small aggregate; every row lands in exactly one range, and
    a series in one file of each range. The file source takes files by modification time, so the files
    of later ranges get later times: of any series the earlier range comes first, whatever the
    number of files a trigger takes."""
    spark = df.sparkSession
    us = epoch_micros("ts")
    cuts = df.agg(F.percentile_approx(us, [i / chunks for i in range(1, chunks)], 10000).alias("q")).first()["q"] if chunks > 1 else []
    place = sum(((us > F.lit(c)).cast("int") for c in sorted(set(cuts or []))), F.lit(0))
    x = df.withColumn("_range", place).withColumn("_file", F.pmod(F.xxhash64(KEY), F.lit(files_per_chunk)))
    x.repartition(chunks * files_per_chunk, "_range", "_file").write.partitionBy("_range", "_file").parquet(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, stamp = fs.listFiles(root, True), 1_000_000_000_000
    while found.hasNext():
        f = found.next().getPath()
        nth = re.search(r"/_range=(\d+)/", f.toString())
        if nth:
            fs.setTimes(f, stamp + 1000 * int(nth[1]), -1)


#: Typed state variables need a state store with column families; any stateful query may use it.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_table(stream_out: DataFrame, out_path: str, checkpoint: str, foreach=None, state_store: str | None = None) -> None:
    """Run the query to completion over what is available (``availableNow``) into
    a parquet table (or a ``foreachBatch`` function), checkpointed for restart. It runs no micro-batch
    without rows: state with an expiry would ask for one after the other and the query would not end.

    ``state_store``: the provider of this query's state, whatever the session's is (``ROCKSDB`` for typed state)."""
    w = stream_out.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # a query keeps the settings that it is started with
    wanted = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"} | ({"spark.sql.streaming.stateStore.providerClass": state_store} if state_store else {})
    conf = stream_out.sparkSession.conf
    before = {name: conf.get(name) for name in wanted}
    for name, value in wanted.items():
        conf.set(name, value)
    try:
        if foreach is not None:
            q = w.foreachBatch(foreach).start()
        else:
            q = w.outputMode("append").format("parquet").option("path", out_path).start()
    finally:
        for name, value in before.items():
            conf.set(name, value)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def snapshot_writer(path: str):
    """STR-02: ``foreachBatch`` that appends the latest row per series of every
    micro-batch (tagged by batch id) to an append-only snapshot table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        names = [c for c in batch.columns if c != KEY]
        latest = batch.filter(~F.col("late")).groupBy(KEY).agg(F.max_by(F.struct(*names), F.struct("ts", "seq")).alias("s"))
        latest.select(KEY, "s.*").withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(path)

    return write


def current_stats_view(spark: SparkSession, path: str) -> DataFrame:
    """STR-02 read side: the newest snapshot row per series."""
    snap = spark.read.parquet(path)
    names = [c for c in snap.columns if c not in (KEY,)]
    return snap.groupBy(KEY).agg(F.max_by(F.struct(*names), F.struct("ts", "seq", "batch_id")).alias("s")).select(KEY, "s.*").drop("batch_id")
