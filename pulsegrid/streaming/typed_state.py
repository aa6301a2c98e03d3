"""STR-01 with typed state variables: trailing-row statistics by ``transformWithStateInPandas``.

The last values of a series are a list state that grows by the new rows of a micro-batch (one append a row, nothing
rewritten) and is cut back to the window when it holds several windows. Frames are consumed one at a time and their results are yielded slice by slice, so memory
does not grow with a key's rows. Values, and the mark of the last row, expire ``ttl`` after they were written: a key that is idle
that long has no state left, and starts anew.

Rows are sorted by ``(ts, seq)`` inside a frame. A row that is not after the last row kept (of an earlier frame or micro-batch)
is late: emitted with ``late = true`` and NULL statistics, and not buffered. ``is_reset = true`` clears the state. A NULL inside the window
voids the statistics until it leaves (WIN-01).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulsegrid.frame import KEY
from pulsegrid.plans.blocked import epoch_micros
from pulsegrid.session import ship_package
from pulsegrid.streaming.rolling_state import SLICE, _window_stats

#: Windows the list may hold before it is cut back to one.
WINDOWS = 4

OUT_SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("ts_us", T.LongType()), T.StructField("seq", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("mean", "std", "min", "max", "median", "current")]
    + [T.StructField("window_size", T.LongType()), T.StructField("late", T.BooleanType())]
)


class TrailingStats(StatefulProcessor):
    def __init__(self, window: int, ttl_ms: int | None):
        self.window, self.ttl_ms = window, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getListState("values", "value double", self.ttl_ms)
        self.mark = handle.getValueState("mark", "ts_us long, seq long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = self.mark.get() if self.mark.exists() else None
        held = [np.nan if v[0] is None else v[0] for v in self.values.get()]
        stored, fresh, rewrite = len(held), [], False
        buffer = np.asarray(held[-self.window :], float)
        for pdf in rows:
            pdf = pdf.sort_values(["ts_us", "seq"], kind="mergesort")
            ts, seq = pdf["ts_us"].to_numpy(np.int64), pdf["seq"].to_numpy(np.int64)
            value, reset = pdf["value"].to_numpy(float, na_value=np.nan), pdf["is_reset"].fillna(False).to_numpy(bool)
            bounds = [-1, *np.flatnonzero(reset).tolist(), len(pdf)]
            for part, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                if part:
                    mark, buffer, fresh, rewrite = None, np.empty(0), [], True
                at = slice(lo + 1, hi)
                t, q, v = ts[at], seq[at], value[at]
                late = np.zeros(len(t), bool)
                late[1:] = (t[1:] == t[:-1]) & (q[1:] == q[:-1])
                if mark is not None:
                    late |= (t < mark[0]) | ((t == mark[0]) & (q <= mark[1]))
                if late.any():
                    nothing = {c: np.nan for c in ("mean", "std", "min", "max", "median")}
                    yield self._out(key, t[late], q[late], nothing | {"current": v[late], "window_size": len(buffer), "late": True})
                t, q, v = t[~late], q[~late], v[~late]
                for cut in range(0, len(t), SLICE):
                    new = v[cut : cut + SLICE]
                    size, mean, std, least, most, median, _ = _window_stats(np.concatenate([buffer, new]), len(new), self.window)
                    yield self._out(key, t[cut : cut + SLICE], q[cut : cut + SLICE], {"mean": mean, "std": std, "min": least, "max": most, "median": median, "current": new, "window_size": size, "late": False})
                    buffer = np.concatenate([buffer, new])[-self.window :]
                    fresh = [*fresh, *new.tolist()][-self.window :]
                if len(t):
                    mark = (int(t[-1]), int(q[-1]))
        as_rows = lambda xs: [(None if np.isnan(x) else float(x),) for x in xs]
        if rewrite or stored + len(fresh) > WINDOWS * self.window:
            self.values.put(as_rows(buffer)) if len(buffer) else self.values.clear()
        elif fresh:
            self.values.appendList(as_rows(fresh))
        if mark is None:
            self.mark.clear()
        else:
            self.mark.update(mark)

    def close(self) -> None:
        pass

    def _out(self, key, ts, seq, columns: dict) -> pd.DataFrame:
        return pd.DataFrame({KEY: key[0], "ts_us": ts, "seq": seq} | columns)[OUT_SCHEMA.fieldNames()].astype({"window_size": "int64"})


def stream_trailing(stream: DataFrame, window: int = 30, ttl_ms: int | None = None) -> DataFrame:
    """WIN-01 statistics of every arriving row of a stream of canonical rows, optional ``is_reset``.

    ``ttl_ms``: processing time after which an idle key's values are forgotten; None keeps them."""
    ship_package(stream.sparkSession)
    reset = F.col("is_reset") if "is_reset" in stream.columns else F.lit(False).alias("is_reset")
    rows = stream.select(KEY, epoch_micros("ts").alias("ts_us"), "seq", "value", reset)
    mode = "none" if ttl_ms is None else "processingTime"
    out = rows.groupBy(KEY).transformWithStateInPandas(TrailingStats(window, ttl_ms), OUT_SCHEMA, "append", mode)
    return out.withColumn("ts", F.expr("timestampadd(MICROSECOND, ts_us, TIMESTAMP_NTZ'1970-01-01 00:00:00')")).drop("ts_us")
