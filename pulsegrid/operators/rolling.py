"""WIN-01..07 and ANO-01: trailing-row windows over each series.

All window columns of one operator share one ``series_window`` spec, so Catalyst
plans one Exchange(series_id) + one Sort for them. Frames are ROWS frames bounded
by the window length, so ``apply_windows`` can run them blocked for a huge series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER, series_window
from pulsegrid.plans.blocked import apply_windows

BASE = [KEY, *ORDER]


def _trailing(part: Sequence[str], n: int) -> Window:
    return series_window(*part).rowsBetween(-(n - 1), 0)


def rolling_stats(
    df: DataFrame, window: int = 30, warmup: str = "partial", col: str = "value", plan: str = "auto"
) -> DataFrame:
    """WIN-01: mean, population std, min, max, median, current, window_size.

    ``warmup='partial'`` computes over the rows seen so far (up to ``window``);
    ``'full'`` gives NULL statistics until the buffer holds ``window`` rows.
    A NULL inside the buffer makes the statistics NULL until it leaves (SEM-17).
    """
    if window < 1:
        raise ValueError("window must be >= 1")
    if warmup not in ("partial", "full"):
        raise ValueError(f"unknown warmup: {warmup}")
    v = F.col(col)

    def build(d: DataFrame, part: Sequence[str]) -> DataFrame:
        w = _trailing(part, window)
        rows = F.count(F.lit(1)).over(w)
        ok = F.count(v).over(w) == rows
        if warmup == "full":
            ok = ok & (rows == window)

        def stat(c: Column, name: str) -> Column:
            return F.when(ok, c).alias(name)

        return d.select(
            *BASE,
            *[c for c in d.columns if c.startswith("_")],
            stat(F.avg(v).over(w), "mean"),
            stat(F.stddev_pop(v).over(w), "std"),
            stat(F.min(v).over(w), "min"),
            stat(F.max(v).over(w), "max"),
            stat(F.percentile(v, 0.5).over(w), "median"),
            v.alias("current"),
            rows.cast("long").alias("window_size"),
        )

    return apply_windows(df.select(*BASE, v.alias(col)), build, lookback=window - 1, plan=plan)


def rolling_mean_zero_pad(df: DataFrame, window: int = 30, col: str = "value", plan: str = "auto") -> DataFrame:
    """WIN-02: mean of a buffer pre-filled with ``window`` zeros (divisor always N)."""
    v = F.col(col)

    def build(d: DataFrame, part: Sequence[str]) -> DataFrame:
        w = _trailing(part, window)
        return d.select(
            *BASE,
            *[c for c in d.columns if c.startswith("_")],
            v.alias("value"),
            (F.coalesce(F.sum(v).over(w), F.lit(0.0)) / F.lit(float(window))).alias("mean_zero_pad"),
        )

    return apply_windows(df.select(*BASE, v.alias(col)), build, lookback=window - 1, plan=plan)


def _full_mean_std(v: Column, w: Window, n: int) -> tuple[Column, Column]:
    complete = F.count(v).over(w) == n
    return F.when(complete, F.avg(v).over(w)), F.when(complete, F.stddev_samp(v).over(w))


def rolling_full(
    df: DataFrame, windows: Sequence[int] = (5, 10, 20), col: str = "value", plan: str = "auto"
) -> DataFrame:
    """WIN-03: trailing mean and sample std, only over complete windows of non-NULL rows."""
    v = F.col(col)

    def build(d: DataFrame, part: Sequence[str]) -> DataFrame:
        cols = []
        for n in windows:
            m, s = _full_mean_std(v, _trailing(part, n), n)
            cols += [m.alias(f"mean{n}"), s.alias(f"std{n}")]
        return d.select(*BASE, *[c for c in d.columns if c.startswith("_")], v.alias("value"), *cols)

    return apply_windows(df.select(*BASE, v.alias(col)), build, lookback=max(windows) - 1, plan=plan)


def lags(df: DataFrame, ks: Sequence[int] = (1, 2, 3), col: str = "value", plan: str = "auto") -> DataFrame:
    """WIN-04: ``lag(value, k)`` per series."""
    v = F.col(col)

    def build(d: DataFrame, part: Sequence[str]) -> DataFrame:
        w = series_window(*part)
        return d.select(
            *BASE,
            *[c for c in d.columns if c.startswith("_")],
            v.alias("value"),
            *[F.lag(v, k).over(w).alias(f"lag{k}") for k in ks],
        )

    return apply_windows(df.select(*BASE, v.alias(col)), build, lookback=max(ks), plan=plan)


def anomaly_features(df: DataFrame, col: str = "value", plan: str = "auto") -> DataFrame:
    """ANO-01: mean5,std5,mean10,std10,mean20,std20,lag1,lag2,lag3; incomplete rows dropped.

    One window spec for all nine columns: one Exchange + one Sort.
    """
    v = F.col(col)

    def build(d: DataFrame, part: Sequence[str]) -> DataFrame:
        w = series_window(*part)
        cols = []
        for n in (5, 10, 20):
            m, s = _full_mean_std(v, _trailing(part, n), n)
            cols += [m.alias(f"mean{n}"), s.alias(f"std{n}")]
        cols += [F.lag(v, k).over(w).alias(f"lag{k}") for k in (1, 2, 3)]
        return d.select(*BASE, *[c for c in d.columns if c.startswith("_")], *cols)

    out = apply_windows(df.select(*BASE, v.alias(col)), build, lookback=19, plan=plan)
    return out.dropna(subset=FEATURES)


FEATURES = ["mean5", "std5", "mean10", "std10", "mean20", "std20", "lag1", "lag2", "lag3"]


def rolling_band(df: DataFrame, window: int = 50, margin: float = 0.1, col: str = "value", plan: str = "auto") -> DataFrame:
    """WIN-05: trailing mean (partial warm-up) and a padded band around the last
    ``window`` values and the last ``window`` means (live-view limits)."""
    v = F.col(col)

    def build(d: DataFrame, part: Sequence[str]) -> DataFrame:
        w = _trailing(part, window)
        keep = [c for c in d.columns if c.startswith("_")]
        step1 = d.select(
            *BASE,
            *keep,
            v.alias("value"),
            F.avg(v).over(w).alias("mean"),
            F.min(v).over(w).alias("_vmin"),
            F.max(v).over(w).alias("_vmax"),
        )
        lo = F.least(F.col("_vmin"), F.min("mean").over(w))
        hi = F.greatest(F.col("_vmax"), F.max("mean").over(w))
        step2 = step1.select(*BASE, *keep, "value", "mean", lo.alias("_lo"), hi.alias("_hi"))
        pad = (F.col("_hi") - F.col("_lo")) * margin
        return step2.select(
            *BASE, *keep, "value", "mean", (F.col("_lo") - pad).alias("band_lo"), (F.col("_hi") + pad).alias("band_hi")
        )

    return apply_windows(df.select(*BASE, v.alias(col)), build, lookback=2 * (window - 1), plan=plan)


def centered_ma(df: DataFrame, period: int, col: str = "value", plan: str = "auto") -> DataFrame:
    """WIN-06: centred moving average; 2xm with half end weights for even m; NULL at both ends."""
    v = F.col(col)
    h = period // 2

    def build(d: DataFrame, part: Sequence[str]) -> DataFrame:
        w = series_window(*part)
        frame = w.rowsBetween(-h, h)
        full = F.count(F.lit(1)).over(frame) == (2 * h + 1)
        total = F.sum(v).over(frame)
        if period % 2 == 0:
            total = total - 0.5 * (F.lag(v, h).over(w) + F.lead(v, h).over(w))
        trend = F.when(full & (F.count(v).over(frame) == 2 * h + 1), total / F.lit(float(period)))
        return d.select(*BASE, *[c for c in d.columns if c.startswith("_")], v.alias("value"), trend.alias("trend"))

    return apply_windows(df.select(*BASE, v.alias(col)), build, lookback=h, lookahead=h, plan=plan)


def current_stats(df: DataFrame, window: int = 30, col: str = "value", plan: str = "auto") -> DataFrame:
    """WIN-07: the last WIN-01 row of each series (a partial aggregate, no second sort)."""
    stats = rolling_stats(df, window, col=col, plan=plan)
    names = ["ts", "seq", "mean", "std", "min", "max", "median", "current", "window_size"]
    last = F.max_by(F.struct(*names), F.struct("ts", "seq")).alias("_s")
    return stats.groupBy(KEY).agg(last).select(KEY, *[F.col(f"_s.{c}").alias(c) for c in names])
