"""Time steps: fixed lengths (``1 hour``) and calendar steps (``1 month``, ``1 quarter``, ``1 year``, ``1 month end``).

A calendar grid counts months from its first point, so the day of the month never drifts (Jan 31, Feb 29, Mar 31); ``end``
grids lie on the last day of every month. ``time_steps`` infers the step of each series from its rows.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER, series_window
from pulsegrid.plans.blocked import apply_windows, epoch_micros

MICROS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}
MONTHS = {"month": 1, "quarter": 3, "year": 12}


class Step(NamedTuple):
    micros: int | None
    months: int | None = None
    end: bool = False


def step_of(every: str) -> Step:
    """``2 hours``, ``1 month``, ``1 quarter end`` .. as a step."""
    m = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?(\s+end)?\s*", every.lower())
    if not m or int(m[1]) < 1 or m[2] not in MICROS | MONTHS or (m[3] and m[2] not in MONTHS):
        raise ValueError(f"not a step: {every!r}")
    if m[2] in MICROS:
        return Step(int(m[1]) * MICROS[m[2]])
    return Step(None, int(m[1]) * MONTHS[m[2]], bool(m[3]))


def _month_no(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def _month_end(ts: Column) -> Column:
    """The same time on the last day of the month."""
    return F.last_day(ts).cast("timestamp_ntz") + (ts - F.date_trunc("day", ts).cast("timestamp_ntz"))


def grid_point(first: Column, k: Column, step: Step) -> Column:
    """The ``k``-th point (0-based) of the grid that begins at ``first``."""
    if step.micros is not None:
        seconds = ((k * F.lit(step.micros)).cast("decimal(24,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        zero = F.lit(0)
        return first + F.make_dt_interval(zero, zero, zero, seconds)
    moved = first + F.make_ym_interval(F.lit(0), (k * step.months).cast("int"))
    return _month_end(moved) if step.end else moved


def grid_index(first: Column, ts: Column, step: Step) -> Column:
    """Index of the last grid point at or before ``ts``; 0 before the first point."""
    if step.micros is not None:
        between = F.timestamp_diff("MICROSECOND", first, ts)
        return F.floor(between / F.lit(step.micros)).cast("long")
    k = F.floor((_month_no(ts) - _month_no(first)) / F.lit(step.months)).cast("long")
    return F.greatest(F.lit(0).cast("long"), k - (grid_point(first, k, step) > ts).cast("long"))


def time_steps(base: DataFrame, plan: str = "auto") -> DataFrame:
    """SEM-10 per series: (series_id, last_ts, gap_us, gap_months, month_end).

    ``gap_us`` is the most frequent gap between consecutive rows. ``gap_months`` is set where more
    gaps are whole calendar months (the same day and time, or month ends) than have any one fixed length: the most frequent number of months.
    ``month_end``: all of them lead from month end to month end."""

    def build(x, part):
        w = series_window(*part)
        keep = [c for c in x.columns if c.startswith("_")]
        return x.select(KEY, "ts", *keep, F.lag("ts").over(w).alias("_before"))

    g = apply_windows(base.select(KEY, *ORDER), build, lookback=1, plan=plan)
    ts, before = F.col("ts"), F.col("_before")
    months = _month_no(ts) - _month_no(before)
    ends = (F.last_day(ts) == F.to_date(ts)) & (F.last_day(before) == F.to_date(before))
    same_time = (epoch_micros("ts") - epoch_micros("_before")) % MICROS["day"] == 0
    whole = (months > 0) & same_time & (ends | (F.dayofmonth(ts) == F.dayofmonth(before)))
    g = g.select(KEY, "ts", (epoch_micros("ts") - epoch_micros("_before")).alias("_g"), F.when(whole, months).alias("_m"), F.when(whole, ends).alias("_e"))
    last = g.groupBy(KEY).agg(F.max("ts").alias("last_ts"), F.mode("_m", True).alias("_months"), F.count("_m").alias("_n"), F.bool_and("_e").alias("_ends"))
    counts = g.filter(F.col("_g") > 0).groupBy(KEY, "_g").agg(F.count(F.lit(1)).alias("_c"))
    mode = counts.groupBy(KEY).agg(F.max_by("_g", F.struct("_c", F.negative("_g"))).alias("gap_us"), F.max("_c").alias("_c"))
    calendar = F.col("_n") > F.col("_c")
    return last.join(mode, KEY, "left").select(
        KEY, "last_ts", "gap_us", F.when(calendar, F.col("_months")).cast("int").alias("gap_months"), F.coalesce(calendar & F.col("_ends"), F.lit(False)).alias("month_end")
    )


def next_stamps(last: pd.Timestamp, gap_us: int | None, gap_months: int | None, month_end: bool, steps: int) -> list[pd.Timestamp] | None:
    """The ``steps`` stamps after ``last``; None without a step."""
    if gap_months:
        moved = [last + pd.DateOffset(months=gap_months * h) for h in range(1, steps + 1)]
        return [t + pd.offsets.MonthEnd(0) for t in moved] if month_end else moved
    if gap_us is None:
        return None
    return [last + pd.Timedelta(microseconds=gap_us * h) for h in range(1, steps + 1)]
