"""DEC-01/02: classical seasonal decomposition per series.

trend = centred moving average (WIN-06); seasonal = mean of the detrended values
per phase ``ord % period`` normalised over the phases (mean 0, or mean 1 for the
multiplicative model, which needs positive values: a series with others gets
NULL components); resid = what is left. NULLs are dropped first and
positions are counted on the remaining rows. A series with fewer than two full
periods gets NULL components instead of failing the whole job.

``period=None`` implies the period from the sampling frequency (hourly 24, daily
7, monthly 12): the most common gap between consecutive rows over all series is
one small aggregate; the window length must be known when the plan is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER
from pulsegrid.functions.numeric import safe_div
from pulsegrid.operators.rolling import centered_ma
from pulsegrid.operators.stats import attach
from pulsegrid.plans.blocked import split_hot, with_ordinal

# fixed values: implied seasonal period per sampling frequency
FREQ_PERIOD = {"hour": 24, "day": 7, "month": 12}

_HOUR_US = 3_600_000_000
_DAY_US = 24 * _HOUR_US


def infer_period(df: DataFrame) -> int:
    """Seasonal period implied by the most common gap between consecutive rows."""
    from pulsegrid.operators.forecast import _clean
    from pulsegrid.sources.steps import time_steps

    gaps = time_steps(_clean(df)).filter(F.col("gap_us").isNotNull())
    top = gaps.groupBy("gap_us").agg(F.count(F.lit(1)).alias("c")).orderBy(F.col("c").desc(), "gap_us").first()
    if top is None:
        raise ValueError("cannot infer a period: no series has two rows")
    gap = int(top["gap_us"])
    if gap == _HOUR_US:
        return FREQ_PERIOD["hour"]
    if gap == _DAY_US:
        return FREQ_PERIOD["day"]
    if 28 * _DAY_US <= gap <= 31 * _DAY_US:
        return FREQ_PERIOD["month"]
    raise ValueError(f"cannot infer a period from a sampling gap of {gap} us; pass period=")


def decompose(
    df: DataFrame, period: int | None = 24, model: str = "additive", col: str = "value", plan: str = "auto"
) -> DataFrame:
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"unknown model: {model}")
    if period is None:
        period = infer_period(df.select(KEY, *ORDER, F.col(col).alias("value")))
    clean = df.select(KEY, *ORDER, F.col(col).alias("value")).filter(F.col("value").isNotNull())
    return reduce(DataFrame.unionByName, (_decompose(part, period, model, how) for part, how in split_hot(clean, plan)))


def _decompose(clean: DataFrame, period: int, model: str, plan: str) -> DataFrame:
    t = centered_ma(clean, period, plan=plan)
    t = with_ordinal(t, "ord", plan)
    n = clean.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_min"))
    t = attach(t, n)
    mult = model == "multiplicative"
    detr = safe_div(F.col("value"), F.col("trend")) if mult else F.col("value") - F.col("trend")
    t = t.withColumn("_phase", (F.col("ord") % period).cast("int")).withColumn("_dt", detr)
    phase = t.groupBy(KEY, "_phase").agg(F.avg("_dt").alias("_pa"))
    norm = phase.groupBy(KEY).agg(F.avg("_pa").alias("_pm"))
    phase = attach(phase, norm)
    seas = safe_div(F.col("_pa"), F.col("_pm")) if mult else F.col("_pa") - F.col("_pm")
    phase = phase.select(KEY, "_phase", seas.alias("seasonal"))
    x = t.join(phase, [KEY, "_phase"], "left")
    ok = F.col("_n") >= 2 * period
    if mult:
        ok = ok & (F.col("_min") > 0)
        resid = safe_div(safe_div(F.col("value"), F.col("trend")), F.col("seasonal"))
    else:
        resid = F.col("value") - F.col("trend") - F.col("seasonal")
    return x.select(
        KEY,
        *ORDER,
        "value",
        F.when(ok, F.col("trend")).alias("trend"),
        F.when(ok, F.col("seasonal")).alias("seasonal"),
        F.when(ok, resid).alias("resid"),
    )
