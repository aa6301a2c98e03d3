"""STA-01/02, FC-01..04, FC-05/06: stationarity tests and forecasts for every
series of a panel in one Spark job.

Estimators (the reference's third-party optimisers are not available, so the
numbers are not expected to equal theirs; correctness is parameter recovery):

* ADF with constant: ``unit_root``.
* ARIMA(p,d,q)(P,D,Q,s) by Hannan-Rissanen: long AR by Levinson-Durbin on lag products, its
  residuals as regressors, then OLS of w_t on lags of w and of the residuals (seasonal lags in
  additive form). No constant when d + D > 0 (after the auto differencing, as the
  reference fits on the already differenced series).
* Trend + seasonality regression: intercept, slope, 25 hinge changepoints evenly
  spaced in time over the first 80 % of the history, and Fourier pairs (yearly
  10, weekly 3, daily 4), ridge-regularised; changes of slope with a Laplace prior
  on request (coordinate descent on the same sums).
* Multiplicative seasonal models by conditional sum of squares: ``seasonal``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.frame import KEY, ORDER, series_window
from pulsegrid.operators.gram import add_packed, laplace_fit, ols, packed, rank, unpack
from pulsegrid.operators.runs import lag_products, placed, series_scale, stream, summed
from pulsegrid.operators.stats import attach
from pulsegrid.operators.unit_root import adf_test, auto_difference  # noqa: F401  (part of this module's interface)
from pulsegrid.plans.blocked import apply_windows, choose_plan, epoch_micros
from pulsegrid.plans.lineage import materialize
from pulsegrid.sources.steps import next_stamps, time_steps


def _clean(df: DataFrame, col: str = "value") -> DataFrame:
    return df.select(KEY, *ORDER, F.col(col).alias("value")).filter(F.col("value").isNotNull())


def diff_once(df: DataFrame, k: int = 1, plan: str = "auto") -> DataFrame:
    """``value - lag(value, k)``; rows without a predecessor are dropped."""

    def build(d, part):
        w = series_window(*part)
        keep = [c for c in d.columns if c.startswith("_")]
        other = [c for c in d.columns if c not in (KEY, *ORDER, "value") and not c.startswith("_")]
        return d.select(KEY, *ORDER, *keep, *other, (F.col("value") - F.lag("value", k).over(w)).alias("value"))

    return apply_windows(df, build, lookback=k, plan=plan).filter(F.col("value").isNotNull())


def tail_values(df: DataFrame, k: int, col: str | dict[str, str], name: str | None = None) -> DataFrame:
    """Last ``k`` values per series as arrays in time order (bounded; the row_number
    filter with a literal k becomes a partial WindowGroupLimit before the shuffle).
    ``col`` may map several source columns to output names, collected in one pass."""
    cols = {col: name} if isinstance(col, str) else dict(col)
    w = Window.partitionBy(KEY).orderBy(*[F.col(c).desc() for c in ORDER])
    t = df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
    fields = [F.col("_rk").alias("r")] + [F.col(c).alias(f"v{i}") for i, c in enumerate(cols)]
    arr = F.array_sort(F.collect_list(F.struct(*fields)), lambda a, b: F.when(a.r > b.r, -1).when(a.r < b.r, 1).otherwise(0))
    t = t.groupBy(KEY).agg(arr.alias("_arr"))
    # a field of an array of structs is the array of that field
    return t.select(KEY, *[F.col("_arr").getField(f"v{i}").alias(out) for i, out in enumerate(cols.values())])


MODEL_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("order", T.ArrayType(T.IntegerType())),
        T.StructField("seasonal_order", T.ArrayType(T.IntegerType())),
        T.StructField("aic", T.DoubleType()),
        T.StructField("bic", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("created", T.TimestampNTZType()),
        T.StructField("state", T.StringType()),
    ]
)


def arima_fit(
    df: DataFrame,
    order: tuple[int, int, int] = (1, 1, 1),
    seasonal_order: tuple[int, int, int, int] = (0, 0, 0, 0),
    auto_stationary: bool = True,
    long_ar: int | None = None,
    col: str = "value",
    plan: str = "auto",
) -> DataFrame:
    """FC-01/02/04: one model row per series (``MODEL_SCHEMA``); ``state`` (JSON)
    holds what the forecast needs: coefficients, the tails of the series and of
    the innovations, the differencing plan and the modal time step.

    Estimation runs on the centred, scaled series and is carried back to its units. The
    long autoregression has ``max(4, ceil(2 n^(1/3)))`` lags for n rows unless given."""
    raw = _clean(df, col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _arima_fit(df, raw, order, _seasonal(seasonal_order), auto_stationary, long_ar, choose_plan(raw, plan))
    finally:
        raw.unpersist()


def _seasonal(seasonal_order: tuple[int, int, int, int]) -> tuple[int, int, int, int]:
    P, D, Q, s = seasonal_order
    return (P, D, Q, s) if s > 1 else (0, 0, 0, 1)


def _differenced(v: np.ndarray, d: int, D: int, s: int) -> np.ndarray:
    v = np.diff(v, d)
    for _ in range(D):
        v = v[s:] - v[:-s] if len(v) > s else v[:0]
    return v


def long_order(n: int, least: int, given: int | None = None) -> int:
    """Lags of the long autoregression of a series of ``n`` values; 0 if it is too short for them."""
    m = max(max(4, math.ceil(2.0 * round(max(n, 0) ** (1 / 3), 9))) if given is None else given, least)
    return m if n > 2 * m + 1 else 0


def levinson(gamma: np.ndarray) -> tuple[np.ndarray, float]:
    """Levinson-Durbin recursion: autocovariances 0..m -> (coefficients 1..m, innovation variance)."""
    phi, var = np.zeros(len(gamma) - 1), float(gamma[0])
    for k in range(len(phi)):
        if var <= 1e-14 * gamma[0] or gamma[0] <= 0:
            break
        r = (gamma[k + 1] - phi[:k] @ gamma[k:0:-1]) / var
        phi[:k] = phi[:k] - r * phi[:k][::-1]
        phi[k] = r
        var *= 1 - r * r
    return phi, var


def autocovariances(sums: np.ndarray, n: int, m: int) -> tuple[np.ndarray, float]:
    """(autocovariances 0..m, mean) from lag products, the sum and the first and last m values.

    Products of the centred series are the products less the mean times the sums without the values at either end."""
    C, total, head, tail = sums[: m + 1], sums[m + 1], sums[m + 2 : 2 * m + 2], sums[2 * m + 2 :]
    mean = total / n
    late = total - np.concatenate(([0.0], np.cumsum(head)))
    early = total - np.concatenate(([0.0], np.cumsum(tail[::-1])))
    return (C - mean * (late + early) + (n - np.arange(m + 1)) * mean**2) / n, mean


def _autoregressions(raw: DataFrame, known: DataFrame, d: int, D: int, s: int, least: int, given: int | None, plan: str) -> DataFrame:
    """(series_id, mean, coefficients, variance) of the long Yule-Walker autoregression of the differenced, scaled series.

    ``known``: ``series_scale`` and the order ``d0`` each series is differenced by first."""
    reach = F.col("d0") + (d + D * s + 1) + (F.greatest(F.lit(4), F.ceil(2.0 * F.cbrt(F.col("_n").cast("double"))).cast("int"), F.lit(least)) if given is None else F.lit(max(given, least)))
    heads = known.select(KEY, "_n", reach.alias("_reach"), F.array(F.col("_n").cast("double"), "_mean", "_std", F.col("d0").cast("double")).alias("_head"))

    def sums(head, first, before, x):
        d0 = int(head[3])
        w = _differenced((x - head[1]) / head[2], d0 + d, D, s)
        lost = d0 + d + D * s
        n, own = int(head[0]) - lost, max(first + before - lost, 0)
        m = long_order(n, least, given)
        mine = w[max(0, own - first) :]
        shape = [float(n), float(m)] if first + before == 0 else [0.0, 0.0]
        return np.concatenate([shape, lag_products(w, max(0, own - first), m), [mine.sum()], placed(w, first, own, 0, m), placed(w, first, own, n - m, m)])

    def solve(batches):
        for pdf in batches:
            rows = []
            for key, v in zip(pdf[KEY], pdf["v"]):
                n, m = int(v[0]), int(v[1])
                if m:
                    gamma, mean = autocovariances(np.asarray(v[2:]), n, m)
                    phi, var = levinson(gamma)
                    rows.append((key, n, mean, phi, var))
                else:
                    rows.append((key, n, None, None, None))
            yield pd.DataFrame(rows, columns=[KEY, "n", "w_mean", "phi", "variance"])

    return summed(stream(raw, heads, plan), sums, plan).mapInPandas(solve, f"{KEY} string, n long, w_mean double, phi array<double>, variance double")


def long_ar(df: DataFrame, order: int, col: str = "value", plan: str = "auto") -> DataFrame:
    """Yule-Walker autoregression of a fixed order: (series_id, n, phi, sigma2); NULL for a series too short for it."""
    raw = _clean(df, col)
    scale = materialize(series_scale(raw), "scale")
    found = _autoregressions(raw, scale.withColumn("d0", F.lit(0)), 0, 0, 1, order, order, choose_plan(raw, plan))
    return found.join(scale.select(KEY, "_std"), KEY).select(KEY, "n", "phi", (F.col("variance") * F.col("_std") * F.col("_std")).alias("sigma2"))


def _arima_fit(df, raw, order, seasonal, auto_stationary, given, plan) -> DataFrame:
    (p, d, q), (P, D, Q, s) = order, seasonal
    known = materialize(series_scale(raw), "arima_scale")
    if auto_stationary:
        d0 = auto_difference(raw, 2, plan=plan, scale=known).select(KEY, F.col("d").alias("d0"))
        known = materialize(known.join(d0, KEY), "arima_scale")
    else:
        known = known.withColumn("d0", F.lit(0))
    ar_lags = list(range(1, p + 1)) + [s * i for i in range(1, P + 1)]
    ma_lags = list(range(1, q + 1)) + [s * i for i in range(1, Q + 1)]
    has_const = (d + D) == 0 or not (ar_lags or ma_lags)
    far, far_ma, lost = max([*ar_lags, *ma_lags, 1]), max([*ma_lags, 0]), d + D * s
    numbers = [F.col("_n").cast("double"), "_mean", "_std", F.col("d0").cast("double")]
    if ma_lags:
        # innovations come from a long autoregression; every series brings its own lags
        ar = materialize(_autoregressions(raw, known, d, D, s, far_ma + 1, given, plan).select(KEY, "w_mean", "phi"), "arima_long_ar")
        known = known.join(ar, KEY)
        head = F.concat(F.array(*numbers, F.coalesce("w_mean", F.lit(0.0))), F.coalesce("phi", F.array().cast("array<double>")))
        longest = F.coalesce(F.size("phi"), F.lit(0))
    else:
        head, longest = F.array(*numbers), F.lit(0)
    kept = lost + 6  # last values of the series that a forecast is integrated from
    reach = F.col("d0") + longest + (lost + far + kept + 1)
    heads = known.select(KEY, "_n", reach.cast("int").alias("_reach"), head.alias("_head"))
    k = int(has_const) + len(ar_lags) + len(ma_lags)
    size = k * (k + 1) // 2 + k + 2

    def sums(head, first, before, x):
        n, mean, std, d0 = int(head[0]), head[1], head[2], int(head[3])
        own, phi = first + before, head[5:]
        out = np.zeros(4 + size + kept + 2 * far)
        if own == 0:
            out[:4] = head[:4]
        w = _differenced((x - mean) / std, d0 + d, D, s)
        if ma_lags and not len(phi):
            w = w[:0]  # too short for innovations
        behind = d0 + lost  # the place of w[0] is first + behind
        e = np.full(len(w), np.nan)
        if ma_lags and len(w) > len(phi):
            e[len(phi) :] = np.convolve(w - head[4], np.concatenate(([1.0], -phi)), "valid")
        start = max([*ar_lags, far_ma + len(phi) if ma_lags else 0, own - first - behind, 0])
        rows = np.arange(start, len(w))
        if len(rows):
            X = np.column_stack([*([np.ones(len(rows))] if has_const else []), *(w[rows - i] for i in ar_lags), *(e[rows - i] for i in ma_lags)])
            out[4 : 4 + size] = packed(X, w[rows])
        if first + len(x) == n:  # the end of the series is here, with all the rows before it that are asked for
            at = 4 + size
            for values, length in ((x, kept), (w, far), (e, far)):
                tail = np.nan_to_num(values[-length:])
                out[at + length - len(tail) : at + length] = tail
                at += length
        return out

    found = summed(stream(raw, heads, plan), sums, plan)
    names = (["const"] if has_const else []) + [f"ar.L{i}" for i in ar_lags] + [f"ma.L{i}" for i in ma_lags]
    # every input series keeps a row: one without usable rows gets status 'failed' (SEM-15)
    every = df.select(F.col(KEY).cast("string").alias(KEY)).distinct()
    info = every.join(found, KEY, "left").join(time_steps(raw, plan), KEY, "left")
    created = datetime.now(timezone.utc).replace(tzinfo=None)

    def model(r) -> dict:
        v = np.asarray(_arr(r["v"]), float)
        row = {KEY: r[KEY], "model": "arima", "version": None, "params": {}, "order": [p, d, q], "seasonal_order": [P, D, Q, s if (P or D or Q) else 0], "aic": None, "bic": None, "n": 0, "status": "failed", "created": created, "state": None}
        if not len(v):
            return row
        total, level, std, d0 = int(v[0]), v[1], v[2], int(v[3])
        g, tails = v[4 : 4 + size], v[4 + size :]
        n = row["n"] = int(g[-1])
        fit = ols(unpack(g, k), g[k * (k + 1) // 2 : -2], g[-2]) if n > k else None
        if fit is None:
            return row
        beta, sse, _ = fit
        # differencing takes the level out; back in the units of the series
        level = level if d0 + d + D == 0 else 0.0
        sigma2 = std * std * sse / n
        memory = sum(b for name, b in zip(names, beta) if name.startswith("ar"))
        params = {name: float(std * b + level * (1 - memory) if name == "const" else b) for name, b in zip(names, beta)}
        ll = -0.5 * n * (math.log(2 * math.pi * max(sigma2, 1e-300)) + 1)
        w = min(far, total - d0 - lost)
        state = {
            "d0": d0,
            "ops": [("r", 1)] * d + [("s", s)] * D,
            "tail_y": tails[kept - min(kept, total) : kept].tolist(),
            "tail_w": (tails[kept + far - w : kept + far] * std + level).tolist(),
            "tail_e": (tails[kept + 2 * far - w :] * std).tolist() if ma_lags else [],
            "last_ts": r["last_ts"].isoformat() if r["last_ts"] is not None else None,
            **_step(r),
        }
        return row | {"params": params | {"sigma2": float(sigma2)}, "aic": -2 * ll + 2 * (k + 1), "bic": -2 * ll + math.log(n) * (k + 1), "status": "ok", "state": json.dumps(state)}

    def solve(batches):
        for pdf in batches:
            yield pd.DataFrame([model(r) for r in pdf.to_dict("records")], columns=MODEL_SCHEMA.fieldNames())

    return materialize(info.mapInPandas(solve, MODEL_SCHEMA), "arima")


def _step(r: dict) -> dict:
    """The step of a row of ``time_steps`` as plain values."""
    number = lambda v: None if v is None or pd.isna(v) else int(v)
    return {"gap_us": number(r["gap_us"]), "gap_months": number(r["gap_months"]), "month_end": bool(r["month_end"] is not None and not pd.isna(r["month_end"]) and r["month_end"])}


def _arr(x) -> list:
    if x is None:
        return []
    if isinstance(x, float) and math.isnan(x):
        return []
    return list(x)


FORECAST_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("forecast", T.DoubleType()),
        T.StructField("forecast_diff", T.DoubleType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)


def _undo(level_tail: np.ndarray, op: tuple[str, int], f: np.ndarray) -> np.ndarray:
    """Integrate forecasts ``f`` of the differenced level back one operator."""
    k = op[1]
    hist = list(level_tail)
    out = []
    for v in f:
        nxt = hist[-k] + v
        hist.append(nxt)
        out.append(nxt)
    return np.asarray(out)


def _levels(tail_y: np.ndarray, ops: list) -> list[np.ndarray]:
    lv = [tail_y]
    for _, k in ops:
        prev = lv[-1]
        lv.append(prev[k:] - prev[:-k] if len(prev) > k else np.asarray([]))
    return lv


def arima_forecast(models: DataFrame, steps: int) -> DataFrame:
    """FC-03: recursion on the model rows (one per series), integrated back to the
    original units (``forecast``) and to the reference's scale (``forecast_diff``).
    Unfitted or failed models produce rows with ``status`` and NULL values."""

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.to_dict("records"):
                sid = r[KEY]
                if r["status"] != "ok" or not r["state"]:
                    for h in range(1, steps + 1):
                        out.append({KEY: sid, "model": r["model"], "step": h, "ts": None, "forecast": None, "forecast_diff": None, "lo": None, "hi": None, "status": r["status"] or "not_fitted"})
                    continue
                st = json.loads(r["state"])
                prm = r["params"]
                c = prm.get("const", 0.0)
                ar = {int(k[4:]): v for k, v in prm.items() if k.startswith("ar.L")}
                ma = {int(k[4:]): v for k, v in prm.items() if k.startswith("ma.L")}
                wh = [0.0 if v is None else v for v in st["tail_w"]]
                eh = [0.0 if v is None else v for v in st["tail_e"]]
                fw = []
                for h in range(steps):
                    val = c
                    for lag, phi in ar.items():
                        val += phi * (wh[-lag] if lag <= len(wh) else 0.0)
                    for lag, th in ma.items():
                        val += th * (eh[-lag] if lag <= len(eh) else 0.0)
                    wh.append(val)
                    eh.append(0.0)
                    fw.append(val)
                fw = np.asarray(fw)
                d0 = st["d0"]
                ops = [tuple(o) for o in ([("r", 1)] * d0 + [tuple(o) for o in st["ops"]])]
                tail_y = np.asarray(st["tail_y"], float)
                lv = _levels(tail_y, ops)
                cur = fw
                fdiff = None
                for i in range(len(ops) - 1, -1, -1):
                    cur = _undo(lv[i], ops[i], cur)
                    if i == d0:
                        fdiff = cur
                if fdiff is None:
                    fdiff = cur if d0 == 0 else fw
                # psi weights of the integrated process for the intervals
                poly = np.zeros(max(ar.keys(), default=0) + 1)
                poly[0] = 1.0
                for lag, phi in ar.items():
                    poly[lag] -= phi
                for _, k in ops:
                    dpoly = np.zeros(k + 1)
                    dpoly[0], dpoly[k] = 1.0, -1.0
                    poly = np.convolve(poly, dpoly)
                psi = np.zeros(steps)
                psi[0] = 1.0
                for j in range(1, steps):
                    v = ma.get(j, 0.0)
                    for i in range(1, min(j, len(poly) - 1) + 1):
                        v += -poly[i] * psi[j - i]
                    psi[j] = v
                sig2 = prm.get("sigma2", 0.0)
                var = sig2 * np.cumsum(psi**2)
                last_ts = pd.Timestamp(st["last_ts"]) if st["last_ts"] else None
                stamps = None if last_ts is None else next_stamps(last_ts, st["gap_us"], st.get("gap_months"), st.get("month_end", False), steps)
                for h in range(steps):
                    ts = stamps and stamps[h]
                    half = 1.959963984540054 * math.sqrt(max(var[h], 0.0))
                    out.append({KEY: sid, "model": r["model"], "step": h + 1, "ts": ts, "forecast": float(cur[h]), "forecast_diff": float(fdiff[h]), "lo": float(cur[h] - half), "hi": float(cur[h] + half), "status": "ok"})
            yield pd.DataFrame(out, columns=FORECAST_SCHEMA.fieldNames())

    return models.mapInPandas(run, FORECAST_SCHEMA)


# ---------------------------------------------------------------- trend + seasonality regression
SEASONALITIES = {"yearly": (365.25 * 86400e6, 10), "weekly": (7 * 86400e6, 3), "daily": (86400e6, 4)}


def _design(t_us: np.ndarray, t0: float, span: float, cps: int, comps: Sequence[str]) -> np.ndarray:
    ts = (t_us - t0) / span if span > 0 else np.zeros_like(t_us)
    cols = [np.ones_like(ts), ts]
    for j in range(1, cps + 1):
        cp = 0.8 * j / (cps + 1)
        cols.append(np.maximum(ts - cp, 0.0))
    for name in comps:
        period, order = SEASONALITIES[name]
        for k in range(1, order + 1):
            ang = 2 * math.pi * k * t_us / period
            cols += [np.sin(ang), np.cos(ang)]
    return np.column_stack(cols)


def trend_season_fit(
    df: DataFrame,
    yearly: bool = True,
    weekly: bool = True,
    daily: bool = True,
    changepoints: int = 25,
    ridge: float = 1.0,
    col: str = "value",
    laplace: float | None = None,
) -> DataFrame:
    """FC-05/07: partial ``X'X, X'y`` per Arrow batch and series in ``mapInPandas``,
    one packed array each, added per series, then a ridge solve on the centred, scaled
    values per series, carried back to their units.

    ``laplace``: scale of a Laplace prior on the changes of slope (scaled values, time from 0 to 1) in place of
    their ridge penalty: most changes become exactly zero, ``trend_changepoints`` lists the others."""
    comps = [c for c, on in (("yearly", yearly), ("weekly", weekly), ("daily", daily)) if on]
    base = _clean(df, col)
    sd = F.stddev_pop("value")
    span = base.groupBy(KEY).agg(
        F.avg("value").alias("_mean"), F.when(sd > 0, sd).otherwise(1.0).alias("_std"), F.min(epoch_micros("ts")).cast("double").alias("_t0"), F.max(epoch_micros("ts")).cast("double").alias("_t1"), F.max("ts").alias("last_ts")
    )
    x = attach(base.select(KEY, epoch_micros("ts").cast("double").alias("_t"), "value"), span.select(KEY, "_t0", "_t1", "_mean", "_std"))
    k = 2 + changepoints + sum(2 * SEASONALITIES[c][1] for c in comps)
    schema = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("v", T.ArrayType(T.DoubleType()))])

    def partial(it):
        for pdf in it:
            rows = []
            for sid, g in pdf.groupby(KEY, sort=False):
                X = _design(g["_t"].to_numpy(), g["_t0"].iloc[0], g["_t1"].iloc[0] - g["_t0"].iloc[0], changepoints, comps)
                rows.append((sid, packed(X, (g["value"].to_numpy() - g["_mean"].iloc[0]) / g["_std"].iloc[0])))
            yield pd.DataFrame(rows, columns=[KEY, "v"])

    sums = add_packed(x.mapInPandas(partial, schema), [KEY])
    every = df.select(F.col(KEY).cast("string").alias(KEY)).distinct()
    info = every.join(sums, KEY, "left").join(span, KEY, "left")
    created = datetime.now(timezone.utc).replace(tzinfo=None)
    nu = k * (k + 1) // 2

    def solve(it):
        for pdf in it:
            out = []
            for r in pdf.to_dict("records"):
                vals = np.asarray(_arr(r["v"]), float)
                if not len(vals):
                    out.append({KEY: r[KEY], "model": "trend_season", "version": None, "params": {}, "order": None, "seasonal_order": None, "aic": None, "bic": None, "n": 0, "status": "failed", "created": created, "state": None})
                    continue
                xtx = unpack(vals[:nu], k)
                xty, yty, n = vals[nu : nu + k], vals[nu + k], int(vals[nu + k + 1])
                # no penalty on intercept and slope
                pen = np.full(k, ridge)
                pen[:2] = 1e-9
                # no more rows than independent columns: nothing is left to estimate the noise from
                if n <= rank(xtx):
                    res = None
                elif laplace is None or not changepoints:
                    res = ols(xtx + np.diag(pen), xty, yty)
                    res = res and (res[0], max(res[1] - float(pen @ res[0] ** 2), 0.0))
                else:
                    pen[2 : 2 + changepoints] = 0.0
                    res = laplace_fit(xtx, xty, yty, n, pen, slice(2, 2 + changepoints), laplace)
                params, status, aic, bic, state = {}, "failed", None, None, None
                if res is not None:
                    beta, sse = res
                    std = float(r["_std"])
                    beta = beta * std
                    beta[0] += float(r["_mean"])
                    sigma2 = std * std * sse / n
                    params = {f"b{i}": float(b) for i, b in enumerate(beta)}
                    params["sigma2"] = sigma2
                    ll = -0.5 * n * (math.log(2 * math.pi * max(sigma2, 1e-300)) + 1)
                    aic, bic, status = -2 * ll + 2 * (k + 1), -2 * ll + math.log(n) * (k + 1), "ok"
                    state = json.dumps({"t0": r["_t0"], "span": r["_t1"] - r["_t0"], "cps": changepoints, "comps": comps, "last_ts": r["last_ts"].isoformat()})
                out.append({KEY: r[KEY], "model": "trend_season", "version": None, "params": params, "order": None, "seasonal_order": None, "aic": aic, "bic": bic, "n": n, "status": status, "created": created, "state": state})
            yield pd.DataFrame(out, columns=MODEL_SCHEMA.fieldNames())

    return materialize(info.mapInPandas(solve, MODEL_SCHEMA), "trend_season")


def trend_changepoints(models: DataFrame) -> DataFrame:
    """The changes of slope of fitted ``trend_season`` models that are not zero: (series_id, ts, delta), delta in units of the
    series per day. A model without any has no row."""

    def run(batches):
        for pdf in batches:
            rows = []
            for key, params, state in zip(pdf[KEY], pdf["params"], pdf["state"]):
                st = json.loads(state)
                for j in range(1, st["cps"] + 1):
                    delta = params[f"b{1 + j}"]
                    if delta and st["span"] > 0:
                        at = pd.Timestamp("1970-01-01") + pd.Timedelta(microseconds=round(st["t0"] + st["span"] * 0.8 * j / (st["cps"] + 1)))
                        rows.append((key, at, delta / (st["span"] / 86400e6)))
            yield pd.DataFrame(rows, columns=[KEY, "ts", "delta"])

    fitted = models.where("model = 'trend_season' and status = 'ok'").select(KEY, F.map_filter("params", lambda k, _: k.startswith("b")).alias("params"), "state")
    return fitted.mapInPandas(run, f"{KEY} string, ts timestamp_ntz, delta double")


def trend_season_forecast(models: DataFrame, steps: int, every_us: int | None = None, history: DataFrame | None = None) -> DataFrame:
    """FC-06: future rows only; the step is the series' modal gap (SEM-10) unless
    ``every_us`` is given. ``history`` (the fitted frame) supplies the modal gap."""
    if history is not None and every_us is None:
        m = models.join(time_steps(_clean(history)).drop("last_ts"), KEY, "left")
    else:
        m = models.withColumns({"gap_us": F.lit(every_us).cast("long"), "gap_months": F.lit(None).cast("int"), "month_end": F.lit(False)})

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.to_dict("records"):
                step = _step(r)
                if r["status"] != "ok" or not (step["gap_us"] or step["gap_months"]):
                    for h in range(1, steps + 1):
                        out.append({KEY: r[KEY], "model": r["model"], "step": h, "ts": None, "forecast": None, "forecast_diff": None, "lo": None, "hi": None, "status": r["status"] if r["status"] != "ok" else "no_step"})
                    continue
                st = json.loads(r["state"])
                last = pd.Timestamp(st["last_ts"])
                stamps = next_stamps(last, **step, steps=steps)
                t = np.asarray([(x - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1) for x in stamps], float)
                X = _design(t, st["t0"], st["span"], st["cps"], st["comps"])
                beta = np.asarray([r["params"][f"b{i}"] for i in range(X.shape[1])])
                f = X @ beta
                half = 1.959963984540054 * math.sqrt(r["params"]["sigma2"])
                for h in range(steps):
                    out.append({KEY: r[KEY], "model": r["model"], "step": h + 1, "ts": stamps[h], "forecast": float(f[h]), "forecast_diff": float(f[h]), "lo": float(f[h] - half), "hi": float(f[h] + half), "status": "ok"})
            yield pd.DataFrame(out, columns=FORECAST_SCHEMA.fieldNames())

    return m.mapInPandas(run, FORECAST_SCHEMA)
