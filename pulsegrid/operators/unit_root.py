"""STA-01/02: augmented Dickey-Fuller tests of all series from lag products.

The regression of dy_t on [1, y_(t-1), dy_(t-1) .. dy_(t-p)] needs only the lag products of dy up to the largest
lag, the sums of y and y^2, and the first and last values: products shifted by one row differ by an edge
term at each end, and the products with y_(t-1) telescope. So a series of L lags sends 3 L + 8 numbers, not an L x L
matrix, and each series carries its own L. One Cholesky factor gives the residual sums of all orders for the AIC.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER
from pulsegrid.functions.numeric import normal_cdf
from pulsegrid.operators.gram import REGULAR, ols
from pulsegrid.operators.runs import lag_products, placed, series_scale, stream, summed
from pulsegrid.plans.blocked import choose_plan

# MacKinnon (1991) response surface, constant only, 5 % level
ADF_5PCT = (-2.8621, -2.738, -8.36)
# MacKinnon (1994) approximate p-values, constant only: the polynomials in the statistic below and above
# the switch, the switch, and the statistics beyond which p is 0 and 1
P_LOW = (2.1659, 1.4412, 0.038269)
P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)
P_SWITCH, P_ZERO, P_ONE = -1.61, -18.83, 2.74


def p_value(t: Column) -> Column:
    """Approximate p-value of a Dickey-Fuller statistic with constant."""
    poly = lambda c: sum((F.lit(a) * F.pow(t, F.lit(i)) for i, a in enumerate(c)), F.lit(0.0))
    p = normal_cdf(F.when(t <= P_SWITCH, poly(P_LOW)).otherwise(poly(P_HIGH)))
    return F.when(t > P_ONE, 1.0).when(t < P_ZERO, 0.0).otherwise(p)


def largest_lag(n: int, lags: int | None) -> int:
    """``lags``, or ceil(12 (n / 100)^(1/4)) for the AIC search; at most n / 2 - 2."""
    most = max(0, n // 2 - 2)
    return min(most, math.ceil(12.0 * (n / 100.0) ** 0.25) if lags is None else lags)


def _width(L: int) -> int:
    return 3 * L + 7


def _variant_sums(v: np.ndarray, first: int, own: int, n: int, d: int, centre: float, lags: int | None) -> np.ndarray:
    """Of y = the d-th differences: lag products of dy, sums of y and y^2, the first and last L + 2 values of y.

    ``v`` starts at place ``first`` of the series, and the run owns places from ``own`` on; so does y, by its later rows."""
    n -= d
    L = largest_lag(n, lags)
    y = np.diff(v, d) - centre
    own = max(own - d, 0)
    mine = y[max(0, own - first) :]
    products = lag_products(np.diff(y), max(0, own - first - 1), L)
    return np.concatenate([products, [mine.sum(), mine @ mine], placed(y, first, own, 0, L + 2), placed(y, first, own, n - L - 2, L + 2)])


def regression(sums: np.ndarray, n: int, L: int, p: int, s: int):
    """Normal equations of order ``p`` over rows t = s .. n-1: (X'X, X'y, y'y, rows)."""
    C, (S1, S2), head, tail = sums[: L + 1], sums[L + 1 : L + 3], sums[L + 3 : 2 * L + 5], sums[2 * L + 5 :]
    dh, dt = np.diff(head), np.diff(tail)  # dh[i]: place i + 1; dt[-1 - i]: place n - 1 - i
    D = np.zeros((p + 1, p + 1))
    for k in range(p + 1):
        D[0, k] = C[k] - dh[k : s - 1] @ dh[: max(0, s - 1 - k)]
    if p:
        a, b = dh[s - 2 :: -1][:p], dt[::-1][:p]  # dy at s-1-i and at n-1-i
        gain = np.outer(a, a) - np.outer(b, b)
        for i in range(p):
            D[i + 1, i + 1 :] = D[i, i:-1] + gain[i, i:]
    rows = n - s
    ends = np.array([tail[L + 1 - j] for j in range(p + 1)])  # y at n-1-j
    starts = np.array([head[s - 1 - j] for j in range(p + 1)])  # y at s-1-j
    before = head[: s - 1]
    X = np.zeros((p + 2, p + 2))
    X[0, 0], X[0, 1], X[1, 1] = rows, S1 - before.sum() - ends[0], S2 - before @ before - ends[0] ** 2
    X[2:, 2:] = D[1:, 1:]
    X[0, 2:] = (ends - starts)[1:]
    squares = (ends**2 - starts**2 + np.diag(D)) / 2
    for j in range(1, p + 1):
        X[1, 1 + j] = squares[j] + D[1:j, j].sum()
    X = np.triu(X) + np.triu(X, 1).T
    xty = np.concatenate([[ends[0] - starts[0], (ends[0] ** 2 - starts[0] ** 2 - D[0, 0]) / 2], D[0, 1:]])
    return X, xty, D[0, 0], rows


def _nested(X: np.ndarray, xty: np.ndarray, yty: float) -> list[float]:
    """Residual sums of the regressions on the first 1, 2, .. columns, as far as they are regular."""
    d = np.sqrt(np.maximum(np.diag(X), 0))
    out, k = [], len(d)
    if not np.isfinite(X).all():
        return out
    low, z, left = np.zeros((k, k)), np.zeros(k), yty
    for j in range(k):
        if d[j] == 0:
            break
        row = X[j, : j + 1] / d[j] / np.where(d[: j + 1] > 0, d[: j + 1], 1)
        for i in range(j):
            low[j, i] = (row[i] - low[j, :i] @ low[i, :i]) / low[i, i]
        pivot = row[j] - low[j, :j] @ low[j, :j]
        if pivot <= REGULAR:
            break
        low[j, j] = math.sqrt(pivot)
        z[j] = (xty[j] / d[j] - low[j, :j] @ z[:j]) / low[j, j]
        left -= z[j] ** 2
        out.append(left)
    return out


def dickey_fuller(sums: np.ndarray, n: int, lags: int | None) -> tuple[int, float] | None:
    """(lag, statistic): the lag of least AIC on the common sample, refitted on its own longest sample."""
    L = largest_lag(n, lags)
    if n < 3:
        return None
    X, xty, yty, rows = regression(sums, n, L, L, L + 1)
    best = None
    for p, sse in enumerate(_nested(X, xty, yty)[1:]):
        if (lags is None or p == L) and rows > p + 2 and sse > 1e-12 * yty:
            aic = rows * math.log(sse / rows) + 2 * (p + 2)
            if best is None or aic < best[0]:
                best = aic, p
    if best is None:
        return None
    p = best[1]
    X, xty, yty, rows = regression(sums, n, L, p, p + 1)
    fit = ols(X, xty, yty) if rows > p + 2 else None
    if fit is None or fit[1] <= 1e-12 * yty:
        return None
    beta, sse, inverse = fit
    return p, float(beta[1] / math.sqrt(sse / (rows - p - 2) * inverse[1, 1]))


TESTED = f"{KEY} string, tests array<struct<d int, n long, lags int, t_stat double>>"


def _tests(clean: DataFrame, max_d: int, lags: int | None, plan: str, scale: DataFrame | None = None) -> DataFrame:
    """(series_id, tests): the test of the series differenced 0..max_d times. ``scale``: its ``series_scale``, if known."""
    scale = series_scale(clean) if scale is None else scale
    reach = F.ceil(12.0 * F.pow(F.col("_n") / 100.0, 0.25)).cast("int") if lags is None else F.lit(lags)
    heads = scale.select(KEY, "_n", (reach + max_d + 2).alias("_reach"), F.array(F.col("_n").cast("double"), "_mean", "_std", "_first", "_last").alias("_head"))

    def sums(head, first, before, x):
        n, mean, std = int(head[0]), head[1], head[2]
        v = (x - mean) / std
        drift = (head[4] - head[3]) / std / max(1, n - 1)
        known = [[float(n)] if first + before == 0 else [0.0]]
        return np.concatenate(known + [_variant_sums(v, first, first + before, n, d, drift if d == 1 else 0.0, lags) for d in range(max_d + 1) if n - d > 2])

    found = summed(stream(clean, heads, plan), sums, plan)

    def solve(batches):
        for pdf in batches:
            rows = []
            for key, v in zip(pdf[KEY], pdf["v"]):
                n, at, tests = int(v[0]), 1, []
                for d in range(max_d + 1):
                    got = None
                    if n - d > 2:
                        width = _width(largest_lag(n - d, lags))
                        got = dickey_fuller(np.asarray(v[at : at + width]), n - d, lags)
                        at += width
                    lag, t = got or (None, None)
                    tests.append({"d": d, "n": max(0, n - d), "lags": lag, "t_stat": t})
                rows.append((key, tests))
            yield pd.DataFrame(rows, columns=[KEY, "tests"])

    return found.mapInPandas(solve, TESTED)


def _clean(df: DataFrame, col: str) -> DataFrame:
    return df.select(KEY, *ORDER, F.col(col).alias("value")).filter(F.col("value").isNotNull())


def adf_test(df: DataFrame, col: str = "value", plan: str = "auto", lags: int | None = None) -> DataFrame:
    """STA-01 per series: (series_id, n, lags, t_stat, crit_5pct, p_value, stationary).

    The lag is chosen by AIC on the common sample up to ``largest_lag``, or fixed by ``lags``; the statistic comes from a refit on
    that lag's own longest sample; stationary if its p-value is below 0.05. A series whose regression is singular or leaves no
    residual has NULL statistics."""
    clean = _clean(df, col)
    t = _tests(clean, 0, lags, choose_plan(clean, plan)).select(KEY, F.col("tests")[0].alias("t")).select(KEY, "t.n", "t.lags", "t.t_stat")
    n = F.col("n").cast("double")
    crit = F.lit(ADF_5PCT[0]) + F.lit(ADF_5PCT[1]) / n + F.lit(ADF_5PCT[2]) / (n * n)
    return t.select(KEY, "n", "lags", "t_stat", crit.alias("crit_5pct"), p_value(F.col("t_stat")).alias("p_value")).withColumn("stationary", F.col("p_value") < 0.05)


def auto_difference(df: DataFrame, max_d: int = 2, col: str = "value", plan: str = "auto", lags: int | None = None, scale: DataFrame | None = None) -> DataFrame:
    """STA-02: smallest d in 0..max_d whose test says stationary, else max_d: (series_id, d, t_stats).

    All orders are tested on one pass over the rows."""
    clean = _clean(df, col)
    t = _tests(clean, max_d, lags, choose_plan(clean, plan), scale)
    good = F.filter("tests", lambda x: F.coalesce(p_value(x["t_stat"]) < 0.05, F.lit(False)))
    pick = F.when(F.size(good) > 0, F.element_at(good, 1)["d"]).otherwise(max_d)
    stats = F.map_from_entries(F.transform("tests", lambda x: F.struct(x["d"].cast("string"), x["t_stat"])))
    return t.select(KEY, pick.cast("int").alias("d"), stats.alias("t_stats"))
