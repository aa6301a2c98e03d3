"""Sum-product (Gram) aggregates and small per-series solves.

Everything that grows with rows is a Spark aggregate (map-side combined, so a
huge series is summed by many tasks). Only the k x k systems (k small) are
solved, one Gram row at a time, in ``mapInPandas`` over the per-series table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY


WIDE = 12


def gram(df: DataFrame, xcols: Sequence[str], ycol: str, by: Sequence[str] = (KEY,), extra: Sequence[Column] = ()) -> DataFrame:
    """Per-group ``n, yty, xty[k], xtx_u[k(k+1)/2]`` over rows where all inputs are non-null.

    Up to ``WIDE`` columns: one aggregate of sum-product expressions. Wider: one packed
    array per Arrow batch and group in ``mapInPandas``, added per group as they stream by
    (hundreds of sum expressions would dominate planning and code generation).
    """
    k = len(xcols)
    ok = F.col(ycol).isNotNull()
    for c in xcols:
        ok = ok & F.col(c).isNotNull()
    x = df.filter(ok)
    if k > WIDE:
        return _gram_partial(x, list(xcols), ycol, list(by), list(extra))
    y = F.col(ycol)
    upper = [F.sum(F.col(xcols[i]) * F.col(xcols[j])) for i in range(k) for j in range(i, k)]
    return x.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y * y).alias("yty"),
        F.array(*[F.sum(F.col(c) * y) for c in xcols]).alias("xty"),
        F.array(*upper).alias("xtx_u"),
        *extra,
    )


def _gram_partial(x: DataFrame, xcols: list[str], ycol: str, by: list[str], extra: list[Column]) -> DataFrame:
    import pandas as pd
    from pyspark.sql import types as T

    k = len(xcols)
    nu = k * (k + 1) // 2
    schema = T.StructType([*[x.schema[c] for c in by], T.StructField("v", T.ArrayType(T.DoubleType()))])

    def partial(it):
        for pdf in it:
            rows = []
            for key, g in pdf.groupby(by, sort=False, dropna=False):
                rows.append((*(key if isinstance(key, tuple) else (key,)), packed(g[xcols].to_numpy(dtype=float), g[ycol].to_numpy(dtype=float))))
            yield pd.DataFrame(rows, columns=[*by, "v"])

    vals = F.col("v")
    out = add_packed(x.select(*by, *xcols, ycol).mapInPandas(partial, schema), by).select(
        *by,
        vals[nu + k + 1].cast("long").alias("n"),
        vals[nu + k].alias("yty"),
        F.slice(vals, nu + 1, k).alias("xty"),
        F.slice(vals, 1, nu).alias("xtx_u"),
    )
    if extra:
        out = out.join(x.groupBy(*by).agg(*extra), by, "left")
    return out


def packed(X: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Upper triangle of X'X, X'y, y'y and the row count in one array."""
    return np.concatenate([(X.T @ X)[np.triu_indices(X.shape[1])], X.T @ y, [y @ y, float(len(y))]])


SALTS = 32


def add_packed(parts: DataFrame, by: list[str]) -> DataFrame:
    """Sum of the arrays ``v`` per group. Rows are added one by one as they stream by in key
    order, first per (group, salt), so a hot series is summed by many tasks, then per group."""
    import pandas as pd

    def adder(keys):
        def run(it):
            key, total, rows = None, None, []
            for pdf in it:
                for *mine, v in zip(*[pdf[c] for c in keys], pdf["v"]):
                    if mine == key:
                        total += np.asarray(v, dtype=float)
                        continue
                    if key is not None:
                        rows.append((*key, total))
                    key, total = mine, np.array(v, dtype=float)
                    if len(rows) >= 1000:
                        yield pd.DataFrame(rows, columns=[*keys, "v"])
                        rows = []
            if key is not None:
                rows.append((*key, total))
            yield pd.DataFrame(rows, columns=[*keys, "v"])

        return run

    salted = parts.withColumn("salt", F.spark_partition_id() % SALTS).select(*by, "salt", "v")
    first = salted.repartition(*by, "salt").sortWithinPartitions(*by, "salt").mapInPandas(adder([*by, "salt"]), salted.schema)
    once = first.drop("salt")
    return once.repartition(*by).sortWithinPartitions(*by).mapInPandas(adder(list(by)), once.schema)


def unpack(xtx_u, k: int) -> np.ndarray:
    m = np.zeros((k, k))
    idx = 0
    for i in range(k):
        for j in range(i, k):
            m[i, j] = m[j, i] = xtx_u[idx]
            idx += 1
    return m


#: Smallest eigenvalue of the scaled normal equations, against the largest, that counts as regular.
REGULAR = 1e-12


def ols(xtx: np.ndarray, xty: np.ndarray, yty: float, ridge: float = 0.0):
    """Least squares from sums by Cholesky on columns scaled to unit length.

    Returns (beta, sse, inverse), or None if the system is singular or its residual sum is
    negative beyond rounding. Callers pass sums of centred, scaled series, so nothing
    cancels against a large level.
    """
    a = xtx + ridge * np.eye(xtx.shape[0])
    d = np.sqrt(np.diag(a))
    if not np.all(np.isfinite(a)) or not np.all(d > 0):
        return None
    scaled = a / np.outer(d, d)
    roots = np.linalg.eigvalsh(scaled)
    if roots[0] <= REGULAR * roots[-1]:
        return None
    low = np.linalg.solve(np.linalg.cholesky(scaled), np.eye(len(d)))
    inv = (low.T @ low) / np.outer(d, d)
    beta = inv @ xty
    sse = float(yty - 2 * beta @ xty + beta @ xtx @ beta)
    if sse < -1e-8 * abs(yty):
        return None
    return beta, max(sse, 0.0), inv


def rank(xtx: np.ndarray) -> int:
    """Independent columns of the design behind ``xtx``."""
    d = np.sqrt(np.diag(xtx))
    used = d > 0
    if not used.any():
        return 0
    roots = np.linalg.eigvalsh(xtx[np.ix_(used, used)] / np.outer(d[used], d[used]))
    return int((roots > REGULAR * roots[-1]).sum())


def lasso(a: np.ndarray, b: np.ndarray, weight: float, x: np.ndarray | None = None, sweeps: int = 10_000) -> np.ndarray:
    """Minimum of ``x'ax / 2 - b'x + weight * |x|_1`` by coordinate descent.

    Once the signs stand still, the system of the coordinates that are not zero is solved outright and taken if
    it keeps their signs and no other coordinate wants to move."""
    x = np.zeros(len(b)) if x is None else x.copy()
    diag = np.diag(a)
    move = np.flatnonzero(diag > 0)
    slope = b - a @ x
    for sweep in range(sweeps):
        far = 0.0
        for j in move:
            want = slope[j] + diag[j] * x[j]
            new = np.sign(want) * max(abs(want) - weight, 0.0) / diag[j]
            if new != x[j]:
                slope -= a[:, j] * (new - x[j])
                far = max(far, abs(new - x[j]) * diag[j] ** 0.5)
                x[j] = new
        if sweep % 10 == 9 or far == 0.0:
            exact = _stationary(a, b, weight, np.sign(x))
            if exact is not None:
                return exact
        if far <= 1e-13 * max(1.0, float(np.abs(b).max(initial=0.0))):
            break
    return x


def _stationary(a: np.ndarray, b: np.ndarray, weight: float, sign: np.ndarray) -> np.ndarray | None:
    on, x = sign != 0, np.zeros(len(b))
    if on.any():
        try:
            x[on] = np.linalg.solve(a[np.ix_(on, on)], b[on] - weight * sign[on])
        except np.linalg.LinAlgError:
            return None
        if (np.sign(x) != sign).any():
            return None
    return x if (np.abs((b - a @ x)[~on]) <= weight * (1 + 1e-9)).all() else None


def laplace_fit(xtx: np.ndarray, xty: np.ndarray, yty: float, n: int, ridge: np.ndarray, sparse: slice, scale: float, rounds: int = 20):
    """(beta, sse) of the regression with a Laplace prior of ``scale`` on the ``sparse`` coefficients and a ridge penalty on the
    others; None if the others are singular. The penalty is the noise variance by ``scale``, in alternation with the fit.

    The other coefficients are eliminated, so coordinate descent sees the sparse ones only."""
    k = len(xty)
    some = np.zeros(k, bool)
    some[sparse] = True
    rest = np.flatnonzero(~some)
    a = xtx + np.diag(ridge)
    plain = ols(a[np.ix_(rest, rest)], xty[rest], yty)
    if plain is None:
        return None
    inv = plain[2]
    cross = a[np.ix_(some, rest)] @ inv
    small, right = a[np.ix_(some, some)] - cross @ a[np.ix_(rest, some)], xty[some] - cross @ xty[rest]
    beta, x, sse = np.zeros(k), np.zeros(int(some.sum())), None
    beta[rest] = plain[0]
    for _ in range(rounds):
        before, sse = sse, max(float(yty - 2 * beta @ xty + beta @ xtx @ beta), 0.0)
        if before is not None and abs(before - sse) <= 1e-10 * max(before, 1e-300):
            break
        x = lasso(small, right, sse / n / scale, x)
        beta[some], beta[rest] = x, inv @ (xty[rest] - a[np.ix_(rest, some)] @ x)
    return beta, max(float(yty - 2 * beta @ xty + beta @ xtx @ beta), 0.0)
