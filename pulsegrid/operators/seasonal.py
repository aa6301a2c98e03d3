"""FC-02: seasonal ARIMA with multiplicative lag polynomials by conditional sum of squares.

``phi(B) Phi(B^s) (w_t - mean) = theta(B) Theta(B^s) e_t``, w the differenced series; innovations before the first
``p + s P`` values are zero. Gauss-Newton with Levenberg damping from the additive Hannan-Rissanen model: the
derivatives of the innovations follow the recursion of the innovations themselves, with shifted right-hand sides. Moving average
factors are kept invertible: roots outside are reflected, moduli end at ``RADIUS``, so the inverse
polynomial dies out after a known number of lags (``memory``) and the recursions are convolutions of that length.

A step needs one small Gram matrix a series. Ordinary series are iterated inside one task; the blocks of long ones,
which are led by ``memory`` more rows, send their Gram matrices, and a round of the iteration is one Spark job for all open series.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY
from pulsegrid.operators.forecast import MODEL_SCHEMA, _arima_fit, _arr, _clean, _differenced, _seasonal, _step
from pulsegrid.operators.gram import packed, unpack
from pulsegrid.operators.runs import each_run, lead, run_rows, series_scale, stream, summed
from pulsegrid.plans.blocked import choose_plan
from pulsegrid.plans.lineage import materialize
from pulsegrid.session import ship_package
from pulsegrid.sources.steps import time_steps

#: Largest modulus of an inverse root of a moving average factor.
RADIUS = 0.98
#: What is left of an innovation after ``memory`` lags.
FORGOTTEN = 1e-13
#: Evaluations at most, and the relative decrease that ends the iteration.
ROUNDS, TOLERANCE = 60, 1e-10
#: Rows of a run that are held with their derivatives at once.
PIECE = 65_536
#: Last values of a series that a forecast is integrated from, beyond the differences' own.
SPARE = 6

#: Differencing order in the head of a series that has no model to start from.
UNSTARTED = -1


def invertible(theta: np.ndarray) -> np.ndarray:
    """Coefficients of ``1 + theta_1 z + ...`` with inverse roots reflected inside and cut at ``RADIUS``."""
    if not len(theta) or not np.isfinite(theta).all():
        return theta
    roots = np.roots(np.concatenate(([1.0], theta)))
    size = np.abs(roots)
    if (size <= RADIUS).all():
        return theta
    inside = np.where(size > 1, 1 / np.conj(np.where(size == 0, 1, roots)), roots)
    size = np.abs(inside)
    inside = np.where(size > RADIUS, inside * (RADIUS / np.where(size == 0, 1, size)), inside)
    return np.real(np.poly(inside))[1:]


def inverse_series(theta: np.ndarray, size: int) -> np.ndarray:
    """At most ``size`` coefficients of ``1 / (1 + theta_1 z + ...)``; what follows the last one is below ``FORGOTTEN``."""
    q, g = len(theta), np.zeros(size)
    g[:1] = 1.0
    for i in range(1, size):
        near = g[max(i - q, 0) : i][::-1]
        g[i] = -(theta[: len(near)] @ near)
        if i % 64 == 0 and np.abs(g[i - q + 1 : i + 1]).max(initial=0.0) < FORGOTTEN:
            return g[: i + 1]
    return g


def _convolve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if min(len(a), len(b)) <= 64:
        return np.convolve(a, b)
    size = 1 << (len(a) + len(b) - 2).bit_length()
    return np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(b, size), size)[: len(a) + len(b) - 1]


def _shift(x: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate((np.zeros(min(k, len(x))), x[: max(len(x) - k, 0)]))


@dataclass(frozen=True)
class Shape:
    """Orders of a model; the parameters are phi, Phi, theta, Theta and the mean if there is no differencing."""

    p: int
    d: int
    q: int
    P: int
    D: int
    Q: int
    s: int

    @property
    def mean(self) -> bool:
        return self.d + self.D == 0

    @property
    def k(self) -> int:
        return self.p + self.P + self.q + self.Q + self.mean

    @property
    def far(self) -> int:
        return self.p + self.s * self.P

    @property
    def far_ma(self) -> int:
        return self.q + self.s * self.Q

    @property
    def lost(self) -> int:
        return self.d + self.D * self.s

    @property
    def kept(self) -> int:
        return self.lost + SPARE

    @property
    def gram(self) -> int:
        return self.k * (self.k + 1) // 2 + self.k + 2

    @property
    def sums(self) -> int:
        return self.gram + self.kept + self.far + self.far_ma

    @staticmethod
    def _lasting(q: int) -> int:
        """Coefficients of an inverse factor of order ``q`` until ``i^(q-1) RADIUS^i``, its slowest decay, is below ``FORGOTTEN``."""
        n = 1.0
        for _ in range(50 if q else 0):
            n = (math.log(FORGOTTEN) - (q - 1) * math.log(max(n, 1.0))) / math.log(RADIUS)
        return math.ceil(n)

    @property
    def memory(self) -> int:
        """Lags after which every admitted inverse moving average has died out."""
        return self._lasting(self.q) + self.s * self._lasting(self.Q) if self.far_ma else 0

    def inverse(self, b: np.ndarray, size: int) -> np.ndarray:
        """Up to ``size`` coefficients of the inverse moving average, each factor by its own recursion."""
        _, _, theta, seasonal_theta, _ = self.split(b)
        one = inverse_series(theta, min(size, self._lasting(self.q)))
        return _convolve(one, self.spread(inverse_series(seasonal_theta, min(size // self.s + 1, self._lasting(self.Q)))[1:]))[:size]

    def split(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
        at = np.cumsum([self.p, self.P, self.q, self.Q])
        phi, seasonal_phi, theta, seasonal_theta, mean = np.split(b, at)
        return phi, seasonal_phi, theta, seasonal_theta, float(mean[0]) if self.mean else 0.0

    def admitted(self, b: np.ndarray) -> np.ndarray:
        phi, seasonal_phi, theta, seasonal_theta, _ = self.split(b)
        return np.concatenate((phi, seasonal_phi, invertible(theta), invertible(seasonal_theta), b[len(b) - self.mean :]))

    def spread(self, c: np.ndarray) -> np.ndarray:
        """Coefficients of a seasonal factor at their lags: 1 at lag 0, ``c_i`` at lag ``s i``."""
        out = np.zeros(self.s * len(c) + 1)
        out[0] = 1.0
        out[self.s :: self.s] = c
        return out

    def factors(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        phi, seasonal_phi, theta, seasonal_theta, _ = self.split(b)
        return np.concatenate(([1.0], -phi)), self.spread(-seasonal_phi), np.concatenate(([1.0], theta)), self.spread(seasonal_theta)

    def innovations(self, w: np.ndarray, b: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(innovations, their derivatives by the parameters); both are zero in the first ``far`` places."""
        ar, seasonal_ar, ma, seasonal_ma = self.factors(b)
        z = w - self.split(b)[4]

        def solved(u):
            u = u[: len(w)].copy()
            u[: self.far] = 0.0
            return _convolve(u, inverse[: len(w)])[: len(w)] if self.far_ma and len(u) else u

        e = solved(np.convolve(z, np.convolve(ar, seasonal_ar)))
        by_ar, by_seasonal_ar = np.convolve(z, seasonal_ar), np.convolve(z, ar)
        by_ma, by_seasonal_ma = np.convolve(e, seasonal_ma), np.convolve(e, ma)
        columns = [-solved(_shift(by_ar, i)) for i in range(1, self.p + 1)] + [-solved(_shift(by_seasonal_ar, self.s * i)) for i in range(1, self.P + 1)]
        columns += [-solved(_shift(by_ma, i)) for i in range(1, self.q + 1)] + [-solved(_shift(by_seasonal_ma, self.s * i)) for i in range(1, self.Q + 1)]
        if self.mean:
            columns.append(solved(np.full(len(w), -ar.sum() * seasonal_ar.sum())))
        return e, np.column_stack(columns) if columns else np.empty((len(w), 0))

    def evaluate(self, head: np.ndarray, first: int, before: int, x: np.ndarray) -> np.ndarray:
        """Gram sums of one run at the parameters of its head, and the tails a forecast needs if the series ends here."""
        n, mean, std, d0, b = int(head[0]), head[1], head[2], int(head[3]), head[4 : 4 + self.k]
        w = _differenced((x - mean) / std, d0 + self.d, self.D, self.s)
        inverse = self.inverse(b, min(max(len(w), 1), self.memory)) if self.far_ma else np.ones(1)
        out, halo = np.zeros(self.sums), self.memory + self.far + self.far_ma
        start, last = max(self.far, before - d0 - self.lost, 0), np.empty(0)
        for at in range(start, len(w), PIECE):
            lo = max(0, at - halo)
            e, J = self.innovations(w[lo : at + PIECE], b, inverse)
            out[: self.gram] += packed(J[at - lo :], e[at - lo :])
            last = e
        if first + len(x) == n:
            at = self.gram
            for values, size in ((x, self.kept), (w, self.far), (last, self.far_ma)):
                tail = values[len(values) - min(size, len(values)) :]
                out[at + size - len(tail) : at + size] = tail
                at += size
        return out

    # the iteration: state = [open, damping, evaluations], the best parameters, the sums there
    def begin(self) -> np.ndarray:
        return np.concatenate(([1.0, 1e-3, 0.0], np.zeros(self.k + self.sums)))

    def sse(self, sums: np.ndarray) -> float:
        return float(sums[self.gram - 2])

    def count(self, sums: np.ndarray) -> int:
        return int(round(sums[self.gram - 1]))

    def advance(self, state: np.ndarray, trial: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, next parameters to evaluate) from the sums at ``trial``."""
        _, damping, rounds = state[:3]
        best, held = state[3 : 3 + self.k], state[3 + self.k :]
        old, new = self.sse(held) if rounds else math.inf, self.sse(sums)
        better = bool(np.isfinite(sums).all()) and new <= old
        settled = better and rounds > 0 and old - new <= TOLERANCE * old
        if better:
            best, held, damping = trial, sums, max(damping / 10, 1e-12)
        else:
            damping = damping * 10
        known = better or rounds > 0
        step = self._step(held, damping) if known and self.count(held) > self.k else None
        more = step is not None and not settled and damping < 1e10 and rounds + 1 < ROUNDS
        state = np.concatenate(([float(more), damping, rounds + 1], best, held))
        return state, self.admitted(best + step) if more else best

    def _step(self, sums: np.ndarray, damping: float) -> np.ndarray | None:
        nu = self.k * (self.k + 1) // 2
        if not self.k:
            return None
        a = unpack(sums[:nu], self.k)
        scale = np.diag(a).copy()
        if not (scale > 0).all():
            return None
        root = np.sqrt(scale)
        step = -np.linalg.lstsq(a / np.outer(root, root) + damping * np.eye(self.k), sums[nu : nu + self.k] / root, rcond=None)[0] / root
        return step if np.isfinite(step).all() else None


def seasonal_fit(
    df: DataFrame,
    order: tuple[int, int, int] = (1, 0, 1),
    seasonal_order: tuple[int, int, int, int] = (1, 0, 1, 24),
    auto_stationary: bool = True,
    col: str = "value",
    plan: str = "auto",
) -> DataFrame:
    """One row a series (``MODEL_SCHEMA``, ``arima_forecast`` reads it). ``params``: the factors ``phi.i``, ``Phi.i``, ``theta.i``,
    ``Theta.i``, the mean of the differenced series where nothing is differenced, ``const``, ``ar.L<lag>`` and ``ma.L<lag>`` of the
    multiplied polynomials, ``sigma2``.

    A series without a start (too short, singular) or with no more usable values than parameters is ``failed``."""
    raw = _clean(df, col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _seasonal_fit(df, raw, order, seasonal_order, auto_stationary, choose_plan(raw, plan))
    finally:
        raw.unpersist()


def _seasonal_fit(df, raw, order, seasonal_order, auto_stationary, plan) -> DataFrame:
    (p, d, q), seasonal = order, _seasonal(seasonal_order)
    shape = Shape(p, d, q, *seasonal)
    begun = _arima_fit(df, raw, order, seasonal, auto_stationary, None, plan)
    known = series_scale(raw).join(begun.where("status = 'ok'").select(KEY, "params", F.get_json_object("state", "$.d0").cast("int").alias("d0")), KEY, "left")
    known = known.withColumn("d0", F.coalesce("d0", F.lit(UNSTARTED)))
    lags = [f"ar.L{i}" for i in range(1, p + 1)] + [f"ar.L{shape.s * i}" for i in range(1, shape.P + 1)]
    lags += [f"ma.L{i}" for i in range(1, q + 1)] + [f"ma.L{shape.s * i}" for i in range(1, shape.Q + 1)]
    first = [F.coalesce(F.col("params")[name], F.lit(0.0)) for name in lags] + [F.lit(0.0)] * shape.mean
    head = F.array(F.col("_n").cast("double"), "_mean", "_std", F.col("d0").cast("double"), *first)
    reach = F.col("d0") + (shape.lost + shape.memory + shape.far + 2 * shape.far_ma + shape.kept + 1)
    heads = materialize(known.select(KEY, "_n", reach.cast("int").alias("_reach"), head.alias("_head")), "seasonal_heads")
    found = _in_tasks(raw, heads, shape) if plan == "plain" else _in_rounds(raw, heads, shape, plan)
    every = df.select(F.col(KEY).cast("string").alias(KEY)).distinct()
    info = every.join(found, KEY, "left").join(time_steps(raw, plan), KEY, "left")
    created = datetime.now(timezone.utc).replace(tzinfo=None)

    def solve(batches):
        for pdf in batches:
            yield pd.DataFrame([_model(shape, r, created) for r in pdf.to_dict("records")], columns=MODEL_SCHEMA.fieldNames())

    return materialize(info.mapInPandas(solve, MODEL_SCHEMA), "seasonal_arima")


ITERATED = f"{KEY} string, _head array<double>, _state array<double>"


def _trial(shape: Shape, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = np.asarray(head, float).copy()
    head[4:] = shape.admitted(head[4:])
    return head, shape.begin()


def _in_tasks(raw: DataFrame, heads: DataFrame, shape: Shape) -> DataFrame:
    """The whole iteration of a series where its rows are."""
    ship_package(raw.sparkSession)

    def run(batches):
        for key, head, first, before, x in each_run(batches):
            if head[3] == UNSTARTED:
                continue
            head, state = _trial(shape, head)
            while state[0]:
                state, head[4:] = shape.advance(state, head[4:].copy(), shape.evaluate(head, first, before, x))
            yield pa.RecordBatch.from_pylist([{KEY: key, "_head": head.tolist(), "_state": state.tolist()}])

    return stream(raw, heads, "plain").mapInArrow(run, ITERATED)


def _in_rounds(raw: DataFrame, heads: DataFrame, shape: Shape, plan: str) -> DataFrame:
    """One evaluation of all open series a job; a series that has settled leaves with its rows."""
    heads = heads.where(F.col("_head")[3] != UNSTARTED)
    rows = materialize(run_rows(raw, heads, plan), "seasonal_rows")

    def begin(batches):
        for pdf in batches:
            both = [_trial(shape, h) for h in pdf["_head"]]
            pdf["_head"], pdf["_state"] = [h for h, _ in both], [s for _, s in both]
            yield pdf

    def advance(batches):
        for pdf in batches:
            new = []
            for head, state, v in zip(pdf["_head"], pdf["_state"], pdf["v"]):
                head = np.asarray(head, float).copy()
                state, head[4:] = shape.advance(np.asarray(state, float), head[4:].copy(), np.asarray(v, float))
                new.append((head, state))
            yield pdf.drop(columns="v").assign(_head=[h for h, _ in new], _state=[s for _, s in new])

    table = f"{KEY} string, _n long, _head array<double>, _state array<double>"
    now = materialize(heads.select(KEY, "_n", "_head").mapInPandas(begin, table), "seasonal_state")
    settled = []
    while not now.isEmpty():
        sums = summed(lead(rows.join(now.select(KEY), KEY, "left_semi"), now, plan), shape.evaluate, plan)
        now = materialize(now.join(sums, KEY).mapInPandas(advance, table), "seasonal_state")
        settled.append(now.where(F.col("_state")[0] == 0))
        now = now.where(F.col("_state")[0] == 1)
    out = now
    for part in settled:
        out = out.unionByName(part)
    return out.select(KEY, "_head", "_state")


def _model(shape: Shape, r: dict, created: datetime) -> dict:
    row = {KEY: r[KEY], "model": "seasonal_arima", "version": None, "params": {}, "order": [shape.p, shape.d, shape.q], "seasonal_order": [shape.P, shape.D, shape.Q, shape.s if shape.P or shape.D or shape.Q else 0]}
    row |= {"aic": None, "bic": None, "n": 0, "status": "failed", "created": created, "state": None}
    head, state = np.asarray(_arr(r["_head"]), float), np.asarray(_arr(r["_state"]), float)
    if not len(state):
        return row
    b, sums = state[3 : 3 + shape.k], state[3 + shape.k :]
    n = row["n"] = shape.count(sums)
    if n <= shape.k or not np.isfinite(sums).all():
        return row
    total, level, std, d0 = int(head[0]), head[1], head[2], int(head[3])
    level = level if d0 + shape.lost == 0 else 0.0
    ar, seasonal_ar, ma, seasonal_ma = shape.factors(b)
    far, near = np.convolve(ar, seasonal_ar), np.convolve(ma, seasonal_ma)
    mean = std * shape.split(b)[4] + level
    params = {f"{name}.{i + 1}": float(c) for name, part in zip(("phi", "Phi", "theta", "Theta"), shape.split(b)) for i, c in enumerate(part)}
    params |= {f"ar.L{i}": float(-c) for i, c in enumerate(far) if i and c} | {f"ma.L{i}": float(c) for i, c in enumerate(near) if i and c}
    if shape.mean:
        params |= {"mean": float(mean), "const": float(mean * far.sum())}
    sigma2 = std * std * shape.sse(sums) / n
    ll = -0.5 * n * (math.log(2 * math.pi * max(sigma2, 1e-300)) + 1)
    y, w, e = np.split(sums[shape.gram :], [shape.kept, shape.kept + shape.far])
    keep = json.dumps(
        {
            "d0": d0,
            "ops": [("r", 1)] * shape.d + [("s", shape.s)] * shape.D,
            "tail_y": y[len(y) - min(len(y), total) :].tolist(),
            "tail_w": (w * std + level).tolist(),
            "tail_e": (e * std).tolist(),
            "last_ts": r["last_ts"].isoformat() if r["last_ts"] is not None else None,
            **_step(r),
        }
    )
    return row | {"params": params | {"sigma2": float(sigma2)}, "aic": -2 * ll + 2 * (shape.k + 1), "bic": -2 * ll + math.log(n) * (shape.k + 1), "status": "ok", "state": keep}
