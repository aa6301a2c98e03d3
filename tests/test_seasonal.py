from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import frame
from pyspark.sql import functions as F

from pulsegrid.operators import forecast, seasonal
from pulsegrid.plans.blocked import forced_blocks

T0 = datetime(2024, 1, 1)


def _rows(values, key):
    return [(key, T0 + timedelta(hours=i), i, None if v is None else float(v)) for i, v in enumerate(values)]


def simulated(n, shape, b, seed, mean=0.0):
    """By the defining recursion, term by term."""
    phi, sphi, theta, stheta, _ = shape.split(np.asarray(b, float))
    rng = np.random.default_rng(seed)
    e = rng.standard_normal(n + 500)
    far, near = {}, {}
    for i, a in enumerate([1.0, *(-phi)]):
        for j, c in enumerate([1.0, *(-sphi)]):
            far[i + shape.s * j] = far.get(i + shape.s * j, 0.0) + a * c
    for i, a in enumerate([1.0, *theta]):
        for j, c in enumerate([1.0, *stheta]):
            near[i + shape.s * j] = near.get(i + shape.s * j, 0.0) + a * c
    x = np.zeros(n + 500)
    for t in range(n + 500):
        x[t] = sum(c * e[t - k] for k, c in near.items() if k <= t) - sum(c * x[t - k] for k, c in far.items() if 0 < k <= t)
    return x[500:] + mean


def plain_innovations(w, shape, b):
    phi, sphi, theta, stheta, mean = shape.split(np.asarray(b, float))
    z, e = w - mean, np.zeros(len(w))
    near = np.convolve(np.concatenate(([1.0], theta)), shape.spread(stheta))
    far = np.convolve(np.concatenate(([1.0], -phi)), shape.spread(-sphi))
    for t in range(shape.far, len(w)):
        e[t] = sum(far[k] * z[t - k] for k in range(len(far))) - sum(near[k] * e[t - k] for k in range(1, len(near)) if k <= t)
    return e


@pytest.mark.parametrize("orders", [(1, 0, 1, 1, 0, 1, 6), (2, 0, 2, 0, 0, 1, 4), (0, 0, 1, 1, 0, 0, 5), (1, 1, 1, 0, 0, 0, 1), (0, 0, 0, 0, 0, 0, 1)])
def test_innovations_and_derivatives(orders):
    shape = seasonal.Shape(*orders)
    rng = np.random.default_rng(5)
    w = rng.standard_normal(300)
    b = shape.admitted(rng.uniform(-0.6, 0.6, shape.k))
    inverse = lambda v: shape.inverse(v, 300)
    e, J = shape.innovations(w, b, inverse(b))
    assert np.allclose(e, plain_innovations(w, shape, b), atol=1e-9)
    for i in range(shape.k):
        step = np.zeros(shape.k)
        step[i] = 1e-6
        slope = (plain_innovations(w, shape, b + step) - plain_innovations(w, shape, b - step)) / 2e-6
        assert np.allclose(J[:, i], slope, atol=1e-5)


def test_inverse_series_and_reflection():
    poly = np.convolve([1.0, 0.9], np.convolve([1, -0.5], [1.0, 0.3]))
    g = seasonal.inverse_series(poly[1:], 1000)
    assert len(g) < 1000 and np.allclose(np.convolve(poly, g)[:1000], np.eye(1, len(g) + 3)[0][:1000], atol=1e-12)
    assert seasonal.invertible(np.array([0.5])) == pytest.approx([0.5])
    assert seasonal.invertible(np.array([2.0])) == pytest.approx([0.5])
    assert seasonal.invertible(np.array([-1.0])) == pytest.approx([-seasonal.RADIUS])
    for c in ([3.0, 2.5, -4.0], [0.0, 0.0, 1.0], [0.0]):
        roots = np.roots([1.0, *seasonal.invertible(np.array(c))])
        assert (np.abs(roots) <= seasonal.RADIUS + 1e-9).all()
    shape = seasonal.Shape(0, 1, 2, 0, 0, 1, 4)
    worst = np.concatenate((np.poly([seasonal.RADIUS] * 2)[1:], [-seasonal.RADIUS]))
    near = np.convolve(np.concatenate(([1.0], worst[:2])), shape.spread(worst[2:]))
    unit = np.convolve(near, shape.inverse(worst, 4 * shape.memory))
    assert np.allclose(unit, np.eye(1, len(unit))[0], atol=1e-9)


def test_recovers_multiplicative_model_and_is_no_worse_than_its_start(spark):
    shape = seasonal.Shape(1, 0, 1, 1, 0, 1, 24)
    b = [0.5, 0.6, 0.4, -0.4, 0.0]
    x = simulated(4000, shape, b, 3, mean=50.0)
    df = frame(spark, _rows(x, "a") + _rows(simulated(1500, shape, b, 4), "b"))
    got = {r["series_id"]: r for r in seasonal.seasonal_fit(df, (1, 0, 1), (1, 0, 1, 24), auto_stationary=False).collect()}
    p = got["a"]["params"]
    assert [p["phi.1"], p["Phi.1"], p["theta.1"], p["Theta.1"]] == pytest.approx(b[:4], abs=0.08)
    assert p["sigma2"] == pytest.approx(1.0, abs=0.08) and p["mean"] == pytest.approx(50, abs=1)
    assert p["ar.L25"] == pytest.approx(-p["phi.1"] * p["Phi.1"]) and p["ma.L25"] == pytest.approx(p["theta.1"] * p["Theta.1"])
    at = lambda q: np.array([q["phi.1"], q["Phi.1"], q["theta.1"], q["Theta.1"], q["mean"]])
    sse = (plain_innovations(x, shape, at(p)) ** 2).sum()
    assert sse == pytest.approx(p["sigma2"] * got["a"]["n"], rel=1e-8)
    first = forecast.arima_fit(df, (1, 0, 1), (1, 0, 1, 24), auto_stationary=False).where("series_id = 'a'").first()["params"]
    begun = shape.admitted(np.array([first["ar.L1"], first["ar.L24"], first["ma.L1"], first["ma.L24"], x.mean()]))
    assert sse <= (plain_innovations(x, shape, begun) ** 2).sum()
    for i in range(5):  # no neighbour is better
        for sign in (-1, 1):
            moved = at(p)
            moved[i] += sign * 0.01
            assert (plain_innovations(x, shape, moved) ** 2).sum() > sse


def test_blocks_of_a_long_series_give_the_same(spark):
    shape = seasonal.Shape(1, 1, 1, 0, 0, 1, 4)
    x = np.cumsum(simulated(3000, seasonal.Shape(1, 0, 1, 0, 0, 1, 4), [0.5, 0.3, 0.5, 0.0], 8)) + 7
    df = frame(spark, _rows(x, "long") + _rows(x[:400] * 2, "short") + _rows([1.0, 2.0], "two"))
    orders = dict(order=(1, 1, 1), seasonal_order=(0, 0, 1, 4), auto_stationary=False)
    one = {r["series_id"]: r for r in seasonal.seasonal_fit(df, **orders, plan="plain").collect()}
    with forced_blocks(500):
        many = {r["series_id"]: r for r in seasonal.seasonal_fit(df, **orders, plan="blocked").collect()}
    assert shape.memory > 500  # the rows before a block span several blocks
    assert {k: r["status"] for k, r in one.items()} == {"long": "ok", "short": "ok", "two": "failed"}
    for k in ("long", "short"):
        assert one[k]["params"] == pytest.approx(many[k]["params"], abs=1e-6) and one[k]["n"] == many[k]["n"]
    f = [{(r["series_id"], r["step"]): r["forecast"] for r in forecast.arima_forecast(spark.createDataFrame(list(m.values()), forecast.MODEL_SCHEMA), 9).collect()} for m in (one, many)]
    assert f[0].keys() == f[1].keys() and all((f[0][k] is None and f[1][k] is None) or f[0][k] == pytest.approx(f[1][k], abs=1e-5) for k in f[0])


def test_pieces_of_a_run_add_up(monkeypatch):
    shape = seasonal.Shape(1, 0, 1, 0, 0, 1, 3)
    x = simulated(5000, shape, [0.5, 0.3, 0.5, 0.0], 9)
    head = np.array([5000, x.mean(), x.std(), 0, 0.4, 0.2, 0.3, 0.01])
    whole = shape.evaluate(head, 0, 0, x)
    monkeypatch.setattr(seasonal, "PIECE", 700)
    assert np.allclose(shape.evaluate(head, 0, 0, x), whole, rtol=1e-9, atol=1e-7)


def test_forecast_follows_the_multiplied_polynomials(spark):
    shape = seasonal.Shape(1, 0, 1, 1, 0, 1, 6)
    x = simulated(900, shape, [0.5, 0.6, 0.4, -0.3, 0.0], 12, mean=20.0)
    m = seasonal.seasonal_fit(frame(spark, _rows(x, "s")), (1, 0, 1), (1, 0, 1, 6), auto_stationary=False)
    p = m.first()["params"]
    b = [p["phi.1"], p["Phi.1"], p["theta.1"], p["Theta.1"], p["mean"]]
    e, z = list(plain_innovations(x, shape, b)), list(x - p["mean"])
    far, near = np.convolve(*shape.factors(np.array(b))[:2]), np.convolve(*shape.factors(np.array(b))[2:])
    for _ in range(14):
        e.append(0.0)
        z.append(-sum(far[k] * z[-k] for k in range(1, len(far))) + sum(near[k] * e[-1 - k] for k in range(1, len(near))))
    got = [r["forecast"] for r in forecast.arima_forecast(m, 14).orderBy("step").collect()]
    assert got == pytest.approx([v + p["mean"] for v in z[-14:]], abs=1e-6)


def test_edges(spark):
    none = frame(spark, [])
    assert seasonal.seasonal_fit(none, (1, 0, 0), (0, 0, 0, 0)).count() == 0
    df = frame(spark, _rows([5.0] * 60, "constant") + _rows([None] * 5, "null") + _rows([1.0], "one"))
    assert {r["series_id"]: r["status"] for r in seasonal.seasonal_fit(df, (1, 0, 1), (1, 0, 0, 4)).collect()} == {"constant": "failed", "null": "failed", "one": "failed"}
    assert df.where(F.col("value").isNull()).count() == 5
