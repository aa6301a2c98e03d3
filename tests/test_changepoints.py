from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import frame

from pulsegrid.operators import forecast, gram

T0 = datetime(2024, 1, 1)


def _rows(values, key):
    return [(key, T0 + timedelta(hours=i), i, None if v is None else float(v)) for i, v in enumerate(values)]


@pytest.mark.parametrize("seed", range(6))
def test_lasso_meets_its_conditions(seed):
    rng = np.random.default_rng(seed)
    X = np.cumsum(rng.standard_normal((80, 12)), axis=0)  # close to collinear
    X[:, 3] = 0.0
    y = X[:, 1] - 2 * X[:, 7] + rng.standard_normal(80)
    a, b = X.T @ X, X.T @ y
    for weight in (0.0 if seed else 1e-3, 5.0, 200.0, 1e9):
        x = gram.lasso(a, b, weight)
        slope = b - a @ x
        on = x != 0
        tolerance = 1e-6 * np.abs(b).max()
        assert np.allclose(slope[on], weight * np.sign(x[on]), atol=tolerance)
        assert (np.abs(slope[~on]) <= weight + tolerance).all()
    assert not gram.lasso(a, b, 1e9).any()


def test_laplace_fit_is_the_minimum():
    """No move of a coefficient lowers the penalised sum at the variance it ends with."""
    rng = np.random.default_rng(1)
    t = np.linspace(0, 1, 400)
    X = np.column_stack([np.ones(400), t, *(np.maximum(t - c, 0) for c in np.linspace(0.1, 0.8, 8)), np.sin(40 * t)])
    y = 3 * t - 5 * np.maximum(t - 0.5, 0) + 0.2 * X[:, -1] + 0.1 * rng.standard_normal(400)
    ridge = np.array([0.0, 0.0, *[0.0] * 8, 1.0])
    beta, sse = gram.laplace_fit(X.T @ X, X.T @ y, y @ y, 400, ridge, slice(2, 10), 0.05)
    weight = sse / 400 / 0.05
    loss = lambda b: ((y - X @ b) ** 2).sum() / 2 + weight * np.abs(b[2:10]).sum() + (ridge * b * b).sum() / 2
    assert sse == pytest.approx(((y - X @ beta) ** 2).sum())
    for i in range(11):
        for step in (-1e-3, 1e-3):
            moved = beta.copy()
            moved[i] += step
            assert loss(moved) > loss(beta)


def test_planted_changepoints_are_found(spark):
    n, cps = 2000, 25
    at = [0.8 * j / (cps + 1) for j in (8, 17)]
    t = np.arange(n) / (n - 1)
    noise = 0.02 * np.random.default_rng(3).standard_normal(n)
    bent = 100 + 5 * (2 * t - 6 * np.maximum(t - at[0], 0) + 9 * np.maximum(t - at[1], 0) + noise)
    straight = 2 * t + noise
    df = frame(spark, _rows(bent, "bent") + _rows(straight, "straight") + _rows([1.0, 2.0], "two") + _rows([None], "null"))
    models = forecast.trend_season_fit(df, yearly=False, weekly=False, laplace=0.05)
    assert {r["series_id"]: r["status"] for r in models.collect()} == {"bent": "ok", "straight": "ok", "two": "failed", "null": "failed"}
    every = forecast.trend_changepoints(models).collect()
    span = (n - 1) / 24  # days
    flat = [r["delta"] * span for r in every if r["series_id"] == "straight"]
    assert len(flat) < cps / 2 and sum(map(abs, flat)) < 0.1  # a prior shrinks, it does not test
    found = [r for r in every if r["series_id"] == "bent"]
    assert len(found) < cps / 2
    for share, delta in zip(at, (-30, 45)):
        near = [r["delta"] for r in found if abs((r["ts"] - T0).total_seconds() / 86400 / span - share) < 0.8 / (cps + 1) * 1.5]
        assert sum(near) * span == pytest.approx(delta, rel=0.1)
    others = [r for r in found if all(abs((r["ts"] - T0).total_seconds() / 86400 / span - share) > 0.8 / (cps + 1) * 1.5 for share in at)]
    assert sum(abs(r["delta"]) for r in others) * span < 3
    f = forecast.trend_season_forecast(models, 24, history=df).where("series_id = 'bent'").orderBy("step").collect()
    slope = 5 * (2 - 6 + 9) / (n - 1)
    assert f[-1]["forecast"] - f[0]["forecast"] == pytest.approx(23 * slope, rel=0.3)


def test_ridge_fit_is_unchanged_without_changepoints(spark):
    df = frame(spark, _rows(np.arange(50) * 2.0 + 1, "line"))
    one = forecast.trend_season_fit(df, False, False, False, changepoints=0).first()
    two = forecast.trend_season_fit(df, False, False, False, changepoints=0, laplace=0.05).first()
    assert one["params"] == pytest.approx(two["params"])
