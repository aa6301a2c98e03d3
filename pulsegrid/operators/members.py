"""ENS-01..03 for any forecasters: what an ensemble member is, and the ensemble of a list of them.

A member fits a panel into a model table (one row per series, with ``model`` and ``status``)
and turns models into forecasts (``series_id, model, step, forecast, status``). Any pair of
functions of that shape will do; a member that fails for a series keeps a row with its
status and is left out of that series' combination.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY
from pulsegrid.operators import forecast
from pulsegrid.operators.baselines import ensemble
from pulsegrid.sources.spine import count_out

COLUMNS = [KEY, "model", "step", "forecast", "status"]


@dataclass(frozen=True)
class Member:
    name: str
    fit: Callable[[DataFrame], DataFrame]
    #: (models, the fitted history, steps) -> forecasts with ``COLUMNS``
    predict: Callable[[DataFrame, DataFrame, int], DataFrame]


@dataclass(frozen=True)
class Ensemble:
    members: tuple[Member, ...]
    models: tuple[DataFrame, ...]
    history: DataFrame

    def status(self) -> DataFrame:
        """(series_id, model, status) of every member and series."""
        parts = [m.select(KEY, "model", "status") for m in self.models]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def predict(self, steps: int, method: str = "average") -> DataFrame:
        """One combined forecast for each series and step; NULL where all members failed."""
        out = None
        for member, models in zip(self.members, self.models):
            part = member.predict(models, self.history, steps).select(*COLUMNS)
            out = part if out is None else out.unionByName(part)
        return ensemble(out, method)


def fit_members(df: DataFrame, members: Sequence[Member]) -> Ensemble:
    """Fit every member on every series."""
    if not members:
        raise ValueError("an ensemble needs a member")
    return Ensemble(tuple(members), tuple(m.fit(df) for m in members), df)


def arima(order: tuple[int, int, int] = (1, 1, 1), **kw) -> Member:
    return Member("arima", lambda df: forecast.arima_fit(df, order, **kw), lambda models, _, steps: forecast.arima_forecast(models, steps))


def trend_season(**kw) -> Member:
    return Member("trend_season", lambda df: forecast.trend_season_fit(df, **kw), lambda models, history, steps: forecast.trend_season_forecast(models, steps, history=history))


def _steps(models: DataFrame, steps: int) -> DataFrame:
    return count_out(models.withColumn("_steps", F.lit(steps)), "_steps", "step").withColumn("step", F.col("step").cast("int")).drop("_steps")


def _constant(name: str, value) -> Member:
    def fit(df):
        known = F.col("value").isNotNull()
        m = df.groupBy(KEY).agg(value.alias("level"), F.count_if(known).alias("n"))
        return m.select(KEY, F.lit(name).alias("model"), "level", "n", F.when(F.col("n") > 0, "ok").otherwise("failed").alias("status"))

    return Member(name, fit, lambda models, _, steps: _steps(models, steps).withColumn("forecast", F.col("level")))


def naive() -> Member:
    """The last known value."""
    known = F.when(F.col("value").isNotNull(), F.struct("ts", "seq"))
    return _constant("naive", F.max_by("value", known))


def mean() -> Member:
    return _constant("mean", F.avg("value"))


def seasonal_naive(season: int = 24) -> Member:
    """The value one season before; a NULL there stays NULL. A series shorter than a season fails."""

    def fit(df):
        tail = forecast.tail_values(df.select(KEY, "ts", "seq", "value"), season, "value", "season")
        return tail.select(KEY, F.lit("snaive").alias("model"), "season", F.when(F.size("season") == season, "ok").otherwise("failed").alias("status"))

    def predict(models, _, steps):
        at = F.col("season")[(F.col("step") - 1) % season]
        return _steps(models, steps).withColumn("forecast", F.when(F.col("status") == "ok", at))

    return Member("snaive", fit, predict)
