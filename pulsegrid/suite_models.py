"""Registered queries of the model operators with closed-form oracles (imported by ``suite``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid import sqlparts as S
from pulsegrid.functions.numeric import CDF, CDF_STEP
from pulsegrid.operators import clean, forecast, rolling, seasonal, shared_forest, unit_root
from pulsegrid.plans.lineage import materialize
from pulsegrid.sources.panels import table
from pulsegrid.sources.spine import fill_on_spine
from pulsegrid.suite import _ADF0, _FEAT_COLS, _HOURLY, _LAGGED, _SCORED, _ar1_sql, _ar_rows, _hourly_clean, p1, p3, register

# ---------------------------------------------------------------- autoregressions from lag products
_R = f"""
SELECT series_id, count(*) AS n, sum(d * d) AS c0, sum(d * d1) / sum(d * d) AS r1, sum(d * d2) / sum(d * d) AS r2 FROM (
  SELECT series_id, d, lag(d, 1) OVER ({S.W}) AS d1, lag(d, 2) OVER ({S.W}) AS d2 FROM (
    SELECT series_id, ts, seq, value - avg(value) OVER (PARTITION BY series_id) AS d FROM ({S.P1}) _a) _b) _c GROUP BY 1"""
_LONG_AR = f"""
SELECT series_id, 1 AS ar_order, n, r1 AS phi1, NULL::DOUBLE AS phi2, c0 / n * (1 - r1 * r1) AS sigma2 FROM ({_R}) _r
UNION ALL SELECT series_id, 2, n, r1 * (1 - r2) / (1 - r1 * r1), (r2 - r1 * r1) / (1 - r1 * r1),
  c0 / n * (1 - r1 * r1) * (1 - power((r2 - r1 * r1) / (1 - r1 * r1), 2)) FROM ({_R}) _r"""


@register("arima_long_ar", _LONG_AR, ["phi1", "phi2", "sigma2"], bits=14)
def q_arima_long_ar(spark, d):
    """FC-01: Yule-Walker autoregressions of orders 1 and 2 of every user series by Levinson-Durbin."""
    out = None
    for k in (1, 2):
        m = forecast.long_ar(p1(spark, d), k)
        phi2 = F.col("phi")[1] if k == 2 else F.lit(None).cast("double")
        rows = m.select("series_id", F.lit(k).alias("ar_order"), "n", F.col("phi")[0].alias("phi1"), phi2.alias("phi2"), "sigma2")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- unit roots
def normal_cdf_sql(x: str) -> str:
    """The approximation of ``functions.normal_cdf`` in SQL."""
    k = f"(1 / (1 + {CDF_STEP} * abs({x})))"
    poly = "0"
    for c in reversed(CDF):
        poly = f"(({poly} + ({c})) * {k})"
    upper = f"(exp(-({x}) * ({x}) / 2) / sqrt(2 * pi()) * {poly})"
    return f"CASE WHEN {x} >= 0 THEN 1 - {upper} ELSE {upper} END"


def p_value_sql(src: str) -> str:
    """Adds ``p_value`` to rows with ``t_stat``."""
    poly = lambda c: " + ".join(f"({a}) * power(t_stat, {i})" for i, a in enumerate(c))
    z = f"SELECT *, CASE WHEN t_stat <= {unit_root.P_SWITCH} THEN {poly(unit_root.P_LOW)} ELSE {poly(unit_root.P_HIGH)} END AS z FROM ({src}) _s"
    return f"SELECT * EXCLUDE (z), CASE WHEN t_stat > {unit_root.P_ONE} THEN 1.0 WHEN t_stat < {unit_root.P_ZERO} THEN 0.0 ELSE {normal_cdf_sql('z')} END AS p_value FROM ({z}) _z"


@register("adf_p_value", f"SELECT *, p_value < 0.05 AS stationary FROM ({p_value_sql(_ADF0)}) _p", ["t_stat", "crit_5pct", "p_value"], bits=16)
def q_adf_p_value(spark, d):
    """STA-01: p-value of the Dickey-Fuller statistic of every user series."""
    return forecast.adf_test(p1(spark, d), lags=0).select("series_id", "n", "t_stat", "crit_5pct", "p_value", "stationary")


def _adf1_sql(src: str) -> str:
    """Statistic of the regression with one lagged difference, by the normal equations of two centred regressors."""
    lagged = f"SELECT *, value - y1 AS dy, y1 - lag(value, 2) OVER ({S.W}) AS dl FROM ({_LAGGED.format(k=1, src=src)}) _a"
    sums = f"""SELECT series_id, count(*) AS m, regr_sxx(dy, y1) AS saa, regr_sxx(dy, dl) AS sbb, regr_sxy(dl, y1) AS sab, regr_sxy(dy, y1) AS say, regr_sxy(dy, dl) AS sby, regr_syy(dy, y1) AS syy
      FROM ({lagged}) _b WHERE dl IS NOT NULL GROUP BY 1"""
    solved = f"SELECT *, saa * sbb - sab * sab AS det FROM ({sums}) _c"
    beta = f"SELECT *, (sbb * say - sab * sby) / det AS a, (saa * sby - sab * say) / det AS b FROM ({solved}) _d"
    return f"SELECT series_id, a / sqrt((syy - a * say - b * sby) / (m - 3) * sbb / det) AS t_stat FROM ({beta}) _e"


def _diff_sql(src: str) -> str:
    return f"SELECT series_id, ts, seq, value FROM (SELECT series_id, ts, seq, value - lag(value) OVER ({S.W}) AS value FROM ({src}) _x) _y WHERE value IS NOT NULL"


def _auto_sql(src: str) -> str:
    levels = [src, _diff_sql(src), _diff_sql(_diff_sql(src))]
    tests = [p_value_sql(_adf1_sql(x)) for x in levels]
    return f"""SELECT series_id, CASE WHEN a.p_value < 0.05 THEN 0 WHEN b.p_value < 0.05 THEN 1 ELSE 2 END AS d, a.t_stat AS t0, b.t_stat AS t1, c.t_stat AS t2
      FROM ({tests[0]}) a JOIN ({tests[1]}) b USING (series_id) JOIN ({tests[2]}) c USING (series_id)"""


def _order_rows(picked):
    return picked.select("series_id", "d", *[F.col("t_stats")[str(k)].alias(f"t{k}") for k in range(3)])


@register("auto_difference_lag1", _auto_sql(S.P1), ["t0", "t1", "t2"], bits=14)
def q_auto_difference_lag1(spark, d):
    """STA-02 with one lagged difference: order and the three statistics of every user series."""
    return _order_rows(forecast.auto_difference(p1(spark, d), lags=1))


def _walked_sql(src: str) -> str:
    return f"SELECT series_id, ts, seq, sum(value - 0.5) OVER ({S.W} ROWS UNBOUNDED PRECEDING) AS value FROM ({src}) _w"


@register("auto_difference_walks", _auto_sql(_walked_sql(_HOURLY)), ["t0", "t1", "t2"], bits=12)
def q_auto_difference_walks(spark, d):
    """STA-02 with one lagged difference on the running sums of the hourly series, which need differencing."""
    from pulsegrid.frame import series_window
    from pyspark.sql import Window

    total = F.sum(F.col("value") - 0.5).over(series_window().rowsBetween(Window.unboundedPreceding, 0))
    return _order_rows(forecast.auto_difference(_hourly_clean(spark, d).withColumn("value", total), lags=1))


# ---------------------------------------------------------------- one detector over all series
def _shared(spark, d):
    """(scaled features of all user series, the forest fitted to all of them)"""
    feats = rolling.anomaly_features(p1(spark, d))
    scaled = materialize(clean.apply_scaler(feats, clean.fit_scaler(feats, _FEAT_COLS), _FEAT_COLS), "shared_features")
    return scaled, shared_forest.fit(scaled, _FEAT_COLS)


@register("iforest_shared")
def q_iforest_shared(spark, d):
    """ANO-02/03: one forest over all user series, broadcast; scores and flags at contamination 0.1."""
    feats, forest = _shared(spark, d)
    scores = materialize(shared_forest.score(feats, forest).select("series_id", "ts", "seq", "score"), "shared_scores")
    return shared_forest.flag(scores, shared_forest.threshold(scores, 0.1))


_SHARED_SQL = f"""
SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_scored) AS BIGINT) AS n_scored, CAST(100 AS INTEGER) AS n_trees, CAST(least(256, sum(n_scored)) AS INTEGER) AS psi,
  CAST(sum(n_scored) - 1 - floor(0.9 * (sum(n_scored) - 1)) AS BIGINT) AS n_above FROM ({_SCORED}) _x"""


@register("iforest_shared_info", _SHARED_SQL)
def q_iforest_shared_info(spark, d):
    """ANO-05 of the shared forest: rows, rows scored inside (0, 1), trees, sample size, rows at or above the cut's rank."""
    feats, forest = _shared(spark, d)
    scores = materialize(shared_forest.score(feats, forest).select("series_id", "ts", "seq", "score"), "shared_scores")
    cut = shared_forest.threshold(scores, 0.1)
    # equal scores at the cut share its rank: count ranks, not scores
    base = p1(spark, d).join(scores.where("score > 0 and score < 1"), ["series_id", "ts", "seq"], "left")
    seen = base.agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("n_scored"), F.count_if(F.col("score") > cut).alias("above"), F.count_if(F.col("score") >= cut).alias("reach"))
    rank = F.col("n_scored") - 1 - F.floor(0.9 * (F.col("n_scored") - 1))
    held = F.when((F.col("above") <= rank) & (rank <= F.col("reach")), rank).cast("long")
    return seen.withColumns({c: F.lit(v) for c, v in forest.select("n_trees", "psi").first().asDict().items()}).select("n", "n_scored", "n_trees", "psi", held.alias("n_above"))


# ---------------------------------------------------------------- calendar steps
_MONTHLY = """
SELECT g.series_id, g.ts, CAST(0 AS BIGINT) AS seq, avg(d.value) AS value FROM (
  SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS ts FROM ({src}) _a GROUP BY 1) g
LEFT JOIN ({src}) d ON d.series_id = g.series_id AND d.ts >= g.ts AND d.ts < g.ts + INTERVAL 1 MONTH GROUP BY 1, 2"""
_CUSTOMERS = "SELECT CAST(o_custkey AS VARCHAR) AS series_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS ts, CAST(0 AS BIGINT) AS seq, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2"


def _monthly(spark, d):
    """Mean daily order revenue of every month, from the daily series."""
    return materialize(fill_on_spine(p3(spark, d), "1 month"), "panel_monthly")


@register("time_spine_monthly", _MONTHLY.format(src=_CUSTOMERS), ["value"], bits=8)
def q_time_spine_monthly(spark, d):
    """SRC-04 with a calendar step: monthly grid per customer with the month's order revenue."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    revenue = o.groupBy(F.col("o_custkey").cast("string").alias("series_id"), month.alias("ts")).agg(F.sum("o_totalprice").alias("value"))
    return fill_on_spine(revenue.withColumn("seq", F.lit(0).cast("long")), "1 month")


@register(
    "arima_monthly",
    f"""SELECT series_id, CAST(h AS INTEGER) AS step, last_ts + to_months(CAST(h AS INTEGER)) AS ts, const * (1 - power(ar, h)) / (1 - ar) + power(ar, h) * last AS forecast
    FROM ({_ar1_sql(_MONTHLY.format(src=S.P3))}) _x JOIN (SELECT series_id, max(ts) AS last_ts FROM ({_MONTHLY.format(src=S.P3)}) _m GROUP BY 1) USING (series_id), unnest(generate_series(1, 15)) t(h)""",
    ["forecast"],
    bits=4,
)
def q_arima_monthly(spark, d):
    """FC-03 with a calendar step: 15 months of the AR(1) of monthly order revenue, on first days of months."""
    m = forecast.arima_fit(_monthly(spark, d), (1, 0, 0), auto_stationary=False)
    return forecast.arima_forecast(m, 15).select("series_id", "step", "ts", "forecast")


# ---------------------------------------------------------------- multiplicative seasonal models
@register("seasonal_css_100", f"SELECT * EXCLUDE (last) FROM ({_ar1_sql(S.P1)}) _x", ["const", "ar", "sigma2", "aic", "bic"], bits=12)
def q_seasonal_css_100(spark, d):
    """FC-02 by conditional sum of squares, without seasonal factors: AR(1) of every user series is least squares."""
    return _ar_rows(seasonal.seasonal_fit(p1(spark, d), (1, 0, 0), (0, 0, 0, 0), auto_stationary=False))


@register("seasonal_css_000_100_24", f"SELECT * EXCLUDE (last) FROM ({_ar1_sql(_HOURLY, 24)}) _x", ["const", "ar", "sigma2", "aic", "bic"], bits=12)
def q_seasonal_css_000_100_24(spark, d):
    """FC-02 by conditional sum of squares: the seasonal factor alone is least squares on lag 24."""
    return _ar_rows(seasonal.seasonal_fit(_hourly_clean(spark, d), (0, 0, 0), (1, 0, 0, 24), auto_stationary=False), 24)


@register("seasonal_multiplicative")
def q_seasonal_multiplicative(spark, d):
    """FC-02: ARIMA(1,0,1)(1,0,1,24) of every hourly series with multiplied polynomials."""
    return seasonal.seasonal_fit(_hourly_clean(spark, d), (1, 0, 1), (1, 0, 1, 24)).drop("created", "state")


@register("seasonal_multiplicative_forecast")
def q_seasonal_multiplicative_forecast(spark, d):
    """FC-03 of the multiplicative model: two days of every hourly series."""
    return forecast.arima_forecast(seasonal.seasonal_fit(_hourly_clean(spark, d), (1, 0, 1), (1, 0, 1, 24)), 48)


# ---------------------------------------------------------------- changepoints
@register("trend_changepoints")
def q_trend_changepoints(spark, d):
    """FC-05 with a Laplace prior on changes of slope: the changepoints of every hourly series."""
    return forecast.trend_changepoints(forecast.trend_season_fit(_hourly_clean(spark, d), yearly=False, laplace=0.05))
