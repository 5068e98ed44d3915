"""Anomaly flags, repair, decomposition and stationarity."""

from __future__ import annotations

from ..operators import anomaly as A
from ..operators.decompose import decompose
from ..operators.stationarity import adf_test, dickey_fuller
from .aggregates import QUARTILES, TREND
from .base import FILL, FILLED, KEYS, PANEL, W, filled, panel, query
from .windows import NEIGHBOURS, RESIDUAL, z_sql


@query(
    "an1_zscore_anomalies",
    f"""{FILLED}, z AS (SELECT series, ds, y, {z_sql(30)} AS zscore_30 FROM filled)
    SELECT *, coalesce(abs(zscore_30) > 3, FALSE) AS is_anomaly_zscore FROM z""",
    num="y zscore_30",
)
def _(spark, sf):
    return A.zscore_anomalies(filled(spark, sf), KEYS)


@query(
    "an2_iqr_anomalies",
    f"""{FILLED}, {QUARTILES} SELECT f.series, f.ds, f.y, f.y < low_fence OR f.y > high_fence AS is_anomaly_iqr
    FROM filled f JOIN fences q ON q.series = f.series""",
    num="y",
)
def _(spark, sf):
    return A.iqr_anomalies(filled(spark, sf), KEYS)


OUTLIERS = f"""{RESIDUAL},
neighbours AS (SELECT *, {NEIGHBOURS} FROM residual),
tested AS (
  SELECT *, coalesce(abs(diff / rolling_std) > 3, FALSE) AS outlier_zs,
    coalesce(abs((y_year_mean - y) / nullif(y_year_mean, 0)) > 1.5, FALSE) AS outlier_year_val FROM neighbours),
outliers AS (SELECT *, outlier_zs AND outlier_year_val AS outlier FROM tested)"""
OUTLIER_NUM = "y smooth_baseline diff rolling_std y_prev_year y_next_year y_year_mean"


@query(
    "an3_trend_outliers", f"{FILLED}, {OUTLIERS} SELECT * FROM outliers",
    num=OUTLIER_NUM,
)
def _(spark, sf):
    return A.trend_outliers(filled(spark, sf), KEYS)


@query(
    "an3_trend_outliers_by_row",
    f"WITH {PANEL}, filled AS (SELECT * FROM panel), {OUTLIERS} SELECT * FROM outliers",
    num=OUTLIER_NUM,
)
def _(spark, sf):
    return A.trend_outliers(panel(spark, sf), KEYS, by_row=True)


FILLED0 = PANEL.replace("panel AS", "filled0 AS")
CLIP = "SELECT series, ds, CASE WHEN outlier THEN smooth_baseline ELSE y END AS y FROM outliers"


@query("an4_clip_outliers", f"{FILLED}, {OUTLIERS} {CLIP}", num="y")
def _(spark, sf):
    return A.clip_and_fill(panel(spark, sf), KEYS)


@query(
    "an4_clip_before_fill",
    f"""WITH {FILLED0}, {OUTLIERS.replace('FROM filled', 'FROM filled0')},
    panel AS ({CLIP}), {FILL} SELECT series, ds, y FROM filled""",
    num="y",
)
def _(spark, sf):
    return A.clip_and_fill(panel(spark, sf), KEYS, fill_first=False)


@query("an5_decompose", f"{FILLED}, {TREND} SELECT * FROM components", num="y trend seasonal residual")
def _(spark, sf):
    return decompose(filled(spark, sf), KEYS)


@query("an6_adf_test")
def _(spark, sf):
    return adf_test(filled(spark, sf), KEYS)


@query(
    "an6_adf_fixed_lag",
    f"""{FILLED}, steps AS (SELECT series, ds, y - lag(y) OVER ({W}) AS dy, lag(y) OVER ({W}) AS x FROM filled),
    lagged AS (SELECT *, lag(dy) OVER ({W}) AS z FROM steps),
    s AS (SELECT series, count(*) AS n, regr_sxx(x, x) AS xx, regr_sxx(z, z) AS zz, regr_sxx(dy, dy) AS yy,
      regr_sxy(x, z) AS xz, regr_sxy(dy, x) AS xy, regr_sxy(dy, z) AS zy FROM lagged WHERE z IS NOT NULL GROUP BY series),
    b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM s)
    SELECT series, n AS rows, b1 / sqrt((yy - b1 * xy - b2 * zy) / (n - 3) * zz / (xx * zz - xz * xz)) AS statistic FROM b""",
    num="statistic",
)
def _(spark, sf):
    return adf_test(filled(spark, sf), KEYS, lags=1).select("series", "rows", "statistic")


@query(
    "an6_dickey_fuller",
    f"""{FILLED}, steps AS (SELECT series, y - lag(y) OVER ({W}) AS dy, lag(y) OVER ({W}) AS x FROM filled)
    SELECT series, count(*) AS rows, regr_slope(dy, x) / sqrt(
      (regr_syy(dy, x) - pow(regr_slope(dy, x), 2) * regr_sxx(dy, x)) / (count(*) - 2) / regr_sxx(dy, x)) AS statistic
    FROM steps WHERE x IS NOT NULL GROUP BY series""",
    num="statistic",
)
def _(spark, sf):
    return dickey_fuller(filled(spark, sf), KEYS)
