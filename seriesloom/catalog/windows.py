"""Window columns."""

from __future__ import annotations

from ..operators import windows as Wn
from ..operators.blocks import over_blocks
from ..operators.evaluate import head_tail_split
from ..operators.grid import fill_grid
from ..sources.panel import supplier_daily
from .base import FILLED, KEYS, SUPPLIER_FILLED, W, filled, full_sql, query


def _over(spark, sf, *families):
    return over_blocks(filled(spark, sf), KEYS, *families)


LAGS = (1, 7, 14, 30, 365)


@query(
    "win1_lag_features",
    f"{FILLED} SELECT series, ds, y, " + ", ".join(f"lag(y, {k}) OVER ({W}) AS lag_{k}" for k in LAGS) + " FROM filled",
    num=" ".join(["y", *[f"lag_{k}" for k in LAGS]]),
)
def _(spark, sf):
    return _over(spark, sf, Wn.lag_features(LAGS))


SQL_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _rolling_sql(stat: str, windows=(7, 14, 30, 90)) -> str:
    return ", ".join(f"{full_sql(SQL_STATS[stat], 'y', n)} AS rolling_{stat}_{n}" for n in windows)


for _i, _stat in enumerate(SQL_STATS, 2):

    @query(
        f"win{_i}_rolling_{_stat}",
        f"{FILLED} SELECT series, ds, y, {_rolling_sql(_stat)} FROM filled",
        num=" ".join(["y", *[f"rolling_{_stat}_{n}" for n in (7, 14, 30, 90)]]),
        digits={f"rolling_std_{n}": 3 for n in (7, 14, 30, 90)},
    )
    def _(spark, sf, stat=_stat):
        return _over(spark, sf, Wn.rolling(stats=(stat,)))


CHANGES = f"""changes AS (SELECT series, ds, y, y - lag(y) OVER ({W}) AS change,
  y / nullif(lag(y) OVER ({W}), 0) - 1 AS pct_change FROM filled),
changed AS (SELECT *, {full_sql('stddev_samp', 'pct_change', 7)} AS volatility_7 FROM changes)"""


@query("win6_diff", f"{FILLED}, {CHANGES} SELECT series, ds, change FROM changed", num="change")
def _(spark, sf):
    return _over(spark, sf, Wn.changes()).select("series", "ds", "change")


@query("win7_pct_change", f"{FILLED}, {CHANGES} SELECT series, ds, pct_change FROM changed", num="pct_change")
def _(spark, sf):
    return _over(spark, sf, Wn.changes()).select("series", "ds", "pct_change")


@query(
    "win8_rolling_volatility",
    f"{FILLED}, {CHANGES} SELECT series, ds, volatility_7 FROM changed",
    num="volatility_7",
)
def _(spark, sf):
    return _over(spark, sf, Wn.changes()).select("series", "ds", "volatility_7")


def z_sql(n: int) -> str:
    return f"(y - {full_sql('avg', 'y', n)}) / nullif({full_sql('stddev_samp', 'y', n)}, 0)"


@query(
    "win9_rolling_zscore",
    f"{FILLED} SELECT series, ds, y, {z_sql(7)} AS zscore_7, {z_sql(30)} AS zscore_30 FROM filled",
    num="y zscore_7 zscore_30",
)
def _(spark, sf):
    return _over(spark, sf, Wn.rolling_zscore())


CENTRED = "ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING"
RESIDUAL = f"""based AS (SELECT series, ds, y, {full_sql('avg', 'y', 21, CENTRED)} AS smooth_baseline FROM filled),
diffed AS (SELECT *, y - smooth_baseline AS diff FROM based),
residual AS (SELECT *, {full_sql('stddev_samp', 'diff', 21, CENTRED)} + 1e-6 AS rolling_std FROM diffed)"""


@query(
    "win10_centered_mean",
    f"{FILLED}, {RESIDUAL} SELECT series, ds, y, smooth_baseline FROM residual",
    num="y smooth_baseline",
)
def _(spark, sf):
    return _over(spark, sf, Wn.centered_mean())


@query(
    "win11_centered_resid_std",
    f"{FILLED}, {RESIDUAL} SELECT * FROM residual",
    num="y smooth_baseline diff rolling_std",
)
def _(spark, sf):
    return _over(spark, sf, Wn.centered_residual())


NEIGHBOURS = f"""lag(y, 365) OVER ({W}) AS y_prev_year, lag(y, -365) OVER ({W}) AS y_next_year,
  (lag(y, 365) OVER ({W}) + lag(y, -365) OVER ({W})) / 2 AS y_year_mean"""


@query(
    "win12_year_neighbours",
    f"{FILLED} SELECT series, ds, y, {NEIGHBOURS} FROM filled",
    num="y y_prev_year y_next_year y_year_mean",
)
def _(spark, sf):
    return _over(spark, sf, Wn.year_neighbours())


@query(
    "win13_momentum",
    f"""{FILLED}, m AS (SELECT series, ds, {full_sql('avg', 'y', 3)} AS mean_3 FROM filled)
    SELECT series, ds, mean_3 / nullif(lag(mean_3) OVER ({W}), 0) - 1 AS momentum FROM m""",
    num="momentum",
)
def _(spark, sf):
    return _over(spark, sf, Wn.momentum()).select("series", "ds", "momentum")


YEARLY = "yearly AS (SELECT series, year(ds) AS year, avg(y) AS mean_y FROM filled GROUP BY 1, 2)"


@query(
    "win14_yoy_growth",
    f"""{FILLED}, {YEARLY} SELECT series, year, mean_y,
    (mean_y / nullif(lag(mean_y) OVER (PARTITION BY series ORDER BY year), 0) - 1) * 100 AS yoy_growth FROM yearly""",
    num="mean_y yoy_growth",
)
def _(spark, sf):
    return Wn.yoy_growth(filled(spark, sf), KEYS)


RECENT = f"""{YEARLY}, last3 AS (
  SELECT series, row_number() OVER (PARTITION BY series ORDER BY year DESC) AS rn,
    (mean_y / nullif(lag(mean_y) OVER (PARTITION BY series ORDER BY year), 0) - 1) * 100 AS growth FROM yearly),
recent AS (SELECT series, avg(growth) AS recent_trend FROM last3 WHERE rn <= 2 GROUP BY series)"""


@query(
    "win15_recent_trend",
    f"""{FILLED}, {RECENT} SELECT series, recent_trend, CASE WHEN recent_trend > 2 THEN 'up'
    WHEN recent_trend < -2 THEN 'down' ELSE 'stable' END AS direction FROM recent""",
    num="recent_trend",
)
def _(spark, sf):
    return Wn.recent_trend(filled(spark, sf), KEYS)


@query(
    "win16_autocorrelation",
    f"""{FILLED}, numbered AS (SELECT *, row_number() OVER ({W}) AS rn,
      count(*) OVER (PARTITION BY series) AS n FROM filled)
    SELECT a.series, k.lag, covar_pop(a.y, b.y) / nullif(stddev_pop(a.y) * stddev_pop(b.y), 0) AS acf
    FROM numbered a, range(1, 50) AS k(lag), numbered b
    WHERE b.series = a.series AND b.rn = a.rn - k.lag AND k.lag < floor(a.n / 4.0)
    GROUP BY a.series, k.lag""",
    num="acf",
)
def _(spark, sf):
    return Wn.autocorrelation(filled(spark, sf), KEYS)


def _past(agg: str, n: int) -> str:
    return full_sql(agg, "y", n, f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING")


@query(
    "win17_lag_rolling_lagged",
    f"{FILLED} SELECT series, ds, y, "
    + ", ".join(f"lag(y, {k}) OVER ({W}) AS lag_{k}" for k in (1, 7, 30)) + ", "
    + ", ".join(f"{_past(SQL_STATS[s], n)} AS past_{s}_{n}" for n in (7, 30) for s in ("mean", "std"))
    + " FROM filled",
    num="y lag_1 lag_7 lag_30 past_mean_7 past_std_7 past_mean_30 past_std_30",
)
def _(spark, sf):
    return _over(spark, sf, Wn.lagged_rolling())


def trend_sql(period: int) -> str:
    h = period // 2
    if period % 2:
        return full_sql("avg", "y", period, f"ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING")
    inner = full_sql("sum", "y", period - 1, f"ROWS BETWEEN {h - 1} PRECEDING AND {h - 1} FOLLOWING")
    return f"({inner} + (lag(y, {h}) OVER ({W}) + lag(y, -{h}) OVER ({W})) / 2) / {period}"


for _p in (365, 12):

    @query(
        f"win18_trend_component_{_p}",
        f"{FILLED} SELECT series, ds, {trend_sql(_p)} AS trend FROM filled",
        num="trend",
    )
    def _(spark, sf, p=_p):
        return _over(spark, sf, Wn.trend_component(p)).select("series", "ds", "trend")


@query(
    "win19_head_tail_split",
    f"""{FILLED} SELECT series, ds, y, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY ds DESC) <= 60
    THEN 'test' ELSE 'train' END AS role FROM filled""",
    num="y",
)
def _(spark, sf):
    return head_tail_split(filled(spark, sf), KEYS, 60)


@query(
    "win_all_suppliers",
    f"""{SUPPLIER_FILLED}, {CHANGES} SELECT series, ds, y, lag(y, 365) OVER ({W}) AS lag_365,
    {full_sql('avg', 'y', 30)} AS rolling_mean_30, {full_sql('max', 'y', 90)} AS rolling_max_90,
    pct_change, {z_sql(30)} AS zscore_30 FROM changed""",
    num="y lag_365 rolling_mean_30 rolling_max_90 pct_change zscore_30",
    digits={"y": 2, "lag_365": 2, "rolling_mean_30": 2, "rolling_max_90": 2},
)
def _(spark, sf):
    grid = fill_grid(supplier_daily(spark, sf), KEYS).drop("real_value")
    return over_blocks(
        grid, KEYS, Wn.lag_features((365,)), Wn.rolling((30, 90), ("mean", "max")), Wn.changes(),
        Wn.rolling_zscore((30,)),
    ).select("series", "ds", "y", "lag_365", "rolling_mean_30", "rolling_max_90", "pct_change", "zscore_30")
