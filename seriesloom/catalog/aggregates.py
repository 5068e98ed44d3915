"""Aggregates per series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from ..operators.anomaly import zscore_anomalies
from ..operators.blocks import over_blocks
from ..operators.decompose import decompose, decompose_strength, seasonal_component
from ..operators.profile import date_range
from ..operators.windows import changes
from .base import FILLED, KEYS, PANEL, W, filled, panel, query
from .windows import CHANGES, YEARLY, trend_sql, z_sql

STATS5 = 'count(y) AS "count", avg(y) AS mean, stddev_samp(y) AS std, min(y) AS min, max(y) AS max'
MS = "avg(y) AS mean, stddev_samp(y) AS std"


@query(
    "agg1_yearly_stats",
    f"{FILLED} SELECT series, year(ds) AS year, {STATS5} FROM filled GROUP BY 1, 2",
    num="mean std min max",
)
def _(spark, sf):
    return S.yearly_stats(filled(spark, sf), KEYS)


@query(
    "agg2_dow_stats",
    f"{FILLED} SELECT series, isodow(ds) - 1 AS day_of_week, {MS} FROM filled GROUP BY 1, 2",
    num="mean std",
)
def _(spark, sf):
    return S.dow_stats(filled(spark, sf), KEYS)


@query(
    "agg3_month_stats",
    f"""{FILLED} SELECT series, month(ds) AS month, strftime(ds, '%b') AS month_name, {MS}, count(y) AS "count"
    FROM filled GROUP BY 1, 2, 3""",
    num="mean std",
)
def _(spark, sf):
    return S.month_stats(filled(spark, sf), KEYS)


@query(
    "agg4_week_stats",
    f"{FILLED} SELECT series, week(ds) AS iso_week, {MS} FROM filled GROUP BY 1, 2",
    num="mean std",
)
def _(spark, sf):
    return S.week_stats(filled(spark, sf), KEYS)


@query(
    "agg5_dom_stats",
    f"{FILLED} SELECT series, day(ds) AS day_of_month, {MS} FROM filled GROUP BY 1, 2",
    num="mean std",
)
def _(spark, sf):
    return S.dom_stats(filled(spark, sf), KEYS)


@query(
    "agg6_quarterly_avg",
    f"""{FILLED} SELECT series, year(ds) AS year, quarter(ds) AS quarter, avg(y) AS mean,
    CAST(year(ds) AS VARCHAR) || '-Q' || CAST(quarter(ds) AS VARCHAR) AS period FROM filled GROUP BY 1, 2, 3, 5""",
    num="mean",
)
def _(spark, sf):
    return S.quarterly_avg(filled(spark, sf), KEYS)


@query(
    "agg7_monthly_range",
    f"{FILLED} SELECT series, month(ds) AS month, max(y) - min(y) AS range_y FROM filled GROUP BY 1, 2",
    num="range_y",
)
def _(spark, sf):
    return S.monthly_range(filled(spark, sf), KEYS)


def _grain(name: str, **fields: str) -> str:
    cols = ", ".join(
        f"{fields.get(c, 'CAST(NULL AS BIGINT)')} AS {c}"
        for c in ("year", "quarter", "month", "iso_week", "day_of_week", "day_of_month")
    )
    by = ", ".join(["series", *fields.values()])
    return f"SELECT series, '{name}' AS grain, {cols}, {STATS5} FROM filled GROUP BY {by}"


@query(
    "agg8_calendar_rollup",
    f"{FILLED} "
    + " UNION ALL ".join(
        [
            _grain("year", year="year(ds)"),
            _grain("day_of_week", day_of_week="(isodow(ds) - 1)"),
            _grain("month", month="month(ds)"),
            _grain("iso_week", iso_week="week(ds)"),
            _grain("day_of_month", day_of_month="day(ds)"),
            _grain("quarter", year="year(ds)", quarter="quarter(ds)"),
        ]
    ),
    num="mean std min max",
)
def _(spark, sf):
    return S.calendar_rollup(filled(spark, sf), KEYS)


WEEKEND = """weekend AS (
  SELECT series, avg(y) FILTER (isodow(ds) < 6) AS weekday_mean, avg(y) FILTER (isodow(ds) >= 6) AS weekend_mean
  FROM filled GROUP BY series)"""


@query(
    "agg9_weekend_split",
    f"{FILLED}, {WEEKEND} SELECT *, (weekend_mean / weekday_mean - 1) * 100 AS weekend_premium_pct FROM weekend",
    num="weekday_mean weekend_mean weekend_premium_pct",
)
def _(spark, sf):
    return S.weekend_split(filled(spark, sf), KEYS)


PRICE = """SELECT series, avg(y) AS mean, quantile_cont(y, 0.5) AS median, min(y) AS min, max(y) AS max,
  stddev_samp(y) AS std, stddev_samp(y) / avg(y) * 100 AS cv_pct FROM filled GROUP BY series"""


@query("agg10_price_summary", f"{FILLED} {PRICE}", num="mean median min max std cv_pct")
def _(spark, sf):
    return S.price_summary(filled(spark, sf), KEYS)


GROWTH = """SELECT series, first_mean, last_mean, years_span, (last_mean / first_mean - 1) * 100 AS total_growth_pct,
  (pow(last_mean / first_mean, 1.0 / years_span) - 1) * 100 AS cagr_pct
  FROM (SELECT series, arg_min(mean_y, year) AS first_mean, arg_max(mean_y, year) AS last_mean,
    max(year) - min(year) AS years_span FROM yearly GROUP BY series) WHERE years_span > 0"""


@query(
    "agg11_growth_cagr",
    f"{FILLED}, {YEARLY} {GROWTH}",
    num="first_mean last_mean total_growth_pct cagr_pct",
    ints="years_span",
)
def _(spark, sf):
    return S.growth_cagr(filled(spark, sf), KEYS)


@query(
    "agg12_peak_trough_month",
    f"""{FILLED}, months AS (SELECT series, month(ds) AS month, avg(y) AS m FROM filled GROUP BY 1, 2)
    SELECT series, arg_max(month, m) AS peak_month, max(m) AS peak_mean, arg_min(month, m) AS trough_month,
      min(m) AS trough_mean, (max(m) - min(m)) / avg(m) * 100 AS seasonal_variation_pct
    FROM months GROUP BY series""",
    num="peak_mean trough_mean seasonal_variation_pct",
)
def _(spark, sf):
    return S.peak_trough_month(filled(spark, sf), KEYS)


@query(
    "agg13_daily_volatility",
    f"""{FILLED}, {CHANGES} SELECT series, stddev_samp(pct_change) * 100 AS daily_volatility_pct,
    avg(volatility_7) * 100 AS weekly_volatility_pct FROM changed GROUP BY series""",
    num="daily_volatility_pct weekly_volatility_pct",
)
def _(spark, sf):
    return S.daily_volatility(over_blocks(filled(spark, sf), KEYS, changes()), KEYS)


@query(
    "agg14_volatility_class",
    f"""{FILLED}, {WEEKEND}, cvs AS (SELECT series, stddev_samp(y) / avg(y) AS cv FROM filled GROUP BY series)
    SELECT c.series, c.cv, (w.weekend_mean / w.weekday_mean - 1) * 100 AS weekend_premium_pct,
      CASE WHEN c.cv * 100 < 10 THEN 'stable' WHEN c.cv * 100 < 20 THEN 'moderate' ELSE 'high' END AS stability,
      CASE WHEN c.cv < 0.1 THEN 'low' WHEN c.cv < 0.3 THEN 'moderate' ELSE 'high' END AS volatility,
      abs((w.weekend_mean / w.weekday_mean - 1) * 100) > 5 AS strong_weekend
    FROM cvs c JOIN weekend w ON w.series = c.series""",
    num="cv weekend_premium_pct",
)
def _(spark, sf):
    return S.volatility_class(filled(spark, sf), KEYS)


QUARTILES = """quartiles AS (
  SELECT series, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM filled GROUP BY series),
fences AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence FROM quartiles)"""


@query(
    "agg15_quartiles_iqr",
    f"{FILLED}, {QUARTILES} SELECT * FROM fences",
    num="q1 q3 iqr low_fence high_fence",
)
def _(spark, sf):
    return S.quartiles_iqr(filled(spark, sf), KEYS)


def _box_sql(groups: dict[str, str]) -> str:
    named = ", ".join(f"{e} AS {n}" for n, e in groups.items())
    by = ", ".join(groups)
    on = " AND ".join(f"v.{n} = b.{n}" for n in groups)
    return f"""{FILLED}, v AS (SELECT {named}, y FROM filled),
    b AS (SELECT {by}, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.75) AS q3,
      min(y) AS min, max(y) AS max FROM v GROUP BY {by})
    SELECT {', '.join(f'b.{n}' for n in groups)}, b.q1, b.median, b.q3, b.min, b.max,
      min(v.y) FILTER (v.y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
      max(v.y) FILTER (v.y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high
    FROM v JOIN b ON {on} GROUP BY ALL"""


BOX = "q1 median q3 min max whisker_low whisker_high"


@query("agg16_boxplot_overall", _box_sql({"series": "series"}), num=BOX)
def _(spark, sf):
    return S.boxplot_stats(filled(spark, sf), KEYS)


@query("agg16_boxplot_by_year", _box_sql({"series": "series", "year": "year(ds)"}), num=BOX)
def _(spark, sf):
    return S.boxplot_stats(filled(spark, sf).withColumn("year", F.year("ds")), ["series", "year"])


@query(
    "agg16_boxplot_weekend",
    _box_sql({"series": "series", "is_weekend": "CAST(isodow(ds) >= 6 AS BIGINT)"}),
    num=BOX,
)
def _(spark, sf):
    rows = filled(spark, sf).withColumn("is_weekend", (F.weekday("ds") >= 5).cast("int"))
    return S.boxplot_stats(rows, ["series", "is_weekend"])


def _hist_sql(source: str, col: str, bins: int) -> str:
    return f"""SELECT v.series, CAST(least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) AS bin,
    count(*) AS "count" FROM {source} v
    JOIN (SELECT series, min({col}) AS lo, max({col}) AS hi FROM {source} GROUP BY series) s ON s.series = v.series
    WHERE {col} IS NOT NULL GROUP BY 1, 2"""


for _bins in (20, 50):

    @query(f"agg17_histogram_{_bins}", f"{FILLED} {_hist_sql('filled', 'y', _bins)}")
    def _(spark, sf, bins=_bins):
        return S.histogram(filled(spark, sf), KEYS, bins)


@query("agg17_histogram_changes", f"{FILLED}, {CHANGES} {_hist_sql('changed', 'change', 50)}")
def _(spark, sf):
    return S.histogram(over_blocks(filled(spark, sf), KEYS, changes()), KEYS, 50, col="change")


@query(
    "agg20_anomaly_rate",
    f"""{FILLED}, z AS (SELECT series, coalesce(abs({z_sql(30)}) > 3, FALSE) AS flag FROM filled)
    SELECT series, count(*) AS row_count, count(*) FILTER (flag) AS anomalies,
      avg(CASE WHEN flag THEN 1 ELSE 0 END) * 100 AS anomaly_pct FROM z GROUP BY series""",
    num="anomaly_pct",
)
def _(spark, sf):
    return S.anomaly_rate(zscore_anomalies(filled(spark, sf), KEYS), KEYS, "is_anomaly_zscore")


@query(
    "agg21_target_stats",
    f"""{FILLED} SELECT series, count(y) AS samples, 19 AS features, min(y) AS min, max(y) AS max, avg(y) AS mean,
    stddev_samp(y) AS std FROM filled GROUP BY series""",
    num="min max mean std",
    ints="features",
)
def _(spark, sf):
    return S.target_stats(filled(spark, sf), KEYS, 19)


@query(
    "agg22_forecast_stats",
    f"""{FILLED}, f AS (SELECT series, lag(y, 7) OVER ({W}) AS forecast FROM filled)
    SELECT series, count(forecast) AS points, min(forecast) AS min, max(forecast) AS max, avg(forecast) AS mean,
      stddev_pop(forecast) AS std FROM f GROUP BY series""",
    num="min max mean std",
)
def _(spark, sf):
    from .models import naive_predictions

    naive = naive_predictions(spark, sf).withColumnRenamed("rf_prediction", "forecast")
    return S.forecast_stats(naive, KEYS)


TREND = f"""trended AS (
  SELECT series, ds, y, {trend_sql(365)} AS trend,
    (row_number() OVER ({W}) - 1) % 365 AS phase, count(*) OVER (PARTITION BY series) AS n FROM filled),
detrended AS (SELECT series, phase, avg(y - trend) AS m FROM trended WHERE n >= 730 GROUP BY 1, 2),
seasons AS (SELECT series, phase, m - avg(m) OVER (PARTITION BY series) AS seasonal FROM detrended),
components AS (
  SELECT t.series, t.ds, t.y, CASE WHEN n >= 730 THEN trend END AS trend, s.seasonal,
    CASE WHEN n >= 730 THEN t.y - trend - s.seasonal END AS residual
  FROM trended t LEFT JOIN seasons s ON s.series = t.series AND s.phase = t.phase)"""


@query("agg23_seasonal_component", f"{FILLED}, {TREND} SELECT * FROM seasons", num="seasonal")
def _(spark, sf):
    return seasonal_component(filled(spark, sf), KEYS)


@query(
    "agg24_decompose_strength",
    f"""{FILLED}, {TREND} SELECT series, 1 - var_pop(residual) / var_pop(trend + residual) AS trend_strength,
    1 - var_pop(residual) / var_pop(seasonal + residual) AS seasonal_strength FROM components GROUP BY series""",
    num="trend_strength seasonal_strength",
)
def _(spark, sf):
    return decompose_strength(decompose(filled(spark, sf), KEYS), KEYS)


@query(
    "agg25_distinct_count",
    f"WITH {PANEL} SELECT series, count(DISTINCT year(ds)) AS years FROM panel GROUP BY series",
)
def _(spark, sf):
    return date_range(panel(spark, sf), KEYS).select("series", "years")
