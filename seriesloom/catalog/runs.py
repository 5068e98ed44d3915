"""Composite runs and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import TIME_FEATURES
from ..operators.grid import fill_grid
from ..plans import additive, eda, ensemble, forecaster
from ..plans.report import long_report
from ..session import scratch_path
from ..sources.panel import supplier_daily
from .aggregates import BOX, QUARTILES, TREND
from .base import FILLED, KEYS, SQL, SUPPLIER_FILLED, W, filled, panel, query
from .features import CALENDAR_SQL, CORR_Y, FEATURED, featured
from .models import ADDITIVE, saved_models
from .windows import CHANGES, LAGS, SQL_STATS, _rolling_sql, z_sql

# -- all exploratory columns in one frame ------------------------------------

ROLLED = [f"rolling_{s}_{n}" for n in (7, 14, 30, 90) for s in SQL_STATS]
EDA_NUM = [
    "y", *[f"lag_{k}" for k in LAGS], *ROLLED, "change", "pct_change", "volatility_7", "zscore_7",
    "zscore_30", "day_of_year_sin", "day_of_year_cos", "day_of_week_sin", "day_of_week_cos",
]
EDA_INTS = [c for c in CALENDAR_SQL if not c.endswith("_name")]
EDA_SQL = f"""{CHANGES}, eda AS (SELECT series, ds, y, change, pct_change, volatility_7,
  {", ".join(f"lag(y, {k}) OVER ({W}) AS lag_{k}" for k in LAGS)},
  {", ".join(_rolling_sql(s) for s in SQL_STATS)},
  {z_sql(7)} AS zscore_7, {z_sql(30)} AS zscore_30,
  {", ".join(f"{e} AS {n}" for n, e in CALENDAR_SQL.items())},
  sin(2 * pi() * dayofyear(ds) / 365.25) AS day_of_year_sin, cos(2 * pi() * dayofyear(ds) / 365.25) AS day_of_year_cos,
  sin(2 * pi() * (isodow(ds) - 1) / 7) AS day_of_week_sin, cos(2 * pi() * (isodow(ds) - 1) / 7) AS day_of_week_cos
  FROM changed)"""
# Many more rows, so fewer digits that float noise could change.
COARSE = {c: 2 for c in ["y", "change", *ROLLED, *[f"lag_{k}" for k in LAGS]]}


@query(
    "e2_eda_features", f"{FILLED}, {EDA_SQL} SELECT * FROM eda",
    num=" ".join(EDA_NUM), ints=" ".join(EDA_INTS),
)
def _(spark, sf):
    return eda.eda_features(filled(spark, sf), KEYS)


@query(
    "e2_eda_features_suppliers", f"{SUPPLIER_FILLED}, {EDA_SQL} SELECT * FROM eda",
    num=" ".join(EDA_NUM), ints=" ".join(EDA_INTS), digits=COARSE,
)
def _(spark, sf):
    grid = fill_grid(supplier_daily(spark, sf), KEYS, reach=eda.reach()).drop("real_value")
    return eda.eda_features(grid, KEYS)


@query(
    "e1_run_eda",
    f"""{FILLED}, {EDA_SQL}, {QUARTILES}, {TREND}
    SELECT e.*, r.real_value, coalesce(abs(e.zscore_30) > 3, FALSE) AS is_anomaly_zscore,
      e.y < q.low_fence OR e.y > q.high_fence AS is_anomaly_iqr, c.trend, c.seasonal, c.residual
    FROM eda e JOIN fences q ON q.series = e.series
    JOIN components c ON c.series = e.series AND c.ds = e.ds
    JOIN filled r ON r.series = e.series AND r.ds = e.ds""",
    num=" ".join([*EDA_NUM, "trend", "seasonal", "residual"]), ints=" ".join(EDA_INTS),
)
def _(spark, sf):
    return eda.run_eda(panel(spark, sf), KEYS)["frame"]


# -- charts and reports ------------------------------------------------------


EDA_VIEW = f"{FILLED}, {EDA_SQL} SELECT * FROM eda"
CORRELATIONS = " UNION ALL ".join(
    f"SELECT series, '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM eda GROUP BY series" for a in eda.HEATMAP for b in eda.HEATMAP if a != b
)
#: Of every chart table: the columns of its x axis, its values, and the SQL it must equal.
CHARTS = {
    "series": ("ds", "y", SQL["gf1_interpolate_time"]),
    "distribution": ("bin", "count", SQL["agg17_histogram_50"]),
    "by_year": ("year", BOX, SQL["agg16_boxplot_by_year"]),
    "monthly": ("month", "mean std count", SQL["agg3_month_stats"]),
    "weekday": ("day_of_week", "mean std", SQL["agg2_dow_stats"]),
    "moving_averages": ("ds", "y rolling_mean_30 rolling_mean_90", EDA_VIEW),
    "volatility": ("ds", "volatility_7", EDA_VIEW),
    "autocorrelation": ("lag", "acf", SQL["win16_autocorrelation"]),
    "changes": ("bin", "count", SQL["agg17_histogram_changes"]),
    "anomalies": ("ds", "y", f"SELECT * FROM ({SQL['an1_zscore_anomalies']}) WHERE is_anomaly_zscore"),
    "quarterly": ("year quarter", "mean", SQL["agg6_quarterly_avg"]),
    "weekend": ("is_weekend", BOX, SQL["agg16_boxplot_weekend"]),
    "yoy": ("year", "mean_y yoy_growth", SQL["win14_yoy_growth"]),
    "trend": ("ds", "trend", SQL["an5_decompose"]),
    "seasonal": ("ds", "seasonal", SQL["an5_decompose"]),
    "correlation": ("a b", "corr", f"{FILLED}, {EDA_SQL} {CORRELATIONS}"),
    "momentum": ("ds", "momentum", SQL["win13_momentum"]),
    "monthly_range": ("month", "range_y", SQL["agg7_monthly_range"]),
}


def _long(part: str, df, x: str = "", items: str = "", label: str = "chart"):
    """A table as rows (``label``, series, x, item, value); x joins the columns it names."""
    items = items.split() or [f.name for f in df.schema if f.dataType.typeName() in ("double", "long", "integer") and f.name not in (*KEYS, *x.split())]
    place = F.concat_ws(" ", *[F.col(c).cast("string") for c in x.split()]) if x else F.lit(None).cast("string")
    series = F.col("series") if "series" in df.columns else F.lit(None).cast("string").alias("series")
    rows = df.select(series, place.alias("x"), *[F.col(c).cast("double").alias(c) for c in items])
    return rows.unpivot(["series", "x"], items, "item", "value").select(F.lit(part).alias(label), "series", "x", "item", "value")


def _union(parts):
    out = None
    for rows in parts:
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _chart_sql(name: str) -> str:
    x, items, sql = CHARTS[name]
    place = " || ' ' || ".join(f"CAST({c} AS VARCHAR)" for c in x.split())
    return " UNION ALL ".join(
        f"SELECT '{name}' AS chart, series, {place} AS x, '{i}' AS item, CAST(\"{i}\" AS DOUBLE) AS value FROM ({sql}) AS t" for i in items.split()
    )


@query("e3_chart_tables", " UNION ALL ".join(map(_chart_sql, CHARTS)), num="value")
def _(spark, sf):
    found = eda.run_eda(panel(spark, sf), KEYS)
    return _union(_long(name, found[f"chart_{name}"], x, items) for name, (x, items, _) in CHARTS.items())


#: Of every section of the report: its numbers, its texts, and the SQL they must equal.
SECTIONS = {
    "overview": ("days years", "first_ds last_ds", f"""{FILLED} SELECT series, min(ds) AS first_ds, max(ds) AS last_ds, count(*) AS days,
      count(DISTINCT year(ds)) AS years FROM filled GROUP BY series"""),
    "completeness": ("row_count complete_pct", "", f"""{FILLED} SELECT series, count(*) AS row_count,
      count(y) * 100.0 / count(*) AS complete_pct FROM filled GROUP BY series"""),
    "price": ("mean median min max std cv_pct", "", SQL["agg10_price_summary"]),
    "trend": ("years_span first_mean last_mean total_growth_pct cagr_pct", "", SQL["agg11_growth_cagr"]),
    "season": ("peak_month peak_mean trough_month trough_mean seasonal_variation_pct", "", SQL["agg12_peak_trough_month"]),
    "weekend": ("weekday_mean weekend_mean weekend_premium_pct", "", SQL["agg9_weekend_split"]),
    "volatility": ("daily_volatility_pct weekly_volatility_pct", "", SQL["agg13_daily_volatility"]),
    "anomalies": ("row_count anomalies anomaly_pct", "", SQL["agg20_anomaly_rate"]),
    "classes": ("cv weekend_premium_pct", "stability volatility strong_weekend", SQL["agg14_volatility_class"]),
    "direction": ("recent_trend", "direction", SQL["win15_recent_trend"]),
}


def _items(section: str, source: str, numbers: str = "", texts: str = "") -> str:
    rows = [(n, f"CAST({n} AS DOUBLE)", "NULL") for n in numbers.split()]
    rows += [(n, "NULL", f"CAST({n} AS VARCHAR)") for n in texts.split()]
    return " UNION ALL ".join(
        f"SELECT series, '{section}' AS section, '{n}' AS item, {value} AS value, {text} AS text FROM ({source}) AS t"
        for n, value, text in rows
    )


REPORT = " UNION ALL ".join(_items(name, sql, numbers, texts) for name, (numbers, texts, sql) in SECTIONS.items())


@query("snk5_report_table", REPORT, num="value")
def _(spark, sf):
    return long_report(eda.summary_tables(eda.eda_frame(filled(spark, sf), KEYS), KEYS), KEYS)


@query("e1_summary_report", REPORT, num="value")
def _(spark, sf):
    return eda.run_eda(panel(spark, sf), KEYS)["report"]


# -- model runs --------------------------------------------------------------


@query("e4_train")
def _(spark, sf):
    return ensemble.train(panel(spark, sf), KEYS).metrics


@query("e5_train_main")
def _(spark, sf):
    """Everything the run gives, in long form: the report, the sweep of the weights, the forecast, importances."""
    span = forecaster.RunSpan(("1995-01-01", "2003-12-31"), ("2002-02-01", "2002-02-28"))
    out = forecaster.train_main(panel(spark, sf), KEYS, span=span)
    report = out["report"].select(F.concat(F.lit("report "), "section").alias("part"), "series", "item", "value", "text")
    final = _long("final", out["final"], "ds", label="part")
    sweep = _long("sweep", out["sweep"], "config ds", label="part")
    scores = _long("importances", out["importances"], "model feature", "score", "part")
    return _union((report, final, sweep, scores))


@query("e6_analyze_training_data")
def _(spark, sf):
    """All four tables over all 19 features, in long form."""
    found = ensemble.analyze_training_data(featured(spark, sf), KEYS, TIME_FEATURES)
    nobody = F.lit(None).cast("string").alias("series")
    top = found["top_correlations"].select(
        F.lit("top_correlations").alias("part"), "series", "feature", F.col("rank").cast("string").alias("item"), F.col("abs_corr").alias("value")
    )
    stats = found["feature_stats"].unpivot(
        ["feature"], ["mean", "std", "min", "q25", "q50", "q75", "max"], "item", "value"
    ).select(F.lit("feature_stats").alias("part"), nobody, "feature", "item", "value")
    missing = found["missing_values"]
    missing = missing.select(
        F.lit("missing_values").alias("part"), nobody, F.col(missing.columns[0]).alias("feature"), F.lit("missing").alias("item"),
        F.col(missing.columns[1]).cast("double").alias("value"),
    )
    spread = found["distributions"]
    spread = spread.select(
        F.lit("distributions").alias("part"), "series", "feature", F.col("bin").cast("string").alias("item"), F.col("count").cast("double").alias("value")
    )
    return top.unionByName(stats).unionByName(missing).unionByName(spread)


@query(
    "e6_top_correlations",
    f"""{FEATURED}, scored AS ({CORR_Y}) SELECT * FROM (
      SELECT series, feature, abs_corr, row_number() OVER (
        PARTITION BY series ORDER BY abs_corr DESC NULLS LAST, feature) AS rank FROM scored) WHERE rank <= 10""",
    num="abs_corr",
)
def _(spark, sf):
    return ensemble.analyze_training_data(featured(spark, sf), KEYS, TIME_FEATURES)["top_correlations"]


@query("e7_analyze_timeseries")
def _(spark, sf):
    """All five tables of the run, in long form."""
    run = additive.AdditiveRun(periods=44, test_periods=60)
    found = additive.analyze_timeseries(panel(spark, sf), KEYS, run, ADDITIVE)
    axes = {"forecast": "ds", "future": "ds", "test_metrics": "", "cross_validation": "cutoff ds", "cross_validation_metrics": "horizon"}
    return _union(_long(name, found[name], x, label="part") for name, x in axes.items())


@query("e7_holdout_metrics")
def _(spark, sf):
    run = additive.AdditiveRun(periods=44, test_periods=60)
    return additive.analyze_timeseries(panel(spark, sf), KEYS, run, ADDITIVE)["test_metrics"]


@query("e9_load_and_predict")
def _(spark, sf):
    return forecaster.load_and_predict(
        spark, saved_models(spark, sf), "2002-02-01", "2002-02-28", scratch_path(spark, "scored"),
        history=filled(spark, sf),
    )
