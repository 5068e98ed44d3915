"""Evaluation, blending, scoring and fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import TIME_FEATURES
from ..operators import additive as Ad
from ..operators import blend as B
from ..operators import evaluate as E
from ..operators import trees as T
from ..operators.blocks import over_blocks
from ..operators.grid import future_frame
from ..operators.importance import feature_union_lookup, top_features
from ..operators.linear import coefficient_table, linear_fit
from ..operators.windows import lag_features, rolling
from ..plans import ensemble as En
from ..plans import voting
from ..session import materialize, scratch_path
from ..sources.models import load_models, save_models
from ..sources.panel import table
from ..sources.sinks import export_training_data, write_forecast, write_scored
from .base import FILLED, KEYS, PANEL, SPINE, W, filled, full_sql, panel, query
from .features import BASE_SQL, FEATURED, WAVES_SQL, featured

# Lagged values serve as predictions where an operator takes any forecast:
# yesterday, the same day last week, and the mean of the last week.
NAIVE = f"""naive AS (
  SELECT series, ds, y, lag(y) OVER ({W}) AS linear_prediction, lag(y, 7) OVER ({W}) AS rf_prediction,
    {full_sql('avg', 'y', 7)} AS gbt_prediction FROM filled)"""


def naive_predictions(spark, sf):
    wide = over_blocks(filled(spark, sf), KEYS, lag_features((1, 7)), rolling((7,), ("mean",)))
    return wide.withColumnsRenamed(
        {"lag_1": "linear_prediction", "lag_7": "rf_prediction", "rolling_mean_7": "gbt_prediction"}
    )


LONG = " UNION ALL ".join(
    f"SELECT series, ds, y, '{m}' AS model, {m}_prediction AS yhat FROM naive" for m in B.MODELS
)


def naive_long(spark, sf):
    long = naive_predictions(spark, sf).unpivot(
        ["series", "ds", "y"], [f"{m}_prediction" for m in B.MODELS], "model", "yhat"
    )
    return long.withColumn("model", F.regexp_replace("model", "_prediction$", ""))


# -- splits and metrics ------------------------------------------------------

TEST60 = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ds DESC) AS back FROM naive)"""


@query(
    "jn3_forecast_actual_join",
    f"""{FILLED}, {NAIVE}, {TEST60} SELECT r.series, r.ds, r.y, n.rf_prediction AS yhat FROM ranked r
    LEFT JOIN naive n ON n.series = r.series AND n.ds = r.ds WHERE r.back <= 60""",
    num="y yhat",
)
def _(spark, sf):
    test = E.head_tail_split(filled(spark, sf), KEYS, 60).where("role = 'test'").drop("role")
    forecast = naive_predictions(spark, sf).select("series", "ds", F.col("rf_prediction").alias("yhat"))
    return E.forecast_actual_join(test, forecast, KEYS)


@query(
    "ev1_regression_metrics",
    f"""{FILLED}, {NAIVE}, long AS ({LONG}) SELECT series, model, avg(abs(y - yhat)) AS mae,
    avg(abs((y - yhat) / nullif(y, 0))) * 100 AS mape, sqrt(avg((y - yhat) * (y - yhat))) AS rmse
    FROM long GROUP BY series, model""",
    num="mae mape rmse",
)
def _(spark, sf):
    return E.regression_metrics(naive_long(spark, sf), ["series", "model"])


FIT = """1 - avg((y - yhat) * (y - yhat)) / nullif(var_pop(y), 0) AS r2, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
  avg(abs(y - yhat)) AS mae"""


@query(
    "ev2_r2_mse_mae",
    f"""{FILLED}, {NAIVE}, long AS ({LONG}) SELECT series, model, {FIT} FROM long
    WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY series, model""",
    num="r2 rmse mae",
)
def _(spark, sf):
    return E.fit_metrics(naive_long(spark, sf), ["series", "model"])


FOLDS = f"""placed AS (
  SELECT series, ds, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY series) AS n FROM filled),
folds AS (
  SELECT p.series, p.ds, k.fold,
    CASE WHEN pos < n - (5 - k.fold + 1) * (n // 6) THEN 'train' ELSE 'test' END AS role
  FROM placed p, range(1, 6) AS k(fold) WHERE pos < n - (5 - k.fold) * (n // 6))"""


@query("ev3_time_series_split", f"{FILLED}, {FOLDS} SELECT * FROM folds")
def _(spark, sf):
    return E.time_series_split(filled(spark, sf), KEYS, 5)


CV = f"""{FILLED}, {NAIVE}, long AS ({LONG}), {FOLDS},
per_fold AS (
  SELECT l.series, l.model, f.fold, {FIT} FROM long l
  JOIN folds f ON f.series = l.series AND f.ds = l.ds AND f.role = 'test'
  WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2, 3),
scores AS (
  SELECT series, model, avg(rmse) AS cv_rmse_mean, stddev_pop(rmse) AS cv_rmse_std, avg(r2) AS cv_r2_mean,
    stddev_pop(r2) AS cv_r2_std, avg(mae) AS cv_mae_mean, stddev_pop(mae) AS cv_mae_std
  FROM per_fold GROUP BY series, model)"""


def _naive_cv(spark, sf):
    folds = E.fold_segments(filled(spark, sf).select("series", "ds"), KEYS, 5)
    folds = folds.where("segment > 0").withColumnRenamed("segment", "fold")
    return E.cv_scores(naive_long(spark, sf).join(folds, ["series", "ds"]), ["series", "model"])


@query(
    "ev4_cv_scores", f"{CV} SELECT * FROM scores",
    num="cv_rmse_mean cv_rmse_std cv_r2_mean cv_r2_std cv_mae_mean cv_mae_std",
)
def _(spark, sf):
    return _naive_cv(spark, sf)


@query(
    "ev7_model_ranking",
    f"""{CV}, r AS (SELECT series, model, cv_rmse_mean,
      row_number() OVER (PARTITION BY series ORDER BY cv_rmse_mean, model) AS rank FROM scores)
    SELECT *, rank = 1 AS is_best FROM r""",
    num="cv_rmse_mean",
)
def _(spark, sf):
    return E.model_ranking(_naive_cv(spark, sf), KEYS)


CUTOFFS = f"""{SPINE}, cutoffs AS (
  SELECT series, lo, hi, hi - 60 - CAST(30 * i AS INTEGER) AS cutoff FROM bounds, range(0, 1000) AS r(i)
  WHERE hi - 60 - CAST(30 * i AS INTEGER) >= lo + 180)"""


@query("ev5_cutoffs", f"WITH {PANEL}, {CUTOFFS} SELECT * FROM cutoffs")
def _(spark, sf):
    return E.cutoffs(panel(spark, sf), KEYS, 180, 30, 60)


ORIGINS = f"""{FILLED}, cutoffs AS (
  SELECT series, hi - 60 - CAST(30 * i AS INTEGER) AS cutoff FROM bounds, range(0, 1000) AS r(i)
  WHERE hi - 60 - CAST(30 * i AS INTEGER) >= lo + 180),
origins AS (
  SELECT f.series, f.ds, f.y, c.cutoff FROM filled f
  JOIN cutoffs c ON c.series = f.series AND f.ds > c.cutoff AND f.ds <= c.cutoff + 60)"""


@query("ev5_rolling_origin_membership", f"{ORIGINS} SELECT * FROM origins", num="y")
def _(spark, sf):
    return E.rolling_origin_membership(filled(spark, sf), KEYS, 180, 30, 60)


# The value at the cutoff as forecast, with a band of +-40 %.
@query(
    "ev6_horizon_metrics",
    f"""{ORIGINS}, scored AS (
      SELECT o.series, date_diff('day', o.cutoff, o.ds) AS h, o.y, f.y AS yhat, f.y * 0.6 AS lo, f.y * 1.4 AS hi
      FROM origins o JOIN filled f ON f.series = o.series AND f.ds = o.cutoff),
    days AS (SELECT series, h, count(*) AS n FROM scored GROUP BY 1, 2),
    span AS (SELECT series, max(h) AS last, greatest(floor(sum(n) * 0.1), 1) / max(n) AS width FROM days GROUP BY 1),
    windowed AS (
      SELECT s.*, t.h2 AS horizon,
        CASE WHEN t.h2 - s.h = ceil(p.width) - 1 THEN p.width - ceil(p.width) + 1 ELSE 1.0 END AS w
      FROM scored s JOIN span p ON p.series = s.series, range(1, 61) AS t(h2)
      WHERE t.h2 >= s.h AND t.h2 < s.h + ceil(p.width) AND t.h2 >= ceil(p.width) AND t.h2 <= p.last)
    SELECT series, horizon, sum(w * (y - yhat) * (y - yhat)) / sum(w) AS mse, sum(w * abs(y - yhat)) / sum(w) AS mae,
      sum(w * abs((y - yhat) / nullif(y, 0))) / sum(w) AS mape,
      sum(w * 2 * abs(y - yhat) / nullif(abs(y) + abs(yhat), 0)) / sum(w) AS smape,
      sum(w * CASE WHEN y BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END) / sum(w) AS coverage,
      quantile_cont(abs((y - yhat) / nullif(y, 0)), 0.5) AS mdape,
      sqrt(sum(w * (y - yhat) * (y - yhat)) / sum(w)) AS rmse
    FROM windowed GROUP BY series, horizon""",
    num="mse mae mape smape coverage mdape rmse",
    digits={"mse": 0, "rmse": 3},
)
def _(spark, sf):
    grid = filled(spark, sf)
    tests = E.rolling_origin_membership(grid, KEYS, 180, 30, 60)
    at_cutoff = grid.select("series", F.col("ds").alias("cutoff"), F.col("y").alias("yhat"))
    scored = tests.join(at_cutoff, ["series", "cutoff"]).withColumns(
        {"yhat_lower": F.col("yhat") * 0.6, "yhat_upper": F.col("yhat") * 1.4}
    )
    return E.horizon_metrics(scored, KEYS)


# -- blending and scoring of given predictions -------------------------------


def _blend_sql(weights) -> str:
    return " + ".join(f"{m}_prediction * {w}" for m, w in weights.items())


@query(
    "md6_weighted_blend",
    f"{FILLED}, {NAIVE} SELECT *, {_blend_sql(B.FINAL_WEIGHTS)} AS forecast FROM naive",
    num="y linear_prediction rf_prediction gbt_prediction forecast",
)
def _(spark, sf):
    return B.weighted_blend(naive_predictions(spark, sf), B.FINAL_WEIGHTS)


@query(
    "sc3_weight_sweep",
    f"{FILLED}, {NAIVE} "
    + " UNION ALL ".join(
        f"SELECT series, ds, '{n}' AS config, {_blend_sql(w)} AS forecast FROM naive"
        for n, w in B.WEIGHT_SETS.items()
    ),
    num="forecast",
)
def _(spark, sf):
    return B.weight_sweep(naive_predictions(spark, sf), KEYS)


NEXT_WEEK = f"""{FILLED}, {NAIVE}, fc AS (
  SELECT series, CAST(ds + 7 AS DATE) AS ds, linear_prediction, rf_prediction, gbt_prediction,
    {_blend_sql(B.FINAL_WEIGHTS)} AS forecast FROM naive)"""


def _shifted(spark, sf):
    """Blended predictions dated a week ahead, so that some lie after the history."""
    blended = B.weighted_blend(naive_predictions(spark, sf), B.FINAL_WEIGHTS)
    return blended.withColumn("ds", F.date_add("ds", 7)).drop("y")


@query(
    "sc4_history_forecast_series",
    f"""{NEXT_WEEK}, long AS (SELECT series, ds, 'history' AS kind, y AS value FROM filled """
    + " ".join(
        f"UNION ALL SELECT series, ds, '{c}', {c} FROM fc"
        for c in ("forecast", "linear_prediction", "rf_prediction", "gbt_prediction")
    )
    + """) SELECT l.*, l.ds > b.hi AS is_forecast FROM long l JOIN bounds b ON b.series = l.series""",
    num="value",
)
def _(spark, sf):
    return B.history_forecast_series(filled(spark, sf), _shifted(spark, sf), KEYS)


@query(
    "snk1_write_forecast",
    f'{NEXT_WEEK} SELECT series, ds AS "Date", forecast AS "Price" FROM fc',
    num='"Price"',
)
def _(spark, sf):
    path = write_forecast(_shifted(spark, sf), scratch_path(spark, "forecast"), KEYS)
    return spark.read.schema("series string, Date date, Price double").option("header", True).csv(path)


@query(
    "snk2_write_scored",
    f"{NEXT_WEEK} SELECT * FROM fc",
    num="linear_prediction rf_prediction gbt_prediction forecast",
)
def _(spark, sf):
    scored = _shifted(spark, sf)
    path = write_scored(scored, scratch_path(spark, "scored"))
    return spark.read.schema(scored.schema).parquet(path)


RAW = ["year", "month_sin", "dayofyear_cos", "day_of_month"]


@query(
    "snk3_export_training_data",
    f"{FEATURED} SELECT series, {', '.join(RAW)}, y FROM featured",
    num="month_sin dayofyear_cos y",
    ints="year day_of_month",
)
def _(spark, sf):
    paths = export_training_data(featured(spark, sf), KEYS, RAW, scratch_path(spark, "export"))
    return spark.read.parquet(paths[1])


@query(
    "snk3_export_features", f"{FEATURED} SELECT * FROM featured",
    num=" ".join(["y", *WAVES_SQL]), ints=" ".join(BASE_SQL),
)
def _(spark, sf):
    paths = export_training_data(featured(spark, sf), KEYS, RAW, scratch_path(spark, "export"))
    return spark.read.parquet(paths[0])


@query(
    "md9_future_frame",
    f"""WITH {PANEL}, {SPINE} SELECT series, ds FROM panel
    UNION ALL SELECT series, hi + CAST(i AS INTEGER) FROM bounds, range(1, 31) AS r(i)""",
)
def _(spark, sf):
    return future_frame(panel(spark, sf), KEYS, 30)


# -- fitted models -----------------------------------------------------------

#: Models of the orders panel at the default folds, search and grids, by session and table folder.  Queries
#: that read a saved model share it, as jobs share what a nightly run has saved.
MODELS: dict[tuple[str, str], str] = {}


def saved_models(spark, sf) -> str:
    """Path of the saved ensemble of the orders panel, trained by the first query that asks."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in MODELS:
        MODELS[key] = save_models(En.train(panel(spark, sf), KEYS), scratch_path(spark, "models"))
    return MODELS[key]


@query("snk4_model_save", "SELECT 'series' AS keys, 'rf,gbt' AS models")
def _(spark, sf):
    saved = spark.read.parquet(f"{saved_models(spark, sf)}/metadata")
    return saved.select(F.array_join("keys", ",").alias("keys"), F.array_join("models", ",").alias("models"))


@query("src2_model_load", f'{FILLED} SELECT series, lo AS "start", hi AS last, FALSE AS no_features FROM bounds')
def _(spark, sf):
    ensemble = load_models(spark, saved_models(spark, sf))
    return ensemble.facts.select("series", "start", "last", (F.size("features") == 0).alias("no_features"))


@query("md1_linear_fit")
def _(spark, sf):
    fits = linear_fit(featured(spark, sf), KEYS, TIME_FEATURES)
    return top_features(coefficient_table(fits, KEYS), KEYS, 5)


def _fold_frames(spark, sf) -> T.FoldFrames:
    cfg = En.EnsembleConfig()
    rows = En._with_fold_scales(
        En.training_frame(panel(spark, sf), KEYS, cfg), KEYS, cfg.folds, cfg.block_days
    )
    data = materialize(rows.where("segment is not null"), "folds")
    return T.FoldFrames(data, En.pooled_selection(data, cfg))


def _fitted(spark, sf, algorithm, params):
    """Predictions on the last fold of a model fitted on all earlier ones."""
    frames = _fold_frames(spark, sf)
    model = T.ESTIMATORS[algorithm](**params).fit(frames.train(frames.folds))
    return T.predict_fold(frames, model, frames.folds, KEYS)


@query("md2_forest_fit")
def _(spark, sf):
    return _fitted(spark, sf, "rf", {"numTrees": 200, "maxDepth": 10})


@query("md3_boosted_fit")
def _(spark, sf):
    return _fitted(spark, sf, "gbt", {"maxIter": 200, "stepSize": 0.1, "maxDepth": 5})


def _searched(spark, sf, algorithm, grid):
    found = T.param_search(_fold_frames(spark, sf), algorithm, T.grid_points(grid, En.EnsembleConfig().n_iter))
    rows = [(a, str(sorted(p.items())), f, loss, p == found.params) for a, p, f, loss in found.scores]
    return spark.createDataFrame(rows, "model string, params string, fold int, mse double, best boolean")


@query("md4_importances")
def _(spark, sf):
    scores = En.importances(load_models(spark, saved_models(spark, sf)))
    return feature_union_lookup(scores, list(B.MODELS))


@query("md5_param_search")
def _(spark, sf):
    return _searched(spark, sf, "gbt", T.BOOSTED_GRID)


@query("md5_forest_search")
def _(spark, sf):
    return _searched(spark, sf, "rf", T.FOREST_GRID)


def blends(scored, weights):
    """Row set of a forecast, and whether it is the weighted sum of its models' predictions."""
    total = sum(F.col(f"{m}_prediction") * w for m, w in weights.items())
    return scored.select("series", "ds", (F.abs(F.col("forecast") - total) < 1e-6).alias("blended"))


def days_sql(first: str, last: str) -> str:
    return f"""WITH {PANEL}, {SPINE} SELECT series, CAST(d AS DATE) AS ds, TRUE AS blended
    FROM bounds, generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY) AS g(d)"""


def _voting(spark, sf):
    return voting.build_and_train(panel(spark, sf), KEYS)


@query("md7_voting_ensemble", days_sql("2002-01-01", "2002-01-03"))
def _(spark, sf):
    scored = voting.vote(*_voting(spark, sf), KEYS, ["2002-01-01", "2002-01-02", "2002-01-03"])
    return blends(scored, B.VOTING_WEIGHTS)


@query("md7_voting_forecast")
def _(spark, sf):
    """The forecasts themselves, of which md7_voting_ensemble checks the blend."""
    return voting.vote(*_voting(spark, sf), KEYS, ["2002-01-01", "2002-01-02", "2002-01-03"])


@query("e8_build_save_reload", days_sql("2002-01-01", "2002-01-31").replace("blended", "same"))
def _(spark, sf):
    model, facts = _voting(spark, sf)
    path = voting.save_voting(model, facts, scratch_path(spark, "voting-model"))
    days = [f"2002-01-{d:02d}" for d in range(1, 32)]
    again = voting.vote(*voting.load_voting(spark, path), KEYS, days).withColumnRenamed("forecast", "reloaded")
    both = voting.vote(model, facts, KEYS, days).join(again, ["series", "ds"])
    return both.select("series", "ds", (F.abs(F.col("forecast") - F.col("reloaded")) < 1e-9).alias("same"))


ADDITIVE = Ad.AdditiveConfig(country_holidays="US")


@query(
    "md8_additive_fit",
    f"""{FILLED} SELECT b.series, b.lo AS "start", b.hi AS last, max(abs(f.y)) AS y_scale, TRUE AS noisy
    FROM bounds b JOIN filled f ON f.series = b.series GROUP BY b.series, b.lo, b.hi""",
    num="y_scale",
)
def _(spark, sf):
    fits = Ad.additive_fit(filled(spark, sf), KEYS, ADDITIVE)
    return fits.select("series", "start", "last", "y_scale", (F.col("sigma") > 0).alias("noisy"))


AHEAD = f"""{FILLED}, dates AS (SELECT series,
  CAST(unnest(generate_series(lo, hi + 44, INTERVAL 1 DAY)) AS DATE) AS ds FROM bounds)"""


@query("md8_changepoints")
def _(spark, sf):
    """Rate of the trend at each changepoint, in units of y a day; most are zero."""
    fits = Ad.additive_fit(filled(spark, sf), KEYS, ADDITIVE)
    rate = fits.select("series", "start", "span", "y_scale", F.posexplode(F.slice("beta", 3, ADDITIVE.changepoints)).alias("changepoint", "b"))
    knots = F.array(*[F.lit(k) for k in ADDITIVE.knots])[F.col("changepoint")]
    day = F.date_add("start", F.floor(knots * F.col("span")).cast("int"))
    return rate.select("series", "changepoint", day.alias("ds"), (F.col("b") * F.col("y_scale") / F.col("span")).alias("rate"))


@query("md10_additive_predict", f"{AHEAD} SELECT series, ds, TRUE AS inside, TRUE AS open FROM dates")
def _(spark, sf):
    fits = Ad.additive_fit(filled(spark, sf), KEYS, ADDITIVE)
    low, high = F.col("yhat_lower"), F.col("yhat_upper")
    return Ad.additive_predict(fits, KEYS, ADDITIVE, 44).select(
        "series", "ds", F.col("yhat").between(low, high).alias("inside"), (low < high).alias("open")
    )


@query("md11_forecast")
def _(spark, sf):
    """Forecast, interval and components, history and 44 days ahead."""
    return Ad.additive_predict(Ad.additive_fit(filled(spark, sf), KEYS, ADDITIVE), KEYS, ADDITIVE, 44)


@query("md11_component_table", f"{AHEAD} SELECT series, ds, TRUE AS adds_up FROM dates")
def _(spark, sf):
    fits = Ad.additive_fit(filled(spark, sf), KEYS, ADDITIVE)
    total = F.col("trend") + F.col("yearly") + F.col("weekly") + F.col("holidays")
    return Ad.additive_predict(fits, KEYS, ADDITIVE, 44).select(
        "series", "ds", (F.abs(total - F.col("yhat")) < 1e-6).alias("adds_up")
    )


@query("ev4_cv_scores_fitted")
def _(spark, sf):
    return load_models(spark, saved_models(spark, sf)).metrics


@query("ev5_rolling_origin_cv", f"{ORIGINS} SELECT series, cutoff, ds, y, TRUE AS inside FROM origins", num="y")
def _(spark, sf):
    rows = Ad.rolling_origin_cv(filled(spark, sf), KEYS, 180, 30, 60, ADDITIVE)
    return rows.select("series", "cutoff", "ds", "y", F.col("yhat").between(F.col("yhat_lower"), F.col("yhat_upper")).alias("inside"))


@query("ev5_rolling_origin_forecasts")
def _(spark, sf):
    return Ad.rolling_origin_cv(filled(spark, sf), KEYS, 180, 30, 60, ADDITIVE)


@query("sc1_forecast")
def _(spark, sf):
    """The forecast and the prediction of every model that sc1_predict_range checks."""
    return En.predict_range(load_models(spark, saved_models(spark, sf)), "2001-01-01", "2002-12-31", B.FINAL_WEIGHTS)


@query("sc1_predict_range", days_sql("2001-01-01", "2002-12-31"))
def _(spark, sf):
    ensemble = load_models(spark, saved_models(spark, sf))
    return blends(En.predict_range(ensemble, "2001-01-01", "2002-12-31", B.FINAL_WEIGHTS), B.FINAL_WEIGHTS)


@query("sc2_predict_from_saved", days_sql("2002-02-01", "2002-02-28"))
def _(spark, sf):
    ensemble = load_models(spark, saved_models(spark, sf))
    weights = {"linear": 0.5, "rf": 0.5}
    return blends(En.predict_range(ensemble, "2002-02-01", "2002-02-28", weights, strict=False), weights)


@query(
    "sc5_batch_predict_dates",
    """SELECT DISTINCT series, ds, TRUE AS blended FROM (
      SELECT o_orderpriority AS series, l_suppkey, max(CAST(l_shipdate AS DATE)) AS ds
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
)
def _(spark, sf):
    # The last shipping day of every supplier, scored for every series it has orders in.
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    dates = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_orderpriority").alias("series"), "l_suppkey")
        .agg(F.max(F.to_date("l_shipdate")).alias("ds"))
        .select("series", "ds")
        .distinct()
    )
    ensemble = load_models(spark, saved_models(spark, sf))
    return blends(B.weighted_blend(En.predict_rows(ensemble, dates), B.FINAL_WEIGHTS), B.FINAL_WEIGHTS)
