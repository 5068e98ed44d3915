import datetime as dt
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.functions.calendar import TIME_FEATURES, with_time_features
from seriesloom.functions.holidays import OwnHoliday
from seriesloom.functions.transformers import ColumnScaler, TimeFeatures, fit_scaler, standard_scale
from seriesloom.operators import additive as Ad
from seriesloom.operators import blend as B
from seriesloom.operators import forests
from seriesloom.operators import trees as T
from seriesloom.operators.boosting import BoostedModel, Spec, Trainer, cell_table, feature_edges
from seriesloom.operators.evaluate import cutoffs, fold_segments, horizon_metrics, model_ranking
from seriesloom.operators.linear import linear_fit, linear_folds
from seriesloom.plans import additive as AdditivePlan
from seriesloom.plans import ensemble as En
from seriesloom.plans import forecaster, voting
from seriesloom.sources.models import load_models, save_models
from seriesloom.sources.sinks import write_forecast
from seriesloom.streaming.score import score_stream, write_scores

K = ["series"]
SMALL = En.EnsembleConfig(
    folds=2,
    n_iter=2,
    forest_grid={"numTrees": [5], "maxDepth": [3, 4]},
    boosted_grid={"maxIter": [3, 6], "stepSize": [0.3], "maxDepth": [3]},
    trees=T.TreeSettings(max_bins=32),
)


@pytest.fixture(scope="module")
def seasonal(spark):
    expr = "100 + 0.05 * t + 10 * sin(2 * pi() * dayofyear(ds) / 365.25) + 3 * (t % 7 = 0)::int"
    expr = expr.replace("(t % 7 = 0)::int", "CAST(weekday(ds) >= 5 AS INT)")
    return spark.sql(
        f"""SELECT series, ds, CAST(scale * ({expr}) AS DOUBLE) AS y FROM (
        SELECT CAST(id AS INT) AS t, date_add(DATE'2015-01-01', CAST(id AS INT)) AS ds FROM range(900))
        JOIN VALUES ('a', 1), ('b', 50) AS s(series, scale)"""
    ).cache()


@pytest.fixture(scope="module")
def trained(seasonal):
    return En.train(seasonal, K, SMALL)


def test_linear_fit_equals_lstsq(seasonal):
    data = with_time_features(seasonal, F.lit("2015-01-01").cast("date"))
    names = ["month_sin", "days_since_start", "day_of_week"]
    fit = {r.series: r for r in linear_fit(data, K, names).collect()}
    rows = data.where("series = 'b'").orderBy("ds").toPandas()
    x = np.column_stack([np.ones(len(rows)), rows[names]])
    want = np.linalg.lstsq(x, rows.y, rcond=None)[0]
    assert np.allclose([fit["b"].intercept, *fit["b"].coef], want, rtol=1e-6)
    assert np.allclose(fit["b"].coef_scaled, want[1:] * rows[names].std(ddof=0), rtol=1e-6)


def test_expanding_folds_equal_separate_fits(seasonal):
    data = fold_segments(with_time_features(seasonal, F.lit("2015-01-01").cast("date")), K, 3)
    names = ["month_sin", "day_of_week"]
    folds = {(r.series, r.fold): r for r in linear_folds(data, K, names, 3).collect()}
    assert set(f for _, f in folds) == {1, 2, 3, 4}
    for fold in (1, 3):
        alone = {r.series: r for r in linear_fit(data.where(F.col("segment") < fold), K, names).collect()}
        for s in "ab":
            assert np.allclose(folds[s, fold].coef, alone[s].coef, rtol=1e-6)


def test_series_alone_gives_the_same_linear_fit(seasonal):
    data = with_time_features(seasonal, F.lit("2015-01-01").cast("date"))
    both = {r.series: r.coef for r in linear_fit(data, K, ["week"]).collect()}
    alone = linear_fit(data.where("series = 'a'"), K, ["week"]).first().coef
    assert np.allclose(both["a"], alone)


def test_collinear_and_constant_columns(daily):
    df = daily("3 * t + 1", 50).selectExpr("*", "day(ds) * 1.0D AS d", "day(ds) * 2.0D AS d2", "1.0D AS c")
    fit = linear_fit(df, K, ["d", "d2", "c"]).first()
    assert all(math.isfinite(c) for c in fit.coef) and fit.coef[2] == 0


def test_column_that_is_constant_in_a_fold_gets_no_weight(daily):
    # The first training rows lie within one year, the test rows beyond it.
    data = with_time_features(daily("100 + t % 7", 1476, "1995-01-01"), F.lit("1995-01-01").cast("date"))
    folds = linear_folds(
        fold_segments(data, K, 5), K, TIME_FEATURES, 5, top_k=10, threshold=0.6
    ).collect()
    first = next(r for r in folds if r.fold == 1)
    weights = dict(zip(first.features, first.coef))
    assert all(weights.get(f, 0) == 0 for f in ("year", "year_sin", "year_cos"))
    assert all(abs(c) < 1e3 for r in folds for c in r.coef)


def plain_boosting(x, z, edges, rounds, rate, depth, penalty=1.0):
    """Rows instead of cells, one node after the other; returns a function of rows and rounds."""
    base, trees, margin = z.mean(), [], np.full(len(z), z.mean())

    def grow(rows, level):
        g, h = (margin - z)[rows].sum(), len(rows)
        best = (1e-6, None)
        for f, cuts in enumerate(edges) if level < depth else ():
            for c in cuts:
                left = rows[x[rows, f] < c]
                if 0 < len(left) < h:
                    gl = (margin - z)[left].sum()
                    gain = gl**2 / (len(left) + penalty) + (g - gl) ** 2 / (h - len(left) + penalty) - g**2 / (h + penalty)
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (f, c))
        if best[1] is None:
            return -rate * g / (h + penalty)
        f, c = best[1]
        return f, c, grow(rows[x[rows, f] < c], level + 1), grow(rows[x[rows, f] >= c], level + 1)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
        return tree

    for _ in range(rounds):
        trees.append(grow(np.arange(len(z)), 0))
        margin = margin + [value(trees[-1], row) for row in x]
    return lambda rows, n: np.array([base + sum(value(t, row) for t in trees[:n]) for row in rows])


def test_boosting_equals_plain_rounds(seasonal):
    frame = En._with_fold_scales(En.training_frame(seasonal, K, SMALL), K, 2, 4096)
    names = ["days_since_start", "day_of_week", "month"]
    frames = T.FoldFrames(frame.cache(), [names[1:], names, names])
    settings = T.TreeSettings(max_bins=32, checkpoint_every=2)
    points = T.grid_points({"maxIter": [2, 5], "stepSize": [0.1, 0.5], "maxDepth": [2, 3]}, 10)
    found = T.param_search(frames, "gbt", points, settings)
    assert len(found.scores) == 16 and set(found.models) == {1, 2, 3}
    columns = sorted(names)
    edges = dict(zip(columns, feature_edges(frame, [F.col(c) for c in columns], 32)))
    for fold, use in ((1, names[1:]), (2, names)):
        rows = frame.select("segment", *use, ((F.col("y") - F.col("mu")[fold - 1]) / F.col("sd")[fold - 1]).alias("z")).toPandas()
        train, test = rows[rows.segment < fold], rows[rows.segment == fold]
        for rate, depth in ((0.1, 2), (0.5, 3)):
            predict = plain_boosting(train[use].to_numpy(float), train.z.to_numpy(), [edges[c] for c in use], 5, rate, depth)
            for n in (2, 5):
                want = ((predict(test[use].to_numpy(float), n) - test.z.to_numpy()) ** 2).mean()
                point = {"maxIter": n, "stepSize": rate, "maxDepth": depth}
                got = next(loss for _, p, f, loss in found.scores if p == point and f == fold)
                assert abs(got - want) < 1e-9
    # Many cells grow level by level over several tasks, to the same trees.
    cells = cell_table(frame, [F.col(c) for c in columns], [edges[c] for c in columns], F.col("segment"), [(F.col("y") - F.col("mu")[1]) / F.col("sd")[1]] * 2)
    trainer = Trainer(cells.cache(), [edges[c] for c in columns], [[0, 1, 2]] * 2, [Spec(2, 0.5, 3), Spec(2, 0.1, 2)])
    (base, one), (again, many) = trainer.grow(5), trainer.grow(5, 2, 100)
    assert np.allclose(base, again) and np.array_equal(one.feature, many.feature) and np.array_equal(one.cut, many.cut)
    assert np.allclose(one.value, many.value, atol=1e-9)
    best = found.params
    for fold in (1, 2):
        scored = found.models[fold].transform(frames.test(fold)).agg(F.avg((F.col("z") - F.col("z_hat")) ** 2)).first()[0]
        assert abs(scored - next(loss for _, p, f, loss in found.scores if p == best and f == fold)) < 1e-9
    assert T.grid_points(T.FOREST_GRID, 10) and len(T.grid_points(T.FOREST_GRID, 3)) == 3


def test_boosted_model_saves_and_explains(spark, tmp_path):
    rows = spark.range(400).selectExpr("id % 20 AS a", "CAST(id % 7 AS DOUBLE) AS b", "1.0D AS c", "IF(id % 20 < 9, 3.0D, -1.0D) AS z")
    data = T.assemble(rows, ["a", "b", "c"]).select("x", "z")
    model = T.boosted(maxIter=30, stepSize=0.3, maxDepth=2).fit(data)
    assert model.transform(data).agg(F.max(F.abs(F.col("z") - F.col("z_hat")))).first()[0] < 0.05
    assert model.featureImportances.toArray().argmax() == 0 and abs(model.featureImportances.toArray().sum() - 1) < 1e-9
    model.write().overwrite().save(str(tmp_path / "b"))
    again = BoostedModel.load(str(tmp_path / "b")).setPredictionCol("other")
    assert again.transform(model.transform(data)).where("other <> z_hat").count() == 0
    with pytest.raises(ValueError):
        T.boosted().fit(data.where("false"))


def test_cells_do_not_grow_with_the_series(spark):
    days = spark.sql("SELECT id AS series, explode(sequence(DATE'2015-01-01', DATE'2016-12-31')) AS ds FROM range(40)")
    rows = with_time_features(days, F.lit("2015-01-01").cast("date")).withColumn("z", F.col("series") * 1.0)
    columns = [F.col(c) for c in TIME_FEATURES]
    cells = cell_table(rows, columns, feature_edges(rows, columns, 400), F.lit(0), [F.col("z")])
    assert cells.count() <= 731 and cells.agg(F.sum(F.col("n")[0])).first()[0] == 40 * 731


def test_training_scores_and_scales(trained):
    scores = {(r.series, r.model): r for r in trained.metrics.collect()}
    assert set(m for _, m in scores) == {"linear", "rf", "gbt"}
    for m in ("linear", "rf", "gbt"):
        # The same shape at 50 times the size: errors scale with it.
        assert abs(scores["b", m].train_rmse / scores["a", m].train_rmse - 50) < 0.5
        assert scores["a", m].train_r2 > 0.8
    assert "stepSize" in scores["a", "gbt"].best_params
    cv = trained.cv_predictions.groupBy("series", "model").agg(F.count_distinct("fold").alias("f")).collect()
    assert all(r.f == 2 for r in cv)


def test_save_load_predict(spark, trained, tmp_path):
    path = save_models(trained, str(tmp_path / "m"))
    loaded = load_models(spark, path)
    want = En.predict_range(trained, "2017-07-01", "2017-07-10").orderBy("series", "ds").collect()
    got = En.predict_range(loaded, "2017-07-01", "2017-07-10").orderBy("series", "ds").collect()
    assert len(got) == 20
    assert all(abs(a.forecast - b.forecast) < 1e-9 for a, b in zip(got, want))
    only = En.predict_range(loaded, "2017-07-01", "2017-07-02", {"linear": 1, "rf": 0, "gbt": 0}).collect()
    assert all(abs(r.forecast - r.linear_prediction) < 1e-9 for r in only)
    dates = En.predict_dates(loaded, ["2017-07-01"]).orderBy("series").collect()
    assert [d.forecast for d in dates] == [r.forecast for r in got if r.ds == dt.date(2017, 7, 1)]
    with pytest.raises(FileNotFoundError):
        load_models(spark, str(tmp_path / "nothing"))
    with pytest.raises(KeyError):
        En.predict_range(loaded, "2017-07-01", "2017-07-02", {"linear": 1})
    loose = En.predict_range(loaded, "2017-07-01", "2017-07-02", {"linear": 1}, strict=False)
    assert loose.where("abs(forecast - linear_prediction) > 1e-9").count() == 0
    empty = En.Ensemble([], [], None, None, {}, {})
    with pytest.raises(ValueError):
        save_models(empty, str(tmp_path / "x"))


def test_stream_scores_like_batch(spark, trained, tmp_path):
    rows = spark.sql("SELECT 'a' AS series, explode(sequence(DATE'2018-01-01', DATE'2018-01-05')) AS ds")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run = write_scores(score_stream(stream, trained), str(tmp_path / "out"), str(tmp_path / "cp"))
    run.awaitTermination(120)
    got = {r.ds: r.forecast for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = En.predict_range(trained, "2018-01-01", "2018-01-05").where("series = 'a'").collect()
    assert len(got) == 5 and all(abs(got[r.ds] - r.forecast) < 1e-9 for r in want)


def test_full_run(spark, seasonal, tmp_path):
    span = forecaster.RunSpan(("2015-01-01", "2017-12-31"), ("2017-07-01", "2017-07-31"))
    out = forecaster.train_main(seasonal, K, SMALL, span, str(tmp_path / "run"))
    assert out["sweep"].count() == 2 * 1096 * len(B.WEIGHT_SETS)
    csv = spark.read.option("header", True).csv(f"{out['path']}/forecast")
    assert csv.columns == ["series", "Date", "Price"] and csv.count() == 62
    assert spark.read.parquet(f"{out['path']}/training_data_raw_features").count() == 1800
    sections = {r.section for r in out["report"].select("section").distinct().collect()}
    assert {"dataset", "best model", "performance rf", "forecast final"} <= sections
    series = forecaster.load_and_predict(
        spark, f"{out['path']}/models", "2017-06-01", "2017-07-02", str(tmp_path / "s"), history=seasonal
    )
    later = series.where("kind = 'forecast' and is_forecast").agg(F.min("ds")).first()[0]
    assert later == dt.date(2017, 6, 19)
    top = out["importances"].groupBy("model").agg(F.sum("score").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-6 for r in top if r.model != "linear")


def test_voting(seasonal):
    model, facts = voting.build_and_train(
        seasonal, K, {"numTrees": 5, "maxDepth": 3}, {"maxIter": 3, "maxDepth": 2, "stepSize": 0.5}, SMALL.trees
    )
    for r in voting.vote(model, facts, K, ["2017-07-01", "2017-07-02"]).collect():
        want = 0.5 * r.gbt_prediction + 0.3 * r.rf_prediction + 0.2 * r.linear_prediction
        assert abs(r.forecast - want) < 1e-9


def test_blend_rules(spark):
    df = spark.sql("SELECT 'a' AS series, DATE'2020-01-01' AS ds, 1.0D AS linear_prediction, 2.0D AS rf_prediction, 6.0D AS gbt_prediction")
    assert B.weighted_blend(df).first().forecast == pytest.approx(3)
    assert B.weighted_blend(df, {"linear": 2, "rf": 0, "gbt": 0}).first().forecast == 2
    assert B.weighted_blend(df, {"linear": 1, "rf": 1, "gbt": 2}, normalized=True).first().forecast == 3.75
    with pytest.raises(ValueError):
        B.blend_column([])


def test_additive_recovers_signal(daily):
    p = daily("100 + 0.05 * t + 10 * sin(2 * pi() * unix_date(ds) / 365.25) + 3 * cos(2 * pi() * unix_date(ds) / 7)", 1500)
    fits = Ad.additive_fit(p, K, size=200)
    out = Ad.additive_predict(fits, K, periods=30)
    assert out.count() == 1530
    both = out.join(p, ["series", "ds"])
    assert both.agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0] < 0.1
    assert both.where("abs(trend + yearly + weekly - yhat) > 1e-9").count() == 0
    width = out.withColumn("w", F.col("yhat_upper") - F.col("yhat_lower")).orderBy(F.desc("ds")).limit(30)
    ws = [r.w for r in width.collect()]
    assert ws[0] >= ws[-1] > 0
    last = both.where("ds = DATE'2015-01-01'").first()
    assert abs(last.weekly - 3 * math.cos(2 * math.pi * 16436 / 7)) < 0.1


def test_additive_holidays(daily):
    p = daily("50 + 20 * CAST(month(ds) = 12 AND day(ds) = 25 AS INT)", 1461)
    cfg = Ad.AdditiveConfig(country_holidays="US")
    out = Ad.additive_predict(Ad.additive_fit(p, K, cfg), K, cfg)
    day = out.where("month(ds) = 12 AND day(ds) = 25").collect()
    assert len(day) == 4 and all(abs(r.yhat - 70) < 1 for r in day)
    with pytest.raises(ValueError):
        Ad.AdditiveConfig(interval_width=2)


def plain_minimum(a, b, weight, steps=200_000):
    """Accelerated proximal gradient steps."""
    x, y, t, size = np.zeros(len(b)), np.zeros(len(b)), 1.0, 1 / np.linalg.eigvalsh(a)[-1]
    for _ in range(steps):
        z = y - size * (a @ y - b)
        fresh = np.sign(z) * np.maximum(np.abs(z) - size * weight, 0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        y, x = fresh + (before - 1) / t * (fresh - x), fresh
    return x


def test_sparse_rates_equal_a_reference_optimiser():
    rng = np.random.default_rng(3)
    t = np.linspace(0, 1, 500)
    x = np.maximum(t[:, None] - np.linspace(0.1, 0.8, 8), 0)
    y = 0.4 * np.maximum(t - 0.4, 0) + 0.02 * rng.normal(size=500)
    a, b = x.T @ x, x.T @ y
    for weight in (1e-3, 0.05, 1.0, 100.0):
        got, want = Ad.sparse_minimum(a, b, weight, np.zeros(8)), plain_minimum(a, b, weight)
        loss = [v @ a @ v / 2 - b @ v + weight * np.abs(v).sum() for v in (got, want)]
        assert loss[0] <= loss[1] + 1e-12 and np.allclose(got, want, atol=1e-4)
    assert not Ad.sparse_minimum(a, b, 100.0, np.ones(8)).any()


def test_one_planted_change_gives_few_rates(daily):
    grid = daily("100 + 0.02 * t - 0.08 * greatest(t - 600, 0) + randn(3)", 1200)
    fit = Ad.additive_fit(grid, K, Ad.AdditiveConfig(yearly_order=0)).first()
    rates = np.array(fit.beta[2:27])
    knots = np.array(Ad.AdditiveConfig().knots)
    assert np.count_nonzero(rates) <= 8
    strong = np.abs(rates) > 0.1 * np.abs(rates).sum()
    assert np.all(np.abs(knots[strong] - 600 / 1199) < 0.1)
    assert abs(rates.sum() - -0.08 * 1199 / fit.y_scale) < 0.1


def test_rebuilt_design_equals_the_columns(spark):
    own = (OwnHoliday("fair", (dt.date(2016, 2, 29), dt.date(2017, 6, 1)), 1, 2),)
    cfg = Ad.AdditiveConfig(changepoints=4, yearly_order=2, weekly_order=2, country_holidays="DE", own_holidays=own)
    rows = spark.sql("SELECT explode(sequence(DATE'2015-12-20', DATE'2018-01-10')) AS ds")
    t = F.datediff("ds", F.lit("2016-01-01").cast("date")) / F.lit(700.0)
    columns = [c for group in cfg.columns(F.col("ds"), t).values() for c in group]
    got = rows.orderBy("ds").select("ds", F.array(*[c.cast("double") for c in columns]).alias("x")).collect()
    day = np.array([(r.ds - Ad.EPOCH).days for r in got], float)
    want = cfg.design(day, (day - (dt.date(2016, 1, 1) - Ad.EPOCH).days) / 700.0)
    assert np.allclose(want[:, 1:], [r.x for r in got], atol=1e-9) and want[:, 14:].sum() > 20


def test_simulated_intervals_cover_and_repeat(spark):
    """Series whose slope changes as often as the model assumes: at its knots first, at any time later."""
    rng = np.random.default_rng(8)
    rows, ahead = [], 120
    first = dt.date(2015, 1, 1)
    cfg = Ad.AdditiveConfig(interval_width=0.8, yearly_order=0, weekly_order=0, changepoint_range=0.95, changepoint_prior_scale=0.5)
    knots = {round(k * 499) for k in cfg.knots}
    for s in range(100):
        slope, level, y = 0.0, 100.0, []
        for i in range(500 + ahead):
            if i in knots or i > 499 and rng.random() < 25 / 499:
                slope += rng.laplace(scale=0.1)
            level += slope
            y.append(level + 0.5 * rng.normal())
        rows += [(s, first + dt.timedelta(i), float(v)) for i, v in enumerate(y)]
    grid = spark.createDataFrame(rows, "series int, ds date, y double").repartition(4).cache()
    cut = first + dt.timedelta(500)
    fits = Ad.additive_fit(grid.where(F.col("ds") < cut), K, cfg).cache()
    out = Ad.additive_predict(fits, K, cfg, ahead, history=False)
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int")
    share = out.join(grid, ["series", "ds"]).agg(F.avg(inside)).first()[0]
    assert 0.7 < share < 0.9
    bounds = lambda df: df.orderBy("series", "ds").select("yhat_lower", "yhat_upper").collect()
    assert bounds(out) == bounds(Ad.additive_predict(fits.repartition(7), K, cfg, ahead, history=False))
    width = out.groupBy(F.datediff("ds", F.lit(cut)).alias("d")).agg(F.avg(F.col("yhat_upper") - F.col("yhat_lower")).alias("w"))
    by_day = {r.d: r.w for r in width.collect()}
    assert by_day[ahead - 1] > 1.5 * by_day[0]


def test_products_ship_one_number_per_column(daily):
    cfg = Ad.AdditiveConfig()
    rows = daily("100 + t % 7", 400).selectExpr("*", "DATE'2015-01-01' AS start", "399.0D AS span", "106.0D AS y_scale")
    design = [c for group in cfg.columns(F.col("ds"), Ad._scaled_time()).values() for c in group]
    sums = Ad._products(rows, K, design).first()
    assert len(sums.xy) == 1 + len(design) and len(sums.days) == 400 and sums.n == 400


def test_rolling_cv_and_analysis(spark, daily, tmp_path):
    p = daily("100 + 0.02 * t + 5 * sin(2 * pi() * unix_date(ds) / 7)", 500)
    cfg = Ad.AdditiveConfig(yearly_order=0, changepoints=5)
    cv = Ad.rolling_origin_cv(p, K, 180, 30, 60, cfg, size=100).cache()
    assert cv.select("cutoff").distinct().count() == (500 - 1 - 60 - 180) // 30 + 1
    assert cv.agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0] < 2
    metrics = horizon_metrics(cv, K).orderBy("horizon").collect()
    assert [m.horizon for m in metrics] == list(range(6, 61))
    assert all(0 <= m.coverage <= 1 and m.rmse >= m.mae * 0.999 for m in metrics)
    path = str(tmp_path / "f")
    out = AdditivePlan.analyze_timeseries(p, K, AdditivePlan.AdditiveRun(10, 60), cfg, forecast_path=path)
    assert out["test_metrics"].first().mape < 2
    saved = spark.read.option("header", True).csv(path)
    assert saved.count() == 10 and saved.agg(F.min("Date")).first()[0] == "2016-05-15"
    with pytest.raises(ValueError):
        AdditivePlan.AdditiveRun(freq="W")


def test_one_cutoff_equals_a_plain_fit(daily):
    p = daily("20 + t % 7 + 0.01 * t", 300)
    cfg = Ad.AdditiveConfig(yearly_order=1, changepoints=0)
    cv = Ad.rolling_origin_cv(p, K, 240, 1000, 59, cfg)
    assert cv.select("cutoff").distinct().count() == 1
    plain = Ad.additive_predict(Ad.additive_fit(p.where("ds <= date_add(DATE'2015-01-01', 240)"), K, cfg), K, cfg, 59)
    both = cv.join(plain.select("series", "ds", F.col("yhat").alias("direct")), ["series", "ds"])
    assert both.count() == 59
    assert both.where("abs(yhat - direct) > 0.05").count() == 0


def test_scalers(spark, daily, tmp_path):
    df = daily("t", 10).withColumn("c", F.lit(4.0))
    scaler = fit_scaler(df, ["y", "c"])
    scaler.write().overwrite().save(str(tmp_path / "s"))
    out = ColumnScaler.load(str(tmp_path / "s")).transform(df)
    r = out.agg(F.avg("y"), F.stddev_pop("y"), F.max("c")).first()
    assert abs(r[0]) < 1e-12 and abs(r[1] - 1) < 1e-12 and r[2] == 0
    assert standard_scale(df, ["y", "c"], K).exceptAll(out).count() == 0


def test_time_features_keep_their_start(spark, daily, tmp_path):
    t = TimeFeatures(startDate="2015-01-01", featureSet="full")
    t.write().overwrite().save(str(tmp_path / "t"))
    later = TimeFeatures.load(str(tmp_path / "t")).transform(daily("t", 3, "2016-01-01"))
    assert [r.days_since_start for r in later.orderBy("ds").collect()] == [365, 366, 367]
    assert set(TIME_FEATURES) <= set(later.columns)


def test_ranking_and_forecast_writer(spark, tmp_path):
    scores = spark.createDataFrame([("a", "x", 2.0), ("a", "y", 1.0), ("a", "z", None)], "series string, model string, cv_rmse_mean double")
    assert [r.model for r in model_ranking(scores, K).orderBy("rank").collect()] == ["y", "x", "z"]
    df = spark.sql("SELECT 'a' AS series, DATE'2020-01-01' AS ds, 1.5D AS forecast")
    path = write_forecast(df, str(tmp_path / "w"), K)
    assert spark.read.option("header", True).csv(path).first().asDict() == {"series": "a", "Date": "2020-01-01", "Price": "1.5"}


def plain_tree(x, w, z, depth):
    """One node after the other; returns a function of a row and a depth to stop at."""

    def grow(rows, level):
        h, g = w[rows].sum(), (w * z)[rows].sum()
        best = (1e-12 * (1 + g * g / h), None)
        for f in range(x.shape[1]) if level < depth else ():
            for c in np.unique(x[rows, f])[:-1] + 1:
                left = rows[x[rows, f] < c]
                gl, hl = (w * z)[left].sum(), w[left].sum()
                gain = gl**2 / hl + (g - gl) ** 2 / (h - hl) - g * g / h
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (f, c))
        if best[1] is None:
            return (g / h,)
        f, c = best[1]
        return g / h, f, c, grow(rows[x[rows, f] < c], level + 1), grow(rows[x[rows, f] >= c], level + 1)

    def value(row, stop, tree, level=0):
        if len(tree) == 1 or level == stop:
            return tree[0]
        return value(row, stop, tree[3] if row[tree[1]] < tree[2] else tree[4], level + 1)

    tree = grow(np.flatnonzero(w > 0), 0)
    return lambda row, stop: value(row, stop, tree)


def test_trees_equal_plain_ones():
    rng = np.random.default_rng(2)
    x = np.column_stack((rng.integers(0, 12, 150), rng.integers(0, 3, 150), rng.integers(0, 40, 150)))
    z, w = np.sin(x[:, 0]) + (x[:, 2] > 20) + 0.1 * rng.normal(size=150), rng.poisson(1, 150).astype(float)
    plain = plain_tree(x, w, z, 30)
    for depth in (0, 1, 3, 30):
        tree = forests.grow_tree(x, w, w * z, depth)
        whole = forests.grow_tree(x, w, w * z, 30)
        for t, stop in ((tree, None), (whole, depth)):
            at = forests.walk(lambda at, t=t: x[np.arange(150), np.maximum(t["feature"][at], 0)] >= t["cut"][at], t["feature"], t["child"], 150, stop)
            assert np.allclose(t["value"][at], [plain(row, depth) for row in x])


def test_grid_losses_equal_the_models_themselves(seasonal, tmp_path):
    frame = En._with_fold_scales(En.training_frame(seasonal, K, SMALL), K, 2, 4096)
    names = ["month_sin", "week", "days_since_start"]
    frames = T.FoldFrames(frame.cache(), [names, names[:2], names])
    points = T.grid_points({"numTrees": [3, 30], "maxDepth": [2, 4, 30]}, 10)
    found = T.param_search(frames, "rf", points, SMALL.trees)
    assert len(found.scores) == 12 and set(found.models) == {1, 2, 3}
    for point in points[:1] + points[-2:]:
        alone = T.param_search(frames, "rf", [point], SMALL.trees)
        for fold in (1, 2):
            loss = next(v for _, p, f, v in found.scores if p == point and f == fold)
            assert abs(alone.scores[fold - 1][3] - loss) < 1e-9
            direct = alone.models[fold].transform(frames.test(fold)).agg(F.avg((F.col("z") - F.col("z_hat")) ** 2)).first()[0]
            assert abs(direct - loss) < 1e-9
    model = found.models[3]
    model.write().overwrite().save(str(tmp_path / "f"))
    again = forests.ForestModel.load(str(tmp_path / "f")).setPredictionCol("other")
    scored = model.copy().transform(frames.train(3))
    assert again.transform(scored).where("abs(other - z_hat) > 1e-12").count() == 0
    assert abs(model.featureImportances.toArray().sum() - 1) < 1e-9 and len(model.trees) == found.params["numTrees"]


def test_bins_halve_until_cells_fit(seasonal):
    rows = with_time_features(seasonal, F.lit("2015-01-01").cast("date"))
    columns = [F.col(c).cast("double") for c in ("days_since_start", "dayofyear")]
    cells, edges = T.counted_cells(rows, columns, F.lit(0), [F.col("y")], T.TreeSettings(max_bins=400, most_cells=150))
    assert cells.count() <= 150 and cells.agg(F.sum(F.col("n")[0])).first()[0] == 1800


def test_short_and_unknown_series_stay(spark, seasonal):
    short = spark.sql("SELECT 'c' AS series, date_add(DATE'2016-01-01', CAST(id AS INT)) AS ds, 5.0D + id AS y FROM range(2)")
    model = En.train(seasonal.unionByName(short), K, SMALL)
    scores = {(r.series, r.model): r for r in model.metrics.collect()}
    assert scores["c", "linear"].cv_rmse_mean is None and scores["c", "linear"].train_rmse is not None
    assert scores["a", "rf"].cv_rmse_mean is not None
    assert {r.series for r in En.predict_range(model, "2017-07-01", "2017-07-01").collect()} == {"a", "b", "c"}
    asked = spark.sql("SELECT s AS series, DATE'2017-07-01' AS ds FROM VALUES ('a'), ('c'), ('x') AS t(s)")
    got = {r.series: r.rf_prediction for r in En.predict_rows(model, asked).collect()}
    assert set(got) == {"a", "c", "x"} and got["x"] is None and got["a"] is not None


def test_rolling_origin_starts_at_the_first_value(daily):
    grid = daily("CASE WHEN t >= 300 THEN 100 + t % 7 END", 600)
    rows = Ad.rolling_origin_cv(grid, K, 180, 30, 60)
    assert rows.select("cutoff").distinct().count() == cutoffs(grid, K, 180, 30, 60).count() == 2


@pytest.mark.parametrize("days", [1, 20, 60])
def test_additive_fit_on_short_histories(daily, days):
    fits = Ad.additive_fit(daily("100 + t % 7", days), K)
    for r in Ad.additive_predict(fits, K, periods=14).collect():
        assert r.yhat_lower <= r.yhat <= r.yhat_upper
        # One value says nothing about which part of the model it belongs to.
        assert 90 < r.yhat < 120 or days == 1


def test_additive_interval_covers_noise(daily):
    grid = daily("100 + 10 * sin(2 * pi() * dayofyear(ds) / 365.25) + 4 * randn(5)", 800)
    rows = Ad.additive_predict(Ad.additive_fit(grid, K), K).join(grid, ["series", "ds"])
    inside = rows.agg(F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int"))).first()[0]
    width = rows.agg(F.avg(F.col("yhat_upper") - F.col("yhat_lower"))).first()[0]
    assert abs(width - 2 * statistics.NormalDist().inv_cdf(0.5 + Ad.AdditiveConfig().interval_width / 2) * 4) < 2
    assert abs(inside - Ad.AdditiveConfig().interval_width) < 0.04


def test_voting_model_survives_saving(spark, seasonal, tmp_path):
    model, facts = voting.build_and_train(seasonal, K, {"numTrees": 3, "maxDepth": 3}, {"maxIter": 2, "maxDepth": 2, "stepSize": 0.5}, SMALL.trees)
    path = voting.save_voting(model, facts, str(tmp_path / "v"))
    days = ["2017-07-01", "2017-07-02"]
    want, got = (voting.vote(*m, K, days).orderBy("series", "ds").collect() for m in ((model, facts), voting.load_voting(spark, path)))
    assert want == got and len(got) == 4
    with pytest.raises(FileNotFoundError):
        voting.load_voting(spark, str(tmp_path / "nothing"))
