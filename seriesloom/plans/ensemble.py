"""The ensemble forecaster: training, evaluation, scoring, and the full run."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import TIME_FEATURES, with_time_features
from ..functions.transformers import TimeFeatures
from ..operators.anomaly import clip_and_fill
from ..operators.blend import weighted_blend
from ..operators.blocks import BLOCK_DAYS, attach
from ..operators.correlation import correlation_matrix, feature_selection, top_correlated
from ..operators.evaluate import cv_scores, fit_metrics, fold_segments, model_ranking
from ..operators.grid import date_bounds
from ..operators.importance import importance_table
from ..operators.linear import coefficient_table, linear_folds, linear_value, select_by_correlation
from ..operators.moments import correlation_of, merge_two, partial_moments, solve_groups
from ..operators.profile import describe_columns, null_counts
from ..operators.stats import histogram
from ..operators.trees import (
    BOOSTED_GRID, FOREST_GRID, FoldFrames, TreeSettings, grid_points, param_search, predict_fold,
)
from ..session import materialize


@dataclass(frozen=True)
class EnsembleConfig:
    folds: int = 5
    n_iter: int = 10
    top_k: int = 10
    threshold: float = 0.6
    clip_outliers: bool = True
    fill_first: bool = True
    forest_grid: Mapping[str, Sequence] = field(default_factory=lambda: FOREST_GRID)
    boosted_grid: Mapping[str, Sequence] = field(default_factory=lambda: BOOSTED_GRID)
    trees: TreeSettings = TreeSettings()
    block_days: int = BLOCK_DAYS


@dataclass
class Ensemble:
    """Fitted models and the tables that describe them.

    ``facts`` holds one row per series: training start, target scale, and the
    linear fit.  ``prepare`` turns dates into the feature vector of the trees.
    """

    keys: list[str]
    features: list[str]
    facts: DataFrame
    prepare: PipelineModel
    trees: dict[str, object]
    params: dict[str, dict]
    metrics: DataFrame | None = None
    training: DataFrame | None = None
    cv_predictions: DataFrame | None = None

    @property
    def models(self) -> list[str]:
        return ["linear", *self.trees] if self.facts is not None else list(self.trees)


def training_frame(panel: DataFrame, keys: Sequence[str], cfg: EnsembleConfig) -> DataFrame:
    """Clipped, filled panel with its 19 time features and fold segments.

    Rows of a series too short for the folds get the last segment: they train the
    final fit alone, and the series has no cross-validation scores.
    """
    grid = clip_and_fill(panel, keys, cfg.fill_first, cfg.clip_outliers, cfg.block_days)
    facts = date_bounds(grid, keys).withColumn("start", F.col("lo"))
    dated = attach(grid, facts, keys, cfg.block_days)
    featured = with_time_features(dated, F.col("start"))
    labelled = fold_segments(featured, keys, cfg.folds, cfg.block_days)
    return labelled.withColumn("segment", F.coalesce("segment", F.lit(cfg.folds)))


def _with_fold_scales(frame: DataFrame, keys: Sequence[str], folds: int, size: int) -> DataFrame:
    """Add ``mu``/``sd``: mean and deviation of y over the training rows of each fold."""
    stats = frame.groupBy(*keys).agg(
        F.min("ds").alias("lo"),
        F.max("ds").alias("hi"),
        *[F.avg(F.when(F.col("segment") < f, F.col("y"))).alias(f"m{f}") for f in range(1, folds + 2)],
        *[F.stddev_pop(F.when(F.col("segment") < f, F.col("y"))).alias(f"s{f}") for f in range(1, folds + 2)],
    )

    def scale(f: int) -> Column:
        return F.when(F.col(f"s{f}") > 0, F.col(f"s{f}")).otherwise(F.lit(1.0))

    facts = stats.select(
        *keys, "lo", "hi",
        F.array(*[F.col(f"m{f}") for f in range(1, folds + 2)]).alias("mu"),
        F.array(*[scale(f) for f in range(1, folds + 2)]).alias("sd"),
    )
    return attach(frame, facts, keys, size)


def pooled_selection(data: DataFrame, cfg: EnsembleConfig) -> list[list[str]]:
    """Features kept for each fold and the final fit, from one pass over the panel.

    Only rows a fold trains on decide about its features.  The result is a
    short list per fold, kept on the driver as model metadata.
    """
    folds, names = cfg.folds, list(TIME_FEATURES)
    zs = [
        F.coalesce((F.col("y") - F.col("mu")[f]) / F.col("sd")[f], F.lit(0.0))
        for f in range(folds + 1)
    ]
    moments = partial_moments(data, ["segment"], [*names, *zs])
    top_k, threshold = cfg.top_k, cfg.threshold

    def solve(_, by_segment: dict) -> dict[str, list]:
        out = {"fold": [], "features": []}
        total = None
        for fold in range(1, folds + 2):
            part = by_segment.get((fold - 1,))
            if part is not None:
                total = part if total is None else merge_two(total, part)
            if total is None:
                continue
            use = [*range(len(names)), len(names) + fold - 1]
            corr = correlation_of(total)[use][:, use]
            kept = select_by_correlation(corr, names, top_k, threshold)
            out["fold"].append(fold)
            out["features"].append([names[i] for i in kept])
        return out

    rows = solve_groups(moments, [], solve, "fold int, features array<string>").collect()
    return [r.features for r in sorted(rows, key=lambda r: r.fold)]


def train(panel: DataFrame, keys: Sequence[str], cfg: EnsembleConfig = EnsembleConfig()) -> Ensemble:
    """Fit the three models with search and expanding-fold evaluation.

    Feature selection and scaling see only the training rows of each fold.
    """
    keys = list(keys)
    frame = _with_fold_scales(
        training_frame(panel, keys, cfg), keys, cfg.folds, cfg.block_days
    ).where("y is not null")
    data = materialize(frame, "training")

    linear = materialize(
        linear_folds(
            data, keys, TIME_FEATURES, cfg.folds, top_k=cfg.top_k, threshold=cfg.threshold
        ),
        "linear",
    )
    frames = FoldFrames(data, pooled_selection(data, cfg))
    final = cfg.folds + 1
    grids = {"rf": cfg.forest_grid, "gbt": cfg.boosted_grid}
    trees, params, fold_models = {}, {}, {}
    for name, grid in grids.items():
        points = grid_points(grid, cfg.n_iter, cfg.trees.seed)
        found = param_search(frames, name, points, cfg.trees)
        fold_models[name] = found.models
        trees[name], params[name] = found.models[final], found.params

    facts = (
        data.groupBy(*keys)
        .agg(
            F.min("start").alias("start"),
            F.max("ds").alias("last"),
            F.first(F.col("mu")[cfg.folds]).alias("mu"),
            F.first(F.col("sd")[cfg.folds]).alias("sd"),
        )
        .join(linear.where(F.col("fold") == final).drop("fold", "n"), keys)
    )
    features = frames.features[-1]
    ensemble = Ensemble(
        keys=keys,
        features=features,
        facts=materialize(facts, "facts"),
        prepare=_preparation(features),
        trees=trees,
        params=params,
        training=data,
    )
    ensemble.cv_predictions = materialize(
        _cv_predictions(data, linear, frames, fold_models, keys), "cv"
    )
    ensemble.metrics = _metrics(ensemble)
    return ensemble


def _preparation(features: Sequence[str]) -> PipelineModel:
    """Dates to the feature vector of the tree models, as a saveable pipeline."""
    return PipelineModel(
        [
            TimeFeatures(startCol="start", featureSet="full"),
            VectorAssembler(inputCols=list(features), outputCol="x"),
        ]
    )


def _cv_predictions(data, linear, frames, fold_models, keys) -> DataFrame:
    """Test-row predictions of all models and folds: ``(keys, model, ds, fold, y, yhat)``."""
    tests = data.where("segment > 0").withColumn("fold", F.col("segment"))
    parts = [
        tests.join(linear, [*keys, "fold"]).select(
            *keys, F.lit("linear").alias("model"), "ds", "fold", "y",
            linear_value(TIME_FEATURES).alias("yhat"),
        )
    ]
    for name, models in fold_models.items():
        for fold in range(1, frames.folds + 1):
            scored = predict_fold(frames, models[fold], fold, keys)
            parts.append(scored.withColumn("model", F.lit(name)).select(*parts[0].columns))
    return reduce(DataFrame.unionByName, parts)


def _metrics(ensemble: Ensemble) -> DataFrame:
    """Cross-validation and training scores per series and model."""
    keys = ensemble.keys
    data = ensemble.training
    cv = cv_scores(ensemble.cv_predictions, [*keys, "model"])
    span = ensemble.facts.withColumns({"lo": F.col("start"), "hi": F.col("last")})
    fitted = _predict(ensemble, attach(data.select(*keys, "ds", "y"), span, keys))
    long = fitted.unpivot(
        [*keys, "ds", "y"], [f"{m}_prediction" for m in ensemble.models], "model", "yhat"
    ).withColumn("model", F.regexp_replace("model", "_prediction$", ""))
    on_training = fit_metrics(long, [*keys, "model"]).withColumnsRenamed(
        {"r2": "train_r2", "rmse": "train_rmse", "mae": "train_mae"}
    )
    best = F.create_map(
        *[x for m, p in ensemble.params.items() for x in (F.lit(m), F.lit(json.dumps(p)))]
    )
    return materialize(
        cv.join(on_training, [*keys, "model"], "right").withColumn("best_params", best[F.col("model")]),
        "metrics",
    )


# -- scoring -----------------------------------------------------------------

FACT_COLUMNS = ["start", "last", "mu", "sd", "features", "intercept", "coef", "coef_scaled"]


def _predict(ensemble: Ensemble, dated: DataFrame) -> DataFrame:
    """Add the prediction of each model to rows that carry the facts of their series."""
    out = ensemble.prepare.transform(dated)
    out = out.withColumn("linear_prediction", linear_value(TIME_FEATURES))
    for name, model in ensemble.trees.items():
        out = model.transform(out).withColumn(
            f"{name}_prediction", F.col("z_hat") * F.col("sd") + F.col("mu")
        ).drop("z_hat")
    return out.drop("x", *TIME_FEATURES, *FACT_COLUMNS)


def predict_rows(ensemble: Ensemble, rows: DataFrame) -> DataFrame:
    """Predictions for given rows ``(keys, ds, ...)``, batch or streaming.

    Rows of unknown series stay, with null predictions.
    """
    known = rows.join(ensemble.facts, ensemble.keys, "left")
    # Any start will do for the features of an unknown series: its scale is null.
    return _predict(ensemble, known.withColumn("start", F.coalesce("start", "ds")))


def predict_range(
    ensemble: Ensemble,
    start: str,
    end: str,
    weights: Mapping[str, float] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Forecast every day from ``start`` to ``end`` for all series.

    The dates grow out of the facts table, so there is no join.
    """
    if not ensemble.models:
        raise ValueError("no models loaded")
    day = F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("ds")
    scored = _predict(ensemble, ensemble.facts.select("*", day))
    blended = weighted_blend(scored, weights, ensemble.models, strict)
    predictions = [f"{m}_prediction" for m in ensemble.models]
    return blended.select(*ensemble.keys, "ds", "forecast", *predictions)


def predict_dates(
    ensemble: Ensemble, dates: Sequence[str], weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Forecast an explicit list of dates for all series."""
    days = F.explode(F.array(*[F.to_date(F.lit(d)) for d in dates])).alias("ds")
    scored = _predict(ensemble, ensemble.facts.select("*", days))
    return weighted_blend(scored, weights, ensemble.models).select(
        *ensemble.keys, "ds", "forecast", *[f"{m}_prediction" for m in ensemble.models]
    )


def importances(ensemble: Ensemble) -> DataFrame:
    """``(model, feature, score)``; the linear score is the mean size of the scaled coefficients."""
    spark = ensemble.facts.sparkSession
    linear = (
        coefficient_table(ensemble.facts, ensemble.keys)
        .groupBy("feature")
        .agg(F.avg(F.abs("score")).alias("score"))
        .select(F.lit("linear").alias("model"), "feature", "score")
    )
    tables = [
        importance_table(spark, name, ensemble.features, model.featureImportances.toArray())
        for name, model in ensemble.trees.items()
    ]
    return reduce(DataFrame.unionByName, tables, linear)


# -- analysis ----------------------------------------------------------------


def analyze_training_data(data: DataFrame, keys: Sequence[str], features: Sequence[str]) -> dict[str, DataFrame]:
    """Top correlations, statistics, nulls and distributions of the training features."""
    top = top_correlated(data, "y", list(features), 10, keys)
    return {
        "top_correlations": top,
        "feature_stats": describe_columns(data, list(features)),
        "missing_values": null_counts(data.select(*features, "y"), only_present=True),
        "distributions": reduce(
            DataFrame.unionByName,
            [
                histogram(data, keys, 30, col=f).withColumn("feature", F.lit(f))
                for f in features
            ],
        ),
    }


def select_features(data: DataFrame, keys: Sequence[str], cfg: EnsembleConfig = EnsembleConfig()) -> DataFrame:
    """Feature selection per series with reasons, over the 19 time features."""
    pairs = correlation_matrix(data, [*TIME_FEATURES, "y"], keys)
    return feature_selection(pairs, "y", keys, cfg.top_k, cfg.threshold)


def ranking(ensemble: Ensemble) -> DataFrame:
    return model_ranking(ensemble.metrics.select(*ensemble.keys, "model", "cv_rmse_mean"), ensemble.keys)
