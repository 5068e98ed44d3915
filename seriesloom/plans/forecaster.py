"""The full training run and the reload-and-score run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blend import FINAL_WEIGHTS, WEIGHT_SETS, history_forecast_series, weight_sweep
from ..operators.profile import completeness, date_range
from ..operators.stats import forecast_stats, target_stats, volatility_class
from ..session import materialize, scratch_path
from ..sources.models import load_models, save_models
from ..sources.sinks import export_training_data, write_forecast, write_scored
from .ensemble import (
    Ensemble, EnsembleConfig, analyze_training_data, importances, predict_range, ranking, train,
)
from .report import long_report


@dataclass(frozen=True)
class RunSpan:
    """Dates scored by the sweep and by the final forecast."""

    sweep: tuple[str, str] = ("2012-01-01", "2020-12-31")
    final: tuple[str, str] = ("2020-02-01", "2020-02-29")


def report_tables(ensemble: Ensemble, panel: DataFrame, forecasts: Mapping[str, DataFrame]) -> DataFrame:
    """Dataset, processing, performance, forecast and ranking sections."""
    keys = ensemble.keys
    data = ensemble.training
    scores = {
        f"performance {m}": ensemble.metrics.where(F.col("model") == m).drop("model")
        for m in ensemble.models
    }
    return long_report(
        {
            "dataset": date_range(panel, keys),
            "quality": completeness(panel, keys),
            "target": target_stats(data, keys, len(ensemble.features)),
            "volatility": volatility_class(data, keys),
            **scores,
            **{f"forecast {n}": forecast_stats(f, keys) for n, f in forecasts.items()},
            "best model": ranking(ensemble).where("is_best").select(*keys, "model", "cv_rmse_mean"),
        },
        keys,
    )


def train_main(
    panel: DataFrame,
    keys: Sequence[str],
    cfg: EnsembleConfig = EnsembleConfig(),
    span: RunSpan = RunSpan(),
    out: str | None = None,
) -> dict[str, object]:
    """Train, save, analyse, sweep the weights, forecast, export and report."""
    spark = panel.sparkSession
    out = out or scratch_path(spark, "run")
    ensemble = train(panel, keys, cfg)
    save_models(ensemble, f"{out}/models")
    keys = ensemble.keys

    # The models are scored once for all weight sets.
    scored = materialize(predict_range(ensemble, *span.sweep), "scored")
    sweep = weight_sweep(scored, keys, WEIGHT_SETS, ensemble.models)
    final = materialize(predict_range(ensemble, *span.final, FINAL_WEIGHTS), "final")
    write_forecast(final, f"{out}/forecast", keys)
    export_training_data(ensemble.training, keys, ensemble.features, f"{out}/training_data")
    forecasts = {n: sweep.where(F.col("config") == n) for n in WEIGHT_SETS}
    return {
        "ensemble": ensemble,
        "path": out,
        "sweep": sweep,
        "final": final,
        "importances": importances(ensemble),
        "analysis": analyze_training_data(ensemble.training, keys, ensemble.features),
        "report": report_tables(ensemble, panel, {**forecasts, "final": final}),
    }


def load_and_predict(
    spark: SparkSession,
    models_path: str,
    start: str,
    end: str,
    out: str,
    weights: Mapping[str, float] = FINAL_WEIGHTS,
    history: DataFrame | None = None,
) -> DataFrame:
    """Reload saved models, score a range, write every prediction column, and return the series."""
    ensemble = load_models(spark, models_path)
    scored = predict_range(ensemble, start, end, weights, strict=False)
    write_scored(scored, out)
    scored = spark.read.schema(scored.schema).parquet(out)
    if history is None:
        return scored
    return history_forecast_series(history, scored, ensemble.keys, ensemble.models)
