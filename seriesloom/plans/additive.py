"""The additive forecast: hold-out evaluation, rolling-origin evaluation, future forecast."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.additive import (
    AdditiveConfig, additive_fit, additive_predict, rolling_origin_cv,
)
from ..operators.evaluate import (
    forecast_actual_join, head_tail_split, horizon_metrics, regression_metrics,
)
from ..operators.grid import fill_grid, prepare_panel
from ..session import materialize
from ..sources.sinks import write_forecast


@dataclass(frozen=True)
class AdditiveRun:
    periods: int = 30
    test_periods: int = 30
    freq: str = "D"
    fill_dates: bool = True

    def __post_init__(self):
        if self.freq != "D":
            raise ValueError("hold-out and rolling-origin evaluation need daily data")


def analyze_timeseries(
    df: DataFrame,
    keys: Sequence[str],
    run: AdditiveRun = AdditiveRun(),
    cfg: AdditiveConfig = AdditiveConfig(),
    order: str | None = None,
    forecast_path: str | None = None,
) -> dict[str, DataFrame]:
    """Prepare, split, fit, forecast, and evaluate on the hold-out and from rolling origins."""
    keys = list(keys)
    grid = prepare_panel(df, keys, order)
    if run.fill_dates:
        grid = fill_grid(grid, keys, "linear_edges", run.freq)
    split = materialize(head_tail_split(grid.select(*keys, "ds", "y"), keys, run.test_periods), "split")
    train, test = (split.where(F.col("role") == r).drop("role") for r in ("train", "test"))

    fits = materialize(additive_fit(train, keys, cfg), "fits")
    forecast = additive_predict(fits, keys, cfg, run.test_periods + run.periods)
    held_out = forecast_actual_join(
        test, forecast.select(*keys, "ds", "yhat"), keys
    )
    future = forecast.join(
        fits.select(*keys, F.date_add("last", run.test_periods).alias("_end")), keys
    ).where("ds > _end").drop("_end")
    if forecast_path:
        write_forecast(future, forecast_path, keys, value="yhat")
    cv = materialize(
        rolling_origin_cv(
            train, keys, 3 * run.test_periods, max(run.test_periods // 2, 1), run.test_periods, cfg
        ),
        "cv",
    )
    return {
        "forecast": forecast,
        "future": future,
        "test_metrics": regression_metrics(held_out, keys),
        "cross_validation": cv,
        "cross_validation_metrics": horizon_metrics(cv, keys),
    }
