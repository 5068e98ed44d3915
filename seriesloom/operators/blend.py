"""Weighted blends of model predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODELS = ("linear", "rf", "gbt")

# The weight sets compared by default, and the final one.
WEIGHT_SETS = {
    "linear only": {"linear": 1.0, "rf": 0.0, "gbt": 0.0},
    "forest only": {"linear": 0.0, "rf": 1.0, "gbt": 0.0},
    "boosted only": {"linear": 0.0, "rf": 0.0, "gbt": 1.0},
    "balanced": {"linear": 0.6, "rf": 0.0, "gbt": 0.4},
    "boosted-linear": {"linear": 0.4, "rf": 0.0, "gbt": 0.6},
}
FINAL_WEIGHTS = {"linear": 0.4, "rf": 0.3, "gbt": 0.3}
VOTING_WEIGHTS = {"gbt": 0.5, "rf": 0.3, "linear": 0.2}


def blend_column(
    models: Sequence[str],
    weights: Mapping[str, float] | None = None,
    strict: bool = True,
    normalized: bool = False,
) -> Column:
    """Sum of weight times prediction.

    Equal weights by default.  A model without a weight raises when ``strict``
    and counts as zero otherwise; weights are divided by their sum only when
    ``normalized``.
    """
    if not models:
        raise ValueError("no models to blend")
    if weights is None:
        weights = {m: 1 / len(models) for m in models}
    missing = [m for m in models if m not in weights]
    if missing and strict:
        raise KeyError(f"no weight for {', '.join(missing)}")
    used = {m: float(weights.get(m, 0.0)) for m in models}
    total = sum(used.values()) if normalized else 1.0
    out = F.lit(0.0)
    for m, w in used.items():
        out = out + F.col(f"{m}_prediction") * F.lit(w / total)
    return out


def weighted_blend(
    predictions: DataFrame,
    weights: Mapping[str, float] | None = None,
    models: Sequence[str] = MODELS,
    strict: bool = True,
    normalized: bool = False,
) -> DataFrame:
    return predictions.withColumn("forecast", blend_column(models, weights, strict, normalized))


def weight_sweep(
    predictions: DataFrame,
    keys: Sequence[str],
    sets: Mapping[str, Mapping[str, float]] = WEIGHT_SETS,
    models: Sequence[str] = MODELS,
) -> DataFrame:
    """The blend under every weight set: ``(keys, ds, config, forecast)``.

    The models are scored once; the sets are literals, so a row is expanded in
    place instead of being joined with a weight table.
    """
    blends = F.array(
        *[
            F.struct(F.lit(name).alias("config"), blend_column(models, w).alias("forecast"))
            for name, w in sets.items()
        ]
    )
    return predictions.select(*keys, "ds", F.inline(blends))


def history_forecast_series(
    history: DataFrame, forecast: DataFrame, keys: Sequence[str], models: Sequence[str] = MODELS
) -> DataFrame:
    """History, blend and single models on one axis, in long form.

    ``is_forecast`` tells the dates after the end of the history of the series.
    """
    end = history.groupBy(*keys).agg(F.max("ds").alias("_end"))
    long = forecast.unpivot(
        [*keys, "ds"], ["forecast", *[f"{m}_prediction" for m in models]], "kind", "value"
    )
    past = history.select(*keys, "ds", F.lit("history").alias("kind"), F.col("y").alias("value"))
    return (
        past.unionByName(long)
        .join(end, list(keys), "left")
        .withColumn("is_forecast", F.coalesce(F.col("ds") > F.col("_end"), F.lit(True)))
        .drop("_end")
    )
