"""Least squares per series, for all expanding folds in one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .moments import Moments, correlation_of, deviations, merge_two, partial_moments, solve_groups

FIT_SCHEMA = (
    "fold int, n bigint, features array<string>, intercept double, "
    "coef array<double>, coef_scaled array<double>"
)


def select_by_correlation(
    corr: np.ndarray, names: Sequence[str], top_k: int | None, threshold: float
) -> list[int]:
    """Positions of the features kept; the target is the last column of ``corr``.

    The same rule as ``feature_selection``, for use inside a fold.
    """
    strength = np.round(np.abs(corr[:-1, -1]), 12)
    strength[np.isnan(strength)] = -1.0
    kept: list[int] = []
    for i in sorted(range(len(names)), key=lambda i: (-strength[i], names[i])):
        if not np.any(np.abs(corr[i, kept]) > threshold):
            kept.append(i)
    return kept[:top_k]


def least_squares(moments: Moments, use: Sequence[int]) -> tuple[float, np.ndarray, np.ndarray]:
    """Intercept, coefficients, and coefficients of the standardised columns.

    The target is the last column.  The minimum-norm solution on standardised
    columns, so collinear and constant columns do no harm.
    """
    n, mean, co = moments
    use = list(use)
    sd = deviations(moments)[use]
    scale = np.where(sd > 0, sd, 1.0)
    varies = np.where(sd > 0, 1.0, 0.0)
    xx = co[np.ix_(use, use)] / n / np.outer(scale, scale) * np.outer(varies, varies)
    xy = co[use, -1] / n / scale * varies
    scaled = np.linalg.pinv(xx, rcond=1e-10, hermitian=True) @ xy
    coef = scaled / scale
    return mean[-1] - coef @ mean[use], coef, scaled


def linear_folds(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    folds: int,
    target: str = "y",
    top_k: int | None = None,
    threshold: float | None = None,
) -> DataFrame:
    """Fits per series for folds 1..folds and, as fold ``folds + 1``, on all rows.

    ``df`` carries ``segment`` (see ``fold_segments``).  Segment moments are
    accumulated, so each expanding fold is solved without reading its rows
    again.  With a ``threshold`` the features are selected inside each fold.
    """
    names = list(features)

    def solve(_, by_segment: dict) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("fold", "n", "features", "intercept", "coef", "coef_scaled")}
        total = None
        for fold in range(1, folds + 2):
            part = by_segment.get((fold - 1,))
            if part is not None:
                total = part if total is None else merge_two(total, part)
            if total is None:
                continue
            use = range(len(names))
            if threshold is not None:
                use = select_by_correlation(correlation_of(total), names, top_k, threshold)
            intercept, coef, scaled = least_squares(total, use)
            for c, v in zip(out, (fold, total[0], [names[i] for i in use], intercept, coef, scaled)):
                out[c].append(v)
        return out

    moments = partial_moments(df.where("segment is not null"), [*keys, "segment"], [*names, target])
    return solve_groups(moments, keys, solve, FIT_SCHEMA)


def linear_fit(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str = "y"
) -> DataFrame:
    """One least-squares fit per series."""
    return linear_folds(
        df.withColumn("segment", F.lit(0)), keys, features, folds=0, target=target
    ).drop("fold")


def linear_value(features: Sequence[str]) -> Column:
    """Prediction from ``intercept``, ``coef`` and the ``features`` array of a fit.

    A fit may use any subset of the columns, so the coefficient of each column
    is looked up by name.
    """
    used = F.col("features")
    total = F.col("intercept")
    for name in features:
        place = F.array_position(used, F.lit(name)).cast("int")
        weight = F.when(place > 0, F.element_at("coef", F.greatest(place, F.lit(1))))
        total = total + F.coalesce(weight * F.col(name), F.lit(0.0))
    return total


def coefficient_table(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coefficients of the standardised features as rows."""
    pairs = F.arrays_zip(F.col("features").alias("feature"), F.col("coef_scaled").alias("score"))
    return fits.select(*keys, F.inline(pairs))


def simple_regression(df: DataFrame, keys: Sequence[str], x: Column) -> DataFrame:
    """Slope and intercept of y on a single regressor, JVM-side only."""
    return df.groupBy(*keys).agg(
        F.regr_slope(F.col("y"), x).alias("slope"),
        F.regr_intercept(F.col("y"), x).alias("intercept"),
    )
