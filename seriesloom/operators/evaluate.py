"""Hold-out splits, folds, error metrics and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ratio
from .blocks import BLOCK_DAYS, attach
from .grid import date_bounds


def head_tail_split(
    grid: DataFrame, keys: Sequence[str], n: int, size: int = BLOCK_DAYS
) -> DataFrame:
    """Add ``role``: the last n days of each series are ``test``, the rest ``train``."""
    facts = date_bounds(grid, keys).withColumn("_cut", F.date_sub("hi", n))
    return (
        attach(grid, facts, keys, size)
        .withColumn("role", F.when(F.col("ds") > F.col("_cut"), "test").otherwise("train"))
        .drop("_cut")
    )


def fold_segments(
    grid: DataFrame, keys: Sequence[str], folds: int = 5, size: int = BLOCK_DAYS
) -> DataFrame:
    """Add ``segment``: 0 for the first training rows, i for the test rows of fold i.

    Fold i (from 1) trains on segments below i and tests on segment i, so one
    label per row describes all expanding folds and no row is copied.  Series
    with too few days for the folds get null.
    """
    days = F.datediff("hi", "lo") + 1
    facts = date_bounds(grid, keys).withColumns(
        {"_hi": F.col("hi"), "_test": F.floor(days / F.lit(folds + 1)).cast("int")}
    )
    from_end = F.datediff("_hi", "ds")
    segment = F.greatest(
        folds - F.floor(from_end / F.col("_test")), F.lit(0)
    ).cast("int")
    return (
        attach(grid, facts, keys, size)
        .withColumn("segment", F.when(F.col("_test") > 0, segment))
        .drop("_hi", "_test")
    )


def time_series_split(
    grid: DataFrame, keys: Sequence[str], folds: int = 5, size: int = BLOCK_DAYS
) -> DataFrame:
    """Expanding folds as rows ``(keys, ds, fold, role)``."""
    seg = F.col("segment")
    return (
        fold_segments(grid, keys, folds, size)
        .where(seg.isNotNull())
        .withColumn("fold", F.explode(F.sequence(F.greatest(seg, F.lit(1)), F.lit(folds))))
        .select(
            *keys, "ds", "fold", F.when(seg == F.col("fold"), "test").otherwise("train").alias("role")
        )
    )


def forecast_actual_join(actual: DataFrame, forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    return actual.join(forecast, [*keys, "ds"], "left")


def _error() -> Column:
    return F.col("y") - F.col("yhat")


def regression_metrics(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """MAE, MAPE in percent and RMSE of ``yhat`` against ``y``."""
    e = _error()
    return pairs.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(ratio(e, F.col("y")))) * 100).alias("mape"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
    )


def fit_metrics(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """R2, RMSE and MAE; null R2 where y is constant."""
    e = _error()
    scored = pairs.where(F.col("y").isNotNull() & F.col("yhat").isNotNull())
    return scored.groupBy(*by).agg(
        (1 - ratio(F.avg(e * e), F.var_pop("y"))).alias("r2"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
    )


def cv_scores(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population deviation over folds of the metrics of each fold."""
    per_fold = fit_metrics(predictions, [*by, "fold"])
    return per_fold.groupBy(*by).agg(
        *[
            f(m).alias(f"cv_{m}_{name}")
            for m in ("rmse", "r2", "mae")
            for name, f in (("mean", F.avg), ("std", F.stddev_pop))
        ]
    )


def cutoffs(
    panel: DataFrame, keys: Sequence[str], initial: int, period: int, horizon: int
) -> DataFrame:
    """Rolling-origin cutoffs per series, from the last possible one backwards.

    One row per cutoff: ``(keys, lo, hi, cutoff)``; ``lo``/``hi`` are the first and
    last day with a value.
    """
    b = date_bounds(panel.where(F.col("y").isNotNull()), keys)
    last = F.date_sub("hi", horizon)
    spare = F.datediff(last, F.date_add("lo", initial))
    return (
        b.withColumns({"_last": last, "_spare": spare})
        .where("_spare >= 0")
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.floor(F.col("_spare") / F.lit(period)).cast("int"))))
        .select(*keys, "lo", "hi", F.date_sub("_last", F.col("_i") * period).alias("cutoff"))
    )


def rolling_origin_membership(
    grid: DataFrame,
    keys: Sequence[str],
    initial: int,
    period: int,
    horizon: int,
    size: int = BLOCK_DAYS,
) -> DataFrame:
    """Test rows of every cutoff: ``(keys, ds, y, cutoff)`` with cutoff < ds <= cutoff + horizon.

    The cutoffs lie on a lattice, so those a day belongs to are computed from
    the day itself: at most horizon / period + 1 rows per day and no range join.
    """
    b = date_bounds(grid.where(F.col("y").isNotNull()), keys)
    spare = F.datediff(F.date_sub("hi", horizon), F.date_add("lo", initial))
    facts = b.withColumns(
        {
            "_last": F.date_sub("hi", horizon),
            "_max_i": F.floor(spare / F.lit(period)).cast("int"),
        }
    ).where(F.col("_max_i") >= 0)
    # Cutoff i lies i * period days before the last one.
    back = F.datediff("_last", "ds")
    first_i = F.greatest(F.floor(back / F.lit(period)).cast("int") + 1, F.lit(0))
    last_i = F.least(F.floor((back + horizon) / F.lit(period)).cast("int"), F.col("_max_i"))
    return (
        attach(grid, facts, keys, size)
        .withColumns({"_a": first_i, "_b": last_i})
        .where("_a <= _b")
        .withColumn("_i", F.explode(F.sequence("_a", "_b")))
        .withColumn("cutoff", F.date_sub("_last", F.col("_i") * period))
        .drop("_last", "_max_i", "_a", "_b", "_i")
    )


def horizon_metrics(scored: DataFrame, keys: Sequence[str], share: float = 0.1) -> DataFrame:
    """Error metrics by forecast horizon, averaged over a rolling ``share`` of the rows.

    ``scored`` has ``ds, cutoff, y, yhat, yhat_lower, yhat_upper`` with the same
    number of rows at every horizon day, as on a gap-free grid.  The window of a
    horizon day reaches back over ``share`` of the rows; where that is no whole
    number of days the earliest day counts in part (in the median, in full).
    """
    y, yhat = F.col("y"), F.col("yhat")
    e = y - yhat
    rows = scored.select(
        *keys,
        F.datediff("ds", "cutoff").alias("_day"),
        (e * e).alias("mse"),
        F.abs(e).alias("mae"),
        F.abs(ratio(e, y)).alias("mape"),
        ratio(2 * F.abs(e), F.abs(y) + F.abs(yhat)).alias("smape"),
        y.between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double").alias("coverage"),
    )
    per_day = rows.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_n"))
    width = F.greatest(F.floor(F.sum("_n") * share), F.lit(1)) / F.max("_n")
    span = per_day.groupBy(*keys).agg(F.max("_day").alias("_last"), width.alias("_width"))
    days = F.ceil("_width").cast("int")
    # Each row is copied to the few horizon days whose window holds it.
    windowed = (
        rows.join(span, list(keys))
        .withColumns(
            {
                "_a": F.greatest(F.col("_day"), days),
                "_b": F.least(F.col("_day") + days - 1, F.col("_last")),
            }
        )
        .where("_a <= _b")
        .withColumn("horizon", F.explode(F.sequence("_a", "_b")))
    )
    earliest = F.col("horizon") - F.col("_day") == days - 1
    w = F.when(earliest, F.col("_width") - days + 1).otherwise(F.lit(1.0))
    return (
        windowed.withColumn("_w", w)
        .groupBy(*keys, "horizon")
        .agg(
            *[
                ratio(F.sum(F.col(m) * F.col("_w")), F.sum("_w")).alias(m)
                for m in ("mse", "mae", "mape", "smape", "coverage")
            ],
            F.median("mape").alias("mdape"),
        )
        .withColumn("rmse", F.sqrt("mse"))
    )


def model_ranking(scores: DataFrame, keys: Sequence[str], metric: str = "cv_rmse_mean") -> DataFrame:
    """Models by ascending error; rank 1 is the best."""
    w = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(metric), "model")
    ranked = scores.withColumn("rank", F.row_number().over(w))
    return ranked.select(*keys, "model", metric, "rank", (F.col("rank") == 1).alias("is_best"))
