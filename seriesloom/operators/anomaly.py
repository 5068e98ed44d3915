"""Anomaly flags and repair of outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ratio
from .blocks import BLOCK_DAYS, attach, over_blocks, row_position
from .grid import date_bounds, fill_grid
from .stats import quartiles_iqr
from .windows import centered_residual, rolling_zscore, year_neighbours

# Fixed value: relative distance from the neighbouring years that makes an outlier.
YEAR_RATIO_LIMIT = 1.5


def flag_zscore(df: DataFrame, threshold: float = 3.0, window: int = 30) -> DataFrame:
    """Flag rows far from their rolling mean; needs the ``rolling_zscore`` column."""
    far = F.abs(f"zscore_{window}") > threshold
    return df.withColumn("is_anomaly_zscore", F.coalesce(far, F.lit(False)))


def zscore_anomalies(
    grid: DataFrame,
    keys: Sequence[str],
    threshold: float = 3.0,
    window: int = 30,
    size: int = BLOCK_DAYS,
) -> DataFrame:
    return flag_zscore(
        over_blocks(grid, keys, rolling_zscore((window,)), size=size), threshold, window
    )


def flag_iqr(df: DataFrame) -> DataFrame:
    """Flag values outside ``low_fence``..``high_fence``."""
    y = F.col("y")
    outside = (y < F.col("low_fence")) | (y > F.col("high_fence"))
    return df.withColumn("is_anomaly_iqr", F.coalesce(outside, F.lit(False))).drop(
        "low_fence", "high_fence"
    )


def iqr_anomalies(df: DataFrame, keys: Sequence[str], size: int = BLOCK_DAYS) -> DataFrame:
    """Flag values outside the quartile fences of their series."""
    fences = quartiles_iqr(df, keys).select(*keys, "low_fence", "high_fence")
    facts = fences.join(date_bounds(df, keys), list(keys))
    return flag_iqr(attach(df, facts, keys, size))


def trend_outliers(
    df: DataFrame,
    keys: Sequence[str],
    window: int = 21,
    threshold: float = 3.0,
    by_row: bool = False,
    size: int = BLOCK_DAYS,
) -> DataFrame:
    """Flag rows that leave both the smooth trend and the level of the same day in other years.

    On a gap-free grid rows are days.  ``by_row`` counts rows of a panel with
    gaps instead, for clipping before the gaps are filled.
    """
    families = (centered_residual(window), year_neighbours(365))
    if by_row:
        numbered = row_position(df, keys, size=size)
        out = over_blocks(
            numbered, keys, *families, pos="pos", size=size, order="pos"
        ).drop("pos")
    else:
        out = over_blocks(df, keys, *families, size=size)
    off_trend = F.abs(ratio(F.col("diff"), F.col("rolling_std"))) > threshold
    off_year = F.abs(ratio(F.col("y_year_mean") - F.col("y"), F.col("y_year_mean"))) > YEAR_RATIO_LIMIT
    return out.withColumns(
        {
            "outlier_zs": F.coalesce(off_trend, F.lit(False)),
            "outlier_year_val": F.coalesce(off_year, F.lit(False)),
            "outlier": F.coalesce(off_trend & off_year, F.lit(False)),
        }
    )


def clip_outliers(flagged: DataFrame) -> DataFrame:
    """Replace flagged values by the smooth baseline."""
    return flagged.withColumn(
        "y", F.when(F.col("outlier"), F.col("smooth_baseline")).otherwise(F.col("y"))
    )


def clip_and_fill(
    panel: DataFrame,
    keys: Sequence[str],
    fill_first: bool = True,
    clip: bool = True,
    size: int = BLOCK_DAYS,
) -> DataFrame:
    """Outlier clipping and gap filling in either order: ``(keys, ds, y)``."""
    columns = [*keys, "ds", "y"]
    if not clip:
        return fill_grid(panel, keys, size=size).select(columns)
    if fill_first:
        grid = fill_grid(panel, keys, size=size).select(columns)
        return clip_outliers(trend_outliers(grid, keys, size=size)).select(columns)
    clipped = clip_outliers(trend_outliers(panel, keys, by_row=True, size=size))
    return fill_grid(clipped.select(columns), keys, size=size).select(columns)
