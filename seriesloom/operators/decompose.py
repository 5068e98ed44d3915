"""Classical additive decomposition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ratio
from .blocks import BLOCK_DAYS, attach, over_blocks
from .grid import date_bounds
from .windows import trend_component


def series_facts(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bounds, start and length of each series, for ``attach``."""
    return date_bounds(grid, keys).withColumns(
        {"_start": F.col("lo"), "_days": F.datediff("hi", "lo") + 1}
    )


def _phased(with_trend: DataFrame, period: int) -> DataFrame:
    """Phase of each row; phase and trend are null for series shorter than two periods."""
    enough = F.col("_days") >= 2 * period
    return with_trend.withColumns(
        {
            "phase": F.when(enough, F.datediff("ds", "_start") % period),
            "trend": F.when(enough, F.col("trend")),
        }
    ).drop("_start", "_days")


def _seasonal(phased: DataFrame, keys: Sequence[str]) -> DataFrame:
    means = (
        phased.where("phase is not null")
        .groupBy(*keys, "phase")
        .agg(F.avg(F.col("y") - F.col("trend")).alias("_m"))
    )
    # At most `period` rows per series.
    centre = F.avg("_m").over(Window.partitionBy(*keys))
    return means.select(*keys, "phase", (F.col("_m") - centre).alias("seasonal"))


def _with_trend(grid: DataFrame, keys: Sequence[str], period: int, size: int) -> DataFrame:
    trended = over_blocks(grid, keys, trend_component(period), size=size)
    return attach(trended, series_facts(grid, keys), keys, size)


def seasonal_component(
    grid: DataFrame, keys: Sequence[str], period: int = 365, size: int = BLOCK_DAYS
) -> DataFrame:
    """Mean detrended value per position in the period, centred: ``(keys, phase, seasonal)``."""
    return _seasonal(_phased(_with_trend(grid, keys, period, size), period), keys)


def add_components(with_trend: DataFrame, keys: Sequence[str], period: int = 365) -> DataFrame:
    """Seasonal and residual for rows that have ``trend`` and the ``series_facts``."""
    phased = _phased(with_trend, period)
    # The phase spreads even a single long series over `period` join keys.
    return (
        phased.join(_seasonal(phased, keys), [*keys, "phase"], "left")
        .drop("phase")
        .withColumn("residual", F.col("y") - F.col("trend") - F.col("seasonal"))
    )


def decompose(
    grid: DataFrame, keys: Sequence[str], period: int = 365, size: int = BLOCK_DAYS
) -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``residual``; null for series under two periods."""
    return add_components(_with_trend(grid, keys, period, size), keys, period)


def decompose_strength(components: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How much of the variance trend and seasonality explain (population variances)."""
    resid = F.col("residual")
    return (
        components.groupBy(*keys)
        .agg(
            F.var_pop(resid).alias("_r"),
            F.var_pop(F.col("trend") + resid).alias("_tr"),
            F.var_pop(F.col("seasonal") + resid).alias("_sr"),
        )
        .select(
            *keys,
            (1 - ratio(F.col("_r"), F.col("_tr"))).alias("trend_strength"),
            (1 - ratio(F.col("_r"), F.col("_sr"))).alias("seasonal_strength"),
        )
    )
