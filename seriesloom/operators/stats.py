"""Descriptive aggregates per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import CALENDAR
from ..functions.scalar import percent, ratio
from .blocks import BLOCK_DAYS, attach

# Limits of the volatility classes and of a strong weekend effect.
EDA_CV_LIMITS = (10.0, 20.0)  # percent
MODEL_CV_LIMITS = (0.1, 0.3)  # ratio
WEEKEND_EFFECT_PCT = 5.0
IQR_FENCE = 1.5

MEASURES = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


def by_calendar(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    measures: Sequence[str] = ("mean", "std"),
) -> DataFrame:
    """Measures of y by calendar fields of ds."""
    groups = [CALENDAR[f](F.col("ds")).alias(f) for f in fields]
    return df.groupBy(*keys, *groups).agg(*[MEASURES[m]("y").alias(m) for m in measures])


def yearly_stats(df, keys):
    return by_calendar(df, keys, ["year"], ["count", "mean", "std", "min", "max"])


def dow_stats(df, keys):
    return by_calendar(df, keys, ["day_of_week"])


def month_stats(df, keys):
    return by_calendar(df, keys, ["month", "month_name"], ["mean", "std", "count"])


def week_stats(df, keys):
    return by_calendar(df, keys, ["iso_week"])


def dom_stats(df, keys):
    return by_calendar(df, keys, ["day_of_month"])


def quarterly_avg(df, keys):
    return (
        df.groupBy(*keys, F.year("ds").alias("year"), F.quarter("ds").alias("quarter"))
        .agg(F.avg("y").alias("mean"))
        .withColumn(
            "period",
            F.concat_ws("-Q", F.col("year").cast("string"), F.col("quarter").cast("string")),
        )
    )


def monthly_range(df, keys):
    return df.groupBy(*keys, F.month("ds").alias("month")).agg(
        (F.max("y") - F.min("y")).alias("range_y")
    )


ROLLUP_SETS = {
    "year": ["year"],
    "day_of_week": ["day_of_week"],
    "month": ["month"],
    "iso_week": ["iso_week"],
    "day_of_month": ["day_of_month"],
    "quarter": ["year", "quarter"],
}


def calendar_rollup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All calendar groupings in one pass and one shuffle.

    ``grain`` names the grouping; the fields that do not belong to it are null.
    """
    fields = ["year", "quarter", "month", "iso_week", "day_of_week", "day_of_month"]
    cal = df.select(*keys, "y", *[CALENDAR[f](F.col("ds")).alias(f) for f in fields])
    sets = [[F.col(c) for c in [*keys, *fs]] for fs in ROLLUP_SETS.values()]
    group_by = [F.col(c) for c in [*keys, *fields]]
    absent = {f: F.grouping(f).alias(f"_no_{f}") for f in fields}
    out = cal.groupingSets(sets, *group_by).agg(
        *absent.values(),
        F.count("y").alias("count"),
        F.avg("y").alias("mean"),
        F.stddev_samp("y").alias("std"),
        F.min("y").alias("min"),
        F.max("y").alias("max"),
    )
    grain = F.when(F.col("_no_quarter") == 0, "quarter")
    for f in ("year", "day_of_week", "month", "iso_week", "day_of_month"):
        grain = grain.when(F.col(f"_no_{f}") == 0, f)
    return out.select(*keys, grain.alias("grain"), *fields, "count", "mean", "std", "min", "max")


def weekend_split(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    weekend = F.weekday("ds") >= 5
    return (
        df.groupBy(*keys)
        .agg(
            F.avg(F.when(~weekend, F.col("y"))).alias("weekday_mean"),
            F.avg(F.when(weekend, F.col("y"))).alias("weekend_mean"),
        )
        .withColumn("weekend_premium_pct", percent(F.col("weekend_mean"), F.col("weekday_mean")))
    )


def price_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(
            F.avg("y").alias("mean"),
            F.median("y").alias("median"),
            F.min("y").alias("min"),
            F.max("y").alias("max"),
            F.stddev_samp("y").alias("std"),
        )
        .withColumn("cv_pct", ratio(F.col("std"), F.col("mean")) * 100)
    )


def _yearly_means(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, F.year("ds").alias("year")).agg(F.avg("y").alias("mean_y"))


def growth_cagr(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total and compound yearly growth over yearly means; series of more than one year."""
    first, last = F.col("first_mean"), F.col("last_mean")
    return (
        _yearly_means(df, keys)
        .groupBy(*keys)
        .agg(
            F.min_by("mean_y", "year").alias("first_mean"),
            F.max_by("mean_y", "year").alias("last_mean"),
            (F.max("year") - F.min("year")).alias("years_span"),
        )
        .where("years_span > 0")
        .withColumns(
            {
                "total_growth_pct": percent(last, first),
                "cagr_pct": (F.pow(ratio(last, first), 1 / F.col("years_span")) - 1) * 100,
            }
        )
    )


def peak_trough_month(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Months with the highest and lowest mean; the lower month number on ties."""
    months = df.groupBy(*keys, F.month("ds").alias("month")).agg(F.avg("y").alias("mean_y"))
    months = months.where("mean_y is not null")
    m, month = F.col("mean_y"), F.col("month")
    return (
        months.groupBy(*keys)
        .agg(
            F.max(F.struct(m, -month)).alias("_hi"),
            F.min(F.struct(m, month)).alias("_lo"),
            F.avg(m).alias("_avg"),
        )
        .select(
            *keys,
            (-F.col("_hi").col2).alias("peak_month"),
            F.col("_hi").mean_y.alias("peak_mean"),
            F.col("_lo").month.alias("trough_month"),
            F.col("_lo").mean_y.alias("trough_mean"),
            (ratio(F.col("_hi").mean_y - F.col("_lo").mean_y, F.col("_avg")) * 100).alias(
                "seasonal_variation_pct"
            ),
        )
    )


def daily_volatility(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From ``changes()`` columns: deviation of daily changes and mean weekly volatility, in percent."""
    return features.groupBy(*keys).agg(
        (F.stddev_samp("pct_change") * 100).alias("daily_volatility_pct"),
        (F.avg("volatility_7") * 100).alias("weekly_volatility_pct"),
    )


def _class(value: Column, limits: tuple[float, float], names: tuple[str, str, str]) -> Column:
    return F.when(value < limits[0], names[0]).when(value < limits[1], names[1]).when(
        value.isNotNull(), names[2]
    )


def volatility_class(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Classes of the coefficient of variation, and whether weekends differ strongly."""
    weekend = F.weekday("ds") >= 5
    out = df.groupBy(*keys).agg(
        ratio(F.stddev_samp("y"), F.avg("y")).alias("cv"),
        percent(
            F.avg(F.when(weekend, F.col("y"))), F.avg(F.when(~weekend, F.col("y")))
        ).alias("weekend_premium_pct"),
    )
    return out.withColumns(
        {
            "stability": _class(F.col("cv") * 100, EDA_CV_LIMITS, ("stable", "moderate", "high")),
            "volatility": _class(F.col("cv"), MODEL_CV_LIMITS, ("low", "moderate", "high")),
            "strong_weekend": F.abs("weekend_premium_pct") > WEEKEND_EFFECT_PCT,
        }
    )


def quartiles_iqr(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    q1, q3, iqr = F.col("q1"), F.col("q3"), F.col("iqr")
    return (
        df.groupBy(*keys)
        .agg(F.percentile("y", F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
        .select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
        .withColumn("iqr", q3 - q1)
        .withColumns({"low_fence": q1 - IQR_FENCE * iqr, "high_fence": q3 + IQR_FENCE * iqr})
    )


def boxplot_stats(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and extremes per group.

    Values are counted first, so both passes work on the distinct values.
    """
    values = df.where("y is not null").groupBy(*groups, "y").agg(F.count(F.lit(1)).alias("n"))
    q = F.percentile("y", F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)]), F.col("n"))
    box = values.groupBy(*groups).agg(q.alias("_q")).select(
        *groups,
        F.col("_q")[0].alias("q1"),
        F.col("_q")[1].alias("median"),
        F.col("_q")[2].alias("q3"),
    )
    reach = IQR_FENCE * (F.col("q3") - F.col("q1"))
    inside = F.when(F.col("y").between(F.col("q1") - reach, F.col("q3") + reach), F.col("y"))
    return (
        values.join(box, list(groups))
        .groupBy(*groups, "q1", "median", "q3")
        .agg(
            F.min(inside).alias("whisker_low"),
            F.max(inside).alias("whisker_high"),
            F.min("y").alias("min"),
            F.max("y").alias("max"),
        )
    )


def histogram(
    df: DataFrame, keys: Sequence[str], bins: int, col: str = "y", size: int = BLOCK_DAYS
) -> DataFrame:
    """Counts in equal-width bins between each series' extremes; the maximum is in the last bin."""
    rows = df.where(F.col(col).isNotNull()).select(*keys, "ds", F.col(col).alias("_v"))
    span = rows.groupBy(*keys).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        F.min("ds").alias("lo"), F.max("ds").alias("hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    binned = attach(rows, span, keys, size).withColumn(
        "bin",
        F.least(
            F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width)), F.lit(bins // 2)),
            F.lit(bins - 1),
        ).cast("int"),
    )
    return binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))


def anomaly_rate(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(flag).alias("anomalies"),
        (F.avg(F.col(flag).cast("int")) * 100).alias("anomaly_pct"),
    )


def target_stats(df: DataFrame, keys: Sequence[str], features: int) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("y").alias("samples"),
        F.lit(features).alias("features"),
        F.min("y").alias("min"),
        F.max("y").alias("max"),
        F.avg("y").alias("mean"),
        F.stddev_samp("y").alias("std"),
    )


def forecast_stats(forecast: DataFrame, keys: Sequence[str], col: str = "forecast") -> DataFrame:
    """Range, mean and population deviation of a forecast."""
    return forecast.groupBy(*keys).agg(
        F.count(col).alias("points"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.avg(col).alias("mean"),
        F.stddev_pop(col).alias("std"),
    )
