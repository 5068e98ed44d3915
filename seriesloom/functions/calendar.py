"""Calendar and cyclical columns of a date."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Period of each cyclically encoded calendar field.
PERIODS = {
    "year": 10,
    "month": 12,
    "dayofyear": 365.25,
    "week": 52,
    "day_of_week": 7,
    "day_of_month": 31,
}

# first/last days of a month counted as its start and end.
MONTH_START_UNTIL = 5
MONTH_END_FROM = 25

CALENDAR = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "iso_week": F.weekofyear,
    "day_of_week": F.weekday,
    "day_of_month": F.dayofmonth,
    "day_of_year": F.dayofyear,
    "month_name": lambda d: F.date_format(d, "MMM"),
    "weekday_name": lambda d: F.date_format(d, "EEE"),
    "is_weekend": lambda d: (F.weekday(d) >= 5).cast("int"),
    "is_month_start": lambda d: (F.dayofmonth(d) <= MONTH_START_UNTIL).cast("int"),
    "is_month_end": lambda d: (F.dayofmonth(d) >= MONTH_END_FROM).cast("int"),
}


def with_calendar(df: DataFrame, *fields: str, ds: str = "ds") -> DataFrame:
    """Add calendar fields (all of them by default)."""
    return df.withColumns({f: CALENDAR[f](F.col(ds)) for f in fields or CALENDAR})


def cyclical(x: Column, period: float) -> tuple[Column, Column]:
    angle = x * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def quarter_label(ds: Column) -> Column:
    return F.concat_ws("-Q", F.year(ds).cast("string"), F.quarter(ds).cast("string"))


BASE_FEATURES = [
    "year",
    "dayofyear",
    "month",
    "day_of_month",
    "week",
    "day_of_week",
    "days_since_start",
]
TIME_FEATURES = BASE_FEATURES + [f"{n}_{fn}" for n in PERIODS for fn in ("sin", "cos")]


def time_feature_columns(ds: Column, start: Column) -> dict[str, Column]:
    """The 19 regression features of a date, given the training start of its series."""
    base = {
        "year": F.year(ds),
        "dayofyear": F.dayofyear(ds),
        "month": F.month(ds),
        "day_of_month": F.dayofmonth(ds),
        "week": F.weekofyear(ds),
        "day_of_week": F.weekday(ds),
        "days_since_start": F.datediff(ds, start),
    }
    waves = {}
    for name, period in PERIODS.items():
        waves[f"{name}_sin"], waves[f"{name}_cos"] = cyclical(base[name], period)
    return base | waves


def with_time_features(df: DataFrame, start: Column, ds: str = "ds") -> DataFrame:
    return df.withColumns(time_feature_columns(F.col(ds), start))
