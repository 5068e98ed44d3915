"""Spark ML transformers made of built-in column expressions."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import attach
from .calendar import TIME_FEATURES, cyclical, time_feature_columns

SHORT_FEATURES = [
    "year",
    "month",
    "day",
    "dayofweek",
    "quarter",
    "is_weekend",
    "month_sin",
    "month_cos",
    "dayofweek_sin",
    "dayofweek_cos",
    "days_since_start",
]


class TimeFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Calendar features of a date column.

    ``featureSet`` is ``short`` (11 columns) or ``full`` (19).  Days are counted
    from the column ``startCol`` if given, else from ``startDate``, both fixed
    at training time so that scoring any range gives the same features.
    """

    inputCol = Param(Params._dummy(), "inputCol", "date column", TypeConverters.toString)
    startCol = Param(Params._dummy(), "startCol", "training start column", TypeConverters.toString)
    startDate = Param(Params._dummy(), "startDate", "training start", TypeConverters.toString)
    featureSet = Param(Params._dummy(), "featureSet", "short or full", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="ds", startCol="", startDate="", featureSet="short"):
        super().__init__()
        self._setDefault(inputCol="ds", startCol="", startDate="", featureSet="short")
        self._set(**self._input_kwargs)

    def features(self) -> list[str]:
        short = self.getOrDefault(self.featureSet) == "short"
        return SHORT_FEATURES if short else TIME_FEATURES

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ds = F.col(self.getOrDefault(self.inputCol))
        column, date = self.getOrDefault(self.startCol), self.getOrDefault(self.startDate)
        start = F.col(column) if column else F.to_date(F.lit(date))
        if self.getOrDefault(self.featureSet) == "full":
            return dataset.withColumns(time_feature_columns(ds, start))
        month_sin, month_cos = cyclical(F.month(ds), 12)
        dow_sin, dow_cos = cyclical(F.weekday(ds), 7)
        return dataset.withColumns(
            {
                "year": F.year(ds),
                "month": F.month(ds),
                "day": F.dayofmonth(ds),
                "dayofweek": F.weekday(ds),
                "quarter": F.quarter(ds),
                "is_weekend": (F.weekday(ds) >= 5).cast("int"),
                "month_sin": month_sin,
                "month_cos": month_cos,
                "dayofweek_sin": dow_sin,
                "dayofweek_cos": dow_cos,
                "days_since_start": F.datediff(ds, start),
            }
        )


class ColumnScaler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise columns in place with stored means and population deviations."""

    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, means=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = zip(
            self.getOrDefault(self.inputCols),
            self.getOrDefault(self.means),
            self.getOrDefault(self.scales),
        )
        return dataset.withColumns({c: (F.col(c) - m) / F.lit(s) for c, m, s in columns})


def fit_scaler(df: DataFrame, cols: list[str]) -> ColumnScaler:
    """A scaler from one aggregate; constant columns are only centred."""
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()
    return ColumnScaler(
        inputCols=list(cols),
        means=[stats[f"m_{c}"] for c in cols],
        scales=[stats[f"s_{c}"] or 1.0 for c in cols],
    )


def standard_scale(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """Standardise columns per series; constant columns are only centred."""
    stats = df.groupBy(*keys).agg(
        F.min("ds").alias("lo"),
        F.max("ds").alias("hi"),
        *[F.avg(c).alias(f"_m_{c}") for c in cols],
        *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols],
    )
    scaled = attach(df, stats, keys).withColumns(
        {
            c: (F.col(c) - F.col(f"_m_{c}"))
            / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(F.lit(1.0))
            for c in cols
        }
    )
    return scaled.drop(*[f"_{x}_{c}" for x in "ms" for c in cols])
