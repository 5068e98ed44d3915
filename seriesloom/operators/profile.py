"""Profiling and cleaning of panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import attach

QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns, ignoring the ones that do not exist."""
    return df.drop(*names)


def drop_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.na.drop(subset=list(cols))


def profile_schema(df: DataFrame) -> DataFrame:
    """One row per column: name, type, and the size of the table."""
    fields = F.array(
        *[
            F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
            for f in df.schema
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.inline(fields), "row_count", F.lit(len(df.columns)).alias("column_count"))
    )


def null_counts(df: DataFrame, only_present: bool = False) -> DataFrame:
    """Nulls per column, from one aggregate over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    out = counts.unpivot([], df.columns, "column_name", "null_count")
    return out.where("null_count > 0") if only_present else out


def describe(df: DataFrame, keys: Sequence[str] = (), col: str = "y") -> DataFrame:
    """Count, mean, std, extremes and quartiles per group.

    The exact percentile keeps the distinct values of a group, which the daily
    grain bounds by the days of the calendar.
    """
    q = F.percentile(col, F.array(*[F.lit(p) for p in QUARTILES]))
    return (
        df.groupBy(*keys)
        .agg(
            F.count(col).alias("count"),
            F.avg(col).alias("mean"),
            F.stddev_samp(col).alias("std"),
            F.min(col).alias("min"),
            q.alias("_q"),
            F.max(col).alias("max"),
        )
        .select(
            *keys, "count", "mean", "std", "min",
            F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"),
            "max",
        )
    )


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe`` of several columns over the whole table, one row per column.

    Values are counted first, so the percentile works on distinct values with
    their frequency and repeated values cost nothing in the shuffle.
    """
    long = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
        )
    )
    freq = long.where("v is not null").groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    n, v = F.col("n"), F.col("v")
    total = F.sum(n)
    mean = F.sum(v * n) / total
    q = F.percentile(v, F.array(*[F.lit(p) for p in QUARTILES]), n)
    centred = freq.join(
        freq.groupBy("feature").agg(mean.alias("mean"), q.alias("_q")), "feature"
    )
    return (
        centred.groupBy("feature")
        .agg(
            total.alias("count"),
            F.first("mean").alias("mean"),
            F.sqrt(F.try_divide(F.sum(n * (v - F.col("mean")) ** 2), total - 1)).alias("std"),
            F.min("v").alias("min"),
            F.first("_q").alias("_q"),
            F.max("v").alias("max"),
        )
        .select(
            "feature", "count", "mean", "std", "min",
            F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"),
            "max",
        )
    )


def completeness(df: DataFrame, keys: Sequence[str] = (), col: str = "y") -> DataFrame:
    """Share of rows with a value, in percent."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.avg(F.col(col).isNotNull().cast("int")) * 100).alias("complete_pct"),
    )


def date_range(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count(F.lit(1)).alias("days"),
        F.count_distinct(F.year("ds")).alias("years"),
    )


def head(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail_per_series(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows of the last n grid days of each series (a gap-free daily grid).

    On such a grid the last n rows are the last n days, so a maximum per series
    replaces a ranking.
    """
    last = df.groupBy(*keys).agg(F.max("ds").alias("hi"))
    last = last.withColumns({"lo": F.date_sub("hi", n - 1), "_from": F.date_sub("hi", n - 1)})
    return attach(df, last, keys).where("ds >= _from").drop("_from")


def sample_rows(df: DataFrame, n: int, cols: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows picked by a hash of ``cols``; the same rows on every run."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
    return df.orderBy(key, *cols).limit(n)
