"""Reading panels: delimited price files, tables, and panels built from facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_panel_csv(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = (),
    time_col: str = "Date",
    value_col: str = "Price",
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Read a headed price file into ``(keys, ds, y)`` with an explicit schema.

    A malformed number or date raises instead of turning into null.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*keys, time_col, value_col]])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    return as_panel(raw, keys, time_col, value_col, date_format)


def as_panel(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    value_col: str,
    date_format: str | None = None,
) -> DataFrame:
    """Cast and rename the columns of a table to ``(keys, ds, y)``."""
    ds = F.to_date(time_col, date_format) if date_format else F.to_date(time_col)
    return df.select(*keys, ds.alias("ds"), F.col(value_col).cast("double").alias("y"))


def as_output(df: DataFrame, time_col: str = "Date", value_col: str = "Price") -> DataFrame:
    """Rename ``ds``/``y`` back to the caller's names."""
    return df.withColumnsRenamed({"ds": time_col, "y": value_col})


def build_panel(
    df: DataFrame,
    keys: dict[str, str | Column],
    time_col: str,
    value_col: str,
    agg=F.avg,
) -> DataFrame:
    """Aggregate a fact table to one value per series and day.

    ``keys`` maps key names to source columns.  The aggregate is combined on
    the map side, so a hot series or day costs one row per task in the shuffle.
    """
    key_cols = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in keys.items()]
    return (
        df.select(*key_cols, F.to_date(time_col).alias("ds"), F.col(value_col).alias("_v"))
        .where(F.col("ds").isNotNull())
        .groupBy(*keys, "ds")
        .agg(agg("_v").alias("y"))
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average order price per priority and day; sparse, with gaps."""
    return build_panel(
        table(spark, sf_dir, "orders"), {"series": "o_orderpriority"}, "o_orderdate", "o_totalprice"
    )


def ship_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average line price per return flag and ship day; few long dense series."""
    return build_panel(
        table(spark, sf_dir, "lineitem"), {"series": "l_returnflag"}, "l_shipdate", "l_extendedprice"
    )


def supplier_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average line price per supplier and ship day; many sparse series."""
    return build_panel(
        table(spark, sf_dir, "lineitem"), {"series": "l_suppkey"}, "l_shipdate", "l_extendedprice"
    )
