"""Writing forecasts, scored tables and training data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .panel import as_output

WRITERS = {
    "csv": lambda w, path: w.option("header", True).csv(path),
    "parquet": lambda w, path: w.parquet(path),
}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    WRITERS[fmt](writer, path)
    return path


def write_forecast(
    forecast: DataFrame,
    path: str,
    keys: Sequence[str],
    value: str = "forecast",
    fmt: str = "csv",
    time_col: str = "Date",
    value_col: str = "Price",
) -> str:
    """Date and price columns only, sorted within files."""
    out = as_output(
        forecast.select(*keys, "ds", F.col(value).alias("y")), time_col, value_col
    ).sortWithinPartitions(*keys, time_col)
    return write_table(out, path, fmt)


def write_scored(scored: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Every column of the scored table."""
    return write_table(scored, path, fmt)


def export_training_data(
    data: DataFrame, keys: Sequence[str], features: Sequence[str], path: str, fmt: str = "parquet"
) -> tuple[str, str]:
    """Two tables: the full engineered frame, and the raw features with the target."""
    flat = [f.name for f in data.schema if not f.dataType.typeName() in ("array", "struct")]
    return (
        write_table(data.select(flat), f"{path}_features", fmt),
        write_table(data.select(*keys, *features, "y"), f"{path}_raw_features", fmt),
    )
