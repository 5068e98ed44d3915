"""Reports as tables: ``(keys, section, item, value, text)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def section(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One summary row per series as rows of items: numbers in ``value``, the rest in ``text``."""
    entries = []
    for f in df.schema:
        if f.name not in keys:
            number = isinstance(f.dataType, T.NumericType)
            c = F.col(f"`{f.name}`")
            entries.append(
                F.struct(
                    F.lit(f.name).alias("item"),
                    (c.cast("double") if number else F.lit(None).cast("double")).alias("value"),
                    (F.lit(None).cast("string") if number else c.cast("string")).alias("text"),
                )
            )
    return df.select(*keys, F.lit(name).alias("section"), F.inline(F.array(*entries)))


def long_report(sections: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [section(df, name, keys) for name, df in sections.items()]
    )
