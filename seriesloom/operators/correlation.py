"""Correlation tables and correlation-based feature selection."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr
from .moments import correlation_of, merged, partial_moments, solve_groups


def correlation_pairs(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Pearson correlation of every column pair, both ways: ``(keys, a, b, corr)``.

    Rows where either column is null are left out pair by pair.  One aggregate
    computes all pairs; meant for a handful of columns, see
    ``correlation_matrix`` for wide tables.
    """
    pairs = list(combinations(cols, 2))
    x = {c: F.col(c).cast("double") for c in cols}
    wide = df.groupBy(*keys).agg(*[safe_corr(x[a], x[b]).alias(f"{a}|{b}") for a, b in pairs])
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{c}|{d}`").alias("corr"))
        for c, d in pairs
        for a, b in ((c, d), (d, c))
    ]
    return wide.select(*keys, F.inline(F.array(*entries)))


def correlation_matrix(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """As ``correlation_pairs``, over the rows without nulls, for many columns.

    Built from mergeable moments, so only one small matrix per task and series
    is shuffled.
    """
    names = list(cols)

    def emit(_, group: dict) -> dict[str, list]:
        corr = correlation_of(merged(group.values()))
        i, j = np.nonzero(~np.eye(len(names), dtype=bool))
        return {"a": [names[k] for k in i], "b": [names[k] for k in j], "corr": corr[i, j]}

    moments = partial_moments(df, keys, names)
    return solve_groups(moments, keys, emit, "a string, b string, corr double")


def correlation_with(
    df: DataFrame, target: str, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Correlation of each column with the target: ``(keys, feature, corr)``."""
    y = F.col(target).cast("double")
    wide = df.groupBy(*keys).agg(
        *[safe_corr(F.col(c).cast("double"), y).alias(c) for c in cols]
    )
    return wide.unpivot(list(keys), list(cols), "feature", "corr")


def top_correlated(
    df: DataFrame, target: str, cols: Sequence[str], n: int, keys: Sequence[str] = ()
) -> DataFrame:
    """The n columns with the largest absolute correlation with the target."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("abs_corr"), "feature")
    return (
        correlation_with(df, target, cols, keys)
        .select(*keys, "feature", F.abs("corr").alias("abs_corr"))
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
    )


def feature_selection(
    pairs: DataFrame,
    target: str,
    keys: Sequence[str] = (),
    top_k: int = 10,
    threshold: float = 0.6,
) -> DataFrame:
    """Keep features by correlation with the target, dropping the weaker of correlated pairs.

    Features are visited by descending correlation with the target; one that is
    correlated above the threshold with a feature kept before it is removed.
    The visit is a fold over one short array per series, ``pairs`` being the
    output of ``correlation_matrix``.  ``reasons`` lists the stronger features a
    removed one clashed with; ``selected`` marks the first ``top_k`` kept ones.
    """
    strong = F.struct(F.col("b").alias("feature"), F.abs("corr").alias("corr"))
    features = (
        pairs.where(F.col("a") != target)
        .groupBy(*keys, F.col("a").alias("feature"))
        .agg(
            F.max(F.when(F.col("b") == target, F.abs("corr"))).alias("target_corr"),
            F.collect_list(
                F.when((F.col("b") != target) & (F.abs("corr") > threshold), strong)
            ).alias("close"),
        )
    )
    # Rounded, so that float noise does not decide between equally correlated features.
    order = F.coalesce(-F.round("target_corr", 12), F.lit(1.0)).alias("order")
    visits = features.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(order, "feature", "target_corr", "close"))).alias("v")
    )
    kept = F.aggregate(
        "v",
        F.expr("cast(array() as array<string>)"),
        lambda kept, f: F.when(
            F.arrays_overlap(kept, F.transform(f.close, lambda c: c.feature)), kept
        ).otherwise(F.concat(kept, F.array(f.feature))),
    )
    out = (
        visits.withColumns({"_kept": kept, "_names": F.transform("v", lambda f: f.feature)})
        .select(*keys, "_kept", "_names", F.posexplode("v").alias("_pos", "_visit"))
        .select(*keys, "_kept", "_names", (F.col("_pos") + 1).alias("rank"), "_visit.*")
    )
    is_kept = F.array_contains(F.col("_kept"), F.col("feature"))
    earlier = F.filter(
        "close",
        lambda c: F.array_contains(F.col("_kept"), c.feature)
        & (F.array_position(F.col("_names"), c.feature) < F.col("rank")),
    )
    return out.select(
        *keys,
        "rank",
        "feature",
        "target_corr",
        is_kept.alias("kept"),
        F.sort_array(earlier).alias("reasons"),
        (is_kept & (F.array_position(F.col("_kept"), F.col("feature")) <= top_k)).alias("selected"),
    )
