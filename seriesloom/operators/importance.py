"""Feature scores of fitted models and their comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def importance_table(
    spark: SparkSession, model: str, features: Sequence[str], scores: Sequence[float]
) -> DataFrame:
    """``(model, feature, score)``: one row per feature of a fitted model."""
    rows = [(model, f, float(s)) for f, s in zip(features, scores)]
    return spark.createDataFrame(rows, "model string, feature string, score double")


def top_features(scores: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """The n features with the largest absolute score, ranked."""
    w = Window.partitionBy(*by).orderBy(F.desc(F.abs("score")), "feature")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def feature_union(scores: DataFrame, by: Sequence[str], n: int = 5) -> DataFrame:
    """Distinct features among the top n of any model (``by`` without the model)."""
    top = top_features(scores, [*by, "model"], n)
    return top.select(*by, "feature").distinct()


def feature_union_lookup(
    scores: DataFrame, models: Sequence[str], by: Sequence[str] = (), n: int = 5
) -> DataFrame:
    """Every top feature with its absolute score in each model, 0 where it has none."""
    wanted = feature_union(scores, by, n)
    tables = [
        scores.where(F.col("model") == m).select(*by, "feature", F.abs("score").alias(m))
        for m in models
    ]
    joined = reduce(lambda a, b: a.join(b, [*by, "feature"], "full"), tables)
    return wanted.join(joined, [*by, "feature"], "left").select(
        *by, "feature", *[F.coalesce(m, F.lit(0.0)).alias(m) for m in models]
    )
