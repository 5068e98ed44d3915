"""One saveable object: features, scaling, three regressors and their weighted mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.transformers import SHORT_FEATURES, TimeFeatures, fit_scaler
from ..operators.blend import VOTING_WEIGHTS, weighted_blend
from ..operators.blocks import attach
from ..operators.grid import date_bounds, fill_grid
from ..operators.trees import TreeSettings, boosted, forest
from ..session import materialize

# Sizes of the two tree ensembles.
FOREST = {"numTrees": 200, "maxDepth": 10}
BOOSTED = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.1}


def build_and_train(
    panel: DataFrame,
    keys: Sequence[str],
    forest_params: dict = FOREST,
    boosted_params: dict = BOOSTED,
    settings: TreeSettings = TreeSettings(),
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the filled panel; returns the model and the per-series facts it needs.

    The target is standardised per series, see ``operators.trees``.  The start
    date of each series is kept, so later ranges count days from the same day.
    """
    keys = list(keys)
    grid = fill_grid(panel, keys).select(*keys, "ds", "y").where("y is not null")
    facts = grid.groupBy(*keys).agg(
        F.min("ds").alias("start"),
        F.avg("y").alias("mu"),
        F.coalesce(F.nullif(F.stddev_pop("y"), F.lit(0.0)), F.lit(1.0)).alias("sd"),
    )
    facts = materialize(facts, "voting-facts")
    rows = attach(grid, facts.join(date_bounds(grid, keys), keys), keys)
    features = TimeFeatures(startCol="start")
    featured = materialize(
        features.transform(rows).withColumn("z", (F.col("y") - F.col("mu")) / F.col("sd")), "voting"
    )
    scaler = fit_scaler(featured, SHORT_FEATURES)
    assembler = VectorAssembler(inputCols=SHORT_FEATURES, outputCol="x")
    data = assembler.transform(scaler.transform(featured)).select("x", "z")
    models = {
        "linear": LinearRegression(
            featuresCol="x", labelCol="z", predictionCol="z_hat", solver="normal", standardization=False
        ).fit(data),
        "rf": forest(settings, **forest_params).fit(data),
        "gbt": boosted(settings, **boosted_params).fit(data),
    }
    for name, model in models.items():
        model.setPredictionCol(f"z_{name}")
    return PipelineModel([features, scaler, assembler, *models.values()]), facts


def save_voting(model: PipelineModel, facts: DataFrame, path: str) -> str:
    """Write the model and its per-series facts below ``path``."""
    model.write().overwrite().save(f"{path}/model")
    facts.write.mode("overwrite").parquet(f"{path}/facts")
    return path


def load_voting(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """Read them back; raises FileNotFoundError when there is none at ``path``."""
    try:
        facts = spark.read.parquet(f"{path}/facts")
    except AnalysisException as e:
        raise FileNotFoundError(f"no saved model at {path}") from e
    return PipelineModel.load(f"{path}/model"), facts


def vote(
    model: PipelineModel, facts: DataFrame, keys: Sequence[str], dates: Sequence[str]
) -> DataFrame:
    """Forecast a list of dates for every series: single predictions and their weighted mean."""
    days = F.explode(F.array(*[F.to_date(F.lit(d)) for d in dates])).alias("ds")
    scored = model.transform(facts.select("*", days)).withColumns(
        {f"{m}_prediction": F.col(f"z_{m}") * F.col("sd") + F.col("mu") for m in VOTING_WEIGHTS}
    )
    blended = weighted_blend(scored, VOTING_WEIGHTS, list(VOTING_WEIGHTS), normalized=True)
    return blended.select(*keys, "ds", "forecast", *[f"{m}_prediction" for m in VOTING_WEIGHTS])
