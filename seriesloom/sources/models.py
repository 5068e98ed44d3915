"""Saving and loading fitted ensembles with Spark ML persistence."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..operators.boosting import BoostedModel
from ..operators.forests import ForestModel
from ..plans.ensemble import Ensemble

LOADERS = {"rf": ForestModel, "gbt": BoostedModel}
METADATA = "keys array<string>, features array<string>, models array<string>, params string"


def save_models(ensemble: Ensemble, path: str, save_performance: bool = True) -> str:
    """Write models, per-series facts, metadata and (optionally) scores below ``path``."""
    if not ensemble.models:
        raise ValueError("no models to save; train first")
    spark = ensemble.facts.sparkSession
    for name, model in ensemble.trees.items():
        model.write().overwrite().save(f"{path}/{name}")
    ensemble.prepare.write().overwrite().save(f"{path}/prepare")
    ensemble.facts.write.mode("overwrite").parquet(f"{path}/facts")
    if save_performance and ensemble.metrics is not None:
        ensemble.metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    row = (ensemble.keys, ensemble.features, list(ensemble.trees), json.dumps(ensemble.params))
    spark.createDataFrame([row], METADATA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/metadata"
    )
    return path


def load_models(spark: SparkSession, path: str) -> Ensemble:
    """Read an ensemble back; raises FileNotFoundError when there is none at ``path``."""
    try:
        meta = spark.read.schema(METADATA).parquet(f"{path}/metadata").first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no saved models at {path}") from e
    try:
        metrics = spark.read.parquet(f"{path}/metrics")
    except AnalysisException:
        metrics = None
    return Ensemble(
        keys=list(meta.keys),
        features=list(meta.features),
        facts=spark.read.parquet(f"{path}/facts"),
        prepare=PipelineModel.load(f"{path}/prepare"),
        trees={m: LOADERS[m].load(f"{path}/{m}") for m in meta.models},
        params=json.loads(meta.params),
        metrics=metrics,
    )
