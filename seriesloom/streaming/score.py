"""Scoring a stream of dates with a fitted ensemble.

Scoring keeps no state: the same columns as in batch, and a static join with
the per-series facts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.blend import weighted_blend
from ..plans.ensemble import Ensemble, predict_rows


def score_stream(
    dates: DataFrame, ensemble: Ensemble, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Add the forecast to a streaming ``(keys, ds)`` frame."""
    return weighted_blend(predict_rows(ensemble, dates), weights, ensemble.models)


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scored rows to parquet; the checkpoint makes restarts exactly-once."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
