"""Global forest and boosted-tree models over a panel.

One model serves all series: the target is standardised per series with
training statistics and predictions are scaled back, so for a single series
this equals a model of its own.  Both kinds grow from cells of binned features
(``boosting.cell_table``), which one pass over the panel counts.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .boosting import BoostedModel, Spec, Trainer, cell_table, feature_edges
from .forests import ForestModel, forest_losses, forest_model, grow_forests

# The parameter grids searched.  30 stands for "unlimited" depth.
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [5, 7, 10, 30]}
BOOSTED_GRID = {"maxIter": [100, 200], "stepSize": [0.01, 0.1], "maxDepth": [3, 5]}


@dataclass(frozen=True)
class TreeSettings:
    """``max_bins`` bounds the split candidates per feature (366 days of a year).

    Bins are halved until there are no more than ``most_cells`` cells, which a task
    holds in memory; a calendar of a century stays below it at full bins.
    """

    max_bins: int = 400
    seed: int = 42
    checkpoint_every: int = 20
    most_cells: int = 1 << 20


def counted_cells(
    rows: DataFrame, columns: Sequence[Column], segment: Column, targets: Sequence[Column], settings: TreeSettings
) -> tuple[DataFrame, list[list[float]]]:
    """Cells in the shared folder, and the edges of their bins."""
    bins = settings.max_bins
    while True:
        edges = feature_edges(rows, columns, bins)
        cells = materialize(cell_table(rows, columns, edges, segment, targets), "cells")
        if bins <= 2 or cells.count() <= settings.most_cells:
            return cells, edges
        bins //= 2


@dataclass(frozen=True)
class TreeEstimator:
    """One model on rows with a vector ``x`` and a target ``z``."""

    algorithm: str
    params: Mapping
    settings: TreeSettings = TreeSettings()

    def fit(self, rows: DataFrame) -> ForestModel | BoostedModel:
        first = rows.select(F.size(vector_to_array("x"))).first()
        if first is None:
            raise ValueError("no rows to fit")
        columns = [vector_to_array("x")[i] for i in range(first[0])]
        cells, edges = counted_cells(rows, columns, F.lit(0), [F.col("z")], self.settings)
        use, p = [range(len(columns))], self.params
        if self.algorithm == "rf":
            trees = grow_forests(cells, use, p["numTrees"], p["maxDepth"], self.settings.seed)
            return forest_model(trees, 1, p["numTrees"], p["maxDepth"], edges)
        trainer = Trainer(cells, edges, use, [Spec(1, p["stepSize"], p["maxDepth"])])
        base, trees = trainer.grow(p["maxIter"], self.settings.checkpoint_every)
        return trainer.model(0, base, trees, p["maxIter"])


def forest(settings: TreeSettings = TreeSettings(), *, numTrees: int = 100, maxDepth: int = 30) -> TreeEstimator:
    return TreeEstimator("rf", {"numTrees": numTrees, "maxDepth": maxDepth}, settings)


def boosted(settings: TreeSettings = TreeSettings(), *, maxIter: int = 100, stepSize: float = 0.1, maxDepth: int = 5) -> TreeEstimator:
    return TreeEstimator("gbt", {"maxIter": maxIter, "stepSize": stepSize, "maxDepth": maxDepth}, settings)


ESTIMATORS = {"rf": forest, "gbt": boosted}


def grid_points(grid: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict]:
    """All points of the grid, or a random sample of ``n_iter`` of them."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    return points if n_iter >= len(points) else random.Random(seed).sample(points, n_iter)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="x").transform(df)


@dataclass
class FoldFrames:
    """Training and test rows of each fold, from one table that labels its rows.

    ``data`` carries ``segment``, the features, and per fold the training mean
    and deviation of the series in the arrays ``mu`` and ``sd``.  ``features``
    lists the features selected for each fold; the last fold has no test rows
    and stands for the final fit.
    """

    data: DataFrame
    features: list[list[str]]

    @property
    def folds(self) -> int:
        return len(self.features) - 1

    def _fold(self, fold: int) -> DataFrame:
        mu, sd = F.col("mu")[fold - 1], F.col("sd")[fold - 1]
        rows = self.data.where(mu.isNotNull()).withColumns({"_mu": mu, "_sd": sd})
        rows = rows.withColumn("z", (F.col("y") - F.col("_mu")) / F.col("_sd"))
        return assemble(rows, self.features[fold - 1])

    def train(self, fold: int) -> DataFrame:
        return self._fold(fold).where(F.col("segment") < fold).select("x", "z")

    def test(self, fold: int) -> DataFrame:
        return self._fold(fold).where(F.col("segment") == fold)


def predict_fold(frames: FoldFrames, model, fold: int, keys: Sequence[str]) -> DataFrame:
    scored = model.transform(frames.test(fold))
    return scored.select(
        *keys, "ds", F.lit(fold).alias("fold"), "y",
        (F.col("z_hat") * F.col("_sd") + F.col("_mu")).alias("yhat"),
    )


@dataclass
class SearchResult:
    algorithm: str
    params: dict
    scores: list[tuple[str, dict, int, float]] = field(default_factory=list)
    models: dict[int, object] = field(default_factory=dict)


def _mean(values: Sequence[float | None]) -> float:
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else float("inf")


def _choose(result: SearchResult, points: list[dict], losses: Mapping[int, list[float]]) -> dict:
    """Enter the losses (per fold, in the order of ``points``) and return the point with the lowest mean."""
    for i, point in enumerate(points):
        result.scores += [(result.algorithm, point, f, loss[i]) for f, loss in losses.items()]
    result.params = min(points, key=lambda p: _mean([loss[points.index(p)] for loss in losses.values()]))
    return result.params


def _fold_cells(frames: FoldFrames, settings: TreeSettings) -> tuple[DataFrame, list[list[float]], list[list[int]]]:
    """Cells of all folds, edges of all features, and the features of every fold by number."""
    names = sorted({n for fs in frames.features for n in fs})
    targets = [(F.col("y") - F.col("mu")[f]) / F.col("sd")[f] for f in range(frames.folds + 1)]
    cells, edges = counted_cells(frames.data, [F.col(n).cast("double") for n in names], F.col("segment"), targets, settings)
    return cells, edges, [[names.index(n) for n in fs] for fs in frames.features]


def forest_search(frames: FoldFrames, points: list[dict], settings: TreeSettings = TreeSettings()) -> SearchResult:
    """One forest per fold, and the final one, at the largest values hold all points."""
    folds = range(1, frames.folds + 1)
    cells, edges, features = _fold_cells(frames, settings)
    trees = grow_forests(cells, features, max(p["numTrees"] for p in points), max(p["maxDepth"] for p in points), settings.seed)
    loss = forest_losses(trees, cells, features, [(p["numTrees"], p["maxDepth"]) for p in points])
    result = SearchResult("rf", points[0])
    best = _choose(result, points, {f: [loss.get((f, i)) for i in range(len(points))] for f in folds})
    of = lambda f: [edges[i] for i in features[f - 1]]
    result.models = {f: forest_model(trees, f, best["numTrees"], best["maxDepth"], of(f)) for f in (*folds, frames.folds + 1)}
    return result


def boosted_search(frames: FoldFrames, points: list[dict], settings: TreeSettings = TreeSettings()) -> SearchResult:
    """All folds, step sizes and depths, and the final models, grow together; fewer rounds are a prefix."""
    folds = range(1, frames.folds + 1)
    cells, edges, features = _fold_cells(frames, settings)
    kinds = sorted({(p["stepSize"], p["maxDepth"]) for p in points})
    specs = [Spec(f, *k) for f in (*folds, frames.folds + 1) for k in kinds]
    trainer = Trainer(cells, edges, features, specs)
    base, trees = trainer.grow(max(p["maxIter"] for p in points), settings.checkpoint_every)
    loss = trainer.losses(base, trees, [p["maxIter"] for p in points])
    of = lambda f, p: specs.index(Spec(f, p["stepSize"], p["maxDepth"]))
    result = SearchResult("gbt", points[0])
    best = _choose(result, points, {f: [loss.get((of(f, p), p["maxIter"])) for p in points] for f in folds})
    result.models = {f: trainer.model(of(f, best), base, trees, best["maxIter"]) for f in (*folds, frames.folds + 1)}
    return result


SEARCHES = {"rf": forest_search, "gbt": boosted_search}


def param_search(frames: FoldFrames, algorithm: str, points: list[dict], settings: TreeSettings = TreeSettings()) -> SearchResult:
    """Mean squared error of each parameter set over the expanding folds; keeps the best.

    Errors are on the standardised target, so no series outweighs the others.  The
    models of the best set come with it: one per fold and the final one.
    """
    return SEARCHES[algorithm](frames, points, settings)
