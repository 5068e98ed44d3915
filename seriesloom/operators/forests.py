"""Regression forests from cells of binned features.

The cells are those of ``boosting``: rows with the same binned features and fold
segment, counted once.  A tree draws each cell a Poisson number of times, as often
on average as it has rows; the draw depends on the cell and the tree alone.  With
all features open to every split, a shallower tree is the deeper one cut off and a
smaller forest is the first trees of a larger one, so one forest per fold, grown at
the largest values, holds every point of a parameter grid and the models to keep.

Trees are rows of a table.  Tasks grow some trees of one fold each from a copy of the
cells, which the caller keeps small enough for a task; the errors of all grid points
come from a join of the trees with the cells they are tested on.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .draws import hashes, poisson, uniform

#: Trees that a task grows of a fold.
TREES_PER_TASK = 25
TREES = "fold int, tree int, feature array<int>, cut array<int>, child array<int>, depth array<int>, value array<double>, gain array<double>"
LISTS = ["feature", "cut", "child", "depth", "value", "gain"]


def grow_tree(bins: np.ndarray, w: np.ndarray, s: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    """A tree on cells with weights ``w`` and weighted target sums ``s``, level by level.

    Nodes are numbered by level; the right child of a node follows its left one
    (``child``).  A split is the one that lowers the squared error most, ties to the
    first feature and lowest cut; a node splits as long as that lowers it at all.
    """
    drawn = w > 0
    bins, w, s = bins[drawn], w[drawn], s[drawn]
    orders = [np.argsort(bins[:, f], kind="stable") for f in range(bins.shape[1])]
    node = np.zeros(len(w), np.int64)
    tree = {"feature": [np.array([-1])], "cut": [np.zeros(1, int)], "child": [np.zeros(1, int)], "depth": [np.zeros(1, int)],
            "value": [np.array([s.sum() / w.sum() if len(w) else 0.0])], "gain": [np.zeros(1)]}
    first, nodes = 0, 1  # numbers of this level's nodes
    for level in range(depth):
        here = node >= first
        if not here.any():
            break
        local = np.where(here, node - first, 0)
        g, h = np.bincount(local[here], s[here], nodes), np.bincount(local[here], w[here], nodes)
        whole = g * g / np.maximum(h, 1e-300)
        gain, feature, cut = 1e-12 * (1 + whole), np.full(nodes, -1), np.zeros(nodes, int)
        left_g, left_h = np.zeros(nodes), np.zeros(nodes)
        for f, order in enumerate(orders):
            o = order[here[order]]
            o = o[np.argsort(local[o], kind="stable")]
            k, b = local[o], bins[o, f]
            at = np.flatnonzero((k[1:] == k[:-1]) & (b[1:] != b[:-1]))
            if not len(at):
                continue
            cg, ch = np.cumsum(s[o]), np.cumsum(w[o])
            opens = np.searchsorted(k, np.arange(nodes))
            before_g, before_h = (np.concatenate(([0.0], c))[opens] for c in (cg, ch))
            n = k[at]
            gl, hl = cg[at] - before_g[n], ch[at] - before_h[n]
            won = gl * gl / hl + (g[n] - gl) ** 2 / (h[n] - hl) - whole[n]
            starts = np.flatnonzero(np.diff(n, prepend=-1))
            top = np.repeat(np.maximum.reduceat(won, starts), np.diff(np.append(starts, len(n))))
            peak = np.flatnonzero(won == top)
            peak = peak[np.diff(n[peak], prepend=-1) > 0]
            peak = peak[won[peak] > gain[n[peak]] * (1 + 1e-9)]
            m = n[peak]
            gain[m], feature[m], cut[m] = won[peak], f, b[at[peak]] + 1
            left_g[m], left_h[m] = gl[peak], hl[peak]
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        child = np.zeros(nodes, int)
        child[split] = first + nodes + 2 * np.arange(len(split))
        tree["feature"][-1], tree["cut"][-1], tree["child"][-1], tree["gain"][-1] = feature, cut, child, np.where(feature >= 0, gain, 0.0)
        pairs = lambda a, b: np.stack((a, b), axis=1).ravel()
        value = pairs(left_g[split] / left_h[split], (g - left_g)[split] / (h - left_h)[split])
        fresh = 2 * len(split)
        for name, v in (("feature", np.full(fresh, -1)), ("cut", np.zeros(fresh, int)), ("child", np.zeros(fresh, int)),
                        ("depth", np.full(fresh, level + 1)), ("value", value), ("gain", np.zeros(fresh))):
            tree[name].append(v)
        moves = here & (feature[local] >= 0)
        right = bins[np.arange(len(bins)), np.maximum(feature[local], 0)] >= cut[local]
        node = np.where(moves, child[local] + right, node)
        first, nodes = first + nodes, fresh
    return {k: np.concatenate(v) for k, v in tree.items()}


def walk(goes_right, feature: np.ndarray, child: np.ndarray, rows: int, depth: int | None = None) -> np.ndarray:
    """Node in which every row ends, ``depth`` levels down at most."""
    at, step = np.zeros(rows, np.int64), 0
    while depth is None or step < depth:
        inner = feature[at] >= 0
        if not inner.any():
            break
        at, step = np.where(inner, child[at] + goes_right(at), at), step + 1
    return at


def _arrays(table: pa.Table, names: Sequence[str]) -> list[np.ndarray]:
    columns = [table.column(n).combine_chunks() for n in names]
    return [c.flatten().to_numpy().reshape(len(c), -1) if pa.types.is_list(c.type) else c.to_numpy() for c in columns]


def grow_forests(cells: DataFrame, features: Sequence[Sequence[int]], trees: int, depth: int, seed: int = 42) -> DataFrame:
    """The trees of a forest per fold (on the segments before it), as a table ``TREES`` in the shared folder."""
    folds, chunks = len(features), -(-trees // TREES_PER_TASK)
    features = [list(f) for f in features]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        fold, chunk = divmod(key[0].as_py(), chunks)
        segment, bins, n, s = _arrays(table, ["segment", "bins", "n", "s"])
        n, s = n[:, fold], s[:, fold]
        rows = np.flatnonzero((segment <= fold) & (n > 0))
        # The order in which cells arrive must not show in sums.
        rows = rows[np.lexsort((*bins[rows].T, segment[rows]))]
        bins, n, s = bins[rows], n[rows], s[rows]
        cell = hashes(np.column_stack((bins, segment[rows]))) ^ np.uint64(seed)
        out = []
        for t in range(chunk * TREES_PER_TASK, min((chunk + 1) * TREES_PER_TASK, trees)):
            w = poisson(n, uniform(cell, np.array([t])))
            tree = grow_tree(bins[:, features[fold]], w, w * s / n, depth)
            out.append((fold + 1, t, *(tree[k] for k in LISTS)))
        kinds = [pa.int32()] * 2 + [pa.list_(pa.int32())] * 4 + [pa.list_(pa.float64())] * 2
        return pa.table({k: pa.array(c, t) for k, c, t in zip(["fold", "tree", *LISTS], zip(*out), kinds)})

    part = F.explode(F.sequence(F.lit(0), F.lit(folds * chunks - 1))).alias("part")
    copies = cells.select("segment", "bins", "n", "s", part).repartition(folds * chunks, "part")
    return materialize(copies.groupBy("part").applyInArrow(run, TREES), "forest")


def forest_losses(trees: DataFrame, cells: DataFrame, features: Sequence[Sequence[int]], points: Sequence[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """{(fold, point): mean squared error on the segment of the fold} for points (number of trees, depth).

    Trees meet the cells of their fold by a join on (fold, part of the forest), which
    gives sums of predictions per cell; one aggregate over the cells gives the errors.
    """
    features, folds = [list(f) for f in features], len(features)
    # The last entry is the final fit, which has no test rows.
    tests = cells.where(F.col("segment").between(1, folds - 1)).select(F.col("segment").alias("of_fold"), F.col("bins").alias("cell"))
    left = trees.withColumn("part", (F.col("tree") / F.lit(TREES_PER_TASK)).cast("int"))
    parts = -(-max(n for n, _ in points) // TREES_PER_TASK)
    asked = tests.withColumn("of_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(key: tuple, some: pa.Table, asked: pa.Table) -> pa.Table:
        fold = key[0].as_py()
        bins = asked.column("cell").combine_chunks()
        x = bins.flatten().to_numpy().reshape(len(bins), -1)[:, features[fold - 1]] if len(bins) else np.empty((0, 1), int)
        sums = np.zeros((len(x), len(points)))
        for row in some.to_pylist() if len(x) else ():
            feature, cut, child, value = (np.array(row[k]) for k in ("feature", "cut", "child", "value"))
            right = lambda at: x[np.arange(len(x)), np.maximum(feature[at], 0)] >= cut[at]  # noqa: B023, E731
            for depth in {d for _, d in points}:
                found = value[walk(right, feature, child, len(x), depth)]
                for i, (n, d) in enumerate(points):
                    if d == depth and row["tree"] < n:
                        sums[:, i] += found
        return pa.table({"fold": pa.array([fold] * len(x), pa.int32()), "cell": bins, "sums": pa.array(list(sums), pa.list_(pa.float64()))})

    pieces = left.groupBy("fold", "part").cogroup(asked.groupBy("of_fold", "of_part")).applyInArrow(run, "fold int, cell array<int>, sums array<double>")
    means = pieces.groupBy("fold", "cell").agg(*[(F.sum(F.col("sums")[i]) / n).alias(f"p{i}") for i, (n, _) in enumerate(points)])
    met = cells.join(means, (F.col("segment") == F.col("fold")) & (F.col("bins") == F.col("cell")))
    n, s, q = (F.get(c, F.col("fold") - 1) for c in ("n", "s", "q"))
    errors = [F.sum(n * F.col(f"p{i}") ** 2 - 2 * F.col(f"p{i}") * s + q) / F.nullif(F.sum(n), F.lit(0.0)) for i in range(len(points))]
    rows = met.groupBy("fold").agg(*[e.alias(f"e{i}") for i, e in enumerate(errors)]).collect()
    return {(r["fold"], i): r[f"e{i}"] for r in rows for i in range(len(points))}


def forest_model(trees: DataFrame, fold: int, number: int, depth: int, edges: Sequence[Sequence[float]]) -> "ForestModel":
    """The first ``number`` trees of a fold, cut off at ``depth``; ``edges`` are those of its features."""
    rows = trees.where((F.col("fold") == fold) & (F.col("tree") < number)).orderBy("tree").collect()  # a model
    out = []
    for r in rows:
        tree = {k: np.array(r[k]) for k in LISTS}
        keep = tree["depth"] <= depth
        feature = np.where(tree["depth"] < depth, tree["feature"], -1)[keep]
        limit = [edges[f][c - 1] if f >= 0 else 0.0 for f, c in zip(feature.tolist(), tree["cut"][keep].tolist())]
        gain = np.where(feature >= 0, tree["gain"][keep], 0.0)
        out.append((feature.tolist(), limit, tree["child"][keep].tolist(), tree["value"][keep].tolist(), gain.tolist()))
    return ForestModel(width=len(edges)).set_trees(out)


class ForestModel(Model, MLWritable, MLReadable):
    """A regression forest as a saveable Spark ML model: adds a prediction column to rows with a feature vector."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    SCHEMA = "tree int, feature array<int>, cut array<double>, child array<int>, value array<double>, gain array<double>"

    @keyword_only
    def __init__(self, *, featuresCol="x", predictionCol="z_hat", width=0):
        super().__init__()
        self._setDefault(featuresCol="x", predictionCol="z_hat", width=0)
        self._set(**self._input_kwargs)
        self.trees: list[tuple] = []

    def set_trees(self, trees: Sequence[tuple]) -> "ForestModel":
        self.trees = [tuple(np.asarray(v) for v in t) for t in trees]
        return self

    def copy(self, extra=None) -> "ForestModel":
        return super().copy(extra).set_trees(self.trees)

    def setPredictionCol(self, name: str) -> "ForestModel":
        return self._set(predictionCol=name)

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the error that the splits of every feature remove, as the mean over the trees."""
        total = np.zeros(self.getOrDefault(self.width))
        for feature, _, _, _, gain in self.trees:
            one = np.bincount(feature[feature >= 0], gain[feature >= 0], len(total))
            total += one / one.sum() if one.sum() else one
        return DenseVector(total / total.sum() if total.sum() else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, width = [t[:4] for t in self.trees], self.getOrDefault(self.width)

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()) if len(x) else np.empty((0, width))
            total, every = np.zeros(len(rows)), np.arange(len(rows))
            for feature, limit, child, value in trees:
                right = lambda at: rows[every, np.maximum(feature[at], 0)] >= limit[at]  # noqa: B023, E731
                total += value[walk(right, feature, child, len(rows))]
            return pd.Series(total / max(len(trees), 1))

        return dataset.withColumn(self.getOrDefault(self.predictionCol), predict(vector_to_array(self.getOrDefault(self.featuresCol))))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = [(i, *(v.tolist() for v in t)) for i, t in enumerate(self.model.trees)]
        self.sparkSession.createDataFrame(rows, ForestModel.SCHEMA).write.parquet(f"{path}/data")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ForestModel()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        rows = self.sparkSession.read.schema(ForestModel.SCHEMA).parquet(f"{path}/data").orderBy("tree").collect()
        return model.set_trees([(r["feature"], r["cut"], r["child"], r["value"], r["gain"]) for r in rows])
