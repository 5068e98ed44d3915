"""Boosted trees from gradient and hessian sums, many models in one pass.

Rows with the same binned features and fold segment are one *cell*, which keeps
count, sum and sum of squares of the target: all that squared loss needs.  The
panel is read once to make cells; what later passes read is bounded by the number
of different binned feature vectors (for calendar features: days times start bins),
not by the number of series.

All models (folds, step sizes, depths) grow together.  A level of their trees is
one job: tasks sum gradients and hessians by (model, node, feature, bin), the sums
meet by model, and one row per node comes back with its best split.  A leaf is worth
``-G / (H + penalty)`` times the step size.  Cells carry the margin of every model
as of the last checkpoint, so a pass replays a bounded number of trees.

Where the cells, once counted, are few enough for a task, a model grows in the task
that gets a copy of them, by the same sums and splits, and all models side by side:
a job per level would only wait for the scheduler.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Penalty on leaf weights, least hessian of a child, least gain of a split.
PENALTY, LEAST_WEIGHT, LEAST_GAIN = 1.0, 1.0, 1e-6
#: Cells that a task handles in all, and at a time.
CELLS_PER_TASK, SLAB = 1 << 16, 1 << 13


class Spec(NamedTuple):
    """A model to train: on the segments before ``fold``."""

    fold: int
    step_size: float
    depth: int


def feature_edges(rows: DataFrame, columns: Sequence[Column], max_bins: int) -> list[list[float]]:
    """Split candidates per column: between all values of columns with few, else quantiles.

    A value lies in the bin that counts the edges not above it.
    """
    known = rows.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    few = [n <= 0.9 * max_bins for n in known]
    shares = [i / max_bins for i in range(1, max_bins)]

    def values(c: Column, small: bool) -> Column:
        # The set is bounded by the count before, the quantiles by their number.
        return F.sort_array(F.collect_set(c)) if small else F.percentile_approx(c, shares, 100 * max_bins)

    c = [x.cast("double") for x in columns]
    found = rows.agg(*[values(x, small).alias(f"v{i}") for i, (x, small) in enumerate(zip(c, few))], *[F.min(x).alias(f"m{i}") for i, x in enumerate(c)]).first()
    edges = []
    for i, small in enumerate(few):
        v = sorted(set(found[f"v{i}"] or []))
        edges.append([(a + b) / 2 for a, b in zip(v, v[1:])] if small else [x for x in v if x > found[f"m{i}"]])
    return edges


def cell_table(rows: DataFrame, columns: Sequence[Column], edges: Sequence[Sequence[float]], segment: Column, targets: Sequence[Column]) -> DataFrame:
    """``segment, bins, n, s, q``: count, sum and sum of squares of every target per cell."""
    xs, zs = [f"x{i}" for i in range(len(columns))], [f"z{i}" for i in range(len(targets))]
    named = rows.select(
        segment.cast("int").alias("segment"),
        *[c.cast("double").alias(x) for c, x in zip(columns, xs)],
        *[z.cast("double").alias(n) for z, n in zip(targets, zs)],
    )
    split = [i for i, e in enumerate(edges) if e]
    if split:
        bins = Bucketizer(
            splitsArray=[[-math.inf, *edges[i], math.inf] for i in split], inputCols=[xs[i] for i in split], outputCols=[f"b{i}" for i in split]
        )
        named = bins.transform(named)
    at = F.array(*[F.col(f"b{i}").cast("int") if edges[i] else F.lit(0) for i in range(len(xs))])
    sums = {"n": F.count, "s": F.sum, "q": lambda z: F.sum(F.col(z) * F.col(z))}
    cells = named.groupBy("segment", at.alias("bins")).agg(*[f(z).alias(f"{name}_{z}") for name, f in sums.items() for z in zs])
    arrays = [F.array(*[F.coalesce(F.col(f"{name}_{z}").cast("double"), F.lit(0.0)) for z in zs]).alias(name) for name in sums]
    return cells.select("segment", "bins", *arrays)


@dataclass
class Grown:
    """Trees of all models in heap order: split feature (-1: leaf), first bin on the right, leaf value, gain."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(models: int, rounds: int, depth: int) -> "Grown":
        shape = (models, rounds, (2 << depth) - 1)
        return Grown(np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.zeros(shape), np.zeros(shape))

    def rounds(self, first: int, last: int) -> "Grown":
        return Grown(*(x[:, first:last].copy() for x in (self.feature, self.cut, self.value, self.gain)))


def places(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Node of one tree per model that every cell ends in: (models, cells)."""
    models, cells = len(feature), len(bins)
    at, every = np.zeros((models, cells), np.int64), np.arange(cells)
    for _ in range(int(math.log2(feature.shape[1] + 1)) - 1):
        f = np.take_along_axis(feature, at, 1)
        right = bins[every, np.maximum(f, 0)] >= np.take_along_axis(cut, at, 1)
        at = np.where(f < 0, at, 2 * at + 1 + right)
    return at


def advance(margin: np.ndarray, bins: np.ndarray, trees: Grown) -> np.ndarray:
    """Margins (models, cells) after these trees."""
    for t in range(trees.feature.shape[1]):
        at = places(bins, trees.feature[:, t], trees.cut[:, t])
        margin = margin + np.take_along_axis(trees.value[:, t], at, 1)
    return margin


def node_sums(bins: np.ndarray, at: np.ndarray, weights: Sequence[np.ndarray], offsets: np.ndarray, nodes: int) -> list[np.ndarray]:
    """Sums of every weight by (node, feature, bin), features one after the other."""
    size = int(offsets[-1])
    code = ((at * size)[:, None] + bins + offsets[:-1]).ravel()
    return [np.bincount(code, np.repeat(w, bins.shape[1]), nodes * size).reshape(nodes, size) for w in weights]


def best_splits(g: np.ndarray, h: np.ndarray, offsets: np.ndarray, penalty: float) -> dict[str, np.ndarray]:
    """Best split of every node: largest gain, ties to the first feature and the lowest cut."""
    nodes, every = len(g), np.arange(len(g))
    all_g, all_h = g[:, : offsets[1]].sum(axis=1), h[:, : offsets[1]].sum(axis=1)
    best = {
        "feature": np.full(nodes, -1), "cut": np.zeros(nodes, int), "gain": np.full(nodes, LEAST_GAIN),
        "g": all_g, "h": all_h, "g_left": np.zeros(nodes), "h_left": np.zeros(nodes),
    }
    worth = lambda a, b: a * a / (b + penalty)
    for f, (start, end) in enumerate(zip(offsets, offsets[1:])):
        if end - start < 2:
            continue
        gl, hl = np.cumsum(g[:, start : end - 1], axis=1), np.cumsum(h[:, start : end - 1], axis=1)
        hr = all_h[:, None] - hl
        gain = worth(gl, hl) + worth(all_g[:, None] - gl, hr) - worth(all_g, all_h)[:, None]
        gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT)] = -np.inf
        at = gain.argmax(axis=1)
        # Sums in another order must not decide a tie.
        better = gain[every, at] > best["gain"] * (1 + 1e-9)
        found = {"feature": f, "cut": at + 1, "gain": gain[every, at], "g_left": gl[every, at], "h_left": hl[every, at]}
        best |= {k: np.where(better, v, best[k]) for k, v in found.items()}
    return best


def place(trees: Grown, m: int, t: int, level: int, node: int, best: dict, step_size: float, penalty: float, features: Sequence[int]) -> int:
    """Enter the best split of a node; returns the number of splits."""
    i = (1 << level) - 1 + node
    leaf = lambda g, h: -step_size * g / (h + penalty)
    if best["feature"] < 0:
        if not level:
            trees.value[m, t, 0] = leaf(best["g"], best["h"])
        return 0
    trees.feature[m, t, i], trees.cut[m, t, i], trees.gain[m, t, i] = features[best["feature"]], best["cut"], best["gain"]
    trees.value[m, t, 2 * i + 1] = leaf(best["g_left"], best["h_left"])
    trees.value[m, t, 2 * i + 2] = leaf(best["g"] - best["g_left"], best["h"] - best["h_left"])
    return 1


def slabs(batches: Iterator[pa.RecordBatch], names: Sequence[str]):
    """Arrays of up to ``SLAB`` cells: vectors for numbers, matrices for lists."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLAB):
            batch = whole.slice(at, SLAB)
            out = []
            for name in names:
                c = batch.column(batch.schema.get_field_index(name))
                out.append(c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False))
            yield batch, out


class Trainer:
    """Grows the trees of ``specs`` on a table of cells."""

    def __init__(self, cells: DataFrame, edges: Sequence[Sequence[float]], features: Sequence[Sequence[int]], specs: Sequence[Spec], penalty: float = PENALTY):
        self.cells, self.edges, self.specs, self.penalty = cells, edges, list(specs), penalty
        #: Per model, its features (numbers of columns).
        self.features = [list(features[s.fold - 1]) for s in specs]
        self.width = [len(e) + 1 for e in edges]
        self.depth = max(s.depth for s in specs)

    def base(self) -> np.ndarray:
        """Mean target of the training rows of every model."""
        folds = [s.fold for s in self.specs]
        sums = [
            F.sum(F.when(F.col("segment") < f, F.col(c)[f - 1])).alias(f"{c}{f}") for f in sorted(set(folds)) for c in ("s", "n")
        ]
        row = self.cells.agg(*sums).first()
        return np.array([(row[f"s{f}"] or 0.0) / (row[f"n{f}"] or 1.0) for f in folds])

    def offsets(self, m: int) -> np.ndarray:
        return np.cumsum([0, *(self.width[f] for f in self.features[m])])

    def sums(self, state: DataFrame, since: Grown, tree: Grown, level: int) -> DataFrame:
        """``model, g, h``: per task, sums by (node of the level, feature, bin)."""
        specs, features = self.specs, self.features
        offsets = [self.offsets(m) for m in range(len(specs))]
        first, nodes = (1 << level) - 1, 1 << level

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list[np.ndarray]] = {}
            for _, (segment, bins, n, s, margin) in slabs(batches, ["segment", "bins", "n", "s", "margin"]):
                margin = advance(margin.T, bins, since)
                at = places(bins, tree.feature[:, 0], tree.cut[:, 0]) - first
                for m, spec in enumerate(specs):
                    h = n[:, spec.fold - 1]
                    rows = np.flatnonzero((segment < spec.fold) & (h > 0) & (at[m] >= 0))
                    if level >= spec.depth or not len(rows):
                        continue
                    weights = h[rows] * margin[m][rows] - s[rows, spec.fold - 1], h[rows]
                    both = node_sums(bins[rows][:, features[m]], at[m][rows], weights, offsets[m], nodes)
                    total[m] = [a + b for a, b in zip(total[m], both)] if m in total else both
            if total:
                columns = [pa.array(list(total), pa.int32())]
                columns += [pa.array([v[k].ravel() for v in total.values()], pa.list_(pa.float64())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["model", "g", "h"])

        return state.mapInArrow(run, "model int, g array<double>, h array<double>")

    def splits(self, sums: DataFrame, level: int) -> DataFrame:
        """Best split of every node of a level that has rows; features are numbered as in the model."""
        offsets, penalty, nodes = [self.offsets(m) for m in range(len(self.specs))], self.penalty, 1 << level

        def run(key: tuple, table: pa.Table) -> pa.Table:
            m = key[0].as_py()
            g, h = (table.column(c).combine_chunks().flatten().to_numpy().reshape(table.num_rows, nodes, -1).sum(axis=0) for c in ("g", "h"))
            best = best_splits(g, h, offsets[m], penalty)
            some = np.flatnonzero(best["h"] > 0)
            columns = {"model": pa.array(np.full(len(some), m), pa.int32()), "node": pa.array(some, pa.int32())}
            columns |= {k: pa.array(v[some], pa.int32() if k in ("feature", "cut") else pa.float64()) for k, v in best.items()}
            return pa.table(columns)

        schema = "model int, node int, feature int, cut int, gain double, g double, h double, g_left double, h_left double"
        return sums.groupBy("model").applyInArrow(run, schema)

    def grow(self, rounds: int, checkpoint_every: int = 20, cells_per_task: int = CELLS_PER_TASK) -> tuple[np.ndarray, Grown]:
        """(start value of every model, its trees)."""
        base, cells = self.base(), self.cells.count()
        if cells <= cells_per_task:
            return base, self.grow_side_by_side(base, rounds)
        return base, self.grow_by_level(base, rounds, checkpoint_every, 1 + cells // cells_per_task)

    def grow_by_level(self, base: np.ndarray, rounds: int, checkpoint_every: int, tasks: int) -> Grown:
        """A job per level of the trees of a round, for cells spread over tasks."""
        trees = Grown.empty(len(self.specs), rounds, self.depth)
        state = self.cells.repartition(tasks).withColumn("margin", F.array(*[F.lit(float(b)) for b in base])).persist()
        done = 0
        for t in range(rounds):
            if t - done == checkpoint_every:
                fresh = materialize(self.moved(state, trees.rounds(done, t)), "margins").persist()
                state.unpersist()
                state, done = fresh, t
            for level in range(self.depth):
                sums = self.sums(state, trees.rounds(done, t), trees.rounds(t, t + 1), level)
                # One row per model and node.
                found = self.splits(sums, level).collect()
                if not sum([place(trees, r["model"], t, level, r["node"], r, self.specs[r["model"]].step_size, self.penalty, self.features[r["model"]]) for r in found]):
                    break
        state.unpersist()
        return trees

    def grow_side_by_side(self, base: np.ndarray, rounds: int) -> Grown:
        """A task per model, each with a copy of the counted cells; a row of trees per model comes back."""
        specs, features, penalty, depth = self.specs, self.features, self.penalty, self.depth
        offsets = [self.offsets(m) for m in range(len(specs))]
        names = ["feature", "cut", "value", "gain"]

        def run(key: tuple, table: pa.Table) -> pa.Table:
            m = key[0].as_py()
            spec, grown = specs[m], Grown.empty(1, rounds, depth)
            bins, n, s = (table.column(c).combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1) for c in ("bins", "n", "s"))
            h, s = n[:, spec.fold - 1], s[:, spec.fold - 1]
            rows = np.flatnonzero((table.column("segment").to_numpy() < spec.fold) & (h > 0))
            # The order in which cells arrive must not show in sums.
            rows = rows[np.lexsort((*bins[rows].T, table.column("segment").to_numpy()[rows]))]
            bins, h, s = bins[rows], h[rows], s[rows]
            mine, margin = bins[:, features[m]], np.full(len(rows), base[m])
            for t in range(rounds):
                for level in range(spec.depth):
                    at = places(bins, grown.feature[:, t], grown.cut[:, t])[0] - ((1 << level) - 1)
                    here = np.flatnonzero(at >= 0)
                    weights = h[here] * margin[here] - s[here], h[here]
                    best = best_splits(*node_sums(mine[here], at[here], weights, offsets[m], 1 << level), offsets[m], penalty)
                    nodes = [{k: v[i] for k, v in best.items()} for i in range(1 << level)]
                    if not sum(place(grown, 0, t, level, i, r, spec.step_size, penalty, features[m]) for i, r in enumerate(nodes) if r["h"] > 0):
                        break
                margin = advance(margin[None, :], bins, grown.rounds(t, t + 1))[0]
            columns = {"model": pa.array([m], pa.int32())}
            columns |= {k: pa.array([getattr(grown, k).ravel()], pa.list_(pa.int32() if k in ("feature", "cut") else pa.float64())) for k in names}
            return pa.table(columns)

        copies = self.cells.select("segment", "bins", "n", "s").withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(specs) - 1))))
        grown = copies.repartition(len(specs), "model").groupBy("model").applyInArrow(
            run, "model int, feature array<int>, cut array<int>, value array<double>, gain array<double>"
        )
        trees = Grown.empty(len(specs), rounds, depth)
        for row in grown.toArrow().to_pylist():
            for k in names:
                of = getattr(trees, k)
                of[row["model"]] = np.array(row[k], of.dtype).reshape(of.shape[1:])
        return trees

    def moved(self, state: DataFrame, trees: Grown) -> DataFrame:
        """``state`` with the margins after ``trees``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, (bins, margin) in slabs(batches, ["bins", "margin"]):
                after = pa.array(list(advance(margin.T, bins, trees).T), pa.list_(pa.float64()))
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", after)

        return state.mapInArrow(run, state.schema)

    def losses(self, base: np.ndarray, trees: Grown, wanted: Sequence[int]) -> dict[tuple[int, int], float]:
        """{(model, rounds): mean squared error on the segment of the model's fold}, from one pass."""
        specs = self.specs

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, (segment, bins, n, s, q) in slabs(batches, ["segment", "bins", "n", "s", "q"]):
                margin, done, rows = np.repeat(base[:, None], len(bins), axis=1), 0, []
                for r in sorted(set(wanted)):
                    margin, done = advance(margin, bins, trees.rounds(done, r)), r
                    for m, spec in enumerate(specs):
                        at, f = segment == spec.fold, spec.fold - 1
                        error = n[at, f] * margin[m][at] ** 2 - 2 * margin[m][at] * s[at, f] + q[at, f]
                        rows.append((m, r, float(error.sum()), float(n[at, f].sum())))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32()] * 2 + [pa.float64()] * 2)]
                yield pa.RecordBatch.from_arrays(columns, names=["model", "rounds", "error", "n"])

        parts = self.cells.mapInArrow(run, "model int, rounds int, error double, n double")
        found = parts.groupBy("model", "rounds").agg((F.sum("error") / F.nullif(F.sum("n"), F.lit(0.0))).alias("loss")).collect()
        return {(r["model"], r["rounds"]): r["loss"] for r in found}

    def model(self, m: int, base: np.ndarray, trees: Grown, rounds: int) -> "BoostedModel":
        """Model ``m`` after ``rounds`` trees, over vectors of its own features."""
        place = {f: i for i, f in enumerate(self.features[m])}
        out = []
        for t in range(rounds):
            feature, cut = trees.feature[m, t], trees.cut[m, t]
            limits = [self.edges[f][c - 1] if f >= 0 else 0.0 for f, c in zip(feature.tolist(), cut.tolist())]
            out.append([[place.get(f, -1) for f in feature.tolist()], limits, trees.value[m, t].tolist(), trees.gain[m, t].tolist()])
        spec = {"base": float(base[m]), "features": len(place), "trees": out}
        return BoostedModel(trees=json.dumps(spec))


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees as a saveable Spark ML model: adds a prediction column to rows with a feature vector."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "start value and trees in heap order, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="x", predictionCol="z_hat", trees="{}"):
        super().__init__()
        self._setDefault(featuresCol="x", predictionCol="z_hat", trees="{}")
        self._set(**self._input_kwargs)

    def setPredictionCol(self, name: str) -> "BoostedModel":
        return self._set(predictionCol=name)

    @property
    def spec(self) -> dict:
        return json.loads(self.getOrDefault(self.trees))

    @property
    def featureImportances(self) -> DenseVector:
        """Mean gain of the splits of every feature, adding up to 1."""
        spec = self.spec
        gain, n = np.zeros(spec["features"]), np.zeros(spec["features"])
        for feature, _, _, gains in spec["trees"]:
            used = np.array(feature) >= 0
            np.add.at(gain, np.array(feature)[used], np.array(gains)[used])
            np.add.at(n, np.array(feature)[used], 1)
        mean = gain / np.maximum(n, 1)
        return DenseVector(mean / mean.sum() if mean.sum() else mean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spec = self.spec
        parts = [np.array([t[k] for t in spec["trees"]]) for k in range(3)] if spec["trees"] else None
        base = spec["base"]

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()) if len(x) else np.empty((0, spec["features"]))
            total = np.full(len(rows), base)
            for feature, limit, value in zip(*parts) if parts else ():
                at, every = np.zeros(len(rows), np.int64), np.arange(len(rows))
                for _ in range(int(math.log2(len(feature) + 1)) - 1):
                    f = feature[at]
                    right = rows[every, np.maximum(f, 0)] >= limit[at]
                    at = np.where(f < 0, at, 2 * at + 1 + right)
                total += value[at]
            return pd.Series(total)

        return dataset.withColumn(self.getOrDefault(self.predictionCol), predict(vector_to_array(self.getOrDefault(self.featuresCol))))
