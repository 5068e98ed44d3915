"""Mergeable first and second moments, the base of every per-series fit.

Each task reduces its rows to one (n, mean, co-moment matrix) per series with
numpy; the partial results are merged per series and handed to a small solver.
What is shuffled depends on the number of columns, not on the history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Groups a task keeps open before it emits their partial moments.
OPEN_GROUPS = 512

Moments = tuple[int, np.ndarray, np.ndarray]


def _of(x: np.ndarray) -> Moments:
    mean = x.mean(axis=0)
    d = x - mean
    return len(x), mean, d.T @ d


def merge_two(a: Moments, b: Moments) -> Moments:
    """Pairwise update of means and co-moments (Chan, Golub and LeVeque)."""
    n = a[0] + b[0]
    delta = b[1] - a[1]
    return (
        n,
        a[1] + delta * (b[0] / n),
        a[2] + b[2] + np.outer(delta, delta) * (a[0] * b[0] / n),
    )


def merged(parts: Iterable[Moments]) -> Moments:
    parts = iter(parts)
    total = next(parts)
    for p in parts:
        total = merge_two(total, p)
    return total


def deviations(moments: Moments) -> np.ndarray:
    """Population deviations; zero for columns that vary only by float noise."""
    n, mean, co = moments
    sd = np.sqrt(np.maximum(np.diag(co), 0.0) / n)
    return np.where(sd > 1e-10 * np.abs(mean), sd, 0.0)


def correlation_of(moments: Moments) -> np.ndarray:
    """Correlation matrix; NaN against a constant column."""
    sd, co = deviations(moments), moments[2] / moments[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        return co / np.outer(sd, sd)


def partial_moments(
    df: DataFrame, by: Sequence[str], columns: Sequence[str | Column] | Column
) -> DataFrame:
    """Moments of ``columns`` per group and task: ``(by..., n, mean, co)``.

    ``columns`` may be one array column whose length is the same within a group.
    Rows with a null in any column are left out.
    """
    by = list(by)
    x = columns
    if not isinstance(columns, Column):
        x = F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in columns])
    rows = df.select(*by, x.alias("_x"))
    key_fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]]
    schema = ", ".join([*key_fields, "n bigint", "mean array<double>", "co array<double>"])

    def emit(groups: dict, types) -> pa.RecordBatch:
        keys = list(groups)
        arrays = [pa.array([k[i] for k in keys], type=t) for i, t in enumerate(types)]
        arrays += [
            pa.array([m[0] for m in groups.values()], pa.int64()),
            pa.array([m[1] for m in groups.values()], pa.list_(pa.float64())),
            # A single row has no co-moments; leave its zeros out.
            pa.array(
                [m[2].ravel() if m[0] > 1 else [] for m in groups.values()],
                pa.list_(pa.float64()),
            ),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[*by, "n", "mean", "co"])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, Moments] = {}
        types: list = []
        for batch in batches:
            types = [batch.schema.field(b).type for b in by]
            vectors = batch.column(len(by))
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            width = vectors.value_lengths().to_numpy(zero_copy_only=False)
            first = np.cumsum(width) - width
            if by:
                frame = pd.DataFrame({b: batch.column(i).to_pylist() for i, b in enumerate(by)})
                ids = frame.groupby(by, sort=False, dropna=False).indices.values()
            else:
                ids = [np.arange(len(width))]
            for rows in ids:
                key = tuple(batch.column(i)[int(rows[0])].as_py() for i in range(len(by)))
                x = values[first[rows][:, None] + np.arange(width[rows[0]])] if len(rows) else values[:0, None]
                x = x[~np.isnan(x).any(axis=1)]
                if len(x):
                    part = _of(x)
                    groups[key] = merge_two(groups[key], part) if key in groups else part
            if len(groups) > OPEN_GROUPS:
                yield emit(groups, types)
                groups = {}
        if groups:
            yield emit(groups, types)

    return rows.mapInArrow(reduce, schema)


def solve_groups(
    moments: DataFrame,
    keys: Sequence[str],
    solve: Callable[[tuple, dict[tuple, Moments]], dict[str, Sequence] | None],
    schema: str,
) -> DataFrame:
    """Merge partial moments and solve per series.

    Moments may be grouped finer than ``keys`` (by fold segment, say): ``solve``
    gets ``{finer key: moments}`` and returns columns of output rows.
    """
    keys = list(keys)
    finer = [c for c in moments.columns if c not in keys and c not in ("n", "mean", "co")]
    types = dict(moments.dtypes)
    names = [f.strip().split(" ")[0] for f in _fields(schema)]

    def combine(pdf: pd.DataFrame) -> dict[tuple, Moments]:
        out: dict[tuple, Moments] = {}
        for at, part in _parts(pdf, finer):
            out[at] = merge_two(out[at], part) if at in out else part
        return out

    if not keys:
        moments = _premerge(moments, finer)

    def apply(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        groups = combine(pdf)
        columns = solve(key, dict(sorted(groups.items())))
        if columns is None:
            return pd.DataFrame(columns=[*keys, *names])
        out = pd.DataFrame(columns)
        for i, k in enumerate(keys):
            out.insert(i, k, key[i])
        return out[[*keys, *names]]

    key_schema = [f"`{k}` {types[k]}" for k in keys]
    grouped = moments.groupBy(*keys) if keys else moments.groupBy(F.lit(0).alias("_all"))
    return grouped.applyInPandas(apply, ", ".join([*key_schema, schema]))


def _parts(pdf: pd.DataFrame, finer: list[str]) -> Iterator[tuple[tuple, Moments]]:
    labels = zip(*[pdf[f] for f in finer]) if finer else iter([()] * len(pdf))
    for at, n, mean, co in zip(labels, pdf["n"], pdf["mean"], pdf["co"]):
        mean, co = np.asarray(mean, dtype=float), np.asarray(co, dtype=float)
        square = co.reshape(len(mean), -1) if len(co) else np.zeros((len(mean), len(mean)))
        yield at, (int(n), mean, square)


def _premerge(moments: DataFrame, finer: list[str]) -> DataFrame:
    """Merge in two steps when all tasks' moments meet in a single group."""
    types = dict(moments.dtypes)

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        out: dict[tuple, Moments] = {}
        for at, part in _parts(pdf, finer):
            out[at] = merge_two(out[at], part) if at in out else part
        rows = [[*at, m[0], m[1], m[2].ravel()] for at, m in out.items()]
        return pd.DataFrame(rows, columns=[*finer, "n", "mean", "co"])

    order = [*finer, "n", "mean", "co"]
    salted = moments.select(*order, (F.spark_partition_id() % 64).alias("_salt"))
    schema = ", ".join(f"`{c}` {types[c]}" for c in order)
    return salted.groupBy("_salt").applyInPandas(combine, schema)


def _fields(schema: str) -> list[str]:
    """Split a DDL string at the commas outside angle brackets."""
    fields, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            fields.append(schema[start:i])
            start = i + 1
    return [*fields, schema[start:]]
