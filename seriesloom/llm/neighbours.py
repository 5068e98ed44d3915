"""Nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is cut into balanced parts with
few edges between them (recursive spectral bisection, refined by swaps).  A small
softmax classifier learns, for any vector, how its neighbours spread over the
parts.  Every vector is filed under its most probable part; a query visits parts
in order of probability until they cover a given share, and is reranked there by
exact distances.

Parts are dealt out in blocks of bounded size, so neither a large part nor a large
set of queries meets in one task.  Equal vectors are filed once, with their
smallest ids: more than ``k + 1`` of them can never be among the k nearest, as ties
go to smaller ids.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import write_table


def usable(vector: Column) -> Column:
    """Not null, not zero, without null, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest_in(x: np.ndarray, k: int, rows: int = 256) -> np.ndarray:
    """The k nearest other rows of every row of ``x``."""
    norms = (x * x).sum(1)
    out = []
    for at in range(0, len(x), rows):
        d = norms[None, :] - 2 * x[at : at + rows] @ x.T
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        out.append(np.argpartition(d, min(k, len(x) - 1) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def bisect_graph(left: np.ndarray, right: np.ndarray, n: int, rounds: int = 60) -> np.ndarray:
    """Halves (0 or 1) of a graph on n nodes with edges (left, right): a spectral cut at the median, refined by swaps."""
    degree = np.bincount(left, minlength=n) + np.bincount(right, minlength=n) + 1e-9
    root = np.sqrt(degree)
    constant = root / np.linalg.norm(root)
    v = np.random.default_rng(5).standard_normal(n)
    for _ in range(rounds):
        # Lazy random walk: keeps eigenvalues positive, so the second one wins.
        u = v / root
        v = (v + (np.bincount(left, u[right], n) + np.bincount(right, u[left], n)) / root) / 2
        v -= constant * (constant @ v)
        v /= np.linalg.norm(v) + 1e-30
    side = np.zeros(n, np.int64)
    side[np.argsort(v / root, kind="stable")[n // 2 :]] = 1
    for _ in range(10):
        other = np.bincount(left, side[right] != side[left], n) + np.bincount(right, side[right] != side[left], n)
        gain = 2 * other - degree  # edges won by moving the node
        zero, one = (np.flatnonzero((side == s) & (gain > 0)) for s in (0, 1))
        swaps = min(len(zero), len(one)) // 2 + min(len(zero), len(one), 1)
        if not swaps:
            break
        before = int((side[left] != side[right]).sum())
        trial = side.copy()
        trial[zero[np.argsort(-gain[zero], kind="stable")[:swaps]]] = 1
        trial[one[np.argsort(-gain[one], kind="stable")[:swaps]]] = 0
        if int((trial[left] != trial[right]).sum()) >= before:
            break
        side = trial
    return side


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """Parts of equal size (a power of two of them) of the neighbour graph."""
    n, k = near.shape
    left, right = np.repeat(np.arange(n), k), near.ravel()
    label = np.zeros(n, np.int64)
    while label.max() + 1 < parts:
        fresh = label * 2
        for p in range(label.max() + 1):
            mine = np.flatnonzero(label == p)
            place = np.full(n, -1)
            place[mine] = np.arange(len(mine))
            inside = (label[left] == p) & (label[right] == p)
            fresh[mine] += bisect_graph(place[left[inside]], place[right[inside]], len(mine))
        label = fresh
    return label


@dataclass
class Router:
    """A softmax classifier over parts."""

    weights: np.ndarray
    bias: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_router(x: np.ndarray, shares: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-5) -> Router:
    """Cross-entropy against the shares of the neighbours, by Adam on all rows."""
    scale = np.sqrt((x * x).mean()) + 1e-30
    z = x / scale
    w, b = np.zeros((x.shape[1], shares.shape[1])), np.log(shares.mean(axis=0) + 1e-9)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for step in range(1, steps + 1):
        error = (Router(w, b).probabilities(z) - shares) / len(z)
        for value, grad, i in ((w, z.T @ error + decay * w, 0), (b, error.sum(axis=0), 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * grad
            moments[i + 1] = 0.999 * moments[i + 1] + 0.001 * grad * grad
            value -= rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 1] / (1 - 0.999**step)) + 1e-10)
    return Router(w / scale, b)


def train_router(x: np.ndarray, parts: int, neighbours: int = 10) -> Router:
    neighbours = min(neighbours, len(x) - 1)
    if parts < 2 or neighbours < 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1))
    near = nearest_in(x, neighbours)
    label = balanced_parts(near, parts)
    shares = np.zeros((len(x), label.max() + 1))
    for column in (*near.T, np.arange(len(x))):
        shares[np.arange(len(x)), label[column]] += 1 / (neighbours + 1)
    return fit_router(x, shares)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


def route(rows: DataFrame, router: Router, coverage: float | None) -> DataFrame:
    """``rows`` with ``parts``: the most probable one, or those that together reach ``coverage``."""
    names = rows.columns

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            p = router.probabilities(matrix(batch.column(names.index("vector"))))
            order = np.argsort(-p, axis=1, kind="stable")
            if coverage is None:
                lists = order[:, :1].tolist()
            else:
                reached = np.cumsum(np.take_along_axis(p, order, 1), axis=1)
                lists = [o[: 1 + int(np.searchsorted(r, coverage))] for o, r in zip(order.tolist(), reached)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*names, "parts"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", parts array<int>"
    return rows.mapInArrow(run, schema)


def search_block(k: int):
    """The k nearest of a block's vectors for each of its queries, by exact distance, ties to smaller ids."""
    kinds = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]

    def run(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if index.num_rows and queries.num_rows:
            x, q = matrix(index.column("vector")), matrix(queries.column("vector"))
            ids, names = index.column("ids").to_pylist(), queries.column("query_id").to_pylist()
            norms = (x * x).sum(1)
            for at in range(0, len(q), 128):
                part = q[at : at + 128]
                d = norms[None, :] - 2 * part @ x.T + (part * part).sum(1)[:, None]
                want = min(k + 1, len(x))
                last = np.partition(d, want - 1, axis=1)[:, want - 1]
                # Rounding of this form must not decide: everything near the border is measured exactly.
                slack = 1e-9 * (norms.max() + (part * part).sum(1))
                for i, row in enumerate(d):
                    near = np.flatnonzero(row <= last[i] + slack[i])
                    exact = np.sqrt(((part[i] - x[near]) ** 2).sum(axis=1))
                    me = names[at + i]
                    some = sorted((s, v) for s, j in zip(exact.tolist(), near.tolist()) for v in ids[j] if v != me)[:k]
                    found += [(me, v, s) for s, v in some]
        columns = list(zip(*found)) if found else [[]] * 3
        return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, kinds)})

    return run


def nearest(
    vectors: DataFrame, k: int = 10, every: int = 100, sample: int = 4096, rows_per_part: int = 2048, max_parts: int = 256,
    coverage: float = 0.93, block_rows: int = 8192, block_queries: int = 8192,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of every vector whose vec_id is divisible by ``every``.

    Distances are Euclidean, in double precision, on the vectors as given.  The
    router is fitted on at most ``sample`` distinct vectors, chosen by hash; every
    vector is indexed.  ``coverage`` is the share of its neighbours that the router
    expects in the parts a query visits, so about the recall.  Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without an id or of another length than
    the most frequent one.  Repeated rows of an id count once.  Fewer candidates
    than ``k`` give shorter lists; an empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("hash", F.xxhash64("vector"))
    rows = write_table(rows, "neighbours")
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return nothing(vectors)
    rows = rows.filter(F.size("vector") == length["d"])
    by_vector = Window.partitionBy("hash", "vector").orderBy("vec_id")
    first = rows.dropDuplicates(["vec_id", "hash"]).withColumn("n", F.row_number().over(by_vector)).filter(F.col("n") <= k + 1)
    index = first.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    index = write_table(index, "neighbours-index")

    n = index.count()
    parts = 1
    while parts * 2 <= min(max_parts, max(1, n // rows_per_part) * 2, max(1, min(sample, n) // 32)):
        parts *= 2
    few = index.select("hash", F.col("vector").cast("array<float>").alias("vector")).orderBy("hash").limit(sample)
    router = train_router(matrix(few.select("vector").toArrow().column("vector")), parts)

    filed = route(index.select("hash", "vector", "ids"), router, None).withColumn("part", F.col("parts")[0]).drop("parts")
    filed = write_table(filed, "neighbours-parts")
    asked = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "hash"]).select(F.col("vec_id").alias("query_id"), "vector")
    asked = route(asked, router, coverage).withColumn("part", F.explode("parts")).drop("parts")
    # At most one row per part reaches the driver.
    sizes = {r["part"]: 1 + r["n"] // block_rows for r in filed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    asks = {r["part"]: 1 + r["n"] // block_queries for r in asked.groupBy("part").agg(F.count("*").alias("n")).collect()}
    table = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, [sizes.get(p, 1), asks.get(p, 1)])])
    blocks, groups = table[F.col("part")][0], table[F.col("part")][1]
    left = filed.withColumn("block", F.pmod(F.xxhash64("hash"), blocks)).withColumn("group", F.explode(F.sequence(F.lit(0), groups - 1)))
    right = asked.withColumn("group", F.pmod(F.xxhash64("query_id"), groups)).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    keys = [F.col("part"), F.col("block").cast("int").alias("block"), F.col("group").cast("int").alias("group")]
    left, right = left.select(*keys, "vector", "ids"), right.select(*keys, "vector", "query_id")
    names = ["part", "block", "group"]
    found = left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(search_block(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nothing(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
