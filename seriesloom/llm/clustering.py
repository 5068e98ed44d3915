"""Centroid clustering over space-filling-curve zone maps.

Vectors become integers, so sums and distances are exact.  They are put in Hilbert
order once and cut into blocks, each with the smallest and largest value of every
component (its box) and the sum of its vectors.  In a round, bounds over the box
tell which centroids are candidates: one that lies farther than another from every
point of the box is none.  A block with one candidate adds its stored sum; the rows of others
are compared with the candidates alone, in numpy.

The blocks are a table in the shared folder, read once per round; only the
centroids and their sums, which do not grow with the input, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import write_table

#: Integers up to this size leave squared distances of 64 components inside a long.
LARGEST = 1 << 27


def hilbert_key(values: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of every row of ``values`` (integers below 2^bits), as bytes that sort."""
    x = [column.astype(np.int64) for column in values.T]
    bit = 1 << (bits - 1)
    while bit > 1:
        for i in range(len(x)):
            hit = (x[i] & bit) > 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & (bit - 1))
            x[i] = x[i] ^ swap if i else x[i]
            x[0] = x[0] ^ np.where(hit, bit - 1, swap if i else 0)
        bit >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip, bit = np.zeros(len(values), np.int64), 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    cells = np.stack([column ^ flip for column in x], axis=1)
    digits = np.stack([cells >> b & 1 for b in range(bits - 1, -1, -1)], axis=1).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(digits.reshape(len(values), -1), axis=1)]


def whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))


def kept_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, x``: integer vectors of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    # The bound also drops infinite values; comparisons with NaN would not, as NaN counts as largest.
    fits = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST / scale))
    rows = rows.filter((F.size("vector") == dims) & F.coalesce(fits, F.lit(False)))
    return rows.select("vec_id", whole(F.col("vector"), scale).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def ordered_blocks(rows: DataFrame, dims: int, bits: int, block_rows: int) -> DataFrame:
    """``ids, x, low, high, total`` per block of up to ``block_rows`` vectors next to each other on the curve.

    Equal vectors are told apart by a hash of their ids, so a vector that is that of
    a third of all rows does not end in one task.
    """
    # Two numbers: the range in which values are told apart.
    least, most = rows.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    if least is None:
        least, most = 0, 0

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dims)
            cells = np.minimum((x - least).astype(float) * ((1 << bits) / (most - least + 1)), (1 << bits) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_key(cells, bits), pa.binary())], names=["vec_id", "x", "place"])

    ordered = rows.mapInArrow(keys, "vec_id long, x array<long>, place binary").withColumn("tie", F.xxhash64("vec_id"))
    ordered = ordered.repartitionByRange("place", "tie").sortWithinPartitions("place", "tie", "vec_id").select("vec_id", "x")

    def block(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        lists = [ids.to_pylist(), x.ravel(), x.min(axis=0), x.max(axis=0), x.sum(axis=0)]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.int64())) for v in lists], names=["ids", "x", "low", "high", "total"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = pa.array([], pa.int64()), np.empty((0, dims), np.int64)
        for batch in batches:
            ids, x = pa.concat_arrays([ids, batch.column(0)]), np.concatenate((x, matrix(batch.column(1), dims)))
            while len(x) >= block_rows:
                yield block(ids[:block_rows], x[:block_rows])
                ids, x = ids[block_rows:], x[block_rows:]
        if len(x):
            yield block(ids, x)

    return ordered.mapInArrow(cut, "ids array<long>, x array<long>, low array<long>, high array<long>, total array<long>")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of a box, ascending.

    By how much the squared distance to c passes that to another centroid is linear
    in the point, so its least value over the box is exact: above zero, c is out.
    """
    slope = 2 * (centroids[None, :, :] - centroids[:, None, :])
    norms = (centroids * centroids).sum(axis=1)
    least = np.where(slope > 0, low * slope, high * slope).sum(axis=2) + norms[:, None] - norms[None, :]
    return np.flatnonzero(~(least > 0).any(axis=1))


def exact_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows, exact: in floating point where every step fits 53 bits."""
    largest = max(int(np.abs(x).max()), int(np.abs(centroids).max()), 1)
    if x.shape[1] * (2 * largest) ** 2 < 1 << 52:
        x, centroids = x.astype(float), centroids.astype(float)
        return ((x * x).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(axis=1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def blocks_of(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """(ids, vectors, sum of the vectors, candidates) of every block."""
    dims = centroids.shape[1]
    for batch in batches:
        for i in range(batch.num_rows):
            ids, x, low, high, total = (batch.column(c)[i].values for c in range(5))
            yield ids, lambda x=x: x.to_numpy().reshape(-1, dims), total.to_numpy(), candidates(low.to_numpy(), high.to_numpy(), centroids)


def step(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: floor of the mean of the vectors nearest to each; without vectors a centroid stays."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for ids, vectors, total, near in blocks_of(batches, centroids):
            if len(near) == 1:
                n[near[0]] += len(ids)
                sums[near[0]] += total
                continue
            x = vectors()
            cluster = near[exact_distances(x, centroids[near]).argmin(axis=1)]
            n += np.bincount(cluster, minlength=k)
            for c in near:
                sums[c] += x[cluster == c].sum(axis=0)
        some = np.flatnonzero(n)
        values = np.concatenate((sums, n[:, None]), axis=1)[some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(list(values), pa.list_(pa.int64()))], names=["cluster", "sums"])

    partial = blocks.mapInArrow(run, "cluster int, sums array<long>").select("cluster", F.posexplode("sums").alias("place", "value"))
    totals = np.zeros((k, dims + 1), object)
    for row in partial.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect():
        totals[row["cluster"], row["place"]] = int(row["s"])  # one number per centroid and component
    fresh = centroids.copy()
    for c in np.flatnonzero(totals[:, dims]):
        fresh[c] = totals[c, :dims] // totals[c, dims]
    return fresh


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` (squared) of every vector; ties go to the smaller number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors, _, near in blocks_of(batches, centroids):
            d = exact_distances(vectors(), centroids[near])
            best = d.argmin(axis=1)
            arrays = [ids, pa.array(near[best], pa.int32()), pa.array(np.take_along_axis(d, best[:, None], axis=1)[:, 0])]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, "vec_id long, cluster int, distance long")


def pruning(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``n_rows, n_candidates`` per block: what the boxes save."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, near in blocks_of(batches, centroids):
            yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([len(near)])], names=["n_rows", "n_candidates"])

    return blocks.mapInArrow(run, "n_rows long, n_candidates long")


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:vec_id``; equal or null ids by their vectors, null last."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    few = rows.select(place.alias("place"), "x").orderBy(F.col("place").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in few], np.int64)


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, bits: int = 4, block_rows: int = 1024
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector that takes part.

    A vector (vec_id, embedding) takes part if it has exactly ``dims`` components,
    none null or non-finite; its components become floor(scale * x).  Those beyond
    2^27 are left out, as squared distances would pass a long.  Centroids start as
    ``first_centroids`` says; fewer vectors than ``k`` start fewer centroids.  Every
    round assigns each vector to the nearest (ties: the smaller number) and replaces
    each centroid that has vectors by the floor of their mean, then all are assigned
    once more.  Repeated rows count each time, rows without an id take part, other
    columns are not read, an empty table gives no rows.  Inertia is the sum of the
    squared distances; one that passes a long is null.
    """
    rows = write_table(kept_vectors(vectors, dims, scale), "vectors")
    centroids = first_centroids(rows, k, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    blocks = write_table(ordered_blocks(rows, dims, bits, block_rows), "vector-blocks")
    for _ in range(rounds):
        fresh = step(blocks, centroids)
        if np.array_equal(fresh, centroids):
            break  # all further rounds would change nothing
        centroids = fresh
    assigned = write_table(assign(blocks, centroids), "assigned")
    parts = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r["cluster"]: int(r["s"]) for r in parts}  # at most one per centroid
    fits = lambda n: n if n < 1 << 63 else None
    facts = [(c, fits(sums[c]), fits(sum(sums.values())), centroids[c].tolist()) for c in sums]
    named = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
