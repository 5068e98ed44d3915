"""Shared helpers: sizes, shared tables, and vectorised hashing of texts.

Texts reach Python as Arrow batches.  ``chunks`` cuts a batch into groups of
documents of bounded size (a longer document is a group of its own), so arrays
never hold more than one such group.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space between words: space and \\t \\n \\v \\f \\r.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_BREAK = r"[\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Inverse of the base modulo 2^64, which exists as the base is odd.
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts lineage, outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def per_worker(key: tuple, make: Callable):
    """What ``make`` gives, made once per Python worker.

    It is held by a module of the worker, not by the function that travels with a
    task, so functions that use it need no copy of this package on the worker.
    """
    held = sys.__dict__.setdefault("_held_by_worker", {})
    if key not in held:
        held[key] = make()
    return held[key]


def training_row(doc_id, modulus: int, left_out: int):
    """True for rows whose crc32(doc_id as text) mod ``modulus`` is not ``left_out``; null ids never train."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus != left_out, F.lit(False))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of SplitMix64)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LETTERS = mix(np.arange(256, dtype=np.uint64), 17)


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Prefix:
    """Hashes of any slice of one byte array from one pass over it."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        table = _LETTERS[_LOWER] if lower else _LETTERS
        terms = table[data]
        terms *= powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.back = powers(len(data) + 1, _INVERSE)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first document, texts as UTF-8) of groups up to ``size`` bytes; null is empty."""
    at, held, group = 0, 0, []
    for i, value in enumerate(texts):
        raw = (value.as_py() or "").encode() if not pa.types.is_binary(texts.type) else value.as_py() or b""
        if group and held + len(raw) > size:
            yield at, group
            at, held, group = i, 0, []
        group.append(raw)
        held += len(raw)
    if group:
        yield at, group


def words_of(group: list[bytes], lower: bool = False):
    """Words of a group of texts: (data, word start, word end, word hash, index of the first word per document).

    The last array has one more entry than there are documents.
    """
    data = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
    word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word))))
    start, end = edge[0::2], edge[1::2]
    ends = np.cumsum([len(x) + 1 for x in group])
    first = np.concatenate(([0], np.searchsorted(start, ends)))
    return data, start, end, Prefix(data, lower).of(start, end), first


def windows(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """One hash for each ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = mix(out * _BASE + hashes[j : j + n], seed)
    return out
