"""Removal of long repeated byte strings by suffix arrays.

Only strings around repeated minimisers can hold a repeated window (``repeats``).
In a bucket they are joined to one string of symbols whose suffix and common-prefix
arrays come from external induced sorting (``induced``): a window repeats if its
suffix shares ``span`` symbols with a neighbour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .induced import suffixes
from .repeats import Units, candidates, covered, profiles, repeats
from .text import write_table

#: Pieces that strings of a crowded minimiser are cut into.
PIECES = 8


def judge(bodies: list[bytes], first: np.ndarray, times: np.ndarray, span: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows per string, and 2 for each window that starts elsewhere as well (else 1)."""
    # Symbols: 0 ends the shard, 1 ends a string, byte b is b + 2.
    sizes = np.array([len(body) for body in bodies])
    symbols = np.ones(int(sizes.sum()) + len(bodies) + 1, np.uint16)
    symbols[-1] = 0
    starts = np.cumsum(np.insert(sizes + 1, 0, 0))[:-1]
    for at, body in zip(starts.tolist(), bodies):
        symbols[at : at + len(body)] = np.frombuffer(body, np.uint8).astype(np.uint16) + 2
    again = np.zeros(len(symbols), bool)
    above = np.empty(0, np.int32)
    for batch, prefix in suffixes(symbols, span, memory):
        before = np.append(above, batch[:-1])
        hit = np.flatnonzero(prefix >= span)
        again[batch[hit]] = True
        # The very first suffix has none before it, and a common prefix of 0.
        again[before[hit - (len(batch) - len(before))]] = True
        above = batch[-1:]
    many = sizes - span + 1
    own = np.repeat(np.arange(len(many)), many)
    at = starts[own] + np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
    return many, np.where(again[at] | (times[own] > 1), 2, 1)


def remove_repeats(docs: DataFrame, span: int = 400, gram: int = 64, shard_bytes: int = 2 << 20, hot: int = 500, memory: int = 32 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document.

    A byte goes if a string of ``span`` bytes over it also starts anywhere else, in
    the same text or another one.  Null texts are empty.  Repeated rows are
    different documents with equal texts, with or without an id; other columns are
    not read; an empty table gives no rows.  ``memory`` bounds the queues of a
    shard; what exceeds it goes to a file of the task.
    """
    units = Units(words=False, span=span, gram=gram, within=True)
    profile = write_table(profiles(docs, units, bytes), "suffixes")
    leaders, texts = candidates(docs, profile, with_ids_only=False, hot=hot)
    step = -(-(span - gram + 1) // PIECES)
    marked = repeats(texts, units, lambda *shard: judge(*shard, span, memory), F.sum("times"), lambda total, _: total > 1, shard_bytes, hot, step)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, marks in zip(*(c.to_pylist() for c in batch.columns)):
                raw = np.frombuffer(text.encode(), np.uint8)
                gone = covered(marks, span, len(raw))
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
                out.append((key, int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "n_gone", "n_parts", "sha_left"])

    cuts = write_table(marked.select("key", "text", "marks").mapInArrow(cut, "key binary, n_gone long, n_parts long, sha_left string"), "suffixes-cuts")
    rows = profile.drop("hashes").join(leaders, "key").join(cuts, "key", "left")
    copy = (F.col("copies") > 1) & (F.col("n_units") >= span)
    some = F.col("n_gone").isNotNull()
    return rows.select(
        "doc_id", F.col("n_units").alias("n_bytes"),
        F.when(copy, F.col("n_units")).when(some, F.col("n_gone")).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, 1).when(some, F.col("n_parts")).otherwise(0).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).when(some, F.col("sha_left")).otherwise(F.col("sha")).alias("kept_sha256"),
    )
