"""Substring dedup over words by super-k-mer partitioning.

Consecutive windows of 13 words that share a minimiser travel as one packed
string to the minimiser's bucket; there the windows are sorted, and each run of
equal windows yields the smallest document it starts in.  A window goes from
every document but that one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import Units, candidates, covered, profiles, repeats
from .text import windows, words_of, write_table


def join_words(raw: bytes) -> bytes:
    return b" ".join(raw.split())


def judge(bodies: list[bytes], first: np.ndarray, times: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows per string, and the smallest document of each window.

    Windows are sorted by hash and neighbours of equal hash compared word for word;
    should two windows share a hash, all are sorted by their words.
    """
    data, start, end, hashes, at = words_of(bodies)
    blob = data.tobytes()
    sizes = np.diff(at) - span + 1
    own = np.repeat(np.arange(len(sizes)), sizes)
    word = np.arange(len(own)) + (own * (span - 1))
    a, b = start[word], end[word + span - 1]
    short = windows(hashes, span)[word]
    order = np.argsort(short, kind="stable")
    fresh = np.concatenate(([True], short[order[1:]] != short[order[:-1]]))
    again = np.flatnonzero(~fresh)
    x, y = order[again - 1], order[again]
    if any(blob[i:j] != blob[k:m] for i, j, k, m in zip(a[x].tolist(), b[x].tolist(), a[y].tolist(), b[y].tolist())):
        whole = [blob[i:j] for i, j in zip(a.tolist(), b.tolist())]
        order = np.array(sorted(range(len(whole)), key=whole.__getitem__))
        fresh = np.array([True, *(whole[i] != whole[j] for i, j in zip(order[1:].tolist(), order.tolist()))])
    heads = np.flatnonzero(fresh)
    value = np.empty(len(own), np.int64)
    value[order] = np.repeat(np.minimum.reduceat(first[own][order], heads), np.diff(np.append(heads, len(own))))
    return sizes, value


def remove_repeats(docs: DataFrame, span: int = 13, gram: int = 7, shard_bytes: int = 4 << 20, hot: int = 2_000) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every document.

    A word goes if a window of ``span`` words over it also starts in a document of
    smaller id.  Null texts have no words.  Rows without an id keep all words and
    count for nobody; rows with equal ids are one document to each other.  Other
    columns are not read; an empty table gives no rows.
    """
    units = Units(words=True, span=span, gram=gram, within=False)
    profile = write_table(profiles(docs, units, join_words), "superkmers")
    leaders, texts = candidates(docs, profile, with_ids_only=True, hot=hot)
    marked = repeats(texts, units, lambda *shard: judge(*shard, span), F.min("first"), np.less, shard_bytes, hot)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, marks in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode().split()
                gone = covered(marks, span, len(words))
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                out.append((key, int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.string()))], names=["key", "n_gone", "sha_left"])

    cuts = write_table(marked.select("key", "text", "marks").mapInArrow(cut, "key binary, n_gone long, sha_left string"), "superkmers-cuts")
    rows = profile.drop("hashes").join(leaders, "key").join(cuts, "key", "left")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_units") >= span)
    lead = F.col("doc_id").isNotNull() & F.col("n_gone").isNotNull()
    return rows.select(
        "doc_id", F.col("n_units").alias("n_words"),
        F.when(copy, F.col("n_units")).when(lead, F.col("n_gone")).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).when(lead, F.col("sha_left")).otherwise(F.col("sha")).alias("kept_sha256"),
    )
