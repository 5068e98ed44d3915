"""Alignment of two tokenizers over the same bytes.

Tokens of both sides are rows (document, byte start).  ``pandas.merge_asof``, keyed
by document, finds for every token start the token of the other side that covers
it; both directions together are all overlaps.  Where a token starts exactly where
its covering token does, both sides ended a token, so a new group begins.

All pairs of a group are links.  Tasks keep one entry per document and distinct
pair of ids; blocks of documents ask the corpus-wide counts with one row per
distinct pair of the block.

Texts are cut where a space follows a non-space: no token of either side crosses
such a place, so each word is encoded once and looked up afterwards, and texts of
any length are aligned in segments.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import PATTERN, byte_letters
from .text import per_worker, write_table

#: Text in one step of an alignment, and in one block of documents.
SEGMENT_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
CACHED_WORDS = 300_000
#: A space that follows white space does not start a word.
_INNER = re.compile(r"\s ")
_BEFORE_WORD = re.compile(r"(?<=\S) ")


class Tokenizers:
    """Byte-level tokenizer A (a JSON vocabulary) and piece tokenizer B (a SentencePiece model), with known words."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {a_path}")
        letters, special = byte_letters(), {x["content"] for x in spec["added_tokens"]}
        vocab = {bytes(letters[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for raw, i in vocab.items():
            self.a_bytes[i] = raw
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces) or self.b.decode(self.b.encode(" ﬁ  x")) != " ﬁ  x":
            raise ValueError("only models whose pieces start at spaces and that leave texts as they are")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def learn(self, words: list[str]) -> None:
        """Encode words, each standing after a space; None where the tokens do not join to the bytes of the word."""
        for word, b in zip(words, self.b.encode(words, num_threads=1)):
            b = b or [self.b.piece_to_id("▁")]  # an empty text gets no space in front
            a, raw = self.a.encode_ordinary(" " + word), (" " + word).encode()
            if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
                self.known[word] = None
            else:
                self.known[word] = struct.pack(f"<{len(a)}I", *a), struct.pack(f"<{len(b)}I", *b)

    def encode(self, text: str | None, size: int) -> list[tuple[bytes, bytes]]:
        """Ids of both sides by segments of up to about ``size`` characters; none where a side changes the bytes.

        Tokens only ever lose bytes (a piece that shows a space for another sign),
        so a text joins to its bytes exactly if all its words do.
        """
        if not text:
            return []
        words = text.split(" ") if _INNER.search(" " + text) is None else _BEFORE_WORD.split(text)
        missing = set(words).difference(self.known)
        if missing:
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
                missing = set(words)
            self.learn(sorted(missing))
        found = [self.known[w] for w in words]
        if None in found:
            return []
        cuts = [0, len(words)]
        if len(text) > size:
            reached = np.cumsum([len(w) + 1 for w in words])
            cuts = np.unique(np.append(np.searchsorted(reached, np.arange(0, reached[-1], size)), len(words))).tolist()
        return [tuple(b"".join([x[side] for x in found[s:e]]) for side in (0, 1)) for s, e in zip(cuts, cuts[1:])]


@dataclass
class Aligned:
    """Alignment of consecutive segments: token ids, their byte ends, groups (numbered through), segments."""

    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_segment: np.ndarray
    b_segment: np.ndarray
    overlaps: tuple[np.ndarray, np.ndarray]
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int


def align_segments(a: list[np.ndarray], b: list[np.ndarray], a_size: np.ndarray, b_size: np.ndarray) -> Aligned:
    """Align segments given as token ids of both sides that cover the same bytes."""
    na, nb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    a_ids, b_ids = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
    a_segment, b_segment = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
    a_end, b_end = np.cumsum(a_size[a_ids]), np.cumsum(b_size[b_ids])
    a_start, b_start = a_end - a_size[a_ids], b_end - b_size[b_ids]
    left = pd.DataFrame({"start": a_start, "document": a_segment})
    right = pd.DataFrame({"start": b_start, "document": b_segment})
    a_cover = pd.merge_asof(left, right.assign(token=np.arange(len(b_ids))), on="start", by="document")["token"].to_numpy()
    b_cover = pd.merge_asof(right, left.assign(token=np.arange(len(a_ids))), on="start", by="document")["token"].to_numpy()
    a_opens, b_opens = a_start == b_start[a_cover], b_start == a_start[b_cover]
    # Pairs of equal starts are found from both sides; once is enough.
    rest = np.flatnonzero(~b_opens)
    overlaps = np.concatenate((np.arange(len(a_ids)), b_cover[rest])), np.concatenate((a_cover, rest))
    a_group, b_group = np.cumsum(a_opens) - 1, np.cumsum(b_opens) - 1
    n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
    return Aligned(a_ids, b_ids, a_end, b_end, a_segment, b_segment, overlaps, a_group, b_group, n_groups)


def linked_ids(x: Aligned, b_vocab: int, slab: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, a id * b_vocab + b id, number of links) per segment and pair of ids, sorted, and links per group."""
    na, nb = np.bincount(x.a_group, minlength=x.n_groups), np.bincount(x.b_group, minlength=x.n_groups)
    a_first, b_first = np.cumsum(na) - na, np.cumsum(nb) - nb
    segment = x.a_segment[a_first]
    work = na * nb
    keys, times = [], []
    span = int(x.a.max(initial=0) + 1) * b_vocab
    for g in np.flatnonzero(work > 1 << 16):
        # Many tokens on both sides: distinct ids and how often they stand there, not single tokens.
        a, n = np.unique(x.a[a_first[g] : a_first[g] + na[g]], return_counts=True)
        b, m = np.unique(x.b[b_first[g] : b_first[g] + nb[g]], return_counts=True)
        keys.append((segment[g] * span + a[:, None] * b_vocab + b[None, :]).ravel())
        times.append((n[:, None] * m[None, :]).ravel())
    small = work[x.a_group] <= 1 << 16
    token = np.flatnonzero(small)
    rows = nb[x.a_group[token]]
    steps = np.cumsum(rows)
    for part in np.split(np.arange(len(token)), np.searchsorted(steps, np.arange(slab, steps[-1] if len(steps) else 0, slab))):
        if not len(part):
            continue
        t, n = token[part], rows[part]
        at = np.repeat(b_first[x.a_group[t]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found = np.repeat(x.a_segment[t] * span + x.a[t] * b_vocab, n) + x.b[at]
        found.sort()
        new = np.flatnonzero(np.diff(found, prepend=-1))
        keys.append(found[new])
        times.append(np.diff(np.append(new, len(found))))
    if not keys:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, work
    key, n = (keys[0], times[0]) if len(keys) == 1 else summed(np.concatenate(keys), np.concatenate(times))
    return key // span, key % span, n, work


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.add.reduceat(n[order], new) if len(new) else n[:0]


class Digits:
    """Texts ``a1,a2|b1;a3|b2,b3`` of groups, written with numpy."""

    def __init__(self, ids: int):
        shown = np.arange(ids).astype(f"S{len(str(ids))}")
        self.length = np.char.str_len(shown)
        self.letters = np.zeros((ids, shown.itemsize + 1), np.uint8)
        self.letters[:, :-1] = np.frombuffer(shown.tobytes(), np.uint8).reshape(ids, -1)

    def write(self, x: Aligned) -> tuple[bytes, np.ndarray]:
        """The groups of all segments, and where each segment's text ends (behind a closing semicolon)."""
        na, nb = np.bincount(x.a_group, minlength=x.n_groups), np.bincount(x.b_group, minlength=x.n_groups)
        total, ends = len(x.a) + len(x.b), np.cumsum(na + nb)
        ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[np.arange(len(x.a)) + (np.cumsum(nb) - nb)[x.a_group]] = x.a
        ids[np.arange(len(x.b)) + np.cumsum(na)[x.b_group]] = x.b
        mark[ends - 1 - nb], mark[ends - 1] = ord("|"), ord(";")
        out, size = self.letters[ids], self.length[ids]
        out[np.arange(total), size] = mark
        text = out[np.arange(out.shape[1]) <= size[:, None]].tobytes()
        written = np.cumsum(size + 1)[ends - 1]
        return text, written[np.searchsorted(x.a_segment[np.cumsum(na) - na], np.arange(x.a_segment[-1] + 1), "right") - 1]


@dataclass
class Document:
    """What is gathered about one text while its segments pass."""

    doc_id: int | None
    sha: hashlib._hashlib.HASH | None = None
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    keys: list[np.ndarray] = field(default_factory=list)
    times: list[np.ndarray] = field(default_factory=list)

    def row(self) -> tuple:
        keys, times = (self.keys, self.times) if self.keys else ([np.empty(0, np.int64)], [np.empty(0, np.int64)])
        key, n = (keys[0], times[0]) if len(keys) == 1 else summed(np.concatenate(keys), np.concatenate(times))
        return self.doc_id, self.n_a, self.n_b, self.n_groups, self.n_links, self.sha.hexdigest() if self.sha else "", key, n


def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return per_worker(("tokenizers", a_path, b_path), lambda: Tokenizers(a_path, b_path))


def alignments(batches: Iterator[pa.RecordBatch], known: Tokenizers, size: int):
    """(documents that end here, documents of the segments, their alignment or None) for groups of segments."""
    ended: list[Document] = []
    group: list[tuple[Document, bytes, bytes]] = []

    def flush():
        x = None
        if group:
            sides = [[np.frombuffer(g[side], "<u4") for g in group] for side in (1, 2)]
            x = align_segments(*sides, known.a_size, known.b_size)
        out = list(ended), [g[0] for g in group], x
        ended.clear()
        group.clear()
        return out

    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc = Document(doc_id.as_py())
            for a, b in known.encode(text.as_py(), size):
                if held > size:
                    yield flush()
                    held = 0
                group.append((doc, a, b))
                held += len(a)  # bytes of ids, at most four times the text's
            ended.append(doc)
            if held > size or len(ended) >= 10_000:
                yield flush()
                held = 0
    if ended:
        yield flush()


def align(docs: DataFrame, a_path: str, b_path: str, size: int = SEGMENT_BYTES) -> DataFrame:
    """The alignment itself, a row per row of ``docs`` (doc_id, text).

    ``a_ids, b_ids``: tokens of space + text.  ``a_ends, b_ends``: byte offsets behind
    each.  ``a_groups, b_groups``: number of the group of each token, from 0; a group
    ends where both sides end a token.  ``a_overlaps, b_overlaps``: the token numbers
    of all pairs that share a byte.  Null or empty texts, and those that a side does
    not give back byte by byte, have empty lists.  Map-only.
    """
    names = ["a_ids", "b_ids", "a_ends", "b_ends", "a_groups", "b_groups", "a_overlaps", "b_overlaps"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(a_path, b_path)
        held: dict[int, list[list[np.ndarray]]] = {}
        for ended, owners, x in alignments(batches, known, size):
            for k, doc in enumerate(owners):
                lists = held.setdefault(id(doc), [[] for _ in names])
                a0, a1 = np.searchsorted(x.a_segment, (k, k + 1))
                b0, b1 = np.searchsorted(x.b_segment, (k, k + 1))
                base = x.a_end[a0 - 1] if a0 else 0
                byte = lists[2][-1][-1] if lists[2] else 0
                seen, left, right = doc.n_groups, doc.n_a, doc.n_b
                some = (x.overlaps[0] >= a0) & (x.overlaps[0] < a1)
                values = [
                    x.a[a0:a1], x.b[b0:b1], x.a_end[a0:a1] - base + byte, x.b_end[b0:b1] - base + byte,
                    x.a_group[a0:a1] - x.a_group[a0] + seen, x.b_group[b0:b1] - x.b_group[b0] + seen,
                    x.overlaps[0][some] - a0 + left, x.overlaps[1][some] - b0 + right,
                ]
                for whole, part in zip(lists, values):
                    whole.append(part)
                doc.n_a, doc.n_b, doc.n_groups = left + a1 - a0, right + b1 - b0, int(values[4][-1]) + 1
            rows = [(doc.doc_id, *[np.concatenate(v) if v else [] for v in held.pop(id(doc), [[]] * len(names))]) for doc in ended]
            columns = list(zip(*rows)) if rows else [[]] * (1 + len(names))
            kinds = [pa.int64()] + [pa.list_(pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{n} array<long>" for n in names))


def gathered(docs: DataFrame, a_path: str, b_path: str, size: int, block: int) -> DataFrame:
    """Two kinds of rows: per document its figures and pairs of linked ids, per block its distinct pairs."""
    schema = (
        "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<long>, asked array<long>, n_docs array<long>"
    )
    kinds = [pa.int64()] * 6 + [pa.string()] + [pa.list_(pa.int64())] * 4
    names = [part.split()[0] for part in schema.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(a_path, b_path)
        digits = Digits(max(len(known.a_bytes), len(known.b_bytes)))
        number = TaskContext.get().partitionId() << 32
        pairs: list[np.ndarray] = []
        held = 0
        for ended, owners, x in alignments(batches, known, size):
            if x is not None:
                segment, key, n, work = linked_ids(x, len(known.b_bytes))
                text, ends = digits.write(x)
                marks = np.arange(len(owners) + 1)
                a_at, b_at, at = (np.searchsorted(of, marks) for of in (x.a_segment, x.b_segment, segment))
                groups_at = np.append(x.a_group[a_at[:-1]], x.n_groups)
                links = np.append(0, np.cumsum(work))[groups_at]
                starts = np.append(0, ends)
                for k, doc in enumerate(owners):
                    if doc.sha is None:
                        doc.sha = hashlib.sha256()
                    else:
                        doc.sha.update(b";")
                    doc.sha.update(memoryview(text)[starts[k] : ends[k] - 1])
                    doc.n_a += int(a_at[k + 1] - a_at[k])
                    doc.n_b += int(b_at[k + 1] - b_at[k])
                    doc.n_groups += int(groups_at[k + 1] - groups_at[k])
                    doc.n_links += int(links[k + 1] - links[k])
                    doc.keys.append(key[at[k] : at[k + 1]])
                    doc.times.append(n[at[k] : at[k + 1]])
                held += int(x.a_end[-1])
            rows = [doc.row() for doc in ended]
            if rows:
                pairs += [r[6] for r in rows]
                yield table([(number, *r, None, None) for r in rows])
            if held >= block and pairs:
                yield table([asked(number, pairs)])
                number, held = number + 1, 0
                pairs.clear()
        if pairs:
            yield table([asked(number, pairs)])

    def asked(number: int, pairs: list[np.ndarray]) -> tuple:
        key, n = np.unique(np.concatenate(pairs), return_counts=True)
        return (number, *[None] * 8, key, n)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def link_counts(docs: DataFrame, a_path: str, b_path: str, size: int = SEGMENT_BYTES, block: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs`` (doc_id, text).

    Links are all pairs of tokens of one group.  The count of a pair of ids is the
    number of rows that hold it linked, over the whole table; ``n_best`` are links
    whose count is the highest of their A id, ``count_sum`` adds the counts of all
    links.  Null or empty texts, and those whose tokens do not join to space + text
    on both sides, have zeros and an empty ``groups_sha256``.  Repeated rows count
    each time, rows without an id stay, other columns are not read, an empty table
    gives no rows.
    """
    pieces = len(Tokenizers(a_path, b_path).b_bytes)
    rows = write_table(gathered(docs, a_path, b_path, size, block), "aligned")
    asked = rows.filter(F.col("asked").isNotNull()).select("block", F.explode(F.arrays_zip("asked", "n_docs")).alias("x"))
    asked = asked.select("block", F.col("x.asked").alias("pair"), F.col("x.n_docs").alias("n"))
    # A pair has one row per block here, an A id as many pairs as B has pieces at most.
    counts = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    of_a = Window.partitionBy(F.expr(f"pair div {pieces}"))
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(of_a))
    answers = asked.select(F.col("block").alias("of"), "pair").join(counts, "pair")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def tell(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        pair, count, best = (found.column(c).to_numpy() for c in ("pair", "count", "best"))
        order = np.argsort(pair)
        lists = texts.column("pairs").combine_chunks()
        at = order[np.searchsorted(pair, lists.flatten().to_numpy(), sorter=order)] if len(pair) else order
        times = texts.column("times").combine_chunks().flatten().to_numpy()
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        sums = [np.diff(np.append(0, np.cumsum(times * of[at]))[np.append(0, ends)]) for of in (best, count)]
        columns = [texts.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        columns += [pa.array(s.astype(np.int64)) for s in sums] + [texts.column("groups_sha256")]
        return pa.Table.from_arrays(columns, names=[part.split()[0] for part in schema.split(", ")])

    texts = rows.filter(F.col("asked").isNull()).drop("asked", "n_docs")
    return texts.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(tell, schema)
