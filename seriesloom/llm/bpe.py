"""Byte-level BPE with forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be joined by
a merge, so a text may be cut between the two bytes whatever stands around them.
The pieces that the vocabulary's word pattern yields are cut further at such
pairs; every fragment is encoded on its own, and the ids are concatenated.

The vocabulary (a ``tokenizers`` JSON file) is given by path; it is opened on the
machine that encodes, so it must be installed there, as Python packages are.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import per_worker

#: Fixed value: the word pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """Printable stand-ins used by byte-level vocabularies: bytes without a visible form follow from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ForcedBoundaryBPE:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str, cache_pieces: int = 400_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        if spec["pre_tokenizer"]["add_prefix_space"] or not spec["pre_tokenizer"]["use_regex"]:
            raise ValueError("only vocabularies that split by the pattern and add no space")
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {to_bytes(s): i for s, i in spec["model"]["vocab"].items()}
        #: (left id, right id) -> rank of the merge, and the id that it makes
        self.ranks, self.made = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(to_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.ranks[self.ids[a], self.ids[b]] = rank
            self.made.append(self.ids[a + b])
        self.first = [self.ids[bytes([b])] for b in range(256)]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        #: inside[a * 256 + b]: some token holds byte a directly before byte b.
        self.inside = np.zeros(65536, bool)
        for token in self.ids:
            raw = np.frombuffer(token, np.uint8).astype(np.int64)
            self.inside[raw[:-1] * 256 + raw[1:]] = True
        self.joined = self.inside.tobytes()
        self.pattern = regex.compile(PATTERN)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache_pieces = cache_pieces
        encoder = self

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                if len(self) >= encoder.cache_pieces:
                    self.clear()
                ids = encoder.piece(piece.encode())
                packed = struct.pack(f"<{len(ids)}I", *ids)
                if len(piece) <= 64:
                    self[piece] = packed
                return packed

        self.pieces = Pieces()

    def cuts(self, raw: bytes) -> list[int]:
        """Forced boundaries of a byte string."""
        if len(raw) < 64:
            joined = self.joined
            return [i for i, (a, b) in enumerate(zip(raw, raw[1:]), 1) if not joined[a << 8 | b]]
        at = np.frombuffer(raw, np.uint8).astype(np.int64)
        return (np.flatnonzero(~self.inside[at[:-1] * 256 + at[1:]]) + 1).tolist()

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one piece: of its fragments, one after the other."""
        cuts = self.cuts(raw)
        if not cuts:
            return self.fragment(raw)
        out = []
        for start, end in zip([0, *cuts], [*cuts, len(raw)]):
            out += self.fragment(raw[start:end])
        return out

    def fragment(self, raw: bytes) -> list[int]:
        """Merges by rank, leftmost first."""
        ids = list(map(self.first.__getitem__, raw))
        return self.short(ids) if len(ids) <= 40 else self.long(ids)

    def short(self, ids: list[int]) -> list[int]:
        get, never = self.ranks.get, len(self.made)
        found = [get(pair, never) for pair in zip(ids, ids[1:])]
        while found and (best := min(found)) != never:
            i = found.index(best)
            ids[i] = self.made[best]
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), never)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), never)
        return ids

    def long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links between neighbours: O(n log n)."""
        n, get, gone = len(ids), self.ranks.get, -1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(rank, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (rank := get((a, b))) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[rank], gone, after[j]
            if (k := after[i]) < n:
                before[k] = i
                if (rank := get((ids[i], ids[k]))) is not None:
                    heapq.heappush(queue, (rank, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (rank := get((ids[h], ids[i]))) is not None:
                heapq.heappush(queue, (rank, h, ids[h], ids[i]))
        return [i for i in ids if i != gone]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split is None or not any(s in text for s in self.special):
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
        out = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                out.append(b"".join(map(self.pieces.__getitem__, self.pattern.findall(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encoder(path: str) -> ForcedBoundaryBPE:
    return per_worker(("bpe", path), lambda: ForcedBoundaryBPE(path))


def encode(docs: DataFrame, tokenizer_path: str, keep_ids: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Encode and decode every text.

    Per row: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256``; with ``keep_ids`` also ``ids``;
    then the columns ``keep`` as they are.  Null texts are empty: no tokens.
    Repeated rows and null ids stay as they are, other columns are not read, an
    empty table gives an empty result.  Map-only: no shuffle, memory is one Arrow
    batch and two bounded caches.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    names = [part.split()[0] for part in schema.split(", ")]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path)
        for batch in batches:
            packed = [bpe.encode(value.as_py() or "") for value in batch.column(1)]
            n = np.array([len(ids) // 4 for ids in packed], np.int64)
            columns = [
                batch.column(0).cast(pa.int64()), pa.array(n), pa.array([hashlib.sha256(ids).hexdigest() for ids in packed], pa.string()),
                pa.array([hashlib.sha256(bpe.decode(ids).encode()).hexdigest() for ids in packed], pa.string()),
            ]
            if keep_ids:
                values = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(values)))
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], names=[*names, *keep])

    return docs.select("doc_id", "text", *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
