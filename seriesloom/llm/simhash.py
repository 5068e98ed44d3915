"""SimHash near-duplicates by anchor-point covering.

A fingerprint of 64 bits is two halves of 32.  If two fingerprints differ in at
most 3 bits, one of the halves differs in at most 1.  The anchors of a half are the
words of a covering code: a perfect Hamming code on 31 bits, covering radius 1,
beside one bit that is kept as it is.  Every half has one nearest anchor (its
*own*), and a half that differs from it in one more bit lies within radius plus
one of that anchor.  So each fingerprint is replicated to all anchors within
radius plus one of its halves, 16.5 a half on average whatever the size of the
corpus, and the own fingerprints of an anchor are compared with all that came to
it.  No link is lost; 2^27 anchors a half keep the sets that are compared small.

Equal fingerprints are one node.  An anchor that many fingerprints reach is dealt
out as a grid of tiles of bounded size, and a tile passes on a spanning forest of
its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .text import write_table

BITS = 64
#: Bits of a half that the Hamming code covers; the remaining one is kept.
CODED = 31
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of a text's word shingles as a signed 64-bit integer; 0 without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = words[at : at + (1 << 16) + width - 1] if len(words) >= width else words
        shingles = map(b" ".join, zip(*(part[j:] for j in range(width)))) if len(words) >= width else [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def syndrome(half: np.ndarray) -> np.ndarray:
    """XOR of the places (1 to 31) of the set bits above the lowest one: 0 for code words."""
    out = np.zeros(len(half), np.int64)
    for place in range(1, CODED + 1):
        out ^= np.where(half >> place & 1, place, 0)
    return out


def own_anchor(half: np.ndarray) -> np.ndarray:
    """The nearest anchor of every half; bit 0 is kept."""
    s = syndrome(half)
    return half ^ np.where(s > 0, np.int64(1) << s, 0)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``half``, anchor, whether it is the own one) for all anchors within radius plus one."""
    s, own = syndrome(half), own_anchor(half)
    index = [np.arange(len(half)), np.arange(len(half))]
    found = [own, own ^ 1]  # the kept bit takes the one difference
    for place in range(1, CODED + 1):
        # Two flips whose places add up to the syndrome give a code word; each such pair once.
        other = s ^ place
        at = np.flatnonzero((s > 0) & (other > place))
        index.append(at)
        found.append(half[at] ^ (np.int64(1) << np.int64(place)) ^ (np.int64(1) << other[at]))
    is_own = np.concatenate([np.full(len(x), k == 0) for k, x in enumerate(index)])
    return np.concatenate(index), np.concatenate(found), is_own


def replicate(nodes: DataFrame) -> DataFrame:
    """``anchor, fp, own``: every fingerprint at every anchor that it reaches with either half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                fps = whole.slice(at, 8192).column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for side in (0, 1):
                    index, anchor, own = anchors(fps >> (32 * side) & 0xFFFFFFFF)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor | side << 32), pa.array(fps[index]), pa.array(own)], names=["anchor", "fp", "own"]
                    )

    return nodes.select("fp").mapInArrow(run, "anchor long, fp long, own boolean")


def spread(rows: DataFrame, tile: int) -> DataFrame:
    """Anchors with more than ``tile`` fingerprints as a grid: own ones by row, all by column."""
    sizes = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if("own").alias("n_own")).filter(F.col("n") > tile)
    grid = sizes.select("anchor", F.ceil(F.col("n_own") / tile).cast("int").alias("down"), F.ceil(F.col("n") / tile).cast("int").alias("across"))
    rows = rows.join(grid, "anchor", "left").withColumns({"down": F.greatest("down", F.lit(1)), "across": F.coalesce("across", F.lit(1))})
    mine = rows.filter("own").withColumn("i", F.pmod(F.hash("fp"), "down")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("across") - 1)))
    others = rows.withColumn("j", F.pmod(F.hash("fp", F.lit(1)), "across")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("down") - 1)))
    both = mine.withColumn("own", F.lit(True)).unionByName(others.withColumn("own", F.lit(False)))
    return both.select("anchor", "i", "j", "fp", "own")


def roots_of(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of the component of every node of a graph on ``n`` nodes."""
    root = np.arange(n)
    while len(u):
        low = np.minimum(root[u], root[v])
        fresh = root.copy()
        np.minimum.at(fresh, root[u], low)
        np.minimum.at(fresh, root[v], low)
        fresh = fresh[fresh]
        while not np.array_equal(fresh, fresh[fresh]):
            fresh = fresh[fresh]
        if np.array_equal(fresh, root):
            break
        root = fresh
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    return root


def forest(own: np.ndarray, all_: np.ndarray, bits: int, rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Links between ``own`` and ``all_`` fingerprints of one tile, as a spanning forest."""
    nodes = np.unique(np.concatenate((own, all_)))
    left, right = np.searchsorted(nodes, own), np.searchsorted(nodes, all_)
    root = np.arange(len(nodes))
    for at in range(0, len(own), rows):
        near = np.bitwise_count((own[at : at + rows, None] ^ all_[None, :]).view(np.uint64)) <= bits
        a, b = np.nonzero(near)
        u, v = root[left[at + a]], root[right[b]]
        apart = u != v
        if apart.any():
            root = roots_of(len(nodes), u[apart], v[apart])[root]
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[linked]], nodes[linked]


def compare(groups: np.ndarray, fps: np.ndarray, own: np.ndarray, bits: int, slab: int = 1 << 21):
    """Links of consecutive tiles (equal numbers in ``groups``), each as pairs or, where many, as a forest."""
    start = np.flatnonzero(np.diff(groups, prepend=groups[:1] - 1 if len(groups) else 0))
    size = np.diff(np.append(start, len(groups)))
    n_own = np.add.reduceat(own, start, dtype=np.int64) if len(start) else size
    work = n_own * (size - n_own)
    # Own fingerprints come first within a tile.
    for g in np.flatnonzero(work > 4096):
        s, o, e = start[g], start[g] + n_own[g], start[g] + size[g]
        yield forest(fps[s:o], fps[o:e], bits)
    few = np.flatnonzero((work > 0) & (work <= 4096))
    steps = np.cumsum(work[few])
    for part in np.split(few, np.searchsorted(steps, np.arange(slab, steps[-1] + 1 if len(steps) else 0, slab))):
        w, s, o, m = work[part], start[part], n_own[part], (size - n_own)[part]
        place = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        across = np.repeat(m, w)
        u, v = fps[np.repeat(s, w) + place // across], fps[np.repeat(s + o, w) + place % across]
        near = (u != v) & (np.bitwise_count((u ^ v).view(np.uint64)) <= bits)
        yield u[near], v[near]


def links(nodes: DataFrame, bits: int = 3, tile: int = 4096) -> DataFrame:
    """``u, v``: links that join the same fingerprints as all pairs at ``bits`` or fewer differing bits (at most 3) would."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves with one difference cover at most 3 bits")
    # A fingerprint meets itself at its own anchor, so only anchors with another one count.
    rows = spread(write_table(replicate(nodes), "simhash-anchors"), tile)
    dealt = rows.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j", F.col("own").desc(), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
            anchor, i, j, fps, own = (table.column(c).to_numpy() for c in range(5))
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            for u, v in compare(np.cumsum(new), fps, own, bits):
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            if table.num_rows < 1 << 16:
                kept = table
                continue
            # The last tile may go on in the next batch; it holds at most a few times ``tile`` rows.
            anchor, i, j = (table.column(c).to_numpy() for c in range(3))
            last = (anchor != anchor[-1]) | (i != i[-1]) | (j != j[-1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if cut:
                yield from found(table.slice(0, cut))
            kept = table.slice(cut).combine_chunks()
        if kept is not None and kept.num_rows:
            yield from found(kept)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 3, tile: int = 4096, salts: int = 16) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs`` (doc_id, text).

    Words are runs of anything but space and \\t \\n \\v \\f \\r, A-Z in lower case;
    shingles are ``width`` words, repeats included, a shorter text is one shingle.
    A bit is set where over half of the shingles' hashes (XXH64, seed 42) set it.
    Fingerprints of at most ``bits`` differing bits are linked, and component_id is
    the smallest doc_id of a connected component.  Texts that are null or without
    words have fingerprint zero and are linked like any other.  Rows without an id
    stay; a component of such rows only has a null component_id.  Repeated rows
    stay, other columns are not read, an empty table gives an empty result.
    """
    found = write_table(fingerprints(docs, width), "simhash")
    nodes = write_table(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    near = components(write_table(links(nodes, bits, tile), "simhash-links"))
    rooted = nodes.join(near.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # A fingerprint may be that of a third of all rows, a component may hold as many fingerprints.
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salt = lambda *names: F.pmod(F.hash(*names), F.lit(salts))
    named = rooted.withColumn("salt", salt("fp")).join(least.withColumn("salt", copies), ["root", "salt"]).select("fp", "component_id")
    rows = found.withColumn("salt", salt("doc_id")).join(named.withColumn("salt", copies), ["fp", "salt"])
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
