"""Repeated windows of texts, found bucket by bucket (shared by the two substring operators).

A window is ``span`` consecutive units (words or bytes).  Its minimiser is the
smallest hash among its grams of ``gram`` units; equal windows have equal
minimisers, so windows of one minimiser can be judged apart from all others.

1. Profiles: each text reports its minimisers.  A census of the different texts,
   dealt by hash, finds those that occur twice; all others cannot hold a repeated
   window.  Hashes
   travel packed, 48 bits each, one row per block of documents and bucket, so a
   minimiser costs one entry per block however common it is.  A false match here
   only lets a text through to step 2.
2. Consecutive windows with the same repeated minimiser form one string, which
   travels with the places it was found at.  Equal strings of a batch are one row.
3. A minimiser's strings travel to its bucket, where the caller judges every
   window of the distinct ones.  Strings of minimisers that the census counts more
   than ``hot`` times are written first.  Those of minimisers that do have more
   than ``hot`` different strings, or very many places, never meet in one bucket.
   With a ``step``, they are cut into pieces of windows that hold the minimiser at
   most ``step`` - 1 units apart; such windows share a core, and equal ones meet in
   the bucket of their core.  Pieces of a core with more than ``hot`` different ones,
   and all strings without a ``step``, are dealt out window by window, by 128-bit
   fingerprints.
4. Runs of repeated windows go back to the texts from the places themselves.

Exact copies of a text take part once, as the row of the smallest id; a text is
known by the first 128 bits of its SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import Prefix, chunks, windows, words_of, write_table

#: Hashes of the census are cut to so many bits.
CENSUS_BITS = 48
HASHES_PER_BUCKET = 1 << 20
DOCS_PER_BLOCK = 4096
#: Texts are cut in groups of so many bytes, whose arrays stay in a core's cache.
GROUP_BYTES = 1 << 18
#: Bytes of distinct strings that a task holds before it writes them.
HELD_BYTES = 16 << 20
#: Places beyond which a minimiser's strings are dealt out, however few they are.
PLACES_PER_BUCKET = 200_000
#: Rows that a piece found in very many strings is spread over.
SALTS = 32
#: Where a string occurs: row of the text, its first window there, smallest document of the text.
PLACE = np.dtype([("row", "<i8"), ("start", "<i4"), ("first", "<i8")])


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` consecutive entries, by doubling."""
    out, done = x, 1
    while done < width:
        step = min(done, width - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def pack(x: np.ndarray) -> bytes:
    """Unsigned 48-bit integers, little-endian."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : CENSUS_BITS // 8]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    few = np.frombuffer(raw, np.uint8).reshape(-1, CENSUS_BITS // 8)
    out = np.zeros((len(few), 8), np.uint8)
    out[:, : CENSUS_BITS // 8] = few
    return out.view("<u8").ravel()


def among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """True for entries of ``x`` that the sorted ``known`` holds."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


@dataclass(frozen=True)
class Units:
    """What a window is made of."""

    words: bool
    span: int
    gram: int
    #: A window repeats if it occurs twice anywhere (else: in two documents).
    within: bool

    def cut(self, group: list[bytes]) -> Cut:
        if self.words:
            group = [b" ".join(raw.split()) for raw in group]
            data, start, end, hashes, first = words_of(group)
            grams = windows(hashes, self.gram)
            return self._cut(data.tobytes(), start, end, np.asarray(first), grams)
        blob = b"".join(group)
        data = np.frombuffer(blob, np.uint8)
        at = np.arange(len(data))
        grams = np.empty(0, np.uint64)
        if len(data) >= self.span:
            grams = Prefix(data).of(at[: len(data) - self.gram + 1], at[self.gram - 1 :] + 1)
        return self._cut(blob, at, at + 1, np.cumsum([0, *map(len, group)]), grams)

    def _cut(self, blob: bytes, start: np.ndarray, end: np.ndarray, first: np.ndarray, grams: np.ndarray) -> Cut:
        many = self.span - self.gram + 1
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        least = sliding(grams, many, np.minimum) if len(grams) >= many else np.empty(0, np.uint64)
        at = np.arange(len(least))
        whole = at + self.span <= first[1:][doc[: len(least)]]
        return Cut(blob, start, end, first, doc, grams, least, whole)

    def reported(self, cut: Cut) -> list[np.ndarray]:
        """Minimisers of every text for the census: distinct, or one for each place if windows repeat within a text."""
        if self.within and len(cut.least):
            # A place is one if some window that holds it has its hash as minimiser.
            pad = np.zeros(self.span - self.gram, np.uint64)
            least = np.where(cut.whole, cut.least, np.uint64(0))
            most = sliding(np.concatenate([pad, least, pad]), self.span - self.gram + 1, np.maximum)
            at = np.flatnonzero(most == cut.grams)
            values = cut.grams[at]
        else:
            at = np.flatnonzero(cut.heads())
            values = cut.least[at]
        values = np.split(values, np.searchsorted(at, cut.first[1:-1]))
        return values if self.within else [np.unique(v) for v in values]


@dataclass(frozen=True)
class Cut:
    """A group of texts in units: ``first`` has the first unit of each text and the end of the last."""

    blob: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    grams: np.ndarray
    #: The minimiser of every window, and whether the window lies in one text.
    least: np.ndarray
    whole: np.ndarray

    def heads(self) -> np.ndarray:
        """True for windows of one text that begin a run of the same minimiser."""
        if not len(self.least):
            return np.zeros(0, bool)
        fresh = np.ones(len(self.least), bool)
        fresh[1:] = (self.least[1:] != self.least[:-1]) | ~self.whole[:-1] | (self.doc[1 : len(self.least)] != self.doc[: len(self.least) - 1])
        return fresh & self.whole


def small(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - CENSUS_BITS)


def profiles(docs: DataFrame, units: Units, sha: Callable[[bytes], bytes]) -> DataFrame:
    """``doc_id, key, n_units, sha, hashes`` of every text; ``sha`` gives the bytes that a text leaves if nothing goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, group in chunks(batch.column(2), GROUP_BYTES):
                part = batch.slice(at, len(group))
                cut = units.cut(group)
                digest = [hashlib.sha256(sha(raw)).hexdigest() for raw in group]
                packed = [pack(small(x)) for x in units.reported(cut)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(cut.first), pa.int64()), pa.array(digest), pa.array(packed, pa.binary())],
                    names=["doc_id", "key", "n_units", "sha", "hashes"],
                )

    return identified(docs).mapInArrow(run, "doc_id long, key binary, n_units long, sha string, hashes binary")


def identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(text).alias("key"), text.alias("text"))


def digest(column) -> Column:
    """The first 128 bits of the SHA-256 of a string or of bytes."""
    return F.substring(F.unhex(F.sha2(column, 256)), 1, 16)


def repeated(texts: DataFrame, hot: int) -> DataFrame:
    """``key, first, hashes, hot``: of every text with such, its minimisers that occur twice, those counted over ``hot`` times apart.

    ``texts`` has each text once: ``key, first, hashes``.
    """
    totals = texts.agg(F.count("*").alias("docs"), F.sum(F.length("hashes")).alias("bytes")).first()
    buckets = 1 + (totals["bytes"] or 0) // (CENSUS_BITS // 8) // HASHES_PER_BUCKET
    blocks = 1 + totals["docs"] // DOCS_PER_BLOCK
    shift = np.uint64(CENSUS_BITS - 20)
    rows = texts.filter(F.length("hashes") > 0).select("key", "first", "hashes", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"))

    def ask(table: pa.Table) -> pa.Table:
        values = unpack(b"".join(table.column("hashes").to_pylist()))
        values, counts = np.unique(values, return_counts=True)
        bucket = ((values >> shift) * np.uint64(buckets) >> np.uint64(20)).astype(np.int32)
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(at[1:], len(values))
        return pa.table(
            {
                "bucket": pa.array(bucket[at], pa.int32()),
                "block": pa.array(np.full(len(at), table.column("block")[0].as_py()), pa.int32()),
                "hashes": pa.array([pack(values[a:b]) for a, b in zip(at, ends)], pa.binary()),
                "counts": pa.array([np.minimum(counts[a:b], 65535).astype("<u2").tobytes() for a, b in zip(at, ends)], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        lists = [unpack(x) for x in table.column("hashes").to_pylist()]
        values = np.concatenate(lists)
        order = np.argsort(values, kind="stable")
        values = values[order]
        heads = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u2").astype(np.int64)[order]
        counts = np.add.reduceat(counts, heads)
        values, counts = values[heads[counts > 1]], counts[counts > 1]
        found, crowded = [], []
        for x in lists:
            at = np.minimum(np.searchsorted(values, x), max(len(values) - 1, 0))
            at = at[values[at] == x] if len(values) else at[:0]
            found.append(pack(values[at]))
            crowded.append(pack(values[at[counts[at] > hot]]))
        return pa.table({"block": table.column("block"), "found": pa.array(found, pa.binary()), "hot": pa.array(crowded, pa.binary())})

    def match(key: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        known, crowded = (np.sort(unpack(b"".join(theirs.column(c).to_pylist()))) for c in ("found", "hot"))
        at, out, much = [], [], []
        if len(known):
            for i, raw in enumerate(mine.column("hashes").to_pylist()):
                x = np.unique(unpack(raw))
                x = x[among(x, known)]
                if len(x):
                    dense = among(x, crowded)
                    at.append(i)
                    out.append(pack(x[~dense]))
                    much.append(pack(x[dense]))
        some = mine.select(["key", "first"]).take(pa.array(at, pa.int64()))
        return some.append_column("hashes", pa.array(out, pa.binary())).append_column("hot", pa.array(much, pa.binary()))

    asked = rows.groupBy("block").applyInArrow(ask, "bucket int, block int, hashes binary, counts binary")
    told = asked.groupBy("bucket").applyInArrow(answer, "block int, found binary, hot binary").filter(F.length("found") > 0)
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(match, "key binary, first long, hashes binary, hot binary")


def strings_of(group: list[bytes], known: np.ndarray, units: Units) -> Iterator[tuple[int, int, int, bytes]]:
    """(text, minimiser, first window, string) of the runs of windows whose minimiser is ``known``."""
    cut = units.cut(group)
    if not len(cut.least) or not len(known):
        return
    heads = np.flatnonzero(cut.heads())
    stop = np.flatnonzero(np.append(cut.heads()[1:] | ~cut.whole[1:], True) & cut.whole)
    hit = np.flatnonzero(among(small(cut.least[heads]), known))
    heads, stop = heads[hit], stop[hit]
    doc = cut.doc[heads]
    begin, end = cut.start[heads], cut.end[stop + units.span - 1]
    for d, mini, at, a, b in zip(doc.tolist(), cut.least[heads].view(np.int64).tolist(), (heads - cut.first[doc]).tolist(), begin.tolist(), end.tolist()):
        yield d, mini, at, cut.blob[a:b]


def strings(texts: DataFrame, units: Units, column: str) -> DataFrame:
    """``mini, body, places, first, times``: the strings of each batch once, of the minimisers in ``column``.

    With all their places, the smallest document, and the number of places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, tuple[int, list]] = {}
            size = 0
            rows, firsts, hashes = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for at, group in chunks(batch.column(2), GROUP_BYTES):
                known = np.unique(unpack(b"".join(hashes[at : at + len(group)])))
                for d, mini, start, body in strings_of(group, known, units):
                    seen = held.get(body)
                    if seen is None:
                        seen = held[body] = (mini, [])
                        size += len(body)
                    seen[1].append((rows[at + d], start, firsts[at + d]))
                if size > HELD_BYTES:
                    yield _string_rows(held)
                    held, size = {}, 0
            yield _string_rows(held)

    some = texts.filter(F.length(column) > 0)
    return some.select("row", "first", "text", column).mapInArrow(run, "mini long, body binary, places binary, first long, times long")


def _string_rows(held: dict[bytes, tuple[int, list]]) -> pa.RecordBatch:
    counts = np.array([len(v[1]) for v in held.values()], np.int64)
    places = np.array([p for v in held.values() for p in v[1]], PLACE)
    ends = np.cumsum(counts)
    least = np.minimum.reduceat(places["first"], ends - counts) if len(places) else np.empty(0, np.int64)
    raw, size = places.tobytes(), PLACE.itemsize
    parts = [raw[a * size : b * size] for a, b in zip((ends - counts).tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays(
        [pa.array([v[0] for v in held.values()], pa.int64()), pa.array(list(held), pa.binary()), pa.array(parts, pa.binary()), pa.array(least, pa.int64()), pa.array(counts)],
        names=["mini", "body", "places", "first", "times"],
    )


#: (row, first window, windows) of runs of repeated windows.
RUNS = "row long, at int, n int"


def runs(sizes: np.ndarray, value: np.ndarray, places: list[bytes], gone: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Runs of windows that go, for every place of strings with ``sizes`` windows of a ``value`` each."""
    held = np.array([len(p) // PLACE.itemsize for p in places], np.int64)
    all_places = np.frombuffer(b"".join(places), PLACE)
    owner = np.repeat(np.arange(len(sizes)), held)
    begin = (np.cumsum(sizes) - sizes)[owner]
    many = sizes[owner]
    # Slices of places with a bounded number of windows; at least one place each.
    part = np.cumsum(many) >> 22
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(many)]
    for a, b in zip(edges, edges[1:]):
        n, place = many[a:b], all_places[a:b]
        own = np.repeat(np.arange(b - a), n)
        entry = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        flag = gone(value[begin[a:b][own] + entry], place["first"][own])
        head = np.flatnonzero(flag & ((entry == 0) | ~np.roll(flag, 1)))
        tail = np.flatnonzero(flag & ((entry == n[own] - 1) | ~np.roll(flag, -1)))
        which = own[head]
        columns = place["row"][which], place["start"][which] + entry[head], tail - head + 1
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32()))], names=["row", "at", "n"])


#: Given distinct strings, the smallest document and the number of places of each: windows per string, a value per window.
Judge = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def judged(rows: DataFrame, judge: Judge, gone, shard_bytes: int) -> DataFrame:
    """Runs that go; ``judge`` is called with whole minimisers, up to about ``shard_bytes`` at a time."""

    def shard(held: dict[bytes, list[bytes]]) -> Iterator[pa.RecordBatch]:
        places = [b"".join(p) for p in held.values()]
        times = np.array([len(p) // PLACE.itemsize for p in places], np.int64)
        firsts = np.frombuffer(b"".join(places), PLACE)["first"]
        first = np.minimum.reduceat(firsts, np.cumsum(times) - times)
        sizes, value = judge(list(held), first, times)
        yield from runs(sizes, value, places, gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[bytes]] = {}
        size, last = 0, None
        for batch in batches:
            for mini, body, places in zip(*(c.to_pylist() for c in batch.columns)):
                if mini != last and size >= shard_bytes:
                    yield from shard(held)
                    held, size = {}, 0
                seen = held.get(body)
                if seen is None:
                    held[body] = [places]
                    size += len(body)
                else:
                    seen.append(places)
                size += len(places)
                last = mini
        if held:
            yield from shard(held)

    return rows.repartition("mini").sortWithinPartitions("mini").mapInArrow(run, RUNS)


def by_window(rows: DataFrame, units: Units) -> DataFrame:
    """Every window of ``rows`` with its 128-bit fingerprint: ``string, at, w1, w2, first, times``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for string, body, first, times in zip(*(c.to_pylist() for c in batch.columns)):
                cut = units.cut([body])
                n = len(cut.least)
                a, b = cut.start[:n].tolist(), cut.end[units.span - 1 :].tolist()
                w = np.frombuffer(b"".join(hashlib.blake2b(cut.blob[i:j], digest_size=16).digest() for i, j in zip(a, b)), "<i8").reshape(-1, 2)
                fill = lambda v: pa.array(np.full(n, v), pa.int64())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array([string] * n, pa.binary()), pa.array(np.arange(n), pa.int32()), pa.array(w[:, 0]), pa.array(w[:, 1]), fill(first), fill(times)],
                    names=["string", "at", "w1", "w2", "first", "times"],
                )

    return rows.mapInArrow(run, "string binary, at int, w1 long, w2 long, first long, times long")


def pieces(rows: DataFrame, units: Units, step: int) -> DataFrame:
    """The strings of ``rows`` cut into pieces, different ones of a string once: ``string, at, core, body, piece, first, times``.

    The offset of a window is the distance to the first minimiser in it.  A piece
    has consecutive windows with offsets from ``step`` * q to ``step`` * q + ``step`` - 1,
    which all hold the units around that minimiser that make the core.  ``at`` has
    the first windows of its places in the string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for string, mini, body, first, times in zip(*(c.to_pylist() for c in batch.columns)):
                cut = units.cut([body])
                at = np.arange(len(cut.least))
                spots = np.flatnonzero(cut.grams == np.int64(mini).view(np.uint64))
                spot = spots[np.searchsorted(spots, at)]
                part = (spot - at) // step
                heads = np.flatnonzero((np.diff(spot, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
                stops = np.append(heads[1:], len(at)) - 1 + units.span
                inner = spot[heads] - part[heads] * step
                cores = zip(cut.start[inner].tolist(), cut.end[inner - step + units.span].tolist())
                held: dict[bytes, tuple[int, list[int]]] = {}
                for k, a, b, q, (c, d) in zip(heads.tolist(), cut.start[heads].tolist(), cut.end[stops - 1].tolist(), part[heads].tolist(), cores):
                    piece = body[a:b]
                    if piece not in held:
                        core = hashlib.blake2b(body[c:d], digest_size=8, salt=q.to_bytes(4, "little")).digest()
                        held[piece] = int.from_bytes(core, "little", signed=True), []
                    held[piece][1].append(k)
                out += [(string, ks, core, piece, hashlib.sha256(piece).digest()[:16], first, times * len(ks)) for piece, (core, ks) in held.items()]
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()
            names = ["string", "at", "core", "body", "piece", "first", "times"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return rows.select("string", "mini", "body", "first", "times").mapInArrow(run, "string binary, at array<int>, core long, body binary, piece binary, first long, times long")


def judged_pieces(rows: DataFrame, judge: Judge, shard_bytes: int) -> DataFrame:
    """``piece, values``: a value per window of the different pieces ``core, piece, body, first, times``."""

    def shard(held: list[tuple]) -> pa.RecordBatch:
        names, bodies, first, times = zip(*held)
        sizes, value = judge(list(bodies), np.array(first, np.int64), np.array(times, np.int64))
        values = pa.ListArray.from_arrays(np.cumsum([0, *sizes]).astype(np.int32), pa.array(value, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), values], names=["piece", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for core, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if core != last and size >= shard_bytes:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
                last = core
        if held:
            yield shard(held)

    rows = rows.select("core", "piece", "body", "first", "times")
    return rows.repartition("core").sortWithinPartitions("core").mapInArrow(run, "piece binary, values array<long>")


def by_fingerprint(rows: DataFrame, units: Units, value) -> DataFrame:
    """``string, values``: a value per window of the different strings ``string, body, first, times``."""
    single = write_table(by_window(rows.select("string", "body", "first", "times"), units), "repeats-windows")
    totals = single.groupBy("w1", "w2").agg(value.alias("value"))
    values = single.join(totals, ["w1", "w2"]).groupBy("string").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("marks"))
    return values.select("string", F.col("marks.value").alias("values"))


def by_piece(rows: DataFrame, units: Units, judge: Judge, value, shard_bytes: int, hot: int, step: int) -> DataFrame:
    """The same as ``by_fingerprint``, for strings with their ``mini``: most are judged in the buckets of their cores.

    A piece of very many strings is one row per salt wherever it is shuffled.
    """
    whole = [F.first("core").alias("core"), F.first("body").alias("body"), F.min("first").alias("first"), F.sum("times").alias("times")]
    salt = F.pmod(F.hash("string"), F.lit(SALTS)).alias("salt")
    salted = pieces(rows, units, step).groupBy("piece", salt).agg(*whole, F.collect_list(F.struct("string", "at")).alias("users"))
    salted = write_table(salted, "repeats-pieces")
    each = write_table(salted.groupBy("piece").agg(*whole), "repeats-cores")
    crowded = write_table(each.groupBy("core").count().filter(F.col("count") > hot).select("core"), "repeats-hot-cores")
    few = judged_pieces(each.join(crowded, "core", "left_anti"), judge, shard_bytes)
    many = by_fingerprint(each.join(crowded, "core", "left_semi").withColumnRenamed("piece", "string"), units, value)
    answers = few.unionByName(many.withColumnRenamed("string", "piece"))
    told = salted.select("piece", "users").join(answers, "piece").select(F.explode("users").alias("user"), "values")
    told = told.select("user.string", F.explode("user.at").alias("at"), "values")
    return told.groupBy("string").agg(F.flatten(F.sort_array(F.collect_list(F.struct("at", "values")))["values"]).alias("values"))


def dealt(rows: DataFrame, units: Units, judge: Judge, value, gone, shard_bytes: int, hot: int, step: int | None) -> DataFrame:
    """The same runs for strings that never meet in one bucket; ``value`` aggregates the windows of one fingerprint."""
    different = rows.groupBy("string").agg(F.first("mini").alias("mini"), F.first("body").alias("body"), F.min("first").alias("first"), F.sum("times").alias("times"))
    values = by_piece(different, units, judge, value, shard_bytes, hot, step) if step else by_fingerprint(different, units, value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = found.values.to_numpy()
                yield from runs(np.array([len(found)]), found, [raw], gone)

    return rows.join(values, "string").select("places", "values").mapInArrow(run, RUNS)


def repeats(texts: DataFrame, units: Units, judge: Judge, value, gone, shard_bytes: int, hot: int, step: int | None = None) -> DataFrame:
    """``row, key, text, marks``: of every text with windows that go, the runs of them.

    ``gone(value, first)`` tells whether a window goes from a text, by the window's value and the text's smallest document.
    """
    many = write_table(strings(texts, units, "hot").withColumn("string", digest("body")), "repeats-strings")
    load = many.groupBy("mini", "string").agg(F.sum("times").alias("times")).groupBy("mini").agg(F.count("*").alias("strings"), F.sum("times").alias("times"))
    crowded = write_table(load.filter((F.col("strings") > hot) | (F.col("times") > PLACES_PER_BUCKET)).select("mini"), "repeats-hot")
    few = strings(texts, units, "hashes").select("mini", "body", "places")
    few = judged(few.unionByName(many.join(crowded, "mini", "left_anti").select("mini", "body", "places")), judge, gone, shard_bytes)
    found = few.unionByName(dealt(many.join(crowded, "mini", "left_semi"), units, judge, value, gone, shard_bytes, hot, step))
    marks = found.groupBy("row").agg(F.collect_list(F.struct("at", "n")).alias("marks"))
    return marks.join(texts.select("row", "key", "text"), "row")


def candidates(docs: DataFrame, profile: DataFrame, with_ids_only: bool, hot: int) -> tuple[DataFrame, DataFrame]:
    """(``key, first, copies`` of every text; ``row, key, first, text, hashes, hot`` of texts that may hold a repeated window)."""
    each = profile.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("hashes").alias("hashes"))
    leaders = write_table(each, "repeats-keys")
    some = repeated(leaders.filter(F.col("first").isNotNull()) if with_ids_only else leaders, hot)
    # Joined on plain columns, so that repeated rows are dropped without another exchange of texts.
    number = lambda c: F.coalesce(c, F.lit(-1 << 63))
    rows = identified(docs).select("key", number("doc_id").alias("id"), "text")
    texts = rows.join(some.withColumn("id", number("first")), ["key", "id"]).dropDuplicates(["key", "id"])
    texts = texts.select(F.monotonically_increasing_id().alias("row"), "key", F.coalesce("first", F.lit(-1)).alias("first"), "text", "hashes", "hot")
    return leaders.drop("hashes"), write_table(texts, "repeats-texts")


def covered(marks: list[dict], span: int, n: int) -> np.ndarray:
    """True for every unit under a window of one of the runs ``marks``."""
    at = np.array([m["at"] for m in marks], np.int64)
    many = np.array([m["n"] for m in marks], np.int64)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + many - 1 + span, -1)
    return np.cumsum(step[:n]) > 0
