"""Near-duplicate documents by ProbMinHash.

A text is the weighted set of its word shingles (weight: how often one occurs).
Every shingle emits arrivals of a Poisson process whose rate is its weight; each
arrival falls into one of ``m`` registers, which keep the earliest one.  A shingle
stops as soon as its next arrival is later than the latest register, so most emit
once or twice.  Two texts agree in a register with the probability Jaccard
similarity of their sets

    J_P(x, y) = sum over common d of 1 / sum over d' of max(x[d'] / x[d], y[d'] / y[d]),

which for sets without repetition is the ordinary Jaccard similarity.

Exact copies are one node.  In every bucket of nodes that share a band of registers
the smallest node leads, and all others are verified against it (J_P from the
texts).  J_P distance is a metric, so a node j that fails against leader L can be
similar to a follower of L only if J_P(j, L) >= 2 t - 1; such nodes are compared
with the followers that are not yet in their component.  What fails stays together
and is led again: a small rest inside one task, a large one as a whole while leaders
find followers, else by an exact comparison of all its pairs, block against block,
as are border nodes with followers.  So a dense bucket costs its size, a loose one
its square in matrix products, and no pair of a bucket is passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .text import chunks, mix, windows, words_of, write_table

#: Similarities of weighted sets are sums of floats; what is short of a limit by less has reached it.
EPS = 1e-9


def weighted_shingles(group: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of a group of texts, sorted; a text of fewer words is one shingle."""
    _, _, _, hashes, first = words_of(group)
    docs = len(group)
    sizes = np.diff(first)
    all_windows = windows(hashes, width)
    owner = np.repeat(np.arange(docs), sizes)
    inside = np.flatnonzero(owner[: len(all_windows)] == owner[len(owner) - len(all_windows) :]) if len(all_windows) else np.empty(0, np.int64)
    doc, shingle = owner[inside], all_windows[inside]
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        whole = np.array([windows(hashes[first[d] : first[d + 1]], int(sizes[d]), 1)[0] for d in short], np.uint64)
        doc, shingle = np.concatenate([doc, short]), np.concatenate([shingle, whole])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(fresh)
    return doc[at], shingle[at], np.diff(np.append(at, len(doc)))


def registers(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, m: int) -> np.ndarray:
    """The shingle of the earliest arrival in each of ``m`` registers, for all documents at once."""
    times, ids = np.full(docs * m, np.inf), np.zeros(docs * m, np.uint64)
    clock, alive = np.zeros(len(doc)), np.arange(len(doc))
    drawn, block = 0, 1
    while len(alive):
        # ``block`` more arrivals of every shingle that may still win a register.
        source = mix(shingle[alive][:, None] + np.arange(drawn, drawn + block, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95), 3)
        gaps = -np.log1p(-(source >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight[alive][:, None]
        arrivals = clock[alive][:, None] + np.cumsum(gaps, axis=1)
        slot = doc[alive][:, None] * m + (mix(source, 5) % np.uint64(m)).astype(np.int64)
        latest = times.reshape(docs, m).max(axis=1)
        early = arrivals < latest[doc[alive]][:, None]
        slots, when = slot[early], arrivals[early]
        np.minimum.at(times, slots, when)
        won = times[slots] == when
        ids[slots[won]] = np.broadcast_to(shingle[alive][:, None], early.shape)[early][won]
        clock[alive] = arrivals[:, -1]
        latest = times.reshape(docs, m).max(axis=1)
        alive = alive[clock[alive] < latest[doc[alive]]]
        drawn += block
        block = min(2 * block, 64) if len(alive) * block < 1 << 20 else block
    return ids.reshape(docs, m)


def band_hashes(ids: np.ndarray, bands: int) -> np.ndarray:
    rows = ids.shape[1] // bands
    out = np.tile(mix(np.arange(bands, dtype=np.uint64), 9), (len(ids), 1))
    for r in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[:, r : rows * bands : rows], 9)
    return out


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets, each (sorted elements, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if (a[1] == 1).all() and (b[1] == 1).all():
        return len(common) / (len(a[0]) + len(b[0]) - len(common))
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    # Elements of a alone have ratio infinity, of b alone ratio 0.
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    order = np.argsort(x / y, kind="stable")
    ratio, x, y = (x / y)[order], x[order], y[order]
    first = np.searchsorted(ratio, ratio, "left")
    above = only_x + np.append(np.cumsum(x[::-1])[::-1], 0.0)[first]
    below = only_y + np.insert(np.cumsum(y), 0, 0.0)[first]
    return float((1 / (above / x + below / y)).sum())


def sketch(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, key, bands``: the hash of the text and of its bands; texts without words have no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, group in chunks(batch.column(2)):
                doc, shingle, count = weighted_shingles(group, width)
                ids = registers(doc, shingle, count.astype(float), len(group), bands * rows)
                has = np.zeros(len(group), bool)
                has[doc] = True
                hashes = band_hashes(ids, bands).view(np.int64)[has]
                offsets = np.concatenate(([0], np.cumsum(has * bands))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.ravel()))
                part = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["doc_id", "key", "bands"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    return texts.mapInArrow(run, "doc_id long, key long, bands array<long>")


def similarities(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``a, b, j``: J_P of each pair of nodes, from their texts (``key, text``)."""
    left = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, leader = None, None  # rows come sorted by b where Spark merged; else this is only a cache
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            out = []
            for i in range(batch.num_rows):
                if held != (b[i].as_py()):
                    held = b[i].as_py()
                    leader = weighted_shingles([(batch.column(3)[i].as_py() or "").encode()], width)[1:]
                member = weighted_shingles([(batch.column(2)[i].as_py() or "").encode()], width)[1:]
                out.append(probability_jaccard(member, leader))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(out, pa.float64())], names=["a", "b", "j"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, j double")


def rest_links(rows: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links ``u, v`` inside small buckets (``band, key, text``): each node against the leaders before it.

    A node is compared with the followers of a leader only where the metric allows
    a link and none is known yet, as between buckets.
    """

    def linked(bucket: list[tuple[int, str]]) -> list[tuple[int, int]]:
        sets = [weighted_shingles([t.encode()], width)[1:] for _, t in bucket]
        part = list(range(len(bucket)))  # component of each node
        led: dict[int, list[int]] = {}
        out = []

        def compare(i: int, j: int) -> float:
            near = probability_jaccard(sets[i], sets[j])
            if near >= threshold - EPS:
                out.append((bucket[i][0], bucket[j][0]))
                old, new = part[i], part[j]
                part[:] = [new if p == old else p for p in part]
            return near

        for i in range(len(bucket)):
            home = None
            for leader, followers in led.items():
                if part[leader] == part[i] and home is not None:
                    continue
                near = compare(i, leader)
                if near >= threshold - EPS and home is None:
                    home = leader
                elif 2 * threshold - 1 - EPS <= near < threshold - EPS:
                    for f in followers:
                        if part[f] != part[i]:
                            compare(i, f)
            if home is None:
                led[i] = []
            else:
                led[home].append(i)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str]] = []
        last = None
        for batch in batches:
            found = []
            for band, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if band != last:
                    found += linked(held)
                    held, last = [], band
                held.append((key, text))
            yield _links(found)
        yield _links(linked(held))

    dealt = rows.select("band", "key", "text").repartition("band").sortWithinPartitions("band", "key")
    return dealt.mapInArrow(run, "u long, v long")


def block_links(texts: list[str], side: np.ndarray, root: np.ndarray, width: int, threshold: float, step: int = 512) -> list[tuple[int, int]]:
    """Index pairs that join what is similar: sides 0 against 1, and side 2 with itself; nodes of one root are joined.

    With the shares A and B of two texts' weights that lie on common shingles,
    J_P <= 1 / (1 / A + 1 / B - 1), and equal if no shingle repeats.  Matrix
    products of counts give the shares for ``step`` x ``step`` nodes at a time; only
    what passes that bound is compared.
    """
    parts = [(at, weighted_shingles(group, width)) for at, group in chunks(pa.array(texts))]
    doc, shingle, count = (np.concatenate(x) for x in zip(*((at + d, e, c) for at, (d, e, c) in parts)))
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    total = np.add.reduceat(np.append(count, 0), first[:-1]).astype(float) * (np.diff(first) > 0)
    plain = np.array([bool((count[a:b] == 1).all()) for a, b in zip(first, first[1:])])
    part, out = np.unique(root, return_inverse=True)[1], []

    def tiles(which: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Nodes, and their entries as (row, shingle, count)."""
        nodes = np.flatnonzero((side == which) & (total > 0))
        cut = []
        for at in range(0, len(nodes), step):
            some = nodes[at : at + step]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            cut.append((some, np.repeat(np.arange(len(some)), np.diff(first)[some]), shingle[rows], count[rows]))
        return cut

    def shares(one, two) -> tuple[np.ndarray, np.ndarray]:
        """Weight of the common shingles in each node of ``one`` and of ``two``."""
        vocabulary = np.intersect1d(one[2], two[2])
        repeats = not (plain[one[0]].all() and plain[two[0]].all())
        shape = len(one[0]), len(two[0])
        sums = [np.zeros(shape) for _ in range(1 + repeats)]
        if not len(vocabulary):
            return sums[0], sums[-1]
        sides = []
        for _, row, element, weight in (one, two):
            place = np.searchsorted(vocabulary, element).clip(max=len(vocabulary) - 1)
            hit = np.flatnonzero(vocabulary[place] == element)
            hit = hit[np.argsort(place[hit], kind="stable")]
            sides.append((row[hit], place[hit], weight[hit]))
        n = [np.bincount(place, minlength=len(vocabulary)) for _, place, _ in sides]
        # Shingles of few nodes: their pairs one by one; the others: dense products.
        few = n[0] * n[1] <= 64
        (row, place, weight), (row_b, _, weight_b) = sides
        some = np.flatnonzero(few[place])
        times = n[1][place[some]]
        left = np.repeat(some, times)
        right = np.repeat((np.cumsum(n[1]) - n[1])[place[some]], times) + np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        flat = row[left] * shape[1] + row_b[right]
        for i, w in enumerate((weight[left], weight_b[right])[: len(sums)]):
            sums[i] += np.bincount(flat, w, shape[0] * shape[1]).reshape(shape)
        many = np.flatnonzero(~few)
        columns = 4096  # of a dense tile
        for at in range(0, len(many), columns):
            chosen = many[at : at + columns]
            dense = []
            for i, (row, place, weight) in enumerate(sides):
                low, high = np.searchsorted(place, (chosen[0], chosen[-1] + 1))
                hit = low + np.flatnonzero(~few[place[low:high]])
                counts = np.zeros((shape[i], len(chosen)), np.float32)
                counts[row[hit], np.searchsorted(chosen, place[hit])] = weight[hit]
                dense.append(counts)
            sums[0] += dense[0] @ (dense[1] > 0).astype(np.float32).T
            if repeats:
                sums[1] += (dense[0] > 0).astype(np.float32) @ dense[1].T
        return sums[0], sums[-1]

    def join(one, two, same: bool) -> None:
        a, b = shares(one, two)
        with np.errstate(divide="ignore"):
            bound = 1 / (total[one[0]][:, None] / a + total[two[0]] / b - 1)
        open_pairs = (bound >= threshold - EPS) & (part[one[0]][:, None] != part[two[0]])
        i, j = np.nonzero(np.triu(open_pairs, 1) if same else open_pairs)
        i, j, k = one[0][i], two[0][j], 0
        while k < len(i):
            u, v = i[k], j[k]
            k += 1
            sets = [(shingle[first[x] : first[x + 1]], count[first[x] : first[x + 1]]) for x in (u, v)]
            if probability_jaccard(*sets) < threshold - EPS:
                continue
            out.append((int(u), int(v)))
            part[part == part[u]] = part[v]
            apart = part[i[k:]] != part[j[k:]]
            i, j, k = i[k:][apart], j[k:][apart], 0

    for one in tiles(0):
        for two in tiles(1):
            join(one, two, False)
    inner = tiles(2)
    for at, one in enumerate(inner):
        for two in inner[at:]:
            join(one, two, one is two)
    return out


def block_pairs(rows: DataFrame, texts: DataFrame, width: int, threshold: float, block: int) -> DataFrame:
    """Links ``u, v`` inside groups of ``rows`` (``group, side, key, root``): side 0 with side 1, or side 2 with itself.

    A group is dealt to blocks of about ``block`` nodes and at most some 4 MB; one
    task compares two blocks, so a node has a copy per block of the other side.
    """
    sizes = rows.join(texts.select("key", F.length("text").alias("size")), "key").groupBy("group", "side")
    need = sizes.agg(F.ceil(F.greatest(F.count("*") / block, F.sum("size") / (4 << 20))).cast("int").alias("m"))
    m = need.groupBy("group").agg(*(F.max(F.when(F.col("side") == i, F.col("m"))).alias(f"m{i}") for i in (0, 1, 2)))
    m = write_table(m.filter("m2 IS NOT NULL OR (m0 IS NOT NULL AND m1 IS NOT NULL)"), "minhash-blocks")
    others = F.when(F.col("side") == 2, F.col("m2")).when(F.col("side") == 1, F.col("m0")).otherwise(F.col("m1"))
    own = F.pmod(F.xxhash64("key"), F.coalesce(F.when(F.col("side") == 2, F.col("m2")).when(F.col("side") == 1, F.col("m1")).otherwise(F.col("m0")), F.lit(1)))
    dealt = rows.join(m, "group").withColumn("own", own.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    inner = F.col("side") == 2
    dealt = dealt.select(
        "group", "key", "root",
        F.when(inner, F.least("own", "other")).when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(inner, F.greatest("own", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")).alias("j"),
        # Two blocks of one side meet as 0 and 1, a block meets itself as 2.
        F.when(inner & (F.col("own") != F.col("other")), (F.col("own") > F.col("other")).cast("int")).otherwise(F.col("side")).alias("side"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def linked() -> list[tuple[int, int]]:
            keys, sides, roots, bodies = zip(*held)
            found = block_links(list(bodies), np.array(sides), np.array(roots, np.int64), width, threshold)
            return [(keys[a], keys[b]) for a, b in found]

        for batch in batches:
            for group, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (group, i, j) != last:
                    if held:
                        yield _links(linked())
                    held, last = [], (group, i, j)
                held.append(row)
        if held:
            yield _links(linked())

    dealt = dealt.join(texts, "key").select("group", "i", "j", "key", "side", "root", "text")
    dealt = dealt.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "side", "key")
    return dealt.mapInArrow(run, "u long, v long")


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])


def crowded(members: DataFrame) -> DataFrame:
    """``members`` (key, band) of buckets that hold two nodes or more."""
    shared = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    return write_table(members.join(shared.select("band"), "band").select("band", "key"), "minhash-buckets")


def near_duplicates(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = 24, rows: int = 5, small_bucket: int = 256, dense: float = 0.2, block: int = 2048
) -> DataFrame:
    """Classes of near-duplicates: ``doc_id, key, class_id, class_key, class_size`` for every document.

    ``key`` is the hash of the text, ``class_id`` the smallest doc_id of the class
    (null only if all are) and ``class_key`` the key of that document,
    ``class_size`` the number of rows.  With 24 bands of 5 registers a pair at the
    threshold shares a band with probability 0.9999.  ``small_bucket`` is the
    largest rest of a bucket that one task compares through leaders; a larger one
    gets another leader if the last one took the share ``dense`` of it, else all its
    pairs are compared, ``block`` by ``block`` nodes to a task.

    Null and empty texts, and texts without words, are classes by their text alone
    only as far as they are copies; repeated rows are copies.  Texts of fewer words
    than ``width`` are one shingle.  Other columns are not read; an empty table
    gives no rows.
    """
    table = write_table(sketch(docs, width, bands, rows), "minhash")
    nodes = table.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first("bands").alias("bands"))
    nodes = write_table(nodes, "minhash-nodes")

    open_rows = crowded(nodes.select("key", F.explode("bands").alias("band")))
    wanted = open_rows.select("key").distinct()
    texts = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    # One row of each text: that of the node's smallest id; repeated rows and null ids leave equal texts.
    first = nodes.join(wanted, "key", "left_semi").select("key", F.col("doc_id").alias("_id"))
    texts = texts.join(first, ["key"]).filter(F.col("doc_id").eqNullSafe(F.col("_id"))).select("key", "text")
    texts = write_table(texts.dropDuplicates(["key"]), "minhash-texts")

    is_near, is_edge = F.col("j") >= threshold - EPS, F.col("j") >= 2 * threshold - 1 - EPS
    known = links = followers = border = loose = None
    while known is None or not open_rows.isEmpty():
        leaders = open_rows.groupBy("band").agg(F.min("key").alias("leader"))
        led = open_rows.join(leaders, "band").filter(F.col("key") != F.col("leader"))
        pairs = led.select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
        fresh = pairs if known is None else pairs.join(known, ["a", "b"], "left_anti")
        fresh = write_table(similarities(fresh, texts, width), "minhash-pairs")
        known = fresh if known is None else known.union(fresh)
        rated = write_table(led.join(known, (led["key"] == known["a"]) & (led["leader"] == known["b"])).select("band", "key", "leader", "j"), "minhash-round")
        near = rated.filter(is_near).select("band", "leader", "key")
        edge = rated.filter(~is_near & is_edge).select("band", "leader", "key")
        followers = near if followers is None else followers.union(near)
        border = edge if border is None else border.union(edge)

        share = F.avg(is_near.cast("int")).alias("share")
        sizes = rated.groupBy("band").agg(F.sum((~is_near).cast("int")).alias("n"), share).filter("n > 1")
        rest = rated.filter(~is_near).select("band", "key").join(sizes, "band")
        inside = rest.filter(F.col("n") <= small_bucket).join(texts, "key")
        inside = write_table(rest_links(inside, width, threshold), "minhash-rest")
        links = inside if links is None else links.union(inside)
        # What is left of a large bucket is led again while leaders find followers in it; of the others all pairs are compared.
        large = write_table(rest.filter(F.col("n") > small_bucket).select("band", "key", "share"), "minhash-large")
        rare = large.filter(F.col("share") < dense).select("band", "key")
        loose = rare if loose is None else loose.union(rare)
        open_rows = write_table(large.filter(F.col("share") >= dense).select("band", "key"), "minhash-open")

    if loose is not None and not loose.isEmpty():
        # Of rests with the same nodes one is enough.
        same = loose.groupBy("band").agg(F.count("*").alias("n"), *(F.bit_xor(F.xxhash64(F.lit(i), "key")).alias(f"h{i}") for i in (0, 1)))
        chosen = same.groupBy("n", "h0", "h1").agg(F.min("band").alias("band")).select("band")
        inner = loose.join(chosen, "band", "left_semi").select(F.col("band").alias("group"), F.lit(2).alias("side"), "key", F.col("key").alias("root"))
        links = links.union(write_table(block_pairs(inner, texts, width, threshold, block), "minhash-loose"))
    links = links.union(known.filter(is_near).select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct()
    roots = components(links)
    if not border.isEmpty():
        # Followers have their leader's root; border nodes of another root are compared with them, whatever the band.
        rooted = roots.select(F.col("node").alias("key"), "root")
        home = roots.select(F.col("node").alias("leader"), F.col("root").alias("home"))
        one = border.select("leader", "key").distinct().join(home, "leader").join(rooted, "key", "left")
        one = one.withColumn("root", F.coalesce("root", "key")).filter("root <> home")
        one = write_table(one.select(F.col("leader").alias("group"), F.lit(1).alias("side"), "key", "root"), "minhash-border")
        two = followers.select("leader", "key").distinct().join(one.select(F.col("group").alias("leader")).distinct(), "leader", "left_semi")
        two = two.join(rooted, "key").select(F.col("leader").alias("group"), F.lit(0).alias("side"), "key", "root")
        more = block_pairs(one.union(two), texts, width, threshold, block)
        more = write_table(more, "minhash-more")
        if not more.isEmpty():
            roots = components(links.union(more))

    labelled = nodes.join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "doc_id", "n", F.coalesce("root", "key").alias("root"))
    labelled = write_table(labelled, "minhash-roots")
    head = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("class_id"), F.col("key").alias("class_key")))
    groups = labelled.groupBy("root").agg(head.alias("head"), F.sum("n").alias("class_size"))
    classes = labelled.join(groups, "root").select("key", "head.class_id", "head.class_key", "class_size")
    return table.select("doc_id", "key").join(classes, "key").select("doc_id", "key", "class_id", "class_key", "class_size")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id.  All columns stay."""
    classes = near_duplicates(docs, **options)
    keep = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key")))
    keep = keep.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    rows = tagged.join(keep, tagged["id"].eqNullSafe(keep["_id"]) & (tagged["key"] == keep["_key"]))
    return rows.dropDuplicates(["id", "key"]).select("row.*")
