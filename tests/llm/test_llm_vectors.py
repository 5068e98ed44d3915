"""Centroid clustering, tokenizer alignment and SimHash against plain versions."""

import collections
import hashlib
import json
import math
from itertools import combinations

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
import tiktoken
import xxhash

from seriesloom.llm import alignment, clustering, simhash
from seriesloom.llm.bpe import byte_letters
from seriesloom.llm.queries import ORACLES, PIECES, QUERIES, TOKENIZER

# -- centroid clustering ------------------------------------------------------


def plain_clusters(rows, k=8, rounds=10):
    """{row number: (cluster, distance)} with Python integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    place = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=place)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        for n, vs in members.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted(((i, *near(v)[::-1]) for i, v in kept), key=str), centroids


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(6, 64))
    rows = [(i, (middles[i % 6] + 0.05 * rng.normal(size=64)).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.25] * 64) for i in range(150)]  # equal vectors
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, [0.5] * 64)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [None] + [1.0] * 63), (2004, [math.nan] * 64), (2005, [math.inf] * 64), (2006, [-0.0] * 64)]
    return spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, cluster int, x string"), rows


def test_hilbert_order_is_a_walk_through_all_cells():
    for dims, bits in ((2, 4), (3, 3), (4, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = clustering.hilbert_key(cells, bits)
        walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert len(set(keys)) == len(keys)
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_clusters_equal_plain_rounds(vectors):
    df, rows = vectors
    floats = [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows]
    expected, centroids = plain_clusters(floats)
    got = clustering.cluster(df, block_rows=32).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == expected
    inertia = collections.Counter()
    for _, c, d in expected:
        inertia[c] += d
    assert all(r.cluster_inertia == inertia[r.cluster] and r.inertia == sum(inertia.values()) for r in got)
    assert all(list(r.centroid) == centroids[r.cluster] for r in got)


def test_candidates_hold_the_nearest_and_boxes_prune(vectors):
    rng = np.random.default_rng(2)
    for _ in range(100):
        c = rng.integers(-50, 50, (6, 3))
        low = rng.integers(-40, 40, 3)
        high = low + rng.integers(0, 20, 3)
        points = rng.integers(low, high + 1, (200, 3))
        nearest = ((points[:, None] - c) ** 2).sum(axis=2)
        assert set(np.flatnonzero((nearest == nearest.min(axis=1)[:, None]).any(axis=0))) <= set(clustering.candidates(low, high, c))
    rows = clustering.kept_vectors(vectors[0], 64, 1024).cache()
    blocks = clustering.ordered_blocks(rows, 64, 4, 16)
    centroids = np.array(plain_clusters([(i, v) for i, v in vectors[1] if v and len(v) == 64 and None not in v])[1])
    cost = clustering.pruning(blocks, centroids).selectExpr("sum(n_rows * n_candidates) / sum(n_rows)").first()[0]
    assert cost < 2  # of 8: vectors in groups meet few centroids


def test_large_components_stay_exact_and_too_large_ones_go():
    x = np.array([[1 << 27, -(1 << 27)], [5, 7]])
    c = np.array([[-(1 << 27), 1 << 27], [0, 0]])
    assert clustering.exact_distances(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]


def test_few_and_no_vectors(spark, vectors):
    df, _ = vectors
    assert clustering.cluster(df.filter("false")).count() == 0
    assert clustering.cluster(df.filter("vec_id > 2000 and vec_id < 2006")).count() == 0
    few = clustering.cluster(df.filter("vec_id in (1, 2, 3)")).collect()
    assert len(few) == 3 and all(r.distance == 0 for r in few)
    huge = spark.createDataFrame([(1, [1e30] * 64), (2, [1.0] * 64)], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in clustering.cluster(huge).collect()] == [2]


def test_cluster_query_equals_its_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = QUERIES["op11_clusters"](spark, sf)
    want = con.execute(ORACLES["op11_clusters"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())


# -- tokenizer alignment ------------------------------------------------------

HARD = [
    (None, "x y"), (900001, None), (900002, ""), (900003, " "), (900004, "  a  b\n c \t d"), (900005, "漢字 🙂 größer ﬁ ▁x"),
    (900006, "x" * 3000), (900007, "<|endoftext|> <s> </s> <0x41> hi"), (900008, "a" + " " * 400 + "b\r\n\r\n   c"),
    (900009, "\x00\x1c \x85 　 x　 y"), (900010, "漢字漢字🙂🙂é é"), (900010, "漢字漢字🙂🙂é é"), (900011, "na " * 5000),
    (900012, "".join(chr(0x1F300 + i % 500) for i in range(3000))), (900013, "wort\n"), (900014, "\n\n wort"),
]


@pytest.fixture(scope="module")
def plain_sides():
    """Functions text -> token ids of both sides, and id -> bytes, from the libraries on whole texts."""
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters, shown = byte_letters(), {i: s for s, i in a.get_vocab().items()}
    a_bytes = lambda i: bytes(letters[c] for c in shown[i])
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return lambda t: a.encode(" " + t, add_special_tokens=False).ids, b.encode, a_bytes, b_bytes


def plain_groups(text, sides):
    """Groups as (A ids, B ids), or None where a side changes the bytes."""
    encode_a, encode_b, a_bytes, b_bytes = sides
    if not text:
        return None
    a, b = encode_a(text), encode_b(text)
    if not b"".join(map(a_bytes, a)) == b"".join(map(b_bytes, b)) == (" " + text).encode():
        return None
    a_ends, b_ends = np.cumsum([len(a_bytes(i)) for i in a]), np.cumsum([len(b_bytes(i)) for i in b])
    cuts = np.intersect1d(a_ends, b_ends)
    a_cuts, b_cuts = np.searchsorted(a_ends, cuts) + 1, np.searchsorted(b_ends, cuts) + 1
    return [(p.tolist(), q.tolist()) for p, q in zip(np.split(a, a_cuts)[:-1], np.split(b, b_cuts)[:-1])]


def plain_alignment(rows, sides):
    docs = [(i, plain_groups(t, sides)) for i, t in rows]
    count = collections.Counter()
    for _, groups in docs:
        count.update({(p, q) for a, b in groups or () for p in a for q in b})
    best = collections.defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = collections.Counter()
    for i, groups in docs:
        links = [(p, q) for a, b in groups or () for p in a for q in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or ())
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        sizes = [sum(len(g[side]) for g in groups or ()) for side in (0, 1)]
        best_links = sum(count[x] == best[x[0]] for x in links)
        out[i, *sizes, len(groups or ()), len(links), best_links, sum(count[x] for x in links), sha] += 1
    return out


FIGURES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("size, block", [(1 << 20, 8 << 20), (2000, 20_000)])
def test_alignment_equals_plain(spark, some_docs, plain_sides, size, block):
    hard = spark.createDataFrame([(*r, 1, "x") for r in HARD], "doc_id long, text string, pair int, block string")
    rows = some_docs.select("doc_id", "text").unionByName(hard, allowMissingColumns=True)
    got = alignment.link_counts(rows, TOKENIZER, PIECES, size, block).select(FIGURES).collect()
    texts = [(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()]
    assert collections.Counter(map(tuple, got)) == plain_alignment(texts, plain_sides)


def test_alignment_lists(spark, plain_sides):
    rows = [r for r in HARD if r[0] not in (None, 900010)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in alignment.align(df, TOKENIZER, PIECES, size=500).collect():
        groups = plain_groups(dict(rows)[r.doc_id], plain_sides)
        if groups is None:
            assert r.a_ids == r.b_ids == r.a_overlaps == []
            continue
        for ids, at, side in ((r.a_ids, r.a_groups, 0), (r.b_ids, r.b_groups, 1)):
            assert list(zip(ids, at)) == [(i, n) for n, g in enumerate(groups) for i in g[side]]
        starts = [0, *r.a_ends[:-1]], [0, *r.b_ends[:-1]]
        if len(r.a_ids) < 1500:
            shared = {(i, j) for i in range(len(r.a_ids)) for j in range(len(r.b_ids)) if max(starts[0][i], starts[1][j]) < min(r.a_ends[i], r.b_ends[j])}
            found = list(zip(r.a_overlaps, r.b_overlaps))
            assert set(found) == shared and len(found) == len(shared)


def test_wide_groups_count_distinct_ids_only():
    """A group of 70,000 by 70,000 tokens: numbers of links are exact without any list of them."""
    a, b = [np.array([5] * 69_999 + [6], np.uint32)], [np.array([1] * 70_000, np.uint32)]
    x = alignment.align_segments(a, b, np.ones(10, np.int64), np.ones(10, np.int64))
    assert x.n_groups == 70_000
    x.a_group[:], x.b_group[:], x.n_groups = 0, 0, 1
    segment, key, n, work = alignment.linked_ids(x, 100)
    assert list(zip(key.tolist(), n.tolist())) == [(501, 69_999 * 70_000), (601, 70_000)]
    assert work.tolist() == [70_000**2] and segment.tolist() == [0, 0]


def test_alignment_without_rows(no_docs):
    assert alignment.link_counts(no_docs, TOKENIZER, PIECES).count() == 0
    assert alignment.align(no_docs, TOKENIZER, PIECES).count() == 0


def test_word_boundaries_hold_for_both_sides():
    """Tokens of texts cut at words equal those of whole texts, for white space of all kinds."""
    rng = np.random.default_rng(3)
    known = alignment.Tokenizers(TOKENIZER, PIECES)
    ranks = {bytes(byte_letters()[c] for c in s): i for s, i in json.load(open(TOKENIZER, encoding="utf-8"))["model"]["vocab"].items() if "<|" not in s}
    whole = tiktoken.Encoding("w", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    signs = ["a", "b", "'s", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "7", "é", "漢", "!", "🙂"]
    for _ in range(500):
        text = "".join(rng.choice(signs, rng.integers(1, 30)))
        parts = known.encode(text, 10)
        assert np.frombuffer(b"".join(p[0] for p in parts), "<u4").tolist() == whole.encode_ordinary(" " + text)
        assert np.frombuffer(b"".join(p[1] for p in parts), "<u4").tolist() == known.b.encode(text)


# -- SimHash ------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, bits=3):
    """{fingerprint: set of fingerprints of its component}"""
    groups = {f: {f} for f in fingerprints}
    for f, g in combinations(groups, 2):
        if (f ^ g).bit_count() <= bits and groups[f] is not groups[g]:
            groups[f] |= groups[g]
            for x in groups[g]:
                groups[x] = groups[f]
    return groups


def test_anchors_cover():
    rng = np.random.default_rng(1)
    half = np.concatenate((rng.integers(0, 1 << 32, 200), [0, 1, (1 << 32) - 1]))
    own = simhash.own_anchor(half)
    assert (simhash.syndrome(own) == 0).all() and (np.bitwise_count(half ^ own) <= 1).all()
    index, anchor, is_own = simhash.anchors(half)
    assert (simhash.syndrome(anchor) == 0).all() and (anchor[is_own] == own).all()
    reached = [set(anchor[index == i].tolist()) for i in range(len(half))]
    assert sum(map(len, reached)) == len(index)  # none twice
    for i, h in enumerate(half):
        for bit in range(32):  # every half within one bit reaches the own anchor of the other
            other = simhash.own_anchor(np.array([h ^ (1 << bit)]))[0]
            assert other in reached[i]


def test_fingerprints_equal_plain(some_docs, odd_docs):
    for docs in (some_docs.limit(60), odd_docs):
        texts = [r.text for r in docs.select("text").collect()]
        assert [simhash.fingerprint(t) & (1 << 64) - 1 for t in texts] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("tile", [4096, 8])
def test_links_join_what_all_pairs_join(spark, tile):
    rng = np.random.default_rng(tile)
    fps = set(rng.integers(-(1 << 63), 1 << 63, 300).tolist())
    middle = int(rng.integers(-(1 << 63), 1 << 63))
    fps |= {middle ^ (1 << int(b)) ^ (1 << int(c)) for b, c in rng.integers(0, 63, (200, 2))}  # a dense group
    for f in list(fps)[:100]:  # chains in which each differs by up to three bits from the one before
        for _ in range(4):
            f ^= sum(1 << int(b) for b in set(rng.integers(0, 63, 3).tolist()))
            fps.add(f)
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = [tuple(r) for r in simhash.links(nodes, tile=tile).collect()]
    unsigned = {f: f & (1 << 64) - 1 for f in fps}
    expected = plain_components(set(unsigned.values()))
    joined = {f: {f} for f in unsigned.values()}
    for u, v in found:
        u, v = unsigned[u], unsigned[v]
        if joined[u] is not joined[v]:
            joined[u] |= joined[v]
            for x in joined[v]:
                joined[x] = joined[u]
    assert joined == expected


def test_simhash_components(spark, some_docs, odd_docs):
    base = "one two three four five six seven eight nine ten " * 40
    extra = [(5000 + i, base + f"word{i}") for i in range(30)] + [(4999, base.upper())]
    docs = some_docs.select("doc_id", "text").union(odd_docs.select("doc_id", "text")).union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    groups = plain_components({f for _, f in rows})
    least = {f: min((i for i, g in rows if g in groups[f] and i is not None), default=None) for _, f in rows}
    expected = collections.Counter((i, f"{f:016x}", least[f]) for i, f in rows)
    assert collections.Counter(map(tuple, simhash.near_duplicates(docs).collect())) == expected


def test_simhash_without_rows_or_ids(spark, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    alone = spark.createDataFrame([(None, "no id"), (None, "no id")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(alone).collect()] == [None, None]


def test_bits_beyond_the_cover_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), bits=4)
