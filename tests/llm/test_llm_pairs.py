"""Near-duplicates, repeated substrings, mixing, neighbours and the pipeline against plain versions."""

import collections
import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from seriesloom.llm import bpe, graph, induced, minhash, mixing, neighbours, repeats, suffixdedup, superkmers, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    w = WORD.findall(text)
    if not w:
        return collections.Counter()
    return collections.Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def plain_jp(x, y):
    both = set(x) | set(y)
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in both) for d in set(x) & set(y))


def plain_classes(texts):
    """{text: smallest id of its class}; copies and links of J_P >= 0.8 join."""
    keys = list(texts)
    sets = [shingles(k) for k in keys]
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if sets[i] and sets[j] and 2 * len(set(sets[i]) & set(sets[j])) > max(len(sets[i]), len(sets[j])) and plain_jp(sets[i], sets[j]) >= 0.8:
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        least[find(i)] = min([least.get(find(i), math.inf), *texts[k]])
    return {k: least[find(i)] for i, k in enumerate(keys)}


def test_probability_jaccard():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 30, 20)).astype(np.uint64) for _ in range(2))
        x, y = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
        expected = plain_jp(collections.Counter(dict(zip(a.tolist(), x.tolist()))), collections.Counter(dict(zip(b.tolist(), y.tolist()))))
        assert math.isclose(minhash.probability_jaccard((a, x), (b, y)), expected, rel_tol=1e-9, abs_tol=1e-12)


def fraction_jp(x, y):
    both = set(x) | set(y)
    return sum(1 / sum(max(Fraction(x[e], x[d]), Fraction(y[e], y[d])) for e in both) for d in set(x) & set(y))


def test_similarities_at_the_threshold_are_near(spark):
    # 12 of 15, 48 of 60 and 68 of 85 shared shingles, and a repeated passage: 0.8 by fractions, and pairs just below.
    texts = [" ".join(f"p{n}w{i}" for i in range(k)) for n, size in enumerate((15, 60, 85)) for k in (size * 4 // 5 + 4, size + 4)]
    texts += [" ".join(f"q{i}" for i in range(k)) for k in (15, 19)]
    texts += [" ".join([f"r{i}" for i in range(25)] * 3), " ".join([f"r{i}" for i in range(25)] * 2)]
    exact = [fraction_jp(shingles(a), shingles(b)) for a, b in zip(texts[::2], texts[1::2])]
    assert exact[:3] == [Fraction(4, 5)] * 3 and exact[3] < Fraction(4, 5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs, rows=1).collect()}
    assert [got[2 * i] == got[2 * i + 1] for i in range(len(exact))] == [j >= Fraction(4, 5) for j in exact]
    assert len(minhash.block_links(texts, np.full(len(texts), 2), np.arange(len(texts)), 5, 0.8)) == sum(j >= Fraction(4, 5) for j in exact)



def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    a, b = rng.integers(1, 1 << 60, 300).astype(np.uint64), rng.integers(1, 1 << 60, 60).astype(np.uint64)
    one, two = np.sort(a), np.sort(np.concatenate([a[60:], b]))
    x, y = rng.integers(1, 4, len(one)), rng.integers(1, 4, len(two))
    doc = np.repeat([0, 1], [len(one), len(two)])
    m = 4000
    ids = minhash.registers(doc, np.concatenate([one, two]), np.concatenate([x, y]).astype(float), 2, m)
    expected = minhash.probability_jaccard((one, x), (two, y))
    assert abs((ids[0] == ids[1]).mean() - expected) < 4 * math.sqrt(expected / m)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def near_docs(spark):
    rng = random.Random(4)
    rows, at = [], 0
    for g in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([40, 120, 400]))]
        for _ in range(rng.choice([1, 2, 6, 25])):
            rows.append((at, edited(rng, base, rng.choice([0, 0, 1, 2, 4, 9]))))
            at += 1
    rows += [(at, "short one"), (at + 1, "short one"), (at + 2, "short two"), (at + 3, "again and again " * 40), (at + 4, "again and again " * 41)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize(("small_bucket", "dense"), [(256, 0.2), (1, 0.2), (1, 2.0)])
def test_near_duplicates_equal_all_pairs(near_docs, some_docs, small_bucket, dense):
    for docs in (near_docs, some_docs):
        texts = collections.defaultdict(list)
        for r in docs.collect():
            texts[r["text"] or ""].append(r["doc_id"])
        expected = plain_classes(texts)
        got = minhash.near_duplicates(docs, small_bucket=small_bucket, dense=dense).collect()
        by_id = {i: t for t, ids in texts.items() for i in ids}
        assert len(got) == len(by_id)
        assert {r["doc_id"]: r["class_id"] for r in got} == {i: expected[t] for i, t in by_id.items()}
        assert minhash.one_of_each(docs).count() == len(set(expected.values()))

def boilerplate(rng, nodes, own, common=40):
    """Texts of one common passage and words of their own: similar to each other below 0.8, and one pair above."""
    base = [f"b{i}" for i in range(common)]
    texts = [" ".join(base + [f"o{n}x{i}" for i in range(own)]) for n in range(nodes)]
    return [*texts, texts[0] + " y", "again " * 9 + texts[1], "again " * 10 + texts[1]]


def joined_classes(nodes, links):
    root = list(range(nodes))
    for a, b in links:
        root = [root[b] if r == root[a] else r for r in root]
    return {frozenset(i for i in range(nodes) if root[i] == r) for r in root}


def test_loose_rests_end_with_all_their_pairs(spark):
    # Every band of one register is shared by nearly all texts: excluding one band does not divide them.
    texts = boilerplate(random.Random(6), 40, 9)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs, rows=1, small_bucket=4, block=8).collect()}
    expected = plain_classes({t: [i] for i, t in enumerate(texts)})
    assert got == {i: expected[t] for i, t in enumerate(texts)}
    assert 1 < len(set(got.values())) < len(texts)


@pytest.mark.parametrize("step", [3, 512])
def test_block_links_equal_all_pairs(step):
    rng = random.Random(7)
    texts = boilerplate(rng, 20, 9) + [edited(rng, ["w%d" % (i % 30) for i in range(90)], rng.choice([0, 1, 2, 3])) for _ in range(20)] + ["", "one"]
    sets = [shingles(t) for t in texts]
    n = len(texts)
    near = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and plain_jp(sets[i], sets[j]) >= 0.8]
    got = minhash.block_links(texts, np.full(n, 2), np.arange(n), 5, 0.8, step)
    assert joined_classes(n, got) == joined_classes(n, near) and set(map(frozenset, got)) <= set(map(frozenset, near))
    side = np.arange(n) % 2
    got = minhash.block_links(texts, side, np.arange(n), 5, 0.8, step)
    assert joined_classes(n, got) == joined_classes(n, [(i, j) for i, j in near if side[i] != side[j]])


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    classes = {r["doc_id"]: r["class_id"] for r in rows}
    assert classes[7] == 6 and classes[1] == classes[2] == 1 and classes[4] == 4 and classes[None] is None
    kept = minhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len({(r["class_id"], r["class_key"]) for r in rows})
    assert minhash.near_duplicates(no_docs).count() == 0 == minhash.one_of_each(no_docs).count()


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(i, i) == find(i) for i in list(root))


def plain_superkmers(texts, span=13):
    least, words = {}, {i: WORD.findall(t) for i, t in texts.items()}
    for i in sorted(words):
        for k in range(len(words[i]) - span + 1):
            least.setdefault(tuple(words[i][k : k + span]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - span + 1):
            if least[tuple(w[k : k + span])] < i:
                gone[k : k + span] = [True] * span
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2_000, 1])
def test_superkmers_equal_the_plain_version(some_docs, near_docs, hot):
    for docs in (some_docs, near_docs):
        expected = plain_superkmers({r["doc_id"]: r["text"] or "" for r in docs.collect()})
        got = superkmers.remove_repeats(docs, hot=hot).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == expected


def test_superkmers_odd_rows(odd_docs, no_docs):
    rows = superkmers.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    gone = {r["doc_id"]: r["n_removed"] for r in rows}
    assert gone[7] == 16 and gone[6] == 0 and gone[9] == 0 and gone[None] == 0 and gone[1] == 0
    assert superkmers.remove_repeats(no_docs).count() == 0


def plain_suffixes(texts, span):
    count = collections.Counter(t[k : k + span] for t in texts for k in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - span + 1):
            if count[t[k : k + span]] > 1:
                gone[k : k + span] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"shard_bytes": 1000, "memory": 1}])
def test_suffix_dedup_equals_the_plain_version(some_docs, near_docs, odd_docs, options):
    for docs, span, gram in ((some_docs, 400, 64), (near_docs, 60, 16), (odd_docs, 400, 64)):
        rows = docs.select("doc_id", "text").collect()
        expected = collections.Counter(zip([r["doc_id"] for r in rows], plain_suffixes([(r["text"] or "").encode() for r in rows], span)))
        got = suffixdedup.remove_repeats(docs, span=span, gram=gram, **options).collect()
        assert collections.Counter((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == expected


@pytest.mark.parametrize("hot", [3, 60])
def test_crowded_minimisers_are_judged_by_suffixes(spark, monkeypatch, hot):
    """A passage in sixty contexts: of its strings only those at a crowded core are dealt out window by window."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefghij", k=6))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, pairs = text(40), [text(10) for _ in range(30)]
    texts = [f"{text(60)} {pairs[i // 2]} {passage} {text(70)}" for i in range(60)] + ["ab" * 700, "ba" * 500]
    dealt, judged = [], []
    plain, kept = repeats.by_fingerprint, repeats.judged_pieces
    monkeypatch.setattr(repeats, "by_fingerprint", lambda rows, *rest: (dealt.append(rows.count()), plain(rows, *rest))[1])
    monkeypatch.setattr(repeats, "judged_pieces", lambda rows, *rest: (judged.append(rows.count()), kept(rows, *rest))[1])
    got = suffixdedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), span=300, gram=40, hot=hot).collect()
    expected = dict(enumerate(plain_suffixes([t.encode() for t in texts], 300)))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == expected
    assert sum(r["n_removed"] > 0 for r in got) == 62
    assert hot > 3 or (sum(judged) > 0 and sum(dealt) < sum(judged))


def test_suffix_dedup_empty(no_docs):
    assert suffixdedup.remove_repeats(no_docs).count() == 0


def test_induced_sorting():
    rng = random.Random(3)
    for _ in range(300):
        text = [rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(1, 60))] * rng.choice([1, 1, 3])
        text.append(0)
        depth, memory, base = rng.choice([3, 5, 1000]), rng.choice([1, 1 << 20]), rng.choice([0, 1 << 20])
        got = [(int(p), int(n)) for a, b in induced.suffixes(np.array(text, np.uint16), depth, memory, base) for p, n in zip(a, b)]
        assert sorted(p for p, _ in got) == list(range(len(text)))
        for (p, _), (q, n) in zip(got, got[1:]):
            a, b = text[p:], text[q:]
            shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert n == shared if shared < depth else n >= depth
            assert a[:depth] >= b[:depth]


def source_passes(mixed):
    rows = mixed.selectExpr("row.source", "row.doc_id", "epoch", "n_tokens").collect()
    tokens, once = collections.Counter(), {}
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
        once[r["source"], r["doc_id"]] = r["n_tokens"]
    whole = collections.Counter()
    for (s, _), n in once.items():
        whole[s] += n
    return rows, {s: tokens[s] / whole[s] for s in whole if whole[s]}


@pytest.fixture(scope="module")
def sourced(spark):
    rows, at = [], 0
    for s, n in (("big", 600), ("mid", 150), ("small", 30), (None, 40)):
        for _ in range(n):
            rows.append((at, " ".join(["w"] * (3 + at % 9)), s))
            at += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixing_keeps_to_the_repetition_limit(sourced):
    rows, passes = source_passes(mixing.mix(sourced, max_repeat=3.0, blocks=16))
    assert {r["doc_id"] for r in rows} == set(range(820))
    assert passes["big"] == 1 and 2.9 < passes["small"] <= 3.0001
    # The exponent is the one that bisection on paper gives.
    total = collections.Counter()
    for r in sourced.collect():
        total[r["source"]] += len(r["text"].split())
    t = 1 - math.log(3) / math.log(total["big"] / min(total.values()))
    for s, n in total.items():
        assert abs(passes[s] - (n / total["big"]) ** (t - 1)) < 12 / n
    assert len(rows) == len({(r["doc_id"], r["epoch"]) for r in rows})


def test_mixing_to_an_entropy_and_a_budget(sourced):
    sizes = sourced.selectExpr("source", "cast(size(split(text, ' ')) as long) as n_tokens")
    plan = mixing.weights(sizes, None, 0.9, 1000).collect()
    w = np.array([r["weight"] for r in plan])
    assert abs(w.sum() - 1) < 1e-9 and abs(-(w * np.log(w)).sum() - 0.9 * math.log(4)) < 1e-6
    rows, _ = source_passes(mixing.mix(sourced, max_repeat=None, entropy_share=0.9, budget=1000, blocks=16))
    got = collections.Counter()
    for r in rows:
        got[r["source"]] += r["n_tokens"]
    for r in plan:
        assert 0 <= 1000 * r["weight"] - got[r["source"]] < 12
    flat = mixing.weights(sizes, 1.0, None, None).first()
    assert flat["exponent"] > 1 - 1e-9


def test_mixing_odd_rows(odd_docs, no_docs):
    mixed = mixing.mix(odd_docs)
    assert mixed.select("row.*").columns == odd_docs.columns
    assert mixed.filter("epoch = 0").count() == odd_docs.count()
    assert mixing.mix(no_docs).count() == 0


def test_neighbours_recall_and_scores(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = v.collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    got = collections.defaultdict(list)
    for r in neighbours.nearest(v, rows_per_part=128).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    hit = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        true = sorted((s, i) for s, i in zip(d.tolist(), ids.tolist()) if i != q)[:10]
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        assert all(math.isclose(s, d[ids == i][0], abs_tol=1e-12) for s, i in got[q])
        hit += len({i for _, i in true} & {i for _, i in got[q]})
    assert hit / 10 / len(got) >= 0.9


def test_neighbours_odd_rows(spark):
    same = [(i, [1.0, 2.0]) for i in range(0, 60)]
    odd = [(200, None), (300, [0.0, 0.0]), (400, [float("nan"), 1.0]), (500, [None, 1.0]), (600, [float("inf"), 1.0]), (700, [1.0]), (None, [1.0, 1.0])]
    v = spark.createDataFrame([*same, *odd, (800, [3.0, 2.0]), (0, [1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(v).orderBy("query_id", "rank").collect()
    assert {r["query_id"] for r in rows} == {0, 800}
    assert [r["vec_id"] for r in rows if r["query_id"] == 0] == list(range(1, 11))
    assert [(r["vec_id"], r["score"]) for r in rows if r["query_id"] == 800] == [(i, 2.0) for i in range(10)]
    assert neighbours.nearest(v.filter("false")).count() == 0
    assert neighbours.nearest(v.filter("vec_id = 800")).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept, written = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.write_table(stage(spark, docs, sf), f"test-{name}")
        if name != "bpe":
            assert out.columns == columns
        written[name] = out
        kept[name], docs = [r["doc_id"] for r in out.select("doc_id").collect()], out
    grammar = toxicity.train_grammar(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    clean = {r["doc_id"] for r in toxicity.score(spark.read.parquet(f"{sf}/documents.parquet"), grammar).filter("predicted = 0").collect()}
    assert set(kept["toxicity"]) == clean
    texts = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if r["doc_id"] in clean:
            texts[r["text"] or ""].append(r["doc_id"])
    assert sorted(kept["near_dedup"]) == sorted(set(plain_classes(texts).values()))
    assert sorted(kept["secret_scan"]) == sorted(kept["near_dedup"])
    assert set(kept["mixing"]) == set(kept["near_dedup"]) and max(collections.Counter(kept["mixing"]).values()) <= 2
    assert sorted(kept["bpe"]) == sorted(kept["mixing"])
    rows = docs.orderBy("file", "place").collect()
    assert [r["doc_id"] for r in rows] == kept["mixing"]
    texts = {r["doc_id"]: r["text"] for r in written["mixing"].collect()}
    encoder = bpe.encoder(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    assert all(np.array(r["ids"], "<u4").tobytes() == encoder.encode(texts[r["doc_id"]] or "") for r in rows)


def test_mix_is_written_in_training_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    mixed = mixing.mix(docs, max_repeat=2.0)
    out = corpus_pipeline.write_table(mixing.in_order(mixed), "ordered").select("doc_id", "_metadata.file_name", "_metadata.row_index")
    want = mixed.orderBy("epoch", "block_order", "doc_order").select("row.doc_id").collect()
    assert [r["doc_id"] for r in out.orderBy("file_name", "row_index").collect()] == [r["doc_id"] for r in want]


def test_stages_take_odd_rows_and_dotted_columns(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        docs = docs.withColumn("a.b", docs["doc_id"])
        for stage in (corpus_pipeline.near_dedup, corpus_pipeline.secret_scan, corpus_pipeline.mix):
            out = stage(spark, docs, "")
            assert out.columns == docs.columns and out.count() <= 2 * docs.count()
        assert corpus_pipeline.tokenise(spark, docs, "").count() == docs.count()
