"""A Katz backoff bigram model over whole corpora, and the log-probability of every text.

Counts up to ``K`` are discounted by Good-Turing, larger ones give up ``TRUST`` of a
count so that no context is left without mass for new words.  The freed mass of a
context is spread over the words not seen after it in proportion to the unigram
model, so every distribution over the vocabulary, the end of text and one unknown
word adds up to 1.  With c*() for discounted counts:

    P(w | h) = c*(h,w) / c(h)   if c(h,w) > 0
             = a(h) P(w)        if h was seen, else P(w)
    P(w)     = c*(w) / N        if c(w) > 0, else all the freed mass (one unknown word)

Texts are dealt to blocks of bounded size.  A block asks each bucket of the count
tables once for each of its distinct words and bigrams, packed and sorted by a
64-bit hash, and gets counts back in the same order; so the most frequent bigram
costs one entry per block, and no table is ever broadcast or collected.  One block
owns each bigram and adds it to the sums of its context, from which the weights
a(h) follow.  Only counts of counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import CHUNK_BYTES, chunks, mix, training_row, words_of, write_table

#: Counts up to this one are discounted.
K = 5
#: What larger counts are discounted by.
TRUST = 0.01
BLOCK_BYTES = 12 << 20
ENTRIES_PER_BUCKET = 1 << 20
#: Hashes that stand for the end and the start of a text.
END, START = mix(np.array([1, 2], np.uint64), 40)
_CODEC = "zstd"


def planes(x: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, which compresses well if they are small."""
    x = np.ascontiguousarray(x)
    return pa.compress(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes(), codec=_CODEC, asbytes=True)


def unplanes(raw: bytes, n: int, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(pa.decompress(raw, n * size, codec=_CODEC, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).view(dtype).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    return planes(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(unplanes(raw, n, "<u8"), dtype=np.uint64)


def bigram(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first, 41) + second, 42)


@dataclass
class Tokens:
    """Tokens of a block: word hashes with END after each text, and per text its length, training flag and id."""

    words: np.ndarray
    sizes: np.ndarray
    train: np.ndarray
    doc_id: list

    @property
    def in_train(self) -> np.ndarray:
        return np.repeat(self.train, self.sizes)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words with START, the place of every token's word in them, and of the word before it."""
        values, second = np.unique(self.words, return_inverse=True)
        at = np.searchsorted(values, START)
        values = np.insert(values, at, START)
        second += second >= at
        first = np.empty_like(second)
        first[1:] = second[:-1]
        first[np.cumsum(self.sizes) - self.sizes] = at
        return values, first, second


def texts_of(blob: bytes, n_bytes: int, lengths: bytes) -> list[bytes]:
    raw = pa.decompress(blob, n_bytes, codec=_CODEC, asbytes=True) if n_bytes else b""
    ends = np.cumsum(np.frombuffer(lengths, "<i8"))
    return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def tokens_of(table: pa.Table) -> Tokens:
    """Tokens of all texts of a block."""
    words, sizes, train, ids = [], [], [], []
    for doc, flag, blob, n, lengths in zip(*(table.column(c).to_pylist() for c in ("doc_id", "train", "blob", "n_bytes", "lengths"))):
        ids += doc
        train += flag
        texts = texts_of(blob, n, lengths)
        at = 0
        while at < len(texts):
            group, held = [], 0
            while at < len(texts) and (not group or held + len(texts[at]) <= CHUNK_BYTES):
                group.append(texts[at])
                held += len(texts[at])
                at += 1
            _, _, _, hashes, first = words_of(group, lower=True)
            count = np.diff(first)
            words.append(np.insert(hashes, first[1:], END))
            sizes.append(count + 1)
    return Tokens(np.concatenate(words), np.concatenate(sizes), np.array(train, bool), ids)


def blocks_of(docs: DataFrame, size: int, modulus: int, left_out: int) -> DataFrame:
    """Texts of ``size`` bytes as compressed blobs, one row per batch and block."""
    text = F.coalesce("text", F.lit(""))
    blocks = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64(F.col("doc_id"), F.xxhash64(text)), F.lit(blocks)).cast("int")
    rows = docs.select(block.alias("block"), F.col("doc_id").cast("long").alias("doc_id"), training_row(F.col("doc_id"), modulus, left_out).alias("train"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy()
            order = np.argsort(block, kind="stable")
            edge = np.flatnonzero(np.append(True, block[order][1:] != block[order][:-1])) if len(order) else []
            sorted_rows = batch.take(pa.array(order))
            for a, b in zip(edge, [*edge[1:], len(order)]):
                part = sorted_rows.slice(int(a), int(b - a))
                for at, group in chunks(part.column(3), 4 * CHUNK_BYTES):
                    some = part.slice(at, len(group))
                    raw = b"".join(group)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0).slice(0, 1),
                            pa.array([some.column(1).to_pylist()], pa.list_(pa.int64())),
                            pa.array([some.column(2).to_pylist()], pa.list_(pa.bool_())),
                            pa.array([pa.compress(raw, codec=_CODEC, asbytes=True) if raw else b""], pa.binary()),
                            pa.array([len(raw)], pa.int64()),
                            pa.array([np.array([len(x) for x in group], "<i8").tobytes()], pa.binary()),
                        ],
                        names=["block", "doc_id", "train", "blob", "n_bytes", "lengths"],
                    )

    kinds = "block int, doc_id array<long>, train array<boolean>, blob binary, n_bytes long, lengths binary"
    return rows.mapInArrow(run, kinds)


ASK = "bucket int, block int, kind int, n int, hashes binary, counts binary"


def split(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes."""
    bucket = ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(hashes)]):
        yield int(bucket[a]), a, b


def table_of(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, schema)})


_ASK = [("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]
_TOLD = [("block", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("counts", pa.binary()), ("marks", pa.binary()), ("stats", pa.list_(pa.int64()))]
TOLD = "block int, bucket int, kind int, n int, counts binary, marks binary, stats array<long>"


def ask_counts(buckets: int):
    """Distinct words (kind 1) and bigrams (kind 2) of a block with their training counts.

    Counts of words are doubled, plus 1 if the word is the context of a held-out
    token: only such contexts can need a backoff weight.
    """

    def run(table: pa.Table) -> pa.Table:
        t = tokens_of(table)
        block, train = table.column("block")[0].as_py(), t.in_train
        values, first, second = t.distinct()
        counts = np.bincount(second, train, len(values)).astype(np.int64)
        start = np.searchsorted(values, START)
        counts[start] = t.train.sum()  # as a context, once for every training text
        held = np.bincount(first, ~train, len(values)) > 0
        rows = [(k, block, 1, b - a, pack_sorted(values[a:b]), planes(2 * counts[a:b] + held[a:b])) for k, a, b in split(values, buckets)]
        pairs, where = np.unique(bigram(values[first], t.words), return_inverse=True)
        counts = np.bincount(where, train, len(pairs)).astype(np.int64)
        rows += [(k, block, 2, b - a, pack_sorted(pairs[a:b]), planes(counts[a:b])) for k, a, b in split(pairs, buckets)]
        return table_of(rows, _ASK)

    return run


def tell_counts(table: pa.Table) -> pa.Table:
    """Totals over all blocks for every question, a mark for the one block that owns a bigram, and counts of counts."""
    rows = []
    for kind in (1, 2):
        part = table.filter(pc.equal(table.column("kind"), kind)) if table.num_rows else table
        n = part.column("n").to_pylist()
        if not n:
            continue
        hashes = np.concatenate([unpack_sorted(raw, k) for raw, k in zip(part.column("hashes").to_pylist(), n)])
        counts = np.concatenate([unplanes(raw, k, "<i8") for raw, k in zip(part.column("counts").to_pylist(), n)])
        values, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        if kind == 1:
            needed = np.bincount(where, counts & 1, len(values)) > 0
            counts >>= 1
        total = np.bincount(where, counts, len(values)).astype(np.int64)
        if kind == 2:
            mark = np.zeros(len(hashes), bool)
            mark[first[total > 0]] = True
        else:
            mark = needed[where]
        own = total[values != START] if kind == 1 else total
        count_of = np.bincount(np.minimum(own, K + 2), minlength=K + 3)
        stats = [*count_of[1 : K + 2].tolist(), int(own.sum()), int(count_of[1:].sum())]
        ends = np.cumsum(n)
        for i, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            rows.append((part.column("block")[i].as_py(), part.column("bucket")[i].as_py(), kind, b - a, planes(total[where[a:b]]), np.packbits(mark[a:b]).tobytes(), stats if i == 0 else None))
    return table_of(rows, _TOLD)


def discounts(n: list[int]) -> list[float]:
    """Good-Turing discount ratios of counts 0 to ``K`` from counts of counts, n[0] = n_1 and so on.

    Where the counts of counts give no ratio between 0 and 1, half a count is taken off.
    """
    out = [0.0]
    tail = (K + 1) * n[K] / n[0] if n[0] else 0.0
    for r in range(1, K + 1):
        ratio = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 0.0
        d = (ratio - tail) / (1 - tail) if tail < 1 else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


def discounted(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return np.where(counts > K, counts - TRUST, np.asarray(d)[np.minimum(counts, K)] * counts)


@dataclass
class Model:
    """Discounts of words and bigrams, the number of training tokens, the vocabulary's size, P(unknown word)."""

    words: list[float]
    bigrams: list[float]
    tokens: int
    vocabulary: int
    unknown: float

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.words) / max(self.tokens, 1), self.unknown)


def model_of(told: DataFrame) -> Model:
    stats = told.filter(F.col("stats").isNotNull()).groupBy("kind").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(K + 3)])
    rows = {r["kind"]: [r[f"s{i}"] for i in range(K + 3)] for r in stats.collect()}
    one, two = rows.get(1, [0] * (K + 3)), rows.get(2, [0] * (K + 3))
    d = discounts(one[: K + 1])
    tokens, vocabulary = one[K + 1], one[K + 2]
    freed = sum(r * one[r - 1] * (1 - d[r]) for r in range(1, K + 1)) + TRUST * (vocabulary - sum(one[:K]))
    return Model(d, discounts(two[: K + 1]), tokens, vocabulary, freed / tokens if tokens else 1.0)


class Counts:
    """Answers for one block, in the order of its questions."""

    def __init__(self, t: Tokens, told: pa.Table):
        self.t = t
        self.words, self.first, self.second = t.distinct()
        self.pairs, self.pair_at = np.unique(bigram(self.words[self.first], t.words), return_inverse=True)
        parts = {1: {}, 2: {}}
        for bucket, kind, n, counts, marks in zip(*(told.column(c).to_pylist() for c in ("bucket", "kind", "n", "counts", "marks"))):
            parts[kind][bucket] = (unplanes(counts, n, "<i8"), np.unpackbits(np.frombuffer(marks, np.uint8), count=n).astype(bool))
        join = lambda kind, i: np.concatenate([parts[kind][b][i] for b in sorted(parts[kind])])
        self.word_counts, self.needed = join(1, 0), join(1, 1)
        self.pair_counts, self.owned = join(2, 0), join(2, 1)


def ask_weights(model: Model, buckets: int):
    """Sums of a block's own bigrams per context, and the contexts that it needs a weight for."""

    def run(key: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return table_of([], _ASK)
        c = Counts(tokens_of(texts), told)
        some = np.zeros(len(c.pairs), np.int64)
        some[c.pair_at] = np.arange(len(c.pair_at))  # a place of each bigram
        own = np.flatnonzero(c.owned & c.needed[c.first[some]])
        context, count = c.first[some[own]], c.pair_counts[own]
        freed = count - discounted(count, model.bigrams)
        seen = model.unigram(c.word_counts[c.second[some[own]]])
        freed = np.bincount(context, freed, len(c.words))
        seen = np.bincount(context, seen, len(c.words))
        want = np.zeros(len(c.words), bool)
        want[wanted(c)] = True
        at = np.flatnonzero((seen > 0) | want)
        rows = []
        for k, a, b in split(c.words[at], buckets):
            sums = np.concatenate([freed[at[a:b]], seen[at[a:b]]])
            rows.append((k, key[0].as_py(), 0, b - a, pack_sorted(c.words[at[a:b]]), planes(sums) + np.packbits(want[at[a:b]]).tobytes()))
        return table_of(rows, _ASK)

    return run


def wanted(c: Counts) -> np.ndarray:
    """Contexts (places in ``c.words``) whose unseen bigrams a text of the block holds."""
    unseen = (c.pair_counts[c.pair_at] == 0) & (c.word_counts[c.first] > 0)
    return np.unique(c.first[unseen])


_WEIGHTS = [("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("sums", pa.binary())]


def tell_weights(table: pa.Table) -> pa.Table:
    """Per block that wants them, the context's freed mass and seen unigram mass."""
    n = table.column("n").to_pylist()
    hashes = [unpack_sorted(raw, k) for raw, k in zip(table.column("hashes").to_pylist(), n)]
    sums, want = [], []
    for raw, k in zip(table.column("counts").to_pylist(), n):
        bits = (k + 7) // 8
        sums.append(unplanes(raw[:-bits], 2 * k, "<f8").reshape(2, k))
        want.append(np.unpackbits(np.frombuffer(raw[-bits:], np.uint8), count=k).astype(bool))
    values, where = np.unique(np.concatenate(hashes), return_inverse=True)
    total = [np.bincount(where, np.concatenate([s[i] for s in sums]), len(values)) for i in (0, 1)]
    rows, at = [], 0
    for i, k in enumerate(n):
        mine = where[at : at + k][want[i]]
        at += k
        if len(mine):
            both = np.concatenate([total[0][mine], total[1][mine]])
            rows.append((table.column("block")[i].as_py(), table.column("bucket")[i].as_py(), len(mine), planes(both)))
    return table_of(rows, _WEIGHTS)


_SCORES = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_block(model: Model):
    def run(key: tuple, texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return table_of([], _SCORES)
        t = tokens_of(texts)
        c = Counts(t, replies.filter(pc.is_valid(replies.column("kind"))))
        freed, seen = np.zeros(len(c.words)), np.zeros(len(c.words))
        weights = replies.filter(pc.is_null(replies.column("kind")))
        parts = {b: unplanes(raw, 2 * n, "<f8").reshape(2, n) for b, n, raw in zip(*(weights.column(x).to_pylist() for x in ("bucket", "n", "counts")))}
        if parts:
            at = wanted(c)
            both = np.concatenate([parts[b] for b in sorted(parts)], axis=1)
            freed[at], seen[at] = both[0], both[1]
        word, pair, context = c.word_counts[c.second], c.pair_counts[c.pair_at], c.word_counts[c.first]
        lower = model.unigram(word)
        total = np.maximum(context, 1)
        backoff = freed[c.first] / total / np.maximum(1 - seen[c.first], 1e-12)
        p = np.where(context == 0, lower, np.where(pair > 0, discounted(pair, model.bigrams) / total, backoff * lower))
        doc = np.repeat(np.arange(len(t.sizes)), t.sizes)
        score = np.bincount(doc, np.log10(np.maximum(p, 1e-300)), len(t.sizes))
        n, v = model.tokens, model.vocabulary
        base = np.log10((word + 0.1) / (n + 0.1 * (v + 1)))
        out = [
            t.doc_id, ~t.train, t.sizes, np.bincount(doc, word > 0, len(t.sizes)).astype(np.int64),
            np.full(len(t.sizes), n), np.bincount(doc, base, len(t.sizes)), score,
        ]
        return pa.table({name: pa.array(column, kind) for column, (name, kind) in zip(out, _SCORES)})

    return run


def score_texts(docs: DataFrame, modulus: int = 10, left_out: int = 0) -> DataFrame:
    """Log10 probability of every text under the model of the training texts.

    Trained on rows whose crc32(doc_id as text) mod ``modulus`` is not ``left_out``;
    rows without an id are never trained on and count as held out.  Letters A-Z are
    lowered, words are cut at white space, and the end of a text is a token, so null
    and empty texts have one token.  Repeated rows are texts of their own; other
    columns are not read; an empty table gives no rows.
    """
    size = docs.select(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 64).alias("n")).first()["n"] or 0
    # About a distinct bigram for every eight bytes.
    buckets = 1 + size // 8 // ENTRIES_PER_BUCKET
    texts = blocks_of(docs, size, modulus, left_out)
    asked = texts.groupBy("block").applyInArrow(ask_counts(buckets), ASK)
    told = write_table(asked.groupBy("bucket").applyInArrow(tell_counts, TOLD), "katz-counts")
    model = model_of(told)
    told = told.select("block", "bucket", "kind", "n", "counts", "marks")
    sums = texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(ask_weights(model, buckets), ASK)
    weights = sums.groupBy("bucket").applyInArrow(tell_weights, "block int, bucket int, n int, sums binary")
    weights = weights.select("block", "bucket", F.lit(None).cast("int").alias("kind"), "n", F.col("sums").alias("counts"), F.lit(None).cast("binary").alias("marks"))
    replies = told.unionByName(weights)
    return texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score_block(model), SCORES)
