"""Toxicity as a weighted finite-state grammar over clauses.

Words become symbols: insults (a lexicon of words and word stems learned from
labelled rows, each with its log-odds), threats, intentions, targets, negators
and verbs of reported speech.  A cascade of sequential transducers reads the
symbols of a clause, each rewriting symbols and weights for the next:

    reported speech -> negation -> threat -> target -> insult

and the clause's score is the weight that the cascade ends with.  A document is
scored from its clauses (best clause, and all of them together) by a logistic
curve fitted on the labelled rows.  Words alone never score: a negated or
reported insult weighs less, one aimed at somebody more.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import training_row, write_table

# Closed word classes of English, French, German and Spanish.
TARGETS = frozenset("you your yours yourself u ur tu te toi vous votre du dich dir ihr euch tú ti usted ustedes vosotros he she they them him her".split())
NEGATORS = frozenset("not never no nobody isn't aren't wasn't don't doesn't didn't won't can't pas jamais nicht kein keine nie nunca jamás".split())
REPORTS = frozenset("said says told wrote writes quoted claimed called reported dit écrit déclaré sagte schrieb behauptete dijo escribió".split())
INTENTS = frozenset("will gonna shall going must vais va werde wird voy".split())
THREATS = frozenset("kill hurt destroy murder stab shoot strangle tuer frapper töten schlagen umbringen matar golpear".split())

STEM_LENGTHS = (3, 4, 5, 6, 7)
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")


@dataclass
class Symbol:
    """A word's class and the weight it carries through the cascade."""

    kind: str
    weight: float = 0.0


#: A sequential transducer: state, symbol -> state, symbol. The start state is 0.
Step = Callable[[int, Symbol], tuple[int, Symbol]]


def reported(state: int, s: Symbol) -> tuple[int, Symbol]:
    """After a verb of saying, insults and threats of the clause are somebody else's: half weight."""
    if s.kind == "report":
        return 1, s
    return state, Symbol(s.kind, s.weight / 2) if state and s.weight else s


def negation(state: int, s: Symbol) -> tuple[int, Symbol]:
    """A negator weakens the three words after it to a quarter."""
    if s.kind == "negator":
        return 3, s
    return max(state - 1, 0), Symbol(s.kind, s.weight / 4) if state and s.weight else s


def threat(state: int, s: Symbol) -> tuple[int, Symbol]:
    """intent .. threat .. target within three words each becomes one weighted threat; a bare verb weighs nothing."""
    if s.kind == "intent":
        return 3, s
    if s.kind == "threat" and 0 < state <= 3:
        return 10 + 3, Symbol("threat", 0.0)
    if s.kind == "target" and state > 10:
        return 0, Symbol("menace", THREAT_WEIGHT)
    if state > 10:
        return (state - 1 if state > 11 else 0), s
    return max(state - 1, 0), s


def target(state: int, s: Symbol) -> tuple[int, Symbol]:
    """An insult within four words after a target counts half more."""
    if s.kind == "target":
        return 4, s
    return max(state - 1, 0), Symbol(s.kind, s.weight * 1.5) if state and s.kind == "insult" else s


#: Weight of "intent threat target", about that of a certain insult.
THREAT_WEIGHT = 6.0
CASCADE: tuple[Step, ...] = (reported, negation, threat, target)


def clause_score(symbols: list[Symbol], cascade: tuple[Step, ...] = CASCADE) -> float:
    """Total weight of insults and menaces after the composed transducers, read in one pass."""
    states, total = [0] * len(cascade), 0.0
    for s in symbols:
        for i, step in enumerate(cascade):
            states[i], s = step(states[i], s)
        if s.kind in ("insult", "menace"):
            total += s.weight
    return total


@dataclass
class Grammar:
    """A learned lexicon and the curve from clause scores to a probability."""

    words: dict[str, float]
    stems: dict[str, float]
    curve: list[float] = field(default_factory=lambda: [-4.0, 0.0, 1.0, 0.0])

    def automaton(self):
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for entry in {*self.words, *self.stems, *THREATS}:
            found.add_word(entry, len(entry))
        if len(found):
            found.make_automaton()
        return found if len(found) else None

    def weight(self, word: str) -> float:
        return max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEM_LENGTHS if n <= len(word))])

    def symbol(self, word: str) -> Symbol:
        if w := self.weight(word):
            return Symbol("insult", w)
        for kind, members in (("target", TARGETS), ("negator", NEGATORS), ("threat", THREATS), ("report", REPORTS), ("intent", INTENTS)):
            if word in members:
                return Symbol(kind)
        return Symbol("other")

    def measure(self, text: str, automaton) -> tuple[float, float]:
        """(best clause, sum over clauses) of one text; clauses without an entry of the lexicon are passed over."""
        best = total = 0.0
        if automaton is None:
            return best, total
        low, done = text.lower(), -1
        for last, length in automaton.iter(low):
            start = last - length + 1
            if start < done or (start and low[start - 1].isalnum()):
                continue
            ends = _CLAUSE_END.search(low, last + 1)
            done = ends.end() if ends else len(low)
            begin = 1 + max(low.rfind(c, 0, start) for c in ".!?;:\n")
            score = clause_score([self.symbol(w.replace("’", "'")) for w in _WORD.findall(low, begin, done)])
            best, total = max(best, score), total + score
        return best, total

    def probability(self, best, total):
        return 1 / (1 + np.exp(-features(np.array([[best, total]])) @ self.curve))[0]


def training_rows(docs: DataFrame, labels: DataFrame, modulus: int, left_out: int, max_rows: int) -> DataFrame:
    """Texts and labels of at most ``max_rows`` labelled documents, the first by a hash of the id."""
    few = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & training_row(F.col("doc_id"), modulus, left_out))
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # Bounded: max_rows rows of 12 bytes.
    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    return write_table(picked.select("text", "toxic"), "toxicity-training")


def learn_lexicon(train: DataFrame, max_entries: int, error: float) -> Grammar:
    """Words and stems that occur in toxic texts beyond chance.

    An entry needs odds of 20 to 1 and a G-test that holds after Bonferroni's
    correction for the number of entries tried; its weight is its log-odds.
    """
    words = (
        train.select("toxic", F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}']+")).alias("words"))
        # Texts of the same words count once, before the words become rows; texts that share some of them each count.
        .select("toxic", F.xxhash64(F.array_sort("words")).alias("text"), "words")
        .dropDuplicates(["toxic", "text"])
        .select("toxic", F.explode("words").alias("word"))
        .filter(F.length("word") >= 3)
        .groupBy("word")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    )
    words = write_table(words, "toxicity-words")
    sums = words.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("n")).first()
    if not sums["a"] or not sums["b"]:
        return Grammar({}, {})
    stems = words.select(
        F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_LENGTHS])).alias("entry"), "a", "b"
    ).filter("entry IS NOT NULL")
    stems = stems.groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("stem", F.lit(True))
    entries = words.select(F.col("word").alias("entry"), "a", "b", F.lit(False).alias("stem")).unionByName(stems)
    share = sums["a"] / (sums["a"] + sums["b"])
    n = F.col("a") + F.col("b")
    part = lambda x, p: F.when(x > 0, x * F.log(x / (n * p))).otherwise(0.0)
    lod = F.log((F.col("a") + 0.5) / sums["a"]) - F.log((F.col("b") + 0.5) / sums["b"])
    limit = 2 * math.log(sums["n"] * (1 + len(STEM_LENGTHS)) / error)
    best = (
        entries.withColumn("g", 2 * (part(F.col("a"), share) + part(F.col("b"), 1 - share)))
        .withColumn("w", lod)
        .filter((F.col("w") > math.log(20)) & (F.col("g") > limit))
        .orderBy(F.desc("g"), "entry", "stem")
        .limit(max_entries)
        .select("entry", "stem", F.least("w", F.lit(8.0)).alias("w"))
        .collect()
    )
    return Grammar({r["entry"]: r["w"] for r in best if not r["stem"]}, {r["entry"]: r["w"] for r in best if r["stem"]})


def features(x: np.ndarray) -> np.ndarray:
    """(1, best, log1p(best), log1p(sum)) of rows (best, sum)."""
    return np.column_stack([np.ones(len(x)), x[:, 0], np.log1p(x)])


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> list[float]:
    """Logistic regression on ``features`` by Newton steps."""
    z = features(x)
    penalty = ridge * np.diag([0.0, 1.0, 1.0, 1.0])
    beta = np.zeros(4)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hessian = z.T @ (z * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(4)
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def measured(texts: DataFrame, grammar: Grammar, keep: str, schema: str) -> DataFrame:
    """Column ``keep`` with (best, total) of column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = grammar.automaton()
        for batch in batches:
            pairs = [grammar.measure(t.as_py() or "", automaton) for t in batch.column(1)]
            best, total = ([p[i] for p in pairs] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.float64()), pa.array(total, pa.float64())], names=[keep, "best", "total"]
            )

    return texts.select(keep, "text").mapInArrow(run, schema)


def train_grammar(
    docs: DataFrame, labels: DataFrame, modulus: int = 3, left_out: int = 1,
    max_rows: int = 20_000, max_entries: int = 5_000, error: float = 0.01,
) -> Grammar:
    """Lexicon and curve from labelled rows whose crc32(doc_id) mod ``modulus`` is not ``left_out``.

    ``max_rows`` bounds the labelled sample; its (best, total, label) triples, and
    at most ``max_entries`` lexicon entries, are what reaches the driver.
    """
    train = training_rows(docs, labels, modulus, left_out, max_rows)
    grammar = learn_lexicon(train, max_entries, error)
    rows = measured(train, grammar, "toxic", "toxic int, best double, total double").toPandas()
    if len(rows) and 0 < rows["toxic"].mean() < 1:
        grammar.curve = fit_curve(rows[["best", "total"]].to_numpy(), rows["toxic"].to_numpy(float))
    return grammar


def score(docs: DataFrame, grammar: Grammar, modulus: int = 3, left_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted, best_clause`` for every document.

    Null and empty texts have no clause and get the score of that; null ids are
    not held out.  Repeated rows are scored each, other columns are not read, an
    empty table gives no rows.  Map-only.
    """
    a, b, c, d = grammar.curve
    x = a + b * F.col("best") + c * F.log1p("best") + d * F.log1p("total")
    rows = measured(docs, grammar, "doc_id", "doc_id long, best double, total double")
    rows = rows.withColumn("score", 1 / (1 + F.exp(-x)))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == left_out, F.lit(False))
    return rows.select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), F.col("best").alias("best_clause"),
    )


def drop_toxic(docs: DataFrame, grammar: Grammar, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more; all columns stay."""
    fields = [f for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = grammar.automaton()
        at = [f.name for f in fields].index("text")
        for batch in batches:
            keep = [grammar.probability(*grammar.measure(t.as_py() or "", automaton)) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
