"""Temperature mixing of sources.

The token shares p of the sources are raised to an exponent t between 0 (equal
weights) and 1 (weights as found).  Bisection finds the flattest mix that keeps to
a repetition limit, or the least flat one that reaches a target entropy.  The
weights are then realised exactly: each source gets whole passes over all its
documents and one part of a pass.  Every pass permutes hash blocks of documents
and the documents inside them; the part of a pass takes blocks in that order
until its token budget is used up, and documents of the last block likewise.

Built-in functions only.  Nothing is sorted over a whole source: budgets are cut
on at most ``blocks`` sums per source, then inside one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import text_or_empty, words
from .text import write_table

STEPS = 60
#: Tasks that share the rows of one source in a join; the other side has a row per source and salt.
SALTS = 64


def power_sum(shares: Column, t: Column) -> Column:
    return F.aggregate(shares, F.lit(0.0), lambda a, p: a + F.pow(p, t))


def entropy(shares: Column, t: Column) -> Column:
    """Entropy of the weights p^t / sum p^t."""
    logs = F.aggregate(shares, F.lit(0.0), lambda a, p: a + F.pow(p, t) * t * F.log(p))
    return F.log(power_sum(shares, t)) - logs / power_sum(shares, t)


def bisect(flat_enough, want_high: bool) -> Column:
    """The border of ``flat_enough`` on [0, 1], a condition that holds up to some t; or 1 if it holds there."""
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def step(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        holds = flat_enough(mid)
        return F.struct(F.when(holds, mid).otherwise(acc["lo"]).alias("lo"), F.when(holds, acc["hi"]).otherwise(mid).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda acc: acc["lo"] if want_high else acc["hi"])
    at_end = F.lit(1.0) if want_high else F.lit(0.0)
    return F.when(flat_enough(at_end) if want_high else ~flat_enough(at_end), at_end).otherwise(found)


def weights(sizes: DataFrame, max_repeat: float | None, entropy_share: float | None, budget: int | None) -> DataFrame:
    """Per source: tokens, share, exponent, weight, passes.  The list of sources is one row on its way."""
    totals = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    row = totals.agg(F.collect_list(F.struct("source", "tokens")).alias("all"), F.sum("tokens").alias("total"))
    row = row.withColumn("shares", F.transform(F.filter("all", lambda s: s["tokens"] > 0), lambda s: s["tokens"] / F.col("total")))
    shares = F.col("shares")
    if (max_repeat is None) == (entropy_share is None):
        raise ValueError("give either max_repeat or entropy_share")
    if max_repeat is not None:
        ratio = F.array_max("shares") / F.array_min("shares")
        t = bisect(lambda t: F.pow(ratio, 1 - t) > max_repeat, want_high=False)
    else:
        t = bisect(lambda t: entropy(shares, t) >= entropy_share * F.log(F.size(shares)), want_high=True)
    row = row.withColumn("t", t).withColumn("z", power_sum(shares, F.col("t"))).withColumn("most", F.array_max("shares"))
    out = row.select(F.explode("all").alias("s"), "total", "t", "z", "most")
    share = F.col("s.tokens") / F.col("total")
    some = F.col("s.tokens") > 0
    weight = F.when(some, F.pow(share, "t") / F.col("z")).otherwise(0.0)
    # Without a budget the largest source passes exactly once, and every other one at least once.
    passes = F.pow(share / F.col("most"), F.col("t") - 1) if budget is None else weight * budget / F.col("s.tokens")
    return out.select(
        F.col("s.source").alias("source"), F.col("s.tokens").alias("tokens"), F.when(some, share).otherwise(0.0).alias("share"),
        F.col("t").alias("exponent"), weight.alias("weight"), F.when(some, passes).otherwise(1.0).alias("passes"),
    )


def order(seed: int, epoch, *parts) -> Column:
    """A position in the permutation of one pass."""
    return F.xxhash64(F.lit(seed), F.lit(epoch) if isinstance(epoch, int) else epoch, *parts)


def mix(
    docs: DataFrame,
    max_repeat: float | None = 2.0,
    entropy_share: float | None = None,
    budget: int | None = None,
    blocks: int = 65536,
    seed: int = 7,
) -> DataFrame:
    """The mix as rows (``row``: the document as a struct, ``n_tokens``, ``epoch``, ``block``, ``block_order``, ``doc_order``).

    A document of a source with 1.6 passes comes once or twice.  Training order
    within a pass is (epoch, block_order, doc_order).  ``budget`` is in tokens
    (words); without it no source gets less than one pass, so every document
    stays.  A part of a pass may fall short of its budget by less than one
    document; equal rows share a position and go together.

    Null sources are a source of their own; null and empty texts have no tokens;
    a source without any token passes once; an empty table gives an empty mix.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    id_hash = F.xxhash64(F.lit(seed), F.col("doc_id"), F.length(text_or_empty()))
    tagged = docs.select(
        row.alias("row"), F.col("source").alias("source"), F.size(words(text_or_empty())).cast("long").alias("n_tokens"),
        F.pmod(id_hash, F.lit(blocks)).cast("int").alias("block"), id_hash.alias("key"),
    )
    sizes = write_table(tagged.select("source", "n_tokens", "block", "key"), "mixing")
    plan = weights(sizes, max_repeat, entropy_share, budget)
    # The last 1e-9 of a pass is rounding.
    plan = plan.withColumn("whole", F.floor(F.col("passes") + 1e-9).cast("int"))
    plan = plan.withColumn("rest", F.greatest(F.lit(0.0), (F.col("passes") - F.col("whole")) * F.col("tokens")))
    plan = write_table(plan, "mixing-plan")

    sums = sizes.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    sums = joined(sums, plan.select("source", "whole", "rest")).withColumn("at", order(seed, F.col("whole"), "block"))
    by_source = Window.partitionBy("source").orderBy("at", "block").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("sum", F.sum("tokens").over(by_source)).withColumn("before", F.col("sum") - F.col("tokens"))
    # The block in which the budget ends, and what is left for it.
    last = (
        sums.filter((F.col("before") <= F.col("rest")) & (F.col("sum") > F.col("rest")))
        .groupBy("source")
        .agg(F.min_by(F.struct("at", "block", (F.col("rest") - F.col("before")).alias("left"), "whole"), "before").alias("cut"))
        .select("source", "cut.*")
    )
    inside = joined(sizes, last.withColumnRenamed("block", "_block"), salts=SALTS).filter(F.col("block") == F.col("_block"))
    inside = inside.withColumn("doc_at", order(seed, F.col("whole"), "key"))
    by_doc = Window.partitionBy("source").orderBy("doc_at").rangeBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("sum", F.sum("n_tokens").over(by_doc)).filter(F.col("sum") <= F.col("left"))
    ends = inside.groupBy("source").agg(F.max("doc_at").alias("doc_cut"))
    cuts = joined(last.select("source", F.col("at").alias("block_cut"), F.col("block").alias("cut_block")), ends, "left")
    full = joined(plan.select("source", "whole", "rest"), cuts, "left")

    block_at, doc_at = order(seed, F.col("whole"), "block"), order(seed, F.col("whole"), "key")
    in_part = (F.col("rest") > 0) & (
        F.col("block_cut").isNull()
        | (block_at < F.col("block_cut"))
        | ((block_at == F.col("block_cut")) & (F.col("block") < F.col("cut_block")))
        | ((F.col("block") == F.col("cut_block")) & F.coalesce(doc_at <= F.col("doc_cut"), F.lit(False)))
    )
    copies = F.col("whole") + F.when(in_part, 1).otherwise(0)
    mixed = joined(tagged, full, salts=SALTS).withColumn("copies", copies).filter(F.col("copies") > 0)
    mixed = mixed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return mixed.select(
        "row", "n_tokens", "epoch", "block", order(seed, F.col("epoch"), "block").alias("block_order"),
        order(seed, F.col("epoch"), "key").alias("doc_order"),
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The documents of a mix in training order: sorted over all partitions by (epoch, block_order, doc_order)."""
    place = ["epoch", "block_order", "doc_order"]
    return mixed.repartitionByRange(*place).sortWithinPartitions(*place).select("row.*")


def joined(left: DataFrame, right: DataFrame, how: str = "inner", salts: int = 1) -> DataFrame:
    """A join on the source in which null equals null; ``salts`` deals the rows of one source to so many tasks by their block."""
    right = right.withColumnRenamed("source", "_source")
    on = left["source"].eqNullSafe(right["_source"])
    if salts > 1:
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (left["block"] % salts == right["_salt"])
    return left.join(right, on, how).drop("_source", "_salt")
