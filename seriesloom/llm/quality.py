"""Quality rules with thresholds learned per language and source from mergeable quantile sketches.

Every text is measured once by built-in functions.  KLL sketches of four ratios
are built per (lang, source): partial sketches merge on the way, so a source
with a third of all rows costs one sketch per task.  Sketches of a language are
the merged sketches of its sources; they serve groups too small for quantiles of
their own.  A document passes if every ratio stays inside its group's fences:
quartiles widened by a multiple of their distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import text_or_empty, trimmed, words, without
from .text import write_table

SYMBOLS = "#*$%&|<>"
#: Ratio, and the least distance between quartiles that counts, so that constant groups keep a margin.
RATIOS = {"symbol_ratio": 0.02, "word_length": 0.5, "dup_line_ratio": 0.1, "repeat_ratio": 0.1}


def windows_of(w: Column) -> Column:
    """One hash for each 3-word window of the array ``w``."""
    starts = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))


def ordered(windows: Column) -> Column:
    """Windows by hash with their places; null, and nothing sorted, for texts that repeat none."""
    marks = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(marks))


def repeated_words(ordered: Column) -> Column:
    """Words inside windows that occur twice or more: a window counts if the one before or after it has its hash."""
    twice = F.filter(ordered, lambda m, i: (m["h"] == F.get(ordered, i + 1)["h"]) | (m["h"] == F.get(ordered, i - 1)["h"]))
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda m: m["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return F.when(ordered.isNull(), F.lit(0).cast("long")).otherwise(covered)


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """Counts per document: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    What a lambda reads again and again is a column of a step before: inside an
    expression, Spark would compute it anew at every use.
    """
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: trimmed(x) != "")
    return (
        docs.select("doc_id", *keep, text_or_empty().alias("_text"))
        .withColumns({"_words": words(text), "_lines": lines})
        .withColumn("_windows", windows_of(F.col("_words")))
        .withColumn("_ordered", ordered(F.col("_windows")))
        .select(
            "doc_id",
            *keep,
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("_ordered")).alias("n_repeat_words"),
        )
    )


def with_ratios(stats: DataFrame) -> DataFrame:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return stats.withColumns(
        {
            "symbol_ratio": per("n_symbols", "word_chars"),
            "word_length": per("word_chars", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"),
            "repeat_ratio": per("n_repeat_words", "n_words"),
        }
    )


def thresholds(rows: DataFrame, spread: float, min_rows: int, sketch_k: int) -> DataFrame:
    """One row per (lang, source) with ``lo_*`` and ``hi_*`` of every ratio."""
    sketches = rows.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(r, F.lit(sketch_k)).alias(r) for r in RATIOS]
    )
    merged = sketches.groupBy("lang").agg(*[F.kll_merge_agg_double(r, F.lit(sketch_k)).alias(f"all_{r}") for r in RATIOS])
    both = sketches.join(merged, sketches["lang"].eqNullSafe(merged["lang"])).drop(merged["lang"])
    out = []
    for ratio, least in RATIOS.items():
        sketch = F.when(F.col("n") >= min_rows, F.col(ratio)).otherwise(F.col(f"all_{ratio}"))
        q = lambda p, s=sketch: F.kll_sketch_get_quantile_double(s, F.lit(p))
        reach = F.greatest(q(0.75) - q(0.25), F.lit(least)) * spread
        out += [(q(0.25) - reach).alias(f"lo_{ratio}"), (q(0.75) + reach).alias(f"hi_{ratio}")]
    return both.select("lang", "source", *out)


def quality_rules(docs: DataFrame, spread: float = 4.0, min_rows: int = 100, sketch_k: int = 200) -> DataFrame:
    """Base counts and a verdict for each document.

    ``kept`` is false where the base rule fails (under 50 words, or more than half
    of the words in repeated 3-word windows) or a ratio leaves the fences of the
    document's (lang, source).  Null and empty texts have zero counts and fail the
    base rule.  Null languages and sources are groups of their own.  Repeated rows
    are measured each; other columns are ignored; an empty table gives no rows.
    Sketches are approximate (rank error about 1.3 % at ``sketch_k`` 200) and
    compact at random, so a document within that error of a fence may change side.
    """
    stats = write_table(measure(docs, "lang", "source"), "quality")
    rows = with_ratios(stats)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", base_failed)
    # Documents that fail the base rule say nothing about what is usual in their source.
    limits = thresholds(rows.filter(~F.col("base_failed")), spread, min_rows, sketch_k).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    inside = F.lit(True)
    for ratio in RATIOS:
        inside = inside & F.col(ratio).between(F.col(f"lo_{ratio}"), F.col(f"hi_{ratio}"))
    joined = rows.join(limits, rows["lang"].eqNullSafe(limits["_lang"]) & rows["source"].eqNullSafe(limits["_source"]), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
