"""Secrets in texts: fixed patterns, and strings whose symbols pass a battery of randomness tests.

A candidate is a run of 20 or more letters, digits and + / - _, and every part of
20 or more between such signs, so that a key in a path is tested by itself.  Its
encoding (hex, base32, base36, letters, letters and digits, base64 or its URL form) is the
smallest that has all symbols that occur.
Letters of one case alone are a word, not a candidate: of random strings of 32 small
letters and digits, 0.003 in 100 have no digit.
Against the hypothesis "uniform and independent symbols of that alphabet" four
tests run: chi-squared on the counts of symbols, and on those of their classes
(digits, vowels and consonants of either case, signs), where words and identifiers
differ most; Wald-Wolfowitz runs around the alphabet's middle; and lag-1 serial
correlation.  Their Bonferroni-combined p-value goes into Benjamini-Hochberg control, one family per length class, as short strings can
reject less: a candidate that is rejected there is text, the others are secrets.
So at most a share ``q`` of the strings waved through as text is expected to be
random.  Only built-in functions; the step-up cut comes from a histogram of
p-values, four numbers that reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import text_or_empty
from .text import write_table

#: Kind, pattern, group whose length counts and its least length; in the order of equal starts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = {"assign": (ASSIGN, 2, 12), "access": (r"AKIA[A-Z0-9]+", 0, 18), "hex": (r"[0-9a-f]{16,}", 0, 16)}
#: Fixed alphabets of the encodings, symbols in order of value.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base52": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Fixed classes of symbols.
CLASSES = ("0123456789", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "aeiou", "bcdfghjklmnpqrstvwxyz", "+/-_")
#: Runs of symbols, whole and between the signs of either base64; the lookbehind starts a match at the start of a run only.
CANDIDATES = tuple(rf"(?<![A-Za-z0-9{signs}])[A-Za-z0-9{signs}]{{20,}}={{0,2}}" for signs in ("+/_-", "+/", "_-", ""))
#: Lower ends of the length classes.
LENGTHS = (20, 32, 48, 96)
SPAN = "array<struct<start:int,end:int,size:int,body:string>>"


def found(text: Column, pattern: str, group: int) -> Column:
    """Matches, leftmost first: start, end (code points), length of the group, and the match itself."""
    p = F.lit(pattern)
    pairs = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(F.regexp_extract_all(text, p, F.lit(0)))).alias("gap"),
        F.regexp_extract_all(text, p, F.lit(0)).alias("body"),
        F.regexp_extract_all(text, p, F.lit(group)).alias("part"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + F.length(m["gap"])
        end = begin + F.length(m["body"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.length(m["part"]).alias("size"), m["body"].alias("body"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def normal_tail(z: Column) -> Column:
    """P(Z > z) for z of either sign: the rational approximation 26.2.17 of Abramowitz and Stegun."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def battery(body: Column) -> Column:
    """Combined p-value of the four tests; null where no encoding has all symbols of the string."""
    symbols = F.regexp_replace(body, "=+$", "")
    # Upper-case keys come in groups; the signs between them are no symbols.
    symbols = F.when(symbols.rlike("^[A-Z0-9_-]+$"), F.regexp_replace(symbols, "[_-]", "")).otherwise(symbols)
    only = lambda name: symbols.rlike("^[" + ALPHABETS[name].replace("-", r"\-") + "]+$")
    alphabet = F.coalesce(*(F.when(only(name), ALPHABETS[name]) for name in ALPHABETS))

    def test(s: Column) -> Column:
        """``s``: struct of the symbols and their alphabet."""
        n, k = F.length(s["symbols"]).cast("double"), F.length(s["alphabet"]).cast("double")
        counts = F.transform(F.split(s["alphabet"], ""), lambda c: n - F.length(F.replace(s["symbols"], c, F.lit(""))))
        squares = F.aggregate(F.filter(counts, lambda c: c > 0), F.lit(0.0), lambda a, c: a + c * c)
        values = F.transform(F.split(s["symbols"], ""), lambda c: F.instr(s["alphabet"], c) - 1)
        zero = F.lit(0.0)
        acc0 = F.struct(
            zero.alias("sum"), zero.alias("squares"), zero.alias("products"), zero.alias("high"), zero.alias("runs"),
            F.lit(-1.0).alias("first"), F.lit(-1.0).alias("last"),
        )

        def step(a: Column, v: Column) -> Column:
            v = v.cast("double")
            fresh = a["last"] < 0
            turn = fresh | ((v >= k / 2) != (a["last"] >= k / 2))
            return F.struct(
                (a["sum"] + v).alias("sum"),
                (a["squares"] + v * v).alias("squares"),
                (a["products"] + F.when(fresh, zero).otherwise(a["last"] * v)).alias("products"),
                (a["high"] + F.when(v >= k / 2, 1.0).otherwise(0.0)).alias("high"),
                (a["runs"] + F.when(turn, 1.0).otherwise(0.0)).alias("runs"),
                F.when(fresh, v).otherwise(a["first"]).alias("first"),
                v.alias("last"),
            )

        def finish(a: Column) -> Column:
            chi = k / n * squares - n
            spread = F.lit(2.0) / (9 * (k - 1))
            z_chi = (F.cbrt(chi / (k - 1)) - (1 - spread)) / F.sqrt(spread)
            high, low = a["high"], n - a["high"]
            both = 2 * high * low
            expected, variance = both / n + 1, both * (both - n) / (n * n * (n - 1))
            z_runs = F.when(variance > 0, (a["runs"] - expected) / F.sqrt(variance)).otherwise(F.lit(9.0))
            mean = a["sum"] / n
            total = a["squares"] - n * mean * mean
            lagged = a["products"] - mean * (2 * a["sum"] - a["first"] - a["last"]) + (n - 1) * mean * mean
            z_serial = F.when(total > 0, (lagged / total + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
            off, classes = zero, zero
            for members in CLASSES:
                seen, expected_here = (F.length(x) - F.length(F.translate(x, members, "")) for x in (s["symbols"], s["alphabet"]))
                expected_here = expected_here * n / k
                off += F.when(expected_here > 0, (seen - expected_here) * (seen - expected_here) / expected_here).otherwise(0.0)
                classes += F.when(expected_here > 0, 1.0).otherwise(0.0)
            free = F.lit(2.0) / (9 * (classes - 1))
            z_classes = (F.cbrt(off / (classes - 1)) - (1 - free)) / F.sqrt(free)
            p = F.least(normal_tail(z_chi), normal_tail(z_classes), *(2 * normal_tail(F.abs(z)) for z in (z_runs, z_serial)))
            return F.least(F.lit(1.0), F.greatest(F.lit(1e-18), 4 * p))

        return F.aggregate(values, acc0, step, finish)

    known = F.filter(F.array(F.struct(symbols.alias("symbols"), alphabet.alias("alphabet"))), lambda s: s["alphabet"].isNotNull() & (F.length(s["symbols"]) > 1))
    one = F.transform(known, test)
    return F.get(one, F.lit(0))


def candidates(text: Column) -> Column:
    """Runs and parts of runs with the battery's p-value; those of no encoding are left out."""
    runs = F.when(text.rlike(CANDIDATES[0]), F.array_distinct(F.concat(*(found(text, c, 0) for c in CANDIDATES)))).otherwise(F.array().cast(SPAN))
    runs = F.filter(runs, lambda m: m["body"].rlike("[0-9]|[a-z].*[A-Z]|[A-Z].*[a-z]"))
    tests = F.transform(runs, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["size"].alias("size"), battery(m["body"]).alias("p")))
    return F.filter(tests, lambda t: t["p"].isNotNull())


def length_class(size: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(LENGTHS):
        out = F.when(size >= least, i).otherwise(out)
    return out


def step_up(tests: DataFrame, q: float, bins: int = 40) -> dict[int, float]:
    """Benjamini-Hochberg cut per length class from a histogram of -log10 p, ``bins`` to a power of ten.

    Every p-value counts as the upper end of its bin, which can only make the cut
    stricter.  At most one row per class reaches the driver.
    """
    level = F.least(F.floor(-F.log10("p") * bins), F.lit(18 * bins)).cast("int")
    counts = tests.groupBy("family", level.alias("level")).agg(F.count("*").alias("n"))
    rows = (
        counts.join(counts.groupBy("family").agg(F.sum("n").alias("m")), "family")
        .join(counts.select("family", F.col("level").alias("_level"), F.col("n").alias("_n")), "family")
        .filter(F.col("_level") >= F.col("level"))
        .groupBy("family", "level", "m")
        .agg(F.sum("_n").alias("rank"))
        .withColumn("upper", F.pow(F.lit(10.0), -F.col("level") / bins))
        .filter(F.col("upper") <= q * F.col("rank") / F.col("m"))
        .groupBy("family")
        .agg(F.max("upper").alias("cut"))
    )
    return {r["family"]: r["cut"] for r in rows.collect()}


def scan(docs: DataFrame, q: float = 0.01, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Spans of every text: ``row``, a struct of the columns ``keep``, and two arrays of (start, end, rank, kind).

    Ends are exclusive, positions count code points.  ``base`` holds the spans of
    the fixed patterns, ``found`` also the random strings that touch none of them.
    """
    text = F.col("text")
    base = [matches(text, kind, rank) for rank, kind in enumerate(KINDS)]
    rows = write_table(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text_or_empty().alias("text")).select(
            "row", F.sort_array(F.concat(*base)).alias("base"), candidates(text).alias("tests")
        ),
        "secrets",
    )
    tests = rows.select(F.explode("tests").alias("t")).select(length_class(F.col("t.size")).alias("family"), F.col("t.p").alias("p"))
    cuts = step_up(tests, q)

    def kept(t: Column) -> Column:
        limit = F.lit(-1.0)
        for family, value in cuts.items():
            limit = F.when(length_class(t["size"]) == family, F.lit(value)).otherwise(limit)
        apart = ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        return (t["p"] > limit) & apart

    # A part of a run that is kept as a whole goes with it.
    inside = lambda t: F.exists("kept", lambda o: (o["start"] <= t["start"]) & (o["end"] >= t["end"]) & (o["end"] - o["start"] > t["end"] - t["start"]))
    extra = F.transform(F.filter("kept", lambda t: ~inside(t)), lambda t: span(t, len(KINDS), "random"))
    return rows.withColumn("kept", F.filter("tests", kept)).select("row", "base", F.sort_array(F.concat("base", extra)).alias("found"))


def matches(text: Column, kind: str, rank: int) -> Column:
    pattern, group, least = KINDS[kind]
    good = F.filter(found(text, pattern, group), lambda m: m["size"] >= least)
    return F.transform(good, lambda m: span(m, rank, kind))


def span(m: Column, rank: int, kind: str) -> Column:
    return F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, q: float = 0.01) -> DataFrame:
    """Counts and spans per document.

    Null and empty texts have no spans.  Repeated rows are scanned each, other
    columns are not read, an empty table gives no rows.  The work of one text is
    linear but for the lists of its own matches.
    """
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs, q).select(
        F.col("row.doc_id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[secret]", q: float = 0.01) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; all rows and columns stay, null texts too."""
    rows = scan(docs, q, keep=tuple(docs.columns))
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate("found", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return rows.withColumn("row", F.col("row").withField("text", F.when(F.size("found") > 0, clean).otherwise(text))).select("row.*")
