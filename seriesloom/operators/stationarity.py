"""Augmented Dickey-Fuller test per series."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_DAYS, Family, attach, over_blocks
from .grid import date_bounds
from .moments import Moments, merge_two, partial_moments, solve_groups
from .windows import lag

# Critical values for the regression with constant, as
# polynomials in 1/T (MacKinnon 2010).
CRITICAL = {
    "crit_1pct": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5pct": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10pct": (-2.56677, -1.5384, -2.809, 0.0),
}
# P-value polynomials (MacKinnon 1994) below and above TAU_STAR.
TAU_STAR, TAU_MIN, TAU_MAX = -1.61, -18.83, 2.74
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def p_value(tau: float) -> float:
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    c = P_SMALL if tau <= TAU_STAR else P_LARGE
    z = sum(a * tau**i for i, a in enumerate(c))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def max_lag_of(days: int) -> int:
    """Default lag bound for a series of ``days`` values."""
    return min(days // 2 - 2, math.ceil(12 * (days / 100) ** 0.25))


def _regress(m: Moments, lags: int) -> tuple[float, float, int]:
    """Statistic of the level, residual sum of squares, rows.

    Columns: level, lagged differences 1..K, difference (the target).
    """
    n, _, co = m
    use = list(range(lags + 1))
    xx, xy = co[np.ix_(use, use)], co[use, -1]
    b = np.linalg.lstsq(xx, xy, rcond=None)[0]
    sse = max(co[-1, -1] - b @ xy, 0.0)
    free = n - len(use) - 1
    var = sse / free * np.linalg.pinv(xx)[0, 0] if free > 0 else math.nan
    return b[0] / math.sqrt(var) if var > 0 else math.nan, sse, n


#: Lagged differences kept per row: the default bound of a series of 100,000 days.
MOST_LAGS = max_lag_of(100_000)


def adf_test(grid: DataFrame, keys: Sequence[str], lags: int | None = None, size: int = BLOCK_DAYS) -> DataFrame:
    """Statistic, p-value, lags and critical values per series; constant series give nulls.

    The number of lagged differences is chosen by AIC over one common sample
    (``lags`` fixes it), and the chosen regression is refitted on all rows it can
    use.  Both come from the same cross-products: the refit adds the few rows at
    the start of the series that the common sample left out.  Each row carries its
    lagged differences as an array as long as the bound of its series, at most
    ``MOST_LAGS``, so nothing has to be known before the job starts.
    """
    if lags is not None and not 0 <= lags <= MOST_LAGS:
        raise ValueError(f"lags must lie between 0 and {MOST_LAGS}")
    filled = grid.where(F.col("y").isNotNull()).select(*keys, "ds", "y")
    reach = MOST_LAGS if lags is None else lags
    past: dict = {"past": lambda w: F.reverse(F.collect_list("d0").over(w.rowsBetween(-max(reach, 1), -1)))}
    steps = Family(({"level": lag("y", 1)}, {"d0": "y - level"}, past), before=reach + 2)
    facts = date_bounds(filled, keys).withColumns(
        {"_start": F.col("lo"), "_n": F.datediff("hi", "lo") + 1}
    )
    n = F.col("_n")
    lag_bound = F.least(
        F.floor(n / F.lit(2)).cast("int") - 2,
        F.ceil(12 * F.pow(n / F.lit(100), F.lit(0.25))).cast("int") if lags is None else F.lit(lags),
        F.lit(reach),
    )
    rows = (
        attach(over_blocks(filled, keys, steps, size=size), facts, keys, size)
        .withColumns({"_pos": F.datediff("ds", "_start"), "_max": lag_bound})
        .where("_max >= 0 and level is not null")
    )
    # Differences before the start of the series count as zero; only early rows have such.
    seen = F.slice("past", F.lit(1), F.col("_max"))
    x = F.concat(F.array("level"), seen, F.array_repeat(F.lit(0.0), F.col("_max") - F.size(seen)), F.array("d0"))
    # Rows before the common sample stand alone, under their position.
    place = F.when(F.col("_pos") > F.col("_max"), F.lit(-1)).otherwise(F.col("_pos"))
    moments = partial_moments(rows.withColumn("_row", place), [*keys, "_max", "_row"], x)

    def solve(_, groups: dict) -> dict[str, list] | None:
        bound = max(g[0] for g in groups)
        sample = groups.get((bound, -1))
        nothing = {"statistic": [None], "p_value": [None], "lags": [None], "rows": [None],
                   **{c: [None] for c in CRITICAL}, "stationary": [None]}
        if sample is None or sample[2][0, 0] <= 0:
            return nothing
        best = None
        for k in range(bound + 1) if lags is None else (bound,):
            _, sse, rows_used = _regress(sample, k)
            if sse <= 0:
                return nothing
            aic = rows_used * math.log(sse / rows_used) + 2 * (k + 2)
            if best is None or aic < best[0]:
                best = (aic, k)
        chosen = best[1]
        refit = sample
        for (_, at), m in groups.items():
            # The row at position p has p - 1 lagged differences before it.
            if at > chosen:
                refit = merge_two(refit, m)
        tau, _, rows_used = _regress(refit, chosen)
        if math.isnan(tau):
            return nothing
        p = p_value(tau)
        crit = {
            name: [sum(c / rows_used**i for i, c in enumerate(poly))]
            for name, poly in CRITICAL.items()
        }
        return {"statistic": [tau], "p_value": [p], "lags": [chosen], "rows": [rows_used],
                **crit, "stationary": [p < 0.05]}

    schema = (
        "statistic double, p_value double, lags int, rows bigint, crit_1pct double, "
        "crit_5pct double, crit_10pct double, stationary boolean"
    )
    return solve_groups(moments, keys, solve, schema)


def dickey_fuller(grid: DataFrame, keys: Sequence[str], size: int = BLOCK_DAYS) -> DataFrame:
    """The test without lagged differences, from built-in regression aggregates."""
    step = Family(({"level": lag("y", 1)},), before=1)
    rows = over_blocks(grid.select(*keys, "ds", "y"), keys, step, size=size)
    dy, x = F.col("y") - F.col("level"), F.col("level")
    slope = F.col("slope")
    return (
        rows.where("level is not null and y is not null")
        .groupBy(*keys)
        .agg(
            F.regr_slope(dy, x).alias("slope"),
            F.regr_sxx(dy, x).alias("_sxx"),
            F.regr_syy(dy, x).alias("_syy"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumn("_sse", F.col("_syy") - slope * slope * F.col("_sxx"))
        .select(
            *keys,
            "rows",
            F.try_divide(
                slope, F.sqrt(F.try_divide(F.col("_sse") / (F.col("rows") - 2), F.col("_sxx")))
            ).alias("statistic"),
        )
    )
