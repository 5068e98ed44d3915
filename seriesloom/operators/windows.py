"""Lag, rolling and growth columns.

Functions that return a ``Family`` describe columns; pass any number of them to
``over_blocks`` to compute all in one shuffle and one sort.  All frames count
rows, and rolling values are null unless all n rows of the frame have a value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalar import percent, ratio
from .blocks import BLOCK_DAYS, Family, Stage, attach, over_blocks

def full(agg: Column, col: str, n: int, frame: WindowSpec) -> Column:
    """``agg`` over a short frame, null unless the frame holds n non-null values."""
    return F.when(F.count(col).over(frame) == n, agg.over(frame))


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


class Doubling:
    """Statistics of the last n rows from totals over 1, 2, 4, ... rows, as SQL.

    A sliding frame visits all its n rows again at every row.  Here the total
    over 2m rows is made of two totals over m rows, m rows apart, so a row costs
    a handful of lags whatever n is; sums are added in pairs and squared
    deviations are merged, so there is no cancellation.  A null or missing row
    makes every total that covers it null, which is the full-frame rule.
    """

    def __init__(self, col: str, largest: int, stats: Sequence[str]):
        self.col, self.measures = col, set(stats)
        self.levels = largest.bit_length() - 1

    def _name(self, part: str, size: int) -> str:
        return self.col if size == 1 else f"_{self.col}_{part}_{size}"

    def _at(self, shifts: Stage, part: str, size: int, back: int) -> str:
        """A total as it was ``back`` rows ago; every shift is a column made once."""
        if part == "dev" and size == 1:
            return f"(0 * {self._at(shifts, 'sum', 1, back)})"
        name = self._name(part, size)
        if back == 0:
            return name
        shifted = f"_{name}_{'back' if back > 0 else 'ahead'}_{abs(back)}"
        shifts[shifted] = lag(name, back)
        return shifted

    def stages(self) -> list[Stage]:
        return [stage for k in range(self.levels) for stage in self._level(2**k)]

    def _level(self, m: int) -> tuple[Stage, Stage]:
        """Totals over 2m rows: the shifts they need, then the totals."""
        shifts: Stage = {}

        def tile(back):
            return m, self._at(shifts, "sum", m, back), self._at(shifts, "dev", m, back)

        def pair(part):
            return f"{self._at(shifts, part, m, 0)}, {self._at(shifts, part, m, m)}"

        columns = {"sum": f"{self._at(shifts, 'sum', m, 0)} + {self._at(shifts, 'sum', m, m)}"}
        if "std" in self.measures:
            columns["dev"] = merged_dev(tile(0), tile(m))
        if "min" in self.measures:
            columns["min"] = f"least({pair('min')})"
        if "max" in self.measures:
            columns["max"] = f"greatest({pair('max')})"
        return shifts, {self._name(part, 2 * m): sql for part, sql in columns.items()}

    def _tiles(self, n: int) -> list[tuple[int, int]]:
        """(size, rows back) of the totals that tile the last n rows."""
        tiles, back = [], 0
        for size in (2**k for k in reversed(range(n.bit_length()))):
            if n & size:
                tiles.append((size, back))
                back += size
        return tiles

    def _sum(self, shifts: Stage, n: int, back: int) -> str:
        return " + ".join(self._at(shifts, "sum", size, b + back) for size, b in self._tiles(n))

    def _stat(self, shifts: Stage, stat: str, n: int, back: int) -> str:
        if stat == "sum":
            return self._sum(shifts, n, back)
        if stat == "mean":
            return f"({self._sum(shifts, n, back)}) / {n}"
        if stat == "std":
            tiles = [
                (size, *[self._at(shifts, part, size, b + back) for part in ("sum", "dev")])
                for size, b in self._tiles(n)
            ]
            total, s, dev = tiles[0]
            for tile in tiles[1:]:
                dev = merged_dev((total, s, dev), tile)
                total, s = total + tile[0], f"({s} + {tile[1]})"
            return f"sqrt(({dev}) / {n - 1})"
        size = 2 ** (n.bit_length() - 1)
        ends = [self._at(shifts, stat, size, b) for b in (back, n - size + back)]
        extreme = "least" if stat == "min" else "greatest"
        whole = f"({self._sum(shifts, n, back)}) IS NOT NULL"
        return f"CASE WHEN {whole} THEN {extreme}({', '.join(ends)}) END"

    def results(self, wanted: dict[str, tuple[str, int, int]]) -> tuple[Stage, Stage]:
        """Last two stages: ``{column: (statistic, n, back)}``, each over the n rows that
        end ``back`` rows before the current one."""
        shifts: Stage = {}
        columns = {name: self._stat(shifts, *spec) for name, spec in wanted.items()}
        return shifts, columns


def lag(col: str, rows: int) -> str:
    return f"lag({col}, {rows}) OVER ({{w}})" if rows else col


def merged_dev(a: tuple[int, str, str], b: tuple[int, str, str]) -> str:
    """Squared deviations of two tiles (rows, sum, squared deviations) together."""
    (n, s, d), (m, t, e) = a, b
    return f"({d} + {e} + pow({s} / {n} - {t} / {m}, 2) * {n * m} / {n + m})"


def lag_features(lags: Sequence[int] = (1, 7, 14, 30, 365), col: str = "y") -> Family:
    return Family(({f"lag_{k}": lag(col, k) for k in lags},), before=max(lags))


STATS = ("mean", "std", "min", "max")


def rolling(
    windows: Sequence[int] = (7, 14, 30, 90), stats: Sequence[str] = STATS, col: str = "y"
) -> Family:
    totals = Doubling(col, max(windows), stats)
    wanted = {f"rolling_{s}_{n}": (s, n, 0) for n in windows for s in stats}
    return Family((*totals.stages(), *totals.results(wanted)), before=max(windows) - 1)


def changes(volatility: int = 7) -> Family:
    """Difference, relative change, and the rolling deviation of the latter."""
    previous = {"_y_before": lag("y", 1)}
    first = {"change": "y - _y_before", "pct_change": "try_divide(y, _y_before) - 1"}
    totals = Doubling("pct_change", volatility, ("std",))
    last = totals.results({f"volatility_{volatility}": ("std", volatility, 0)})
    return Family((previous, first, *totals.stages(), *last), before=volatility)


def rolling_zscore(windows: Sequence[int] = (7, 30)) -> Family:
    """Distance of y from its rolling mean in rolling standard deviations."""
    totals = Doubling("y", max(windows), ("mean", "std"))
    moments = totals.results({f"_{s}_{n}": (s, n, 0) for n in windows for s in ("mean", "std")})
    z = {f"zscore_{n}": f"try_divide(y - _mean_{n}, _std_{n})" for n in windows}
    return Family((*totals.stages(), *moments, z), before=max(windows) - 1)


def centered_mean(n: int = 21, name: str = "smooth_baseline") -> Family:
    half = n // 2
    return Family(
        ({name: lambda w: full(F.avg("y"), "y", n, w.rowsBetween(-half, half))},),
        before=half,
        after=half,
    )


def centered_residual(n: int = 21) -> Family:
    """Centred baseline, distance from it, and the centred deviation of that distance."""
    half = n // 2
    return Family(
        (
            centered_mean(n).stages[0],
            {"diff": lambda w: F.col("y") - F.col("smooth_baseline")},
            {
                "rolling_std": lambda w: full(
                    F.stddev_samp("diff"), "diff", n, w.rowsBetween(-half, half)
                )
                + F.lit(1e-6)
            },
        ),
        before=2 * half,
        after=2 * half,
    )


def year_neighbours(days: int = 365) -> Family:
    """Value one year back and ahead (by rows of the daily grid) and their mean."""
    return Family(
        (
            {"y_prev_year": lag("y", days), "y_next_year": lag("y", -days)},
            {"y_year_mean": "(y_prev_year + y_next_year) / 2"},
        ),
        before=days,
        after=days,
    )


def momentum(n: int = 3) -> Family:
    """Relative change of the n-row mean."""
    return Family(
        (
            {f"mean_{n}": lambda w: full(F.avg("y"), "y", n, trailing(w, n))},
            {"momentum": lambda w: ratio(F.col(f"mean_{n}"), F.lag(f"mean_{n}").over(w)) - 1},
        ),
        before=n,
    )


def lagged_rolling(lags: Sequence[int] = (1, 7, 30), windows: Sequence[int] = (7, 30)) -> Family:
    """Lags, and rolling mean and deviation of the rows before the current one."""
    totals = Doubling("y", max(windows), ("mean", "std"))
    past = totals.results(
        {f"past_{s}_{n}": (s, n, 1) for n in windows for s in ("mean", "std")}
    )
    shifts = past[0] | lag_features(lags).stages[0]
    return Family((*totals.stages(), shifts, past[1]), before=max(*lags, *windows))


def trend_component(period: int = 365) -> Family:
    """Centred moving average; an even period weighs both end rows by half."""
    half = period // 2
    totals = Doubling("y", period, ("mean",))
    if period % 2:
        last = totals.results({"trend": ("mean", period, -half)})
    else:
        shifts, inner = totals.results({"_inner": ("sum", period - 1, 1 - half)})
        shifts |= {"_left": lag("y", half), "_right": lag("y", -half)}
        last = (shifts, inner, {"trend": f"(_inner + (_left + _right) / 2) / {period}"})
    return Family((*totals.stages(), *last), before=half + 1, after=half)


def yoy_growth(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Yearly mean and its growth over the previous year present, in percent."""
    w = Window.partitionBy(*keys).orderBy("year")
    return (
        panel.groupBy(*keys, F.year("ds").alias("year"))
        .agg(F.avg("y").alias("mean_y"))
        .withColumn("yoy_growth", percent(F.col("mean_y"), F.lag("mean_y").over(w)))
    )


def recent_trend(panel: DataFrame, keys: Sequence[str], limit: float = 2.0) -> DataFrame:
    """Mean growth over the last three yearly means and its direction."""
    w = Window.partitionBy(*keys).orderBy(F.desc("year"))
    last3 = (
        panel.groupBy(*keys, F.year("ds").alias("year"))
        .agg(F.avg("y").alias("mean_y"))
        .withColumns(
            {
                "_rank": F.row_number().over(w),
                "_growth": percent(F.col("mean_y"), F.lead("mean_y").over(w)),
            }
        )
        .where("_rank <= 2")
    )
    trend = F.col("recent_trend")
    return last3.groupBy(*keys).agg(F.avg("_growth").alias("recent_trend")).withColumn(
        "direction", F.when(trend > limit, "up").when(trend < -limit, "down").otherwise("stable")
    )


def autocorrelation(
    grid: DataFrame, keys: Sequence[str], max_lag: int = 50, size: int = BLOCK_DAYS
) -> DataFrame:
    """Correlation of y with itself k rows earlier, k below min(max_lag, n / 4).

    One window pass gives every row its predecessors as columns, and one aggregate
    the sum of products for every lag, of values less the mean of their series.  The
    sums over either side of the pairs follow from the whole ones and the first and
    last ``max_lag - 1`` values.
    """
    reach = max_lag - 1
    lags = range(1, max_lag)
    rows = grid.where(F.col("y").isNotNull()).select(*keys, "ds", "y")
    facts = rows.groupBy(*keys).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"), F.avg("y").alias("_m"))
    facts = facts.withColumns({"_lo": F.col("lo"), "_hi": F.col("hi")})
    centred = attach(rows, facts, keys, size).select(
        *keys, "ds", (F.col("y") - F.col("_m")).alias("u"), F.datediff("ds", "_lo").alias("_at"), F.datediff("_hi", "ds").alias("_back")
    )
    past = Family(({f"past_{k}": lag("u", k) for k in lags},), before=reach)
    u = F.col("u")

    def edge(place: str) -> Column:
        return F.collect_list(F.when(F.col(place) < reach, F.struct(F.col(place).alias("at"), u.alias("u"))))

    sums = over_blocks(centred, keys, past, size=size).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(u).alias("s"), F.sum(u * u).alias("q"),
        F.array(*[F.sum(u * F.col(f"past_{k}")) for k in lags]).alias("p"), edge("_at").alias("_at"), edge("_back").alias("_back"),
    )

    def less(ends: str, total: str, power: int) -> Column:
        """Per lag, ``total`` without the values that stand closer than it to this end."""

        def one(k: Column) -> Column:
            gone = F.filter(ends, lambda e: e["at"] < k)
            return F.col(total) - F.aggregate(gone, F.lit(0.0), lambda a, e: a + (e["u"] if power == 1 else e["u"] * e["u"]))

        return F.transform(F.sequence(F.lit(1), F.lit(reach)), one)

    # One row per series from here on.
    sides = {f"{t}{i}": less(e, t, power) for i, e in enumerate(("_at", "_back")) for t, power in (("s", 1), ("q", 2))}
    known = sums.withColumns(sides)

    def acf(k: Column) -> Column:
        a, b, qa, qb, p = (F.get(c, k - 1) for c in ("s0", "s1", "q0", "q1", "p"))
        n = F.col("n") - k
        spread = F.sqrt(F.greatest(qa - a * a / n, F.lit(0.0))) * F.sqrt(F.greatest(qb - b * b / n, F.lit(0.0)))
        return F.struct(k.cast("int").alias("lag"), F.try_divide(p - a * b / n, spread).alias("acf"))

    known = known.withColumn("last", F.least(F.lit(reach), F.floor(F.col("n") / 4).cast("int") - 1)).where("last >= 1")
    return known.select(*keys, F.inline(F.transform(F.sequence(F.lit(1), F.col("last")), acf)))
