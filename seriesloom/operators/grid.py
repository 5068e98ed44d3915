"""Gap-free calendar grids and filling of missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BLOCK_DAYS, block_of


@dataclass(frozen=True)
class Axis:
    """Integer axis of a calendar frequency, as SQL.

    ``first``/``final`` give the position of the first grid date at or after,
    and the last at or before a date; ``date`` turns a position into a date.
    """

    first: str
    final: str
    date: str

    def up(self, day: str) -> Column:
        return F.expr(self.first.format(d=day))

    def down(self, day: str) -> Column:
        return F.expr(self.final.format(d=day))

    def at(self, pos: str) -> Column:
        return F.expr(self.date.format(p=pos))


# 1970-01-04, day 3 of the epoch, is a Sunday: weekly grids lie on Sundays,
# monthly grids on the last day of the month.
AXES = {
    "D": Axis("unix_date({d})", "unix_date({d})", "date_from_unix_date({p})"),
    "W": Axis(
        "cast(ceil((unix_date({d}) - 3) / 7) as int)",
        "cast(floor((unix_date({d}) - 3) / 7) as int)",
        "date_from_unix_date({p} * 7 + 3)",
    ),
    "M": Axis(
        "year({d}) * 12 + month({d}) - 1",
        "year({d}) * 12 + month({d}) - 1 - cast({d} <> last_day({d}) as int)",
        "last_day(make_date(cast(floor({p} / 12) as int), {p} % 12 + 1, 1))",
    ),
}


def date_bounds(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    return panel.groupBy(*keys).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))


def date_spine(panel: DataFrame, keys: Sequence[str], freq: str = "D") -> DataFrame:
    """Every grid date between the first and last date of each series."""
    ax = AXES[freq]
    return (
        date_bounds(panel, keys)
        .select(*keys, ax.up("lo").alias("_a"), ax.down("hi").alias("_b"))
        .where("_a <= _b")
        .select(*keys, F.explode(F.sequence("_a", "_b")).alias("_p"))
        .select(*keys, ax.at("_p").alias("ds"))
    )


def spine_join(spine: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grid rows with the columns of ``df`` where a row exists, nulls elsewhere."""
    return spine.join(df, [*keys, "ds"], "left")


def future_frame(
    panel: DataFrame, keys: Sequence[str], periods: int, freq: str = "D", history: bool = True
) -> DataFrame:
    """History dates followed by ``periods`` further grid dates per series."""
    ax = AXES[freq]
    ahead = (
        date_bounds(panel, keys)
        .withColumn("_b", ax.down("hi"))
        .withColumn("_p", F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + periods)))
        .select(*keys, ax.at("_p").alias("ds"))
    )
    return panel.select(*keys, "ds").unionByName(ahead) if history else ahead


def _segments(
    panel: DataFrame, keys: Sequence[str], ax: Axis, size: int, reach: tuple[int, int] | None = None
) -> DataFrame:
    """Stretches of the grid between neighbouring observations, in the blocks they reach.

    One row per stretch and block: grid positions ``start``..``stop`` of the stretch in
    block ``_blk`` or within ``before`` rows ahead of it and ``after`` behind it, the
    observation at the left end of the stretch (``pos0``, ``y0``) and the next one
    (``pos1``, ``y1``); either is null where there is none.  A block is given the
    observations within its reach, the nearest ones outside it, and a mark beyond either
    end of the series.  The latter come from one summary row per (series, blocks reached),
    so an arbitrarily long series is never sorted in one task, and days are made in the
    task that holds their observations.
    """
    before, after = reach or (0, 0)
    rows = panel.select(*keys, "y", ax.up("ds").alias("_up"), ax.down("ds").alias("_down"))
    # Every day lies on the daily axis; a comparison that is always true would reach one of
    # the two scans below and keep them from being one.
    on_grid = "" if ax.first == ax.final else " AND _up = _down"
    rows = rows.selectExpr(
        "*",
        f"y IS NOT NULL{on_grid} AS _seen",
        f"{block_of(f'_up - {after}', size)} AS _from",
        f"{block_of(f'_up + {before}', size)} AS _to",
    )
    within = rows.where("_seen").selectExpr(*keys, "_from AS _first", "_to AS _last", "_up", "y", "_seen")

    by_place = Window.partitionBy(*keys).orderBy("_from", "_to")
    whole = Window.partitionBy(*keys)
    later = by_place.rowsBetween(1, Window.unboundedFollowing)
    earlier = by_place.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.expr("CASE WHEN _seen THEN _up END")
    edges = (
        rows.groupBy(*keys, "_from", "_to")
        .agg(
            F.min("_up").alias("_lo"),
            F.max("_down").alias("_hi"),
            F.min(seen).alias("_head"),
            F.min_by("y", seen).alias("_head_y"),
            F.max(seen).alias("_tail"),
            F.max_by("y", seen).alias("_tail_y"),
        )
        .withColumns(
            {
                "lo": F.min("_lo").over(whole),
                "hi": F.max("_hi").over(whole),
                "_next": F.first(F.expr("CASE WHEN _head IS NOT NULL THEN _to END"), ignorenulls=True).over(later),
                "_prev": F.last(F.expr("CASE WHEN _head IS NOT NULL THEN _from END"), ignorenulls=True).over(earlier),
                "rank": F.row_number().over(by_place),
            }
        )
        .withColumns({"_a": F.expr(block_of("lo", size)), "_b": F.expr(block_of("hi", size))})
    )
    # The last observation before the next one is in reach, the first one after the previous
    # one was, and the marks.
    outer = edges.selectExpr(
        *keys,
        """inline(array(
          CASE WHEN _tail IS NOT NULL THEN struct(_to + 1 AS _first, coalesce(_next, _b) AS _last, _tail AS _up,
            _tail_y AS y, true AS _seen) END,
          CASE WHEN _head IS NOT NULL THEN struct(coalesce(_prev, _a) AS _first, _from - 1 AS _last, _head AS _up,
            _head_y AS y, true AS _seen) END,
          CASE WHEN rank = 1 THEN struct(_a AS _first, _b AS _last, lo - 1 AS _up, CAST(NULL AS DOUBLE) AS y,
            false AS _seen) END,
          CASE WHEN rank = 1 THEN struct(_a AS _first, _b AS _last, hi + 1 AS _up, CAST(NULL AS DOUBLE) AS y,
            false AS _seen) END))""",
    ).where("_first <= _last")
    points = within.unionByName(outer).selectExpr(*keys, "_up", "y", "_seen", "explode(sequence(_first, _last)) AS _blk")
    if reach is not None:
        # The days are sorted in the task that makes them, several for each point: partitions
        # that are merged by the bytes of the points would be too large for memory then.
        points = points.repartition(int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_blk")
    in_block = Window.partitionBy(*keys, "_blk").orderBy("_up")
    return (
        points.withColumns({"_at": F.lead("_up").over(in_block), "_y": F.lead("y").over(in_block), "_real": F.lead("_seen").over(in_block)})
        .where("_at IS NOT NULL")
        .selectExpr(
            *keys,
            "_blk",
            f"greatest(IF(_seen, _up, _up + 1), _blk * {size} - {before}) AS start",
            f"least(_at - 1, _blk * {size} + {size - 1 + after}) AS stop",
            "IF(_seen, _up, NULL) AS pos0",
            "y AS y0",
            "IF(_real, _at, NULL) AS pos1",
            "_y AS y1",
        )
        .where("start <= stop")
    )


# Value of a grid position between the observations of its stretch, by method.
LINE = """CASE WHEN pos = pos0 THEN y0 WHEN pos0 IS NULL THEN NULL WHEN pos1 IS NULL THEN y0
  ELSE y0 + (y1 - y0) * (pos - pos0) / (pos1 - pos0) END"""
METHODS = {
    None: "CASE WHEN pos = pos0 THEN y0 END",
    "time": LINE,
    "linear": LINE,
    "linear_edges": f"coalesce({LINE}, y1)",
    "bfill_ffill": "CASE WHEN pos = pos0 THEN y0 ELSE coalesce(y1, y0) END",
}


def fill_grid(
    panel: DataFrame,
    keys: Sequence[str],
    method: str | None = "time",
    freq: str = "D",
    size: int = BLOCK_DAYS,
    reach: tuple[int, int] | None = None,
) -> DataFrame:
    """The panel on its gap-free grid: ``(keys, ds, y, real_value)``.

    ``time`` and ``linear`` interpolate between neighbours along the grid (the
    same thing on a daily grid), keep leading nulls and carry the last value to
    the end; ``linear_edges`` also fills the start with the first value;
    ``bfill_ffill`` takes the next value, then the previous one; ``None`` leaves
    gaps null.

    ``reach``, rows back and ahead, adds the copies and columns (``_blk``, ``_own``) that
    ``spread`` would: ``over_blocks`` then needs no shuffle of days, as the copies are made
    of the observations.  Series and day must be unique in the panel.
    """
    ax = AXES[freq]
    before, after = reach or (0, 0)
    blocks = [
        F.col("_blk").alias("_blk", metadata={"before": before, "after": after, "size": size}),
        F.expr(f"{block_of('pos', size)} = _blk").alias("_own"),
    ]
    return (
        _segments(panel, keys, ax, size, reach)
        .selectExpr("*", "explode(sequence(start, stop)) AS pos")
        .select(
            *keys,
            ax.at("pos").alias("ds"),
            F.expr(METHODS[method]).alias("y"),
            F.expr("coalesce(pos = pos0, false)").alias("real_value"),
            *(blocks if reach else []),
        )
    )


def dedupe_keep_first(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """One whole row per ``by``: the one with the smallest ``order``.

    An aggregate rather than a row number, so duplicates are combined before
    the shuffle however many there are.
    """
    rest = [c for c in df.columns if c not in by]
    return (
        df.groupBy(*by)
        .agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
        .select(*by, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def prepare_panel(
    df: DataFrame, keys: Sequence[str], order: str | None = None, size: int = BLOCK_DAYS
) -> DataFrame:
    """Dedupe (when an ``order`` column says what comes first), grid and interpolate."""
    if order is not None:
        df = dedupe_keep_first(df, [*keys, "ds"], order)
    return fill_grid(df, keys, "time", size=size)


def missing_dates(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grid days without a value."""
    have = panel.where(F.col("y").isNotNull()).select(*keys, "ds")
    return date_spine(panel, keys).join(have, [*keys, "ds"], "left_anti")
