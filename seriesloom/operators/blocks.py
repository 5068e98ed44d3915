"""Windows over time blocks instead of whole series.

A window partitioned by the series keys alone puts a whole series into one
task.  Here the partition is (keys, block of consecutive days): every row is
copied into the blocks whose frames reach it, the window runs per block, and
each block keeps the rows it owns.  The result equals the plain window for any
bounded frame, while a task never holds more than a block plus its margins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_DAYS = 4096

# A window column: SQL with ``{w}`` for the window, or a function of the window.
WindowColumn = str | Callable[[WindowSpec], Column]
Stage = dict[str, WindowColumn]

DAY = "unix_date(ds)"


@dataclass(frozen=True)
class Family:
    """Window columns computed together.

    ``stages`` run one after the other, so that a stage may use columns of the
    stages before it; columns that start with an underscore are dropped at the
    end.  ``before``/``after`` say how many rows back and ahead the last stage
    reaches in total.
    """

    stages: tuple[Stage, ...]
    before: int = 0
    after: int = 0


def block_of(pos: str, size: int = BLOCK_DAYS) -> str:
    """SQL of the block a position lies in."""
    return f"cast(floor(({pos}) / {size}) as int)"


def window_columns(stage: Stage, partition: Sequence[str], order: str) -> dict[str, Column]:
    spec = Window.partitionBy(*partition).orderBy(order)
    text = f"PARTITION BY {', '.join(f'`{p}`' for p in partition)} ORDER BY `{order}`"
    return {
        name: F.expr(make.format(w=text)) if isinstance(make, str) else make(spec)
        for name, make in stage.items()
    }


def spread(df: DataFrame, before: int, after: int, pos: str = DAY, size: int = BLOCK_DAYS) -> DataFrame:
    """Copy each row into every block that has rows within reach of it."""
    home = block_of(pos, size)
    if before == 0 and after == 0:
        return df.selectExpr("*", f"{home} AS _blk", "true AS _own")
    first, last = block_of(f"{pos} - {after}", size), block_of(f"{pos} + {before}", size)
    copies = df.selectExpr("*", f"{home} AS _home", f"explode(sequence({first}, {last})) AS _blk")
    return copies.selectExpr("*", "_blk = _home AS _own").drop("_home")


def reach_of(*families: Family) -> tuple[int, int]:
    """Rows back and ahead that the families reach together."""
    return max(f.before for f in families), max(f.after for f in families)


def lies_spread(df: DataFrame, before: int, after: int, size: int = BLOCK_DAYS) -> bool:
    """Whether ``fill_grid`` has copied the rows already; too few copies raise."""
    if not {"_blk", "_own"} <= set(df.columns):
        return False
    had = df.schema["_blk"].metadata
    if had.get("size") != size or had["before"] < before or had["after"] < after:
        raise ValueError(f"rows spread by {had or 'others'}; {before} back, {after} ahead, blocks of {size} are needed")
    return True


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    *families: Family,
    pos: str = DAY,
    size: int = BLOCK_DAYS,
    order: str = "ds",
) -> DataFrame:
    """Add the columns of all families in one shuffle and one sort.

    ``df`` must be free of gaps along ``pos`` (the day number by default), so
    that k rows back is k positions back.  A grid filled with the ``reach`` of the
    families lies in its blocks already and is not shuffled again.
    """
    before, after = reach_of(*families)
    out = df if lies_spread(df, before, after, size) else spread(df, before, after, pos, size)
    scratch: set[str] = set()
    for i in range(max(len(f.stages) for f in families)):
        stage: Stage = {}
        for f in families:
            if i < len(f.stages):
                stage |= f.stages[i]
        out = out.withColumns(window_columns(stage, [*keys, "_blk"], order))
        scratch |= {c for c in stage if c.startswith("_")}
    return out.where("_own").drop("_blk", "_own", *scratch)


def row_position(
    df: DataFrame, keys: Sequence[str], ds: str = "ds", size: int = BLOCK_DAYS
) -> DataFrame:
    """Add ``pos``, the 0-based row number per series by date, without one task per series.

    Rows are numbered inside their block; the counts of the earlier blocks,
    one row per (series, block), give the offset.
    """
    blocked = df.selectExpr("*", f"{block_of(f'unix_date({ds})', size)} AS _blk")
    offsets = (
        blocked.groupBy(*keys, "_blk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("_n").over(
                    Window.partitionBy(*keys)
                    .orderBy("_blk")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_n")
    )
    local = F.row_number().over(Window.partitionBy(*keys, "_blk").orderBy(ds)) - 1
    return (
        blocked.withColumn("_local", local)
        .join(offsets, [*keys, "_blk"])
        .withColumn("pos", F.col("_offset") + F.col("_local"))
        .drop("_blk", "_local", "_offset")
    )


def attach(
    df: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    size: int = BLOCK_DAYS,
) -> DataFrame:
    """Join one-row-per-series ``facts`` to the rows of the series.

    ``facts`` must carry ``lo``/``hi`` dates that cover the rows.  The facts are
    repeated once per block and joined on (keys, block), so that a long series
    is spread over tasks like everywhere else.  Catalyst broadcasts the facts
    by itself when their size allows.
    """
    first, last = block_of("unix_date(lo)", size), block_of("unix_date(hi)", size)
    wide = facts.selectExpr("*", f"explode(sequence({first}, {last})) AS _blk").drop("lo", "hi")
    rows = df.selectExpr("*", f"{block_of(DAY, size)} AS _blk")
    return rows.join(wide, [*keys, "_blk"]).drop("_blk")
