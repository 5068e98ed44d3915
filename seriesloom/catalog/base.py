"""Registration of queries and the SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.grid import fill_grid
from ..sources.panel import orders_daily

KEYS = ["series"]

# Digits kept when results are compared: values on the scale of prices get
# fewer than ratios and waves.
DIGITS = 3
RATIO_DIGITS = 6
RATIOS = {
    "pct_change", "volatility_7", "zscore_7", "zscore_30", "momentum", "corr", "abs_corr",
    "target_corr", "acf", "cv", "r2", "score", "mape", "smape", "mdape", "coverage",
    "trend_strength", "seasonal_strength",
}


def digits_of(column: str) -> int:
    wave = column.endswith(("_sin", "_cos"))
    return RATIO_DIGITS if wave or column in RATIOS else DIGITS


def offset_of(digits: int) -> float:
    """Added before rounding.  Averages of prices are often short decimals that end in 5,
    where the last bit of a sum decides the rounding; the offset moves the
    boundaries between rounded values to where no short decimals lie."""
    return float(f"0.31416e-{digits}")

# The operators as written, and with their results made comparable (rounded).
OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# The SQL as written, before rounding.
SQL: dict[str, str] = {}


def finish(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Comparable values: rounded doubles without negative zero, 64-bit integers."""
    out = {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = digits.get(f.name, digits_of(f.name))
            out[f.name] = F.round(c + F.lit(offset_of(d)), d) + F.lit(0.0)
        elif isinstance(f.dataType, T.IntegralType):
            out[f.name] = c.cast("bigint")
    return df.withColumns(out)


def query(
    name: str, sql: str | None = None, num: str = "", ints: str = "", digits: Mapping[str, int] = {}
):
    """Register a query.

    ``num`` and ``ints`` name the double and integer columns of ``sql``; they are
    rounded and cast like the columns of the DataFrame.
    """

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        OPERATORS[name] = fn
        QUERIES[name] = lambda spark, sf: finish(fn(spark, sf), digits)
        if sql is not None:
            SQL[name] = sql
            swaps = []
            for c in num.split():
                d = digits.get(c, digits_of(c))
                swaps.append(f"round({c} + CAST({offset_of(d)!r} AS DOUBLE), {d}) + 0.0 AS {c}")
            swaps += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
            replace = f" REPLACE ({', '.join(swaps)})" if swaps else ""
            ORACLES[name] = f"SELECT *{replace} FROM ({sql}) AS result"
        return fn

    return register


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return orders_daily(spark, sf)


def filled(spark: SparkSession, sf: str) -> DataFrame:
    return fill_grid(panel(spark, sf), KEYS).select("series", "ds", "y")


# -- SQL fragments -----------------------------------------------------------

PANEL = """panel AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds, avg(o_totalprice) AS y
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2)"""

SUPPLIER_PANEL = """panel AS (
  SELECT l_suppkey AS series, CAST(l_shipdate AS DATE) AS ds, avg(l_extendedprice) AS y
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2)"""

SHIP_PANEL = """panel AS (
  SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS ds, avg(l_extendedprice) AS y
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2)"""

SPINE = """bounds AS (SELECT series, min(ds) AS lo, max(ds) AS hi FROM panel GROUP BY series),
spine AS (
  SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM bounds)"""

GRID = f"""{SPINE},
grid AS (
  SELECT s.series, s.ds, p.y
  FROM spine s LEFT JOIN panel p ON p.series = s.series AND p.ds = s.ds)"""

FILL = f"""{GRID},
carried AS (
  SELECT series, ds, y,
    last_value(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER back AS pd,
    last_value(y IGNORE NULLS) OVER back AS py,
    first_value(CASE WHEN y IS NOT NULL THEN ds END IGNORE NULLS) OVER ahead AS nd,
    first_value(y IGNORE NULLS) OVER ahead AS ny
  FROM grid
  WINDOW back AS (PARTITION BY series ORDER BY ds ROWS UNBOUNDED PRECEDING),
    ahead AS (PARTITION BY series ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT series, ds, y IS NOT NULL AS real_value,
    CASE WHEN y IS NOT NULL THEN y WHEN pd IS NULL THEN NULL WHEN nd IS NULL THEN py
      ELSE py + (ny - py) * date_diff('day', pd, ds) / date_diff('day', pd, nd) END AS y
  FROM carried)"""

FILLED = f"WITH {PANEL}, {FILL}"
SUPPLIER_FILLED = f"WITH {SUPPLIER_PANEL}, {FILL}"

W = "PARTITION BY series ORDER BY ds"


def full_sql(agg: str, col: str, n: int, frame: str | None = None) -> str:
    """A rolling aggregate that is null until the frame holds n values."""
    frame = frame or f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    over = f"OVER ({W} {frame})"
    return f"CASE WHEN count({col}) {over} = {n} THEN {agg}({col}) {over} END"
