"""Sources, profiling, cleaning, grids and filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.holidays import Calendar, own_holidays, with_holidays
from ..operators import grid as G
from ..operators import profile as P
from ..session import scratch_path
from ..sources.panel import (
    as_output, as_panel, orders_daily, read_panel_csv, ship_daily, supplier_daily, table,
)
from .base import FILL, FILLED, GRID, KEYS, PANEL, SHIP_PANEL, SPINE, SUPPLIER_PANEL, filled, panel, query


@query("src1_read_panel", f"WITH {PANEL} SELECT * FROM panel", num="y")
def _(spark, sf):
    path = scratch_path(spark, "prices")
    as_output(panel(spark, sf)).write.option("header", True).csv(path)
    return read_panel_csv(spark, path, KEYS)


@query("src1_build_panel_orders", f"WITH {PANEL} SELECT * FROM panel", num="y")
def _(spark, sf):
    return orders_daily(spark, sf)


@query("src1_build_panel_ship", f"WITH {SHIP_PANEL} SELECT * FROM panel", num="y")
def _(spark, sf):
    return ship_daily(spark, sf)


@query("src1_build_panel_supplier", f"WITH {SUPPLIER_PANEL} SELECT * FROM panel", num="y")
def _(spark, sf):
    return supplier_daily(spark, sf)


@query(
    "prj1_cast_value",
    "SELECT o_orderkey, CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS y FROM orders",
    num="y",
)
def _(spark, sf):
    text = table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("string"))
    return text.select("o_orderkey", F.col("price").cast("double").alias("y"))


@query(
    "prj2_parse_date",
    "SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS ds FROM orders",
)
def _(spark, sf):
    text = table(spark, sf, "orders").withColumn("d", F.date_format("o_orderdate", "dd/MM/yyyy"))
    return text.select("o_orderkey", F.to_date("d", "dd/MM/yyyy").alias("ds"))


@query(
    "prj3_rename_select",
    'SELECT o_orderkey AS series, CAST(o_orderdate AS DATE) AS "Date", o_totalprice AS "Price" FROM orders',
    num='"Price"',
)
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "series")
    return as_output(as_panel(orders, KEYS, "o_orderdate", "o_totalprice"))


@query(
    "prj4_numeric_columns",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
    num="l_quantity l_extendedprice l_discount l_tax",
    ints="l_linenumber",
)
def _(spark, sf):
    t = table(spark, sf, "lineitem")
    return t.select(P.numeric_columns(t))


@query(
    "prj5_drop_columns",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    num="o_totalprice",
)
def _(spark, sf):
    return P.drop_columns(table(spark, sf, "orders"), "o_orderdate", "o_orderstatus", "no_such_column")


@query(
    "flt1_filter_flag",
    f"WITH {PANEL} SELECT series, ds, y FROM panel WHERE isodow(ds) >= 6",
    num="y",
)
def _(spark, sf):
    return panel(spark, sf).where(F.weekday("ds") >= 5)


@query("flt2_drop_null", f"WITH {PANEL}, {GRID} SELECT * FROM grid WHERE y IS NOT NULL", num="y")
def _(spark, sf):
    return P.drop_null(G.fill_grid(panel(spark, sf), KEYS, None).drop("real_value"), "y")


@query(
    "dq1_profile_schema",
    f"""WITH {PANEL}, n AS (SELECT count(*) AS row_count FROM panel)
    SELECT c.column_name, c.data_type, n.row_count, 3 AS column_count
    FROM n, (VALUES ('series', 'string'), ('ds', 'date'), ('y', 'double')) AS c(column_name, data_type)""",
    ints="row_count column_count",
)
def _(spark, sf):
    return P.profile_schema(panel(spark, sf))


@query(
    "dq2_null_counts",
    f"""WITH {PANEL}, {GRID}
    SELECT 'series' AS column_name, count(*) FILTER (series IS NULL) AS null_count FROM grid
    UNION ALL SELECT 'ds', count(*) FILTER (ds IS NULL) FROM grid
    UNION ALL SELECT 'y', count(*) FILTER (y IS NULL) FROM grid""",
    ints="null_count",
)
def _(spark, sf):
    return P.null_counts(G.fill_grid(panel(spark, sf), KEYS, None).drop("real_value"))


DESCRIBE = """count(y) AS "count", avg(y) AS mean, stddev_samp(y) AS std, min(y) AS min,
  quantile_cont(y, 0.25) AS q25, quantile_cont(y, 0.5) AS q50, quantile_cont(y, 0.75) AS q75, max(y) AS max"""


@query(
    "dq3_describe",
    f"{FILLED} SELECT series, {DESCRIBE} FROM filled GROUP BY series",
    num="mean std min q25 q50 q75 max",
)
def _(spark, sf):
    return P.describe(filled(spark, sf), KEYS)


@query(
    "dq3_describe_suppliers",
    f"WITH {SUPPLIER_PANEL} SELECT series, {DESCRIBE} FROM panel GROUP BY series",
    num="mean std min q25 q50 q75 max",
)
def _(spark, sf):
    return P.describe(supplier_daily(spark, sf), KEYS)


@query(
    "dq4_completeness",
    f"""WITH {PANEL}, {GRID}
    SELECT series, count(*) AS row_count, avg(CASE WHEN y IS NULL THEN 0 ELSE 1 END) * 100 AS complete_pct
    FROM grid GROUP BY series""",
    num="complete_pct",
)
def _(spark, sf):
    return P.completeness(G.fill_grid(panel(spark, sf), KEYS, None), KEYS)


@query("dq5_missing_dates", f"WITH {PANEL}, {GRID} SELECT series, ds FROM grid WHERE y IS NULL")
def _(spark, sf):
    return G.missing_dates(panel(spark, sf), KEYS)


@query(
    "dq6_date_range",
    f"""WITH {PANEL} SELECT series, min(ds) AS first_ds, max(ds) AS last_ds, count(*) AS days,
    count(DISTINCT year(ds)) AS years FROM panel GROUP BY series""",
)
def _(spark, sf):
    return P.date_range(panel(spark, sf), KEYS)


@query(
    "dq7_dedupe_keep_first",
    """SELECT series, ds, o_orderkey, y FROM (
      SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds, o_orderkey, o_totalprice AS y,
        row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn
      FROM orders) WHERE rn = 1""",
    num="y",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series"),
        F.to_date("o_orderdate").alias("ds"),
        "o_orderkey",
        F.col("o_totalprice").alias("y"),
    )
    return G.dedupe_keep_first(rows, ["series", "ds"], "o_orderkey")


@query("dq8_real_value_flag", f"{FILLED} SELECT series, ds, real_value FROM filled")
def _(spark, sf):
    return G.fill_grid(panel(spark, sf), KEYS).drop("y")


@query("jn1_date_spine", f"WITH {PANEL}, {SPINE} SELECT series, ds FROM spine")
def _(spark, sf):
    return G.date_spine(panel(spark, sf), KEYS)


# Weekly and monthly grids of SQL: the days of the spine that lie on the grid.
WEEKLY = "isodow(ds) = 7"
MONTHLY = "ds = last_day(ds)"


@query("jn1_date_spine_weekly", f"WITH {PANEL}, {SPINE} SELECT series, ds FROM spine WHERE {WEEKLY}")
def _(spark, sf):
    return G.date_spine(panel(spark, sf), KEYS, "W")


@query("jn1_date_spine_monthly", f"WITH {PANEL}, {SPINE} SELECT series, ds FROM spine WHERE {MONTHLY}")
def _(spark, sf):
    return G.date_spine(panel(spark, sf), KEYS, "M")


@query("jn2_spine_left_join", f"WITH {PANEL}, {GRID} SELECT series, ds, y FROM grid", num="y")
def _(spark, sf):
    p = panel(spark, sf)
    return G.spine_join(G.date_spine(p, KEYS), p, KEYS)


HOLIDAYS = """years AS (
  SELECT unnest(generate_series(CAST(year(min(ds)) AS BIGINT), CAST(year(max(ds)) AS BIGINT))) AS yr FROM panel),
fixed AS (
  SELECT make_date(yr, m, d) AS ds, n AS holiday FROM years,
    (VALUES (1, 1, 'New Year''s Day', 1), (6, 19, 'Juneteenth', 2021), (7, 4, 'Independence Day', 1),
      (11, 11, 'Veterans Day', 1), (12, 25, 'Christmas Day', 1)) AS f(m, d, n, since) WHERE yr >= since
  UNION ALL SELECT make_date(max(yr) + 1, 1, 1), 'New Year''s Day' FROM years),
days AS (
  SELECT CAST(unnest(generate_series(make_date(min(yr), 1, 1), make_date(max(yr), 12, 31), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM years),
nth AS (
  SELECT d.ds, n AS holiday FROM days d,
    (VALUES (1, 1, 3, 'Martin Luther King Jr. Day'), (2, 1, 3, 'Washington''s Birthday'),
      (9, 1, 1, 'Labor Day'), (10, 1, 2, 'Columbus Day'), (11, 4, 4, 'Thanksgiving')) AS f(m, dow, k, n)
  WHERE month(d.ds) = m AND isodow(d.ds) = dow AND ceil(day(d.ds) / 7.0) = k
  UNION ALL SELECT max(ds), 'Memorial Day' FROM days WHERE month(ds) = 5 AND isodow(ds) = 1 GROUP BY year(ds)),
holidays AS (
  SELECT * FROM fixed UNION ALL SELECT * FROM nth
  UNION ALL SELECT ds + CASE WHEN isodow(ds) = 6 THEN -1 ELSE 1 END, holiday || ' (observed)'
  FROM fixed WHERE isodow(ds) >= 6)"""


@query(
    "jn4_holiday_join",
    f"""WITH {PANEL}, {HOLIDAYS}
    SELECT p.series, p.ds, p.y, h.holiday FROM panel p LEFT JOIN holidays h ON CAST(h.ds AS DATE) = p.ds""",
    num="y",
)
def _(spark, sf):
    p = panel(spark, sf)
    # Two scalars: the years the calendar must cover.
    first, last = p.agg(F.year(F.min("ds")), F.year(F.max("ds"))).first()
    return with_holidays(p, first, last).select("series", "ds", "y", "holiday")


# Easter Sunday by the rule of Meeus, Jones and Butcher; feasts with the day before and after; and as the user's
# own table the day of the highest price of each year, with the two days that follow.
FEASTS = """years AS (
  SELECT unnest(generate_series(CAST(year(min(ds)) AS BIGINT) - 1, CAST(year(max(ds)) AS BIGINT) + 1)) AS y FROM panel),
m1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
m2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM m1),
m3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM m2),
m4 AS (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM m3),
easter AS (SELECT y, make_date(y, n // 31, n % 31 + 1) AS sunday FROM m4),
days AS (
  SELECT sunday + d AS ds, n AS name FROM easter, (VALUES (-2, 'Karfreitag'), (1, 'Ostermontag'),
    (39, 'Christi Himmelfahrt'), (50, 'Pfingstmontag')) AS f(d, n)
  UNION ALL SELECT make_date(y, m, d), n FROM years, (VALUES (1, 1, 'Neujahr'), (5, 1, 'Tag der Arbeit'),
    (10, 3, 'Tag der Deutschen Einheit'), (12, 25, 'Erster Weihnachtstag'), (12, 26, 'Zweiter Weihnachtstag')) AS f(m, d, n)
  WHERE y >= 1990 OR n <> 'Tag der Deutschen Einheit'),
peaks AS (SELECT arg_max(ds, y) AS ds FROM panel WHERE series = '5-LOW' GROUP BY year(ds)),
around AS (
  SELECT ds + CAST(k AS INTEGER) AS ds, name || CASE WHEN k = 0 THEN '' ELSE format(' {:+d}', k) END AS holiday FROM days, range(-1, 2) AS r(k)
  UNION ALL SELECT ds + CAST(k AS INTEGER), 'Spitze' || CASE WHEN k = 0 THEN '' ELSE format(' {:+d}', k) END FROM peaks, range(0, 3) AS r(k))"""


@query(
    "jn4_feasts_and_own_days",
    f"""WITH {PANEL}, {FEASTS}
    SELECT p.series, p.ds, p.y, h.holiday FROM panel p LEFT JOIN around h ON CAST(h.ds AS DATE) = p.ds""",
    num="y",
)
def _(spark, sf):
    p = panel(spark, sf)
    first, last = p.agg(F.year(F.min("ds")), F.year(F.max("ds"))).first()
    peaks = p.where("series = '5-LOW'").groupBy(F.year("ds")).agg(F.max_by("ds", "y").alias("ds"))
    own = own_holidays(peaks.select(F.lit("Spitze").alias("holiday"), "ds", F.lit(2).alias("after")), after="after")
    return with_holidays(p, first, last, Calendar("DE", 1, 1, own)).select("series", "ds", "y", "holiday")


@query("gf1_interpolate_time", f"{FILLED} SELECT series, ds, y FROM filled", num="y")
def _(spark, sf):
    return filled(spark, sf)


@query(
    "gf1_interpolate_time_suppliers",
    f"WITH {SUPPLIER_PANEL}, {FILL} SELECT series, ds, y FROM filled",
    num="y",
)
def _(spark, sf):
    return G.fill_grid(supplier_daily(spark, sf), KEYS).drop("real_value")


BY_ROW = """numbered AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ds) AS rn FROM grid),
near AS (
  SELECT series, ds, y, rn,
    last_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER back AS p_rn,
    last_value(y IGNORE NULLS) OVER back AS py,
    first_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER ahead AS n_rn,
    first_value(y IGNORE NULLS) OVER ahead AS ny
  FROM numbered
  WINDOW back AS (PARTITION BY series ORDER BY ds ROWS UNBOUNDED PRECEDING),
    ahead AS (PARTITION BY series ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
by_row AS (
  SELECT series, ds, CASE WHEN y IS NOT NULL THEN y WHEN p_rn IS NULL THEN NULL WHEN n_rn IS NULL THEN py
    ELSE py + (ny - py) * (rn - p_rn) / (n_rn - p_rn) END AS y, py, ny
  FROM near)"""


def _grid_at(where: str) -> str:
    """The panel on a coarser grid: only values dated on the grid take part."""
    return f"""{SPINE},
grid AS (
  SELECT s.series, s.ds, p.y FROM (SELECT * FROM spine WHERE {where}) s
  LEFT JOIN panel p ON p.series = s.series AND p.ds = s.ds)"""


@query(
    "gf2_interpolate_linear",
    f"WITH {PANEL}, {_grid_at(WEEKLY)}, {BY_ROW} SELECT series, ds, y FROM by_row",
    num="y",
)
def _(spark, sf):
    return G.fill_grid(panel(spark, sf), KEYS, "linear", "W").drop("real_value")


@query(
    "gf3_bfill_ffill",
    f"""WITH {PANEL}, {GRID}
    SELECT series, ds, coalesce(y,
      first_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ds ROWS UNBOUNDED PRECEDING)) AS y
    FROM grid""",
    num="y",
)
def _(spark, sf):
    return G.fill_grid(panel(spark, sf), KEYS, "bfill_ffill").drop("real_value")


for _freq, _name, _where in (("D", "daily", "TRUE"), ("W", "weekly", WEEKLY), ("M", "monthly", MONTHLY)):

    @query(
        f"gf4_fill_missing_dates_{_name}",
        f"""WITH {PANEL}, {_grid_at(_where)}, {BY_ROW}
        SELECT series, ds, coalesce(y, ny, py) AS y FROM by_row""",
        num="y",
    )
    def _(spark, sf, freq=_freq):
        return G.fill_grid(panel(spark, sf), KEYS, "linear_edges", freq).drop("real_value")


# The first order of each day and priority, then grid and interpolation.
FIRST_ORDER = """panel AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds, arg_min(o_totalprice, o_orderkey) AS y
  FROM orders GROUP BY 1, 2)"""


@query("gf5_prepare_panel", f"WITH {FIRST_ORDER}, {FILL} SELECT series, ds, y, real_value FROM filled", num="y")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series"),
        F.to_date("o_orderdate").alias("ds"),
        "o_orderkey",
        F.col("o_totalprice").alias("y"),
    )
    return G.prepare_panel(rows, KEYS, order="o_orderkey")


@query("srt1_sort_by_date", f"WITH {PANEL} SELECT * FROM panel ORDER BY series, ds", num="y")
def _(spark, sf):
    return panel(spark, sf).orderBy("series", "ds")


@query(
    "srt2_sort_by_score",
    f"WITH {PANEL} SELECT series, avg(y) AS score FROM panel GROUP BY series ORDER BY score DESC",
    num="score",
)
def _(spark, sf):
    return panel(spark, sf).groupBy("series").agg(F.avg("y").alias("score")).orderBy(F.desc("score"))


@query("lim1_head", f"WITH {PANEL} SELECT * FROM panel ORDER BY ds, series LIMIT 10", num="y")
def _(spark, sf):
    return P.head(panel(spark, sf), 10, "ds", "series")


@query(
    "lim2_tail",
    f"""{FILLED} SELECT series, ds, y FROM (
      SELECT *, row_number() OVER (PARTITION BY series ORDER BY ds DESC) AS rn FROM filled) WHERE rn <= 10""",
    num="y",
)
def _(spark, sf):
    return P.tail_per_series(filled(spark, sf), KEYS, 10)


@query(
    "lim3_sample",
    f"""WITH {PANEL} SELECT * FROM panel
    ORDER BY md5('42|' || series || '|' || CAST(ds AS VARCHAR)), series, ds LIMIT 5""",
    num="y",
)
def _(spark, sf):
    return P.sample_rows(panel(spark, sf), 5, ["series", "ds"])
