"""Calendar fields, scalar functions, feature transformers and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import TIME_FEATURES, cyclical, quarter_label, with_calendar, with_time_features
from ..functions.transformers import SHORT_FEATURES, TimeFeatures, standard_scale
from ..operators import correlation as C
from ..operators import importance as I
from ..operators.blocks import attach
from ..operators.grid import date_bounds
from ..operators.linear import simple_regression
from ..operators.trees import assemble
from .base import FILLED, KEYS, PANEL, filled, panel, query

CALENDAR_SQL = {
    "year": "year(ds)",
    "quarter": "quarter(ds)",
    "month": "month(ds)",
    "iso_week": "week(ds)",
    "day_of_week": "isodow(ds) - 1",
    "day_of_month": "day(ds)",
    "day_of_year": "dayofyear(ds)",
    "month_name": "strftime(ds, '%b')",
    "weekday_name": "strftime(ds, '%a')",
    "is_weekend": "CASE WHEN isodow(ds) >= 6 THEN 1 ELSE 0 END",
    "is_month_start": "CASE WHEN day(ds) <= 5 THEN 1 ELSE 0 END",
    "is_month_end": "CASE WHEN day(ds) >= 25 THEN 1 ELSE 0 END",
}

for _i, (_name, _expr) in enumerate(CALENDAR_SQL.items(), 1):

    @query(
        f"cal{_i}_{_name}",
        f"WITH {PANEL} SELECT series, ds, {_expr} AS {_name} FROM panel",
        ints="" if _name.endswith("_name") else _name,
    )
    def _(spark, sf, name=_name):
        return with_calendar(panel(spark, sf).select("series", "ds"), name)


@query(
    "cal13_days_since_start",
    f"""WITH {PANEL} SELECT series, ds, date_diff('day', min(ds) OVER (PARTITION BY series), ds) AS days_since_start
    FROM panel""",
)
def _(spark, sf):
    return _started(panel(spark, sf)).select(
        "series", "ds", F.datediff("ds", "start").alias("days_since_start")
    )


def _started(df):
    """Rows with the first date of their series."""
    return attach(df, date_bounds(df, KEYS).withColumn("start", F.col("lo")), KEYS)


@query(
    "cal14_cyclical",
    f"""WITH {PANEL} SELECT series, ds, sin(2 * pi() * month(ds) / 12) AS month_sin,
    cos(2 * pi() * month(ds) / 12) AS month_cos, sin(2 * pi() * dayofyear(ds) / 365.25) AS doy_sin,
    cos(2 * pi() * dayofyear(ds) / 365.25) AS doy_cos FROM panel""",
    num="month_sin month_cos doy_sin doy_cos",
)
def _(spark, sf):
    month = cyclical(F.month("ds"), 12)
    doy = cyclical(F.dayofyear("ds"), 365.25)
    return panel(spark, sf).select(
        "series", "ds", month[0].alias("month_sin"), month[1].alias("month_cos"),
        doy[0].alias("doy_sin"), doy[1].alias("doy_cos"),
    )


BASE_SQL = {
    "year": "year(ds)",
    "dayofyear": "dayofyear(ds)",
    "month": "month(ds)",
    "day_of_month": "day(ds)",
    "week": "week(ds)",
    "day_of_week": "(isodow(ds) - 1)",
    "days_since_start": "date_diff('day', min(ds) OVER (PARTITION BY series), ds)",
}
PERIODS_SQL = {"year": "10", "month": "12", "dayofyear": "365.25", "week": "52", "day_of_week": "7", "day_of_month": "31"}
WAVES_SQL = {
    f"{n}_{f}": f"{f}(2 * pi() * {BASE_SQL[n]} / {p})" for n, p in PERIODS_SQL.items() for f in ("sin", "cos")
}
TIME_SQL = ", ".join(f"{e} AS {n}" for n, e in {**BASE_SQL, **WAVES_SQL}.items())
FEATURED = f"{FILLED}, featured AS (SELECT series, ds, y, {TIME_SQL} FROM filled)"


def featured(spark, sf):
    return with_time_features(_started(filled(spark, sf)), F.col("start")).drop("start")


@query(
    "cal15_time_features", f"{FEATURED} SELECT * FROM featured",
    num=" ".join(["y", *WAVES_SQL]), ints=" ".join(BASE_SQL),
)
def _(spark, sf):
    return featured(spark, sf)


@query(
    "cal16_year_quarter_label",
    f"WITH {PANEL} SELECT series, ds, CAST(year(ds) AS VARCHAR) || '-Q' || CAST(quarter(ds) AS VARCHAR) AS period FROM panel",
)
def _(spark, sf):
    return panel(spark, sf).select("series", "ds", quarter_label(F.col("ds")).alias("period"))


DEVIATION = f"""WITH {PANEL} SELECT series, ds, y - avg(y) OVER (PARTITION BY series) AS dev FROM panel"""


def _deviation(df):
    mean = df.groupBy("series").agg(F.avg("y").alias("m"), F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    return attach(df, mean, KEYS).select("series", "ds", (F.col("y") - F.col("m")).alias("dev"))


@query("scl1_abs", f"SELECT series, ds, abs(dev) AS dev FROM ({DEVIATION})", num="dev")
def _(spark, sf):
    return _deviation(panel(spark, sf)).withColumn("dev", F.abs("dev"))


@query("scl2_date_text", f"WITH {PANEL} SELECT series, ds, strftime(ds, '%Y-%m-%d') AS text FROM panel")
def _(spark, sf):
    return panel(spark, sf).select("series", "ds", F.date_format("ds", "yyyy-MM-dd").alias("text"))


@query(
    "scl3_sqrt_pow",
    f"SELECT series, ds, sqrt(abs(dev)) AS root, pow(abs(dev), 0.25) AS fourth_root FROM ({DEVIATION})",
    num="root fourth_root",
)
def _(spark, sf):
    dev = F.abs("dev")
    return _deviation(panel(spark, sf)).select(
        "series", "ds", F.sqrt(dev).alias("root"), F.pow(dev, F.lit(0.25)).alias("fourth_root")
    )


@query(
    "u1_time_features_transformer",
    f"""{FILLED} SELECT series, ds, year(ds) AS year, month(ds) AS month, day(ds) AS day,
    isodow(ds) - 1 AS dayofweek, quarter(ds) AS quarter, CASE WHEN isodow(ds) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    sin(2 * pi() * month(ds) / 12) AS month_sin, cos(2 * pi() * month(ds) / 12) AS month_cos,
    sin(2 * pi() * (isodow(ds) - 1) / 7) AS dayofweek_sin, cos(2 * pi() * (isodow(ds) - 1) / 7) AS dayofweek_cos,
    date_diff('day', min(ds) OVER (PARTITION BY series), ds) AS days_since_start FROM filled""",
    num="month_sin month_cos dayofweek_sin dayofweek_cos",
    ints="year month day dayofweek quarter is_weekend days_since_start",
)
def _(spark, sf):
    rows = _started(filled(spark, sf).drop("y"))
    return TimeFeatures(startCol="start").transform(rows).select("series", "ds", *SHORT_FEATURES)


SCALED = ["y", "month_sin", "days_since_start"]


@query(
    "fs2_standard_scale",
    f"{FEATURED} SELECT series, ds, "
    + ", ".join(
        f"({c} - avg({c}) OVER (PARTITION BY series)) / stddev_pop({c}) OVER (PARTITION BY series) AS {c}"
        for c in SCALED
    )
    + " FROM featured",
    num=" ".join(SCALED),
)
def _(spark, sf):
    rows = featured(spark, sf).select("series", "ds", *SCALED)
    return standard_scale(rows, SCALED, KEYS).select("series", "ds", *SCALED)


@query("fs3_assemble")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = assemble(featured(spark, sf), TIME_FEATURES)
    return rows.select("series", "ds", "y", vector_to_array("x").alias("x"))


# Pairwise correlations of a few features and the target, both ways.
PAIR_COLUMNS = ["y", "dayofyear", "month_sin", "week", "day_of_month"]


def _pairs_sql(columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT series, '{a}' AS a, '{b}' AS b,
        covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) AS corr FROM featured GROUP BY series"""
        for a in columns for b in columns if a != b
    )


@query("agg18_correlation_pairs", f"{FEATURED} {_pairs_sql(PAIR_COLUMNS)}", num="corr")
def _(spark, sf):
    return C.correlation_pairs(featured(spark, sf), PAIR_COLUMNS, KEYS)


@query("agg18_correlation_matrix", f"{FEATURED} {_pairs_sql(PAIR_COLUMNS)}", num="corr")
def _(spark, sf):
    return C.correlation_matrix(featured(spark, sf), PAIR_COLUMNS, KEYS)


CORR_Y = " UNION ALL ".join(
    f"SELECT series, '{f}' AS feature, abs(covar_pop({f}, y) / nullif(stddev_pop({f}) * stddev_pop(y), 0)) AS abs_corr FROM featured GROUP BY series"
    for f in TIME_FEATURES
)


@query(
    "agg19_top_correlated",
    f"""{FEATURED}, scored AS ({CORR_Y}) SELECT * FROM (
      SELECT series, feature, abs_corr, row_number() OVER (
        PARTITION BY series ORDER BY abs_corr DESC NULLS LAST, feature) AS rank FROM scored) WHERE rank <= 10""",
    num="abs_corr",
)
def _(spark, sf):
    return C.top_correlated(featured(spark, sf), "y", TIME_FEATURES, 10, KEYS)


CLOSE = " UNION ALL ".join(
    f"SELECT series, '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS c FROM featured GROUP BY series"
    for a in TIME_FEATURES for b in TIME_FEATURES if a != b
)


@query(
    "fs1_feature_selection",
    f"""{FEATURED.replace('WITH', 'WITH RECURSIVE', 1)}, scored AS ({CORR_Y}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY round(abs_corr, 12) DESC, feature) AS rank FROM scored),
    pairs AS ({CLOSE}),
    clash AS (SELECT series, a, list(b) AS stronger FROM pairs WHERE c > 0.6 GROUP BY series, a),
    visits AS (
      SELECT r.series, r.rank, r.feature, coalesce(k.stronger, []) AS stronger
      FROM ranked r LEFT JOIN clash k ON k.series = r.series AND k.a = r.feature),
    walk AS (
      SELECT series, CAST(0 AS BIGINT) AS step, CAST([] AS VARCHAR[]) AS kept FROM bounds
      UNION ALL
      SELECT w.series, v.rank,
        CASE WHEN list_has_any(w.kept, v.stronger) THEN w.kept ELSE list_append(w.kept, v.feature) END
      FROM walk w JOIN visits v ON v.series = w.series AND v.rank = w.step + 1),
    done AS (SELECT series, kept FROM walk WHERE step = {len(TIME_FEATURES)})
    SELECT r.series, r.rank, r.feature, r.abs_corr AS target_corr, list_contains(d.kept, r.feature) AS kept,
      coalesce(y.reasons, '') AS reasons, y.closest,
      list_contains(d.kept, r.feature) AND list_position(d.kept, r.feature) <= 10 AS selected
    FROM ranked r JOIN done d ON d.series = r.series
    LEFT JOIN (
      SELECT p.series, p.a, string_agg(p.b, ',' ORDER BY p.b) AS reasons, max(p.c) AS closest
      FROM pairs p JOIN done k ON k.series = p.series
      JOIN ranked s ON s.series = p.series AND s.feature = p.b
      JOIN ranked q ON q.series = p.series AND q.feature = p.a
      WHERE p.c > 0.6 AND s.rank < q.rank AND list_contains(k.kept, p.b) AND NOT list_contains(k.kept, p.a)
      GROUP BY p.series, p.a) y ON y.series = r.series AND y.a = r.feature""",
    num="target_corr closest",
    digits={"closest": 6},
)
def _(spark, sf):
    pairs = C.correlation_matrix(featured(spark, sf), [*TIME_FEATURES, "y"], KEYS)
    chosen = C.feature_selection(pairs, "y", KEYS)
    return chosen.withColumns(
        {
            "closest": F.array_max(F.transform("reasons", lambda r: r.corr)),
            "reasons": F.array_join(F.transform("reasons", lambda r: r.feature), ","),
        }
    )


@query(
    "md1_simple_regression",
    f"""{FEATURED} SELECT series, regr_slope(y, days_since_start) AS slope,
    regr_intercept(y, days_since_start) AS intercept FROM featured GROUP BY series""",
    num="slope intercept",
)
def _(spark, sf):
    return simple_regression(featured(spark, sf), KEYS, F.col("days_since_start"))


# Scores of each feature against each series stand in for the scores of models here.
SCORES = f"{FEATURED}, scores AS (SELECT series AS model, feature, abs_corr AS score FROM ({CORR_Y}))"
TOP5 = """top5 AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, feature) AS rank FROM scores) WHERE rank <= 5)"""


def _scores(spark, sf):
    return C.correlation_with(featured(spark, sf), "y", TIME_FEATURES, KEYS).select(
        F.col("series").alias("model"), "feature", F.abs("corr").alias("score")
    )


@query("set1_union_distinct", f"{SCORES}, {TOP5} SELECT DISTINCT feature FROM top5")
def _(spark, sf):
    return I.feature_union(_scores(spark, sf), [], 5)


@query(
    "set2_except_removed",
    f"{SCORES}, {TOP5} SELECT DISTINCT feature FROM scores EXCEPT SELECT feature FROM top5",
)
def _(spark, sf):
    scores = _scores(spark, sf)
    return scores.select("feature").distinct().join(I.feature_union(scores, [], 5), "feature", "left_anti")


@query(
    "jn5_feature_union_lookup",
    f"""{SCORES}, {TOP5}, wanted AS (SELECT DISTINCT feature FROM top5)
    SELECT w.feature, coalesce(max(s.score) FILTER (s.model = '1-URGENT'), 0) AS urgent,
      coalesce(max(s.score) FILTER (s.model = '2-HIGH'), 0) AS high,
      coalesce(max(s.score) FILTER (s.model = '5-LOW'), 0) AS low
    FROM wanted w JOIN scores s ON s.feature = w.feature GROUP BY w.feature""",
    num="urgent high low",
)
def _(spark, sf):
    models = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}
    return I.feature_union_lookup(_scores(spark, sf), list(models)).withColumnsRenamed(models)
