import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.functions.calendar import TIME_FEATURES, with_calendar, with_time_features
from seriesloom.functions.holidays import CALENDARS, Calendar, OwnHoliday, holiday_dimension, own_holidays, with_holidays
from seriesloom.operators import correlation as C
from seriesloom.operators import profile as P
from seriesloom.operators import stats as S
from seriesloom.operators.anomaly import clip_and_fill, iqr_anomalies, trend_outliers, zscore_anomalies
from seriesloom.operators.decompose import decompose, decompose_strength
from seriesloom.operators.moments import merge_two, merged, partial_moments, solve_groups
from seriesloom.operators.stationarity import adf_test, dickey_fuller, max_lag_of, p_value

K = ["series"]

# Known statistics of the time features over the days 2012-01-01..2016-01-16.
GOLDEN = {
    "year": (2013.53, 1.14239, 2012, 2013, 2014, 2015, 2016),
    "month_sin": (0.000683561, 0.704106, -1, -0.5, 0, 0.5, 1),
    "dayofyear_cos": (0.0106835, 0.710879, -0.999979, -0.69831, 0.0182766, 0.724004, 0.999991),
    "day_of_month": (15.6513, 8.80031, 1, 8, 16, 23, 31),
    "day_of_month_cos": (-0.0190724, 0.701011, -0.994869, -0.758758, -0.0506492, 0.688967, 1),
    "day_of_week_cos": (0, 0.707346, -0.900969, -0.900969, -0.222521, 0.62349, 1),
    "day_of_week_sin": (0, 0.707346, -0.974928, -0.781831, 0, 0.781831, 0.974928),
}
# Correlations that make the weaker feature drop out over the same days.
PARTNERS = {
    ("year_sin", "year"): 0.93, ("year_cos", "year"): 0.97, ("days_since_start", "year"): 0.97,
    ("week_sin", "month_sin"): 0.97, ("dayofyear_sin", "month_sin"): 0.95, ("dayofyear", "month_sin"): 0.76,
    ("month", "month_sin"): 0.76, ("week", "month_sin"): 0.75, ("week_cos", "dayofyear_cos"): 1.0,
    ("month_cos", "dayofyear_cos"): 0.95, ("day_of_month_sin", "day_of_month"): 0.80,
    ("day_of_week", "day_of_week_sin"): 0.73,
}


@pytest.fixture(scope="module")
def calendar_days(spark):
    days = spark.sql(
        "SELECT 'a' AS series, explode(sequence(DATE'2012-01-01', DATE'2016-01-16')) AS ds"
    )
    return with_time_features(days, F.lit("2012-01-01").cast("date")).cache()


def test_golden_feature_statistics(calendar_days):
    got = {r.feature: r for r in P.describe_columns(calendar_days, list(GOLDEN)).collect()}
    for f, want in GOLDEN.items():
        r = got[f]
        assert r["count"] == 1477
        for have, value in zip((r.mean, r.std, r.min, r.q25, r.q50, r.q75, r.max), want):
            assert abs(have - value) <= 1e-5 * max(1, abs(value)) * (300 if f == "year" else 1)


def test_golden_partners(calendar_days):
    corr = {
        (r.a, r.b): abs(r["corr"])
        for r in C.correlation_matrix(calendar_days, TIME_FEATURES, K).collect()
    }
    assert len(TIME_FEATURES) == 19
    for pair, want in PARTNERS.items():
        assert round(corr[pair], 2) == want
    kept = set(TIME_FEATURES) - {a for a, _ in PARTNERS}
    assert len(kept) == 7 and max(corr[a, b] for a in kept for b in kept if a != b) < 0.28


def test_feature_selection_keeps_the_stronger(calendar_days):
    # A target that ranks the 7 uncorrelated features first.
    order = ["year", "month_sin", "dayofyear_cos", "day_of_week_cos", "day_of_month_cos", "day_of_month", "day_of_week_sin"]
    pairs = C.correlation_matrix(calendar_days, TIME_FEATURES, K)
    strength = {f: 0.9 - 0.1 * i for i, f in enumerate(order)}
    rows = [("a", f, "y", strength.get(f, 0.001)) for f in TIME_FEATURES]
    spark = calendar_days.sparkSession
    target = spark.createDataFrame(rows, "series string, a string, b string, corr double")
    out = C.feature_selection(pairs.unionByName(target), "y", K, top_k=5).collect()
    assert [r.feature for r in sorted(out, key=lambda r: r["rank"]) if r.kept] == order
    assert sum(r.selected for r in out) == 5
    reasons = {(r.feature, x.feature): round(x.corr, 2) for r in out for x in r.reasons}
    assert all(reasons[p] == v for p, v in PARTNERS.items())


def test_calendar_edges(panel):
    p = panel({"a": {"2016-01-01": 1.0, "2018-12-31": 1.0, "2020-02-29": 1.0}})
    got = {str(r.ds): r for r in with_calendar(p).collect()}
    assert got["2016-01-01"].iso_week == 53 and got["2018-12-31"].iso_week == 1
    leap = got["2020-02-29"]
    assert (leap.day_of_week, leap.weekday_name, leap.is_weekend, leap.day_of_year) == (5, "Sat", 1, 60)
    assert leap.is_month_end == 1 and got["2016-01-01"].is_month_start == 1


def test_holidays(spark, panel):
    names = {(str(r.ds), r.holiday) for r in holiday_dimension(spark, 2021, 2022).collect()}
    for day, name in [
        ("2021-01-18", "Martin Luther King Jr. Day"), ("2021-05-31", "Memorial Day"),
        ("2021-11-25", "Thanksgiving"), ("2021-07-05", "Independence Day (observed)"),
        ("2021-12-31", "New Year's Day (observed)"), ("2022-06-20", "Juneteenth (observed)"),
    ]:
        assert (day, name) in names
    assert ("2020-06-19", "Juneteenth") not in {
        (str(r.ds), r.holiday) for r in holiday_dimension(spark, 2020, 2020).collect()
    }
    p = panel({"a": {"2021-07-04": 1.0, "2021-07-06": 1.0}})
    got = {str(r.ds): r.holiday for r in with_holidays(p, 2021, 2021).collect()}
    assert got == {"2021-07-04": "Independence Day", "2021-07-06": None}


def test_histogram_edges(daily):
    got = {r.bin: r["count"] for r in S.histogram(daily("t", 101), K, 20).collect()}
    assert sum(got.values()) == 101 and got[19] == 6 and set(got) == set(range(20))
    flat = S.histogram(daily("7", 9), K, 20).collect()
    assert [(r.bin, r["count"]) for r in flat] == [(10, 9)]


def test_describe_matches_numpy(daily):
    r = P.describe(daily("(t * 37) % 101", 300), K).first()
    x = np.array([(t * 37) % 101 for t in range(300)], float)
    assert np.allclose(
        [r["count"], r.mean, r.std, r.min, r.q25, r.q50, r.q75, r.max],
        [300, x.mean(), x.std(ddof=1), x.min(), *np.quantile(x, [0.25, 0.5, 0.75]), x.max()],
    )


def test_constant_column_has_no_correlation(daily):
    df = daily("t", 50).withColumn("c", F.lit(1.0))
    assert all(r["corr"] is None for r in C.correlation_pairs(df, ["y", "c"], K).collect())
    top = C.top_correlated(df, "y", ["c"], 5, K).first()
    assert top.abs_corr is None


def test_one_hot_series_does_not_change_results(spark, daily):
    hot = daily("sin(t) * 10 + t % 7", 3000, series="hot")
    rest = daily("cos(t) * 3", 400, series="cold")
    both = hot.unionByName(rest)
    for fn in (lambda d: S.histogram(d, K, 20, size=64), lambda d: iqr_anomalies(d, K, size=64)):
        assert fn(both).where("series = 'hot'").exceptAll(fn(hot)).count() == 0


def test_spike_is_flagged_and_clipped(daily):
    base = "100 + sin(t / 20.0)"
    p = daily(f"CASE WHEN t = 600 THEN 1000 ELSE {base} END", 1200)
    flags = trend_outliers(p, K, size=128).where("outlier").collect()
    assert [r.y for r in flags] == [1000.0]
    clipped = clip_and_fill(p, K).agg(F.max("y")).first()[0]
    assert clipped < 200
    same = clip_and_fill(p, K).exceptAll(clip_and_fill(p, K, fill_first=False)).count()
    assert same == 0
    assert clip_and_fill(p, K, clip=False).agg(F.max("y")).first()[0] == 1000
    assert zscore_anomalies(p, K).where("is_anomaly_zscore").count() >= 1
    assert trend_outliers(daily("t % 5", 20), K).where("outlier").count() == 0


def test_decomposition_recovers_and_adds_up(daily):
    p = daily("50 + 0.1 * t + 10 * sin(2 * pi() * t / 365)", 365 * 4)
    parts = decompose(p, K, size=512).where("trend is not null").cache()
    assert parts.count() == 365 * 3 + 1
    assert parts.where("abs(trend + seasonal + residual - y) > 1e-9").count() == 0
    worst = parts.agg(F.max(F.abs(F.col("residual")))).first()[0]
    assert worst < 0.2
    strong = decompose_strength(parts, K).first()
    assert strong.trend_strength > 0.99 and strong.seasonal_strength > 0.99
    short = decompose(daily("t", 700), K)
    assert short.count() == 700 and short.where("trend is not null or seasonal is not null").count() == 0


def _numpy_adf(y):
    def fit(lags, first):
        t = np.arange(first, len(y))
        dy = np.diff(y)
        x = np.column_stack([np.ones(len(t)), y[t - 1]] + [dy[t - 1 - k] for k in range(1, lags + 1)])
        b = np.linalg.lstsq(x, dy[t - 1], rcond=None)[0]
        e = dy[t - 1] - x @ b
        se = np.sqrt(e @ e / (len(t) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
        return b[1] / se, len(t) * np.log(e @ e / len(t)) + 2 * (lags + 2), len(t)

    top = max_lag_of(len(y))
    lags = min(range(top + 1), key=lambda k: fit(k, top + 1)[1])
    tau, _, n = fit(lags, lags + 1)
    return tau, lags, n


def test_calendars_speak_alike(spark):
    """Flags of a date, the dimension and the dates in Python agree, for every country, with windows and own days."""
    own = (OwnHoliday("fair", (dt.date(2019, 12, 31), dt.date(2020, 2, 29)), 1, 1),)
    first, last = dt.date(2015, 1, 1), dt.date(2024, 12, 31)
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2024-12-31')) AS ds")
    for country in (None, *CALENDARS):
        calendar = Calendar(country, 1, 2, own)
        flags = calendar.flags(F.col("ds"))
        wide = days.select("ds", F.array(*[F.when(c == 1, F.lit(n)) for n, c in flags.items()]).alias("names"))
        by_flag = {(r.ds, n) for r in wide.collect() for n in r.names if n}
        by_join = {tuple(r) for r in holiday_dimension(spark, 2015, 2024, calendar).collect()}
        by_date = {(d, n) for n, ds in calendar.dates(first, last).items() for d in ds}
        assert by_flag == by_join == by_date and list(flags) == list(calendar.dates(first, last))
    with pytest.raises(KeyError):
        Calendar("XX").flags(F.col("ds"))


def test_easter_feasts_and_own_tables(spark):
    found = {(str(r.ds), r.holiday) for r in holiday_dimension(spark, 2016, 2017, "DE").collect()}
    assert {("2016-03-25", "Karfreitag"), ("2016-03-28", "Ostermontag"), ("2016-05-16", "Pfingstmontag"), ("2017-04-17", "Ostermontag")} <= found
    assert ("2017-10-31", "Reformationstag") in found and ("2016-10-31", "Reformationstag") not in found
    table = spark.sql("SELECT * FROM VALUES ('a', DATE'2016-05-01', -1, 2), ('a', DATE'2017-05-01', NULL, NULL), ('b', NULL, 0, 0) AS t(n, d, lower, upper)")
    assert own_holidays(table, "n", "d", "lower", "upper") == (OwnHoliday("a", (dt.date(2016, 5, 1), dt.date(2017, 5, 1)), 1, 2),)
    assert own_holidays(table.where("false"), "n", "d") == ()


def test_adf_plans_without_a_job_and_with_fixed_lags(spark, daily):
    grid = daily("100 + 3 * randn(1)", 300)
    sc = spark.sparkContext
    sc.setJobGroup("adf-plan", "planning")
    test = adf_test(grid, K, lags=2)
    assert not sc.statusTracker().getJobIdsForGroup("adf-plan")
    sc.setJobGroup("other", "")
    y = np.array([r.y for r in grid.orderBy("ds").collect()])
    d = np.diff(y)
    x = np.column_stack([np.ones(len(d) - 2), y[2:-1], d[1:-1], d[:-2]])
    b, sse = np.linalg.lstsq(x, d[2:], rcond=None)[:2]
    tau = b[1] / math.sqrt(sse[0] / (len(x) - 4) * np.linalg.inv(x.T @ x)[1, 1])
    got = test.first()
    assert got.lags == 2 and got.rows == len(x) and abs(got.statistic - tau) < 1e-6
    with pytest.raises(ValueError):
        adf_test(grid, K, lags=10_000)


def test_adf_against_direct_regression(spark):
    rng = np.random.default_rng(7)
    noise = rng.normal(size=(3, 400))
    ar = np.zeros(300)
    for t in range(3, 300):
        ar[t] = 0.6 * ar[t - 1] - 0.3 * ar[t - 3] + noise[2][t]
    series = {"walk": np.cumsum(noise[0]), "white": noise[1], "ar": ar, "flat": np.full(60, 2.0)}
    rows = [(s, i, float(v)) for s, ys in series.items() for i, v in enumerate(ys)]
    df = spark.createDataFrame(rows, "series string, t int, y double").selectExpr(
        "series", "date_add(DATE'2015-01-01', t) ds", "y"
    )
    got = {r.series: r for r in adf_test(df, K, size=64).collect()}
    for s in ("walk", "white", "ar"):
        tau, lags, n = _numpy_adf(series[s])
        assert (got[s].lags, got[s].rows) == (lags, n) and abs(got[s].statistic - tau) < 1e-6
    assert got["white"].stationary and not got["walk"].stationary
    assert got["flat"].statistic is None
    assert abs(got["white"].crit_5pct + 2.87) < 0.01
    simple = {r.series: r.statistic for r in dickey_fuller(df, K).collect()}
    assert abs(simple["white"] - got["white"].statistic) < 1e-6 or got["white"].lags > 0
    assert p_value(3) == 1 and p_value(-20) == 0 and abs(p_value(-2.86) - 0.05) < 0.005


def test_moments_merge_like_one_pass(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) + 1e6
    whole = (500, x.mean(axis=0), (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)))
    cuts = [x[:10], x[10:11], x[11:]]
    parts = [(len(c), c.mean(axis=0), (c - c.mean(axis=0)).T @ (c - c.mean(axis=0))) for c in cuts]
    n, mean, co = merged(parts)
    assert n == 500 and np.allclose(mean, whole[1]) and np.allclose(co, whole[2], atol=1e-4)
    assert merge_two(parts[0], parts[1])[0] == 11
    rows = [(i % 2, *map(float, r)) for i, r in enumerate(x)] + [(0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double").repartition(6)

    def solve(_, groups):
        n, mean, co = merged(groups.values())
        return {"n": [n], "va": [co[0, 0] / n]}

    for keys, counts in ((["k"], [250, 250]), ([], [500])):
        out = solve_groups(partial_moments(df, keys, ["a", "b", "c"]), keys, solve, "n bigint, va double").collect()
        assert [r.n for r in out] == counts
    assert abs(out[0].va - x[:, 0].var()) < 1e-6
