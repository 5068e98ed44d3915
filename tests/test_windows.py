import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom.operators import windows as Wn
from seriesloom.operators.blocks import attach, over_blocks, row_position, window_columns
from seriesloom.operators.evaluate import fold_segments, rolling_origin_membership, time_series_split
from seriesloom.operators.grid import date_bounds, fill_grid
from seriesloom.sources.panel import orders_daily

K = ["series"]
FAMILIES = {
    "lags": Wn.lag_features((1, 7, 365)),
    "rolling": Wn.rolling((7, 90)),
    "changes": Wn.changes(),
    "zscore": Wn.rolling_zscore(),
    "residual": Wn.centered_residual(),
    "neighbours": Wn.year_neighbours(),
    "momentum": Wn.momentum(),
    "past": Wn.lagged_rolling(),
    "trend365": Wn.trend_component(365),
    "trend12": Wn.trend_component(12),
}


@pytest.fixture(scope="module")
def grid(spark, sf):
    return fill_grid(orders_daily(spark, sf), K).select("series", "ds", "y").cache()


@pytest.mark.parametrize("name", FAMILIES)
def test_blocks_equal_plain_window(grid, name):
    family = FAMILIES[name]
    plain = grid
    for stage in family.stages:
        plain = plain.withColumns(window_columns(stage, K, "ds"))
    plain = plain.select([c for c in plain.columns if not c.startswith("_")])
    blocked = over_blocks(grid, K, family, size=100)
    assert blocked.count() == grid.count()
    assert blocked.exceptAll(plain).count() == 0


def test_equal_to_pandas(grid):
    got = over_blocks(grid, K, Wn.rolling((7, 90)), Wn.changes(), Wn.lagged_rolling(), Wn.trend_component()).toPandas()
    for _, g in got.sort_values("ds").groupby("series"):
        y = g.y
        pct = y.pct_change()
        for col, want in {
            "lag_30": y.shift(30),
            "rolling_mean_7": y.rolling(7).mean(),
            "rolling_std_7": y.rolling(7).std(),
            "rolling_min_7": y.rolling(7).min(),
            "rolling_max_90": y.rolling(90).max(),
            "rolling_std_90": y.rolling(90).std(),
            "trend": y.rolling(365, center=True).mean(),
            "past_mean_30": y.shift(1).rolling(30).mean(),
            "change": y.diff(),
            "volatility_7": pct.rolling(7).std(),
        }.items():
            assert (g[col].isna() == want.isna()).all()
            scale = max(1.0, want.abs().max())
            assert (g[col] - want).abs().max() < 1e-6 * scale


def test_zero_before_change_and_constant_series(daily):
    flat = over_blocks(daily("0", 40), K, Wn.changes(), Wn.rolling_zscore()).agg(
        F.count("pct_change"), F.count("zscore_7")
    )
    assert tuple(flat.first()) == (0, 0)


def test_autocorrelation_is_one_aggregate(daily):
    plan = Wn.autocorrelation(daily("t", 30), K)._jdf.queryExecution().optimizedPlan().toString()
    # Rows are copied at the borders of blocks; pairs are not made.
    assert "posexplode" not in plan
    # One for the mean and the bounds of each series, one for all lags; only facts,
    # the borders of blocks and the lags of a series are copied, no pairs.
    assert plan.count("Aggregate [") == 2 and plan.count("Generate ") <= 3


def test_autocorrelation(daily, grid):
    got = {r.lag: r.acf for r in Wn.autocorrelation(grid.where("series = '5-LOW'"), K, size=64).collect()}
    y = grid.where("series = '5-LOW'").orderBy("ds").toPandas().y
    assert set(got) == set(range(1, min(50, len(y) // 4)))
    assert all(abs(got[k] - y.autocorr(k)) < 1e-9 for k in got)
    # A constant series has no correlation, and short ones only few lags.
    assert all(r.acf is None for r in Wn.autocorrelation(daily("5", 30), K).collect())
    assert Wn.autocorrelation(daily("t * t", 30), K).count() == 6


def test_row_position(spark, sf):
    p = orders_daily(spark, sf)
    want = p.withColumn("n", F.row_number().over(Window.partitionBy("series").orderBy("ds")) - 1)
    got = row_position(p, K, size=17)
    assert got.join(want.select("series", "ds", "n"), ["series", "ds"]).where("n <> pos").count() == 0
    assert got.count() == p.count()


def test_attach_keeps_every_row(grid):
    facts = date_bounds(grid, K).withColumn("first", F.col("lo"))
    assert attach(grid, facts, K, size=11).count() == grid.count()


def test_folds_do_not_leak(grid):
    folds = time_series_split(grid, K, 5)
    edges = folds.groupBy("series", "fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("ds"))).alias("train_end"),
        F.min(F.when(F.col("role") == "test", F.col("ds"))).alias("test_start"),
        F.max(F.when(F.col("role") == "test", F.col("ds"))).alias("test_end"),
        F.count_if(F.col("role") == "test").alias("n_test"),
    )
    assert edges.where("train_end >= test_start").count() == 0
    ends = edges.join(date_bounds(grid, K), K).where("fold = 5 and test_end <> hi").count()
    assert ends == 0
    days = {r.series: r.n for r in grid.groupBy("series").agg(F.count("*").alias("n")).collect()}
    assert all(r.n_test == days[r.series] // 6 for r in edges.collect())


def test_fold_sizes_of_1477_days(daily):
    seg = fold_segments(daily("t", 1477), K, 5).groupBy("segment").count().collect()
    assert {r.segment: r["count"] for r in seg} == {0: 247, 1: 246, 2: 246, 3: 246, 4: 246, 5: 246}
    short = fold_segments(daily("t", 3), K, 5)
    assert short.where("segment is not null").count() == 0


def test_rolling_origins(daily):
    got = rolling_origin_membership(daily("t", 1417), K, 180, 30, 60)
    per = got.groupBy("cutoff").agg(F.count("*").alias("n"), F.min("ds").alias("a"), F.max("ds").alias("b"))
    assert per.count() == 40
    assert per.where("n <> 60 or datediff(a, cutoff) <> 1 or datediff(b, cutoff) <> 60").count() == 0
    assert rolling_origin_membership(daily("t", 200), K, 180, 30, 60).count() == 0


def test_partition_count_does_not_matter(spark, grid):
    family = Wn.rolling((7,), ("min", "max"))
    a = over_blocks(grid.repartition(1), K, family, size=50)
    b = over_blocks(grid.repartition(7), K, family, size=1000)
    assert a.exceptAll(b).count() == 0


def test_one_shuffle_for_all_window_columns(spark, grid, tmp_path):
    from seriesloom.plans.eda import eda_features

    grid.write.parquet(str(tmp_path / "grid"))
    features = eda_features(spark.read.parquet(str(tmp_path / "grid")), K)
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_yearly_growth_and_direction(daily):
    up = daily("100 * pow(1.1, year(ds) - 2015)", 1461)
    growth = [r.yoy_growth for r in Wn.yoy_growth(up, K).orderBy("year").collect()]
    assert growth[0] is None and all(abs(g - 10) < 1e-9 for g in growth[1:])
    assert Wn.recent_trend(up, K).first().direction == "up"
    assert Wn.recent_trend(daily("5", 800), K).first().direction == "stable"
    assert pd.isna(Wn.recent_trend(daily("5", 100), K).first().recent_trend)
