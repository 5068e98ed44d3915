import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import grid as G
from seriesloom.operators.blocks import over_blocks, spread
from seriesloom.operators.windows import centered_mean, lag_features
from seriesloom.plans import eda
from seriesloom.sources.panel import as_output, build_panel, orders_daily, read_panel_csv, supplier_daily

K = ["series"]


def values(df, col="y"):
    return {(r.series, str(r.ds)): r[col] for r in df.collect()}


def test_interpolation_edges(panel):
    p = panel({"a": {"2020-01-01": None, "2020-01-02": 10.0, "2020-01-05": 40.0, "2020-01-07": None}})
    got = values(G.fill_grid(p, K))
    assert [got["a", f"2020-01-0{d}"] for d in range(1, 8)] == [None, 10, 20, 30, 40, 40, 40]
    real = values(G.fill_grid(p, K), "real_value")
    assert [d for (_, d), v in sorted(real.items()) if v] == ["2020-01-02", "2020-01-05"]
    edges = values(G.fill_grid(p, K, "linear_edges"))
    assert edges["a", "2020-01-01"] == 10
    back = values(G.fill_grid(p, K, "bfill_ffill"))
    assert [back["a", f"2020-01-0{d}"] for d in range(1, 8)] == [10, 10, 40, 40, 40, 40, 40]


def test_all_null_single_row_and_interleaved_series(panel):
    p = panel(
        {
            "null": {"2020-02-28": None, "2020-03-01": None},
            "one": {"2020-02-28": 3.0},
            "b": {"2020-02-27": 1.0, "2020-03-01": 4.0},
        }
    )
    got = values(G.fill_grid(p, K))
    assert got["null", "2020-02-29"] is None and len([k for k in got if k[0] == "null"]) == 3
    assert got["one", "2020-02-28"] == 3.0
    assert got["b", "2020-02-29"] == 3.0


@pytest.mark.parametrize("size", [1, 3, 32, 400])
def test_blocks_do_not_change_the_fill(spark, sf, size):
    p = orders_daily(spark, sf)
    for method in ("time", "bfill_ffill", None):
        want = G.fill_grid(p, K, method)
        got = G.fill_grid(p, K, method, size=size)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("freq", ["D", "W", "M"])
def test_fill_equals_pandas(spark, sf, freq):
    p = supplier_daily(spark, sf).where("series < 3")
    got = G.fill_grid(p, K, "linear_edges", freq).toPandas().sort_values(["series", "ds"])
    alias = {"D": "D", "W": "W", "M": "ME"}[freq]
    for s, raw in p.toPandas().groupby("series"):
        raw = raw.assign(ds=pd.to_datetime(raw.ds)).set_index("ds").sort_index()
        days = pd.date_range(raw.index.min(), raw.index.max(), freq=alias)
        want = raw.y.reindex(days).interpolate(method="linear").bfill().ffill()
        mine = got[got.series == s]
        assert list(pd.to_datetime(mine.ds)) == list(days)
        assert abs(mine.y.to_numpy() - want.to_numpy()).max() < 1e-6


def test_observed_values_survive(spark, sf):
    p = orders_daily(spark, sf)
    both = p.join(G.fill_grid(p, K).withColumnRenamed("y", "z"), ["series", "ds"])
    assert both.count() == p.count()
    assert both.where("y <> z or not real_value").count() == 0


def test_spine_missing_and_future(panel):
    p = panel({"a": {"2020-01-30": 1.0, "2020-02-02": 2.0}})
    assert G.date_spine(p, K).count() == 4
    assert sorted(str(r.ds) for r in G.missing_dates(p, K).collect()) == ["2020-01-31", "2020-02-01"]
    ahead = G.future_frame(p, K, 2, history=False).orderBy("ds").collect()
    assert [str(r.ds) for r in ahead] == ["2020-02-03", "2020-02-04"]
    month = G.date_spine(p, K, "M").collect()
    assert [str(r.ds) for r in month] == ["2020-01-31"]


def test_dedupe_keeps_the_first_row_whole(spark):
    rows = [("a", dt.date(2020, 1, 1), 2, 5.0), ("a", dt.date(2020, 1, 1), 1, None), ("a", dt.date(2020, 1, 2), 1, 7.0)]
    df = spark.createDataFrame(rows, "series string, ds date, ord int, y double")
    got = {r.ds: (r.ord, r.y) for r in G.dedupe_keep_first(df, ["series", "ds"], "ord").collect()}
    assert got == {dt.date(2020, 1, 1): (1, None), dt.date(2020, 1, 2): (1, 7.0)}
    # The first value is null, so it is filled from its neighbours, not from the duplicate.
    filled = values(G.prepare_panel(df, K, order="ord"))
    assert filled["a", "2020-01-01"] is None


def test_csv_round_trip_and_bad_values(spark, panel, tmp_path):
    p = panel({"a": {"2020-01-01": 1.5, "2020-01-02": 2.5}})
    as_output(p).write.option("header", True).csv(str(tmp_path / "ok"))
    assert values(read_panel_csv(spark, str(tmp_path / "ok"), K)) == values(p)
    spark.createDataFrame([("2020-01-01", "x")], "Date string, Price string").write.option(
        "header", True
    ).csv(str(tmp_path / "bad"))
    with pytest.raises(Exception):
        read_panel_csv(spark, str(tmp_path / "bad")).collect()


def test_build_panel_drops_null_dates(spark):
    df = spark.sql("SELECT 'a' AS k, TIMESTAMP'2020-01-01 10:00:00' AS t, 2.0D AS v UNION ALL SELECT 'a', NULL, 9.0D")
    assert [tuple(r) for r in build_panel(df, {"series": "k"}, "t", "v").collect()] == [
        ("a", dt.date(2020, 1, 1), 2.0)
    ]
    top = build_panel(df, {"series": "k"}, "t", "v", agg=F.max).collect()
    assert top[0].y == 2.0


def test_daily_fill_reads_its_panel_once(spark, sf):
    """The final adaptive plan has one scan; the second use is the same exchange."""
    filled = G.fill_grid(orders_daily(spark, sf), ["series"])
    filled.collect()
    plan = filled._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("size, reach", [(3, (0, 0)), (3, (2, 1)), (3, (20, 7)), (40, (365, 0)), (4096, (365, 30))])
def test_reach_equals_copies_of_the_filled_days(spark, panel, size, reach):
    """Gaps longer than blocks, null ends, a null series and a null key; every copy that an owned row can see."""
    odd = panel(
        {
            "gaps": {"2020-01-01": 1.0, "2020-01-02": 4.0, "2020-01-20": None, "2020-02-25": 2.0, "2020-02-26": 8.0},
            "ends": {"2020-01-03": None, "2020-01-15": 5.0, "2020-01-31": None},
            "null": {"2020-01-03": None, "2020-01-15": None},
            "one": {"2020-01-31": 3.0},
            None: {"2020-01-01": 3.0, "2020-01-09": 11.0},
        }
    )
    for method in ("time", "linear_edges"):
        day = G.fill_grid(odd, K, method, size=size)
        want = spread(day, *reach, size=size)
        got = G.fill_grid(odd, K, method, size=size, reach=reach)
        # A block with no day of the series keeps no row.
        want = want.join(want.where("_own").select("series", "_blk").distinct().withColumnsRenamed({"series": "s", "_blk": "k"}), F.expr("series <=> s AND _blk = k"), "left_semi")
        owned = got.where("_own").select("series", "_blk").distinct().withColumnsRenamed({"series": "s", "_blk": "k"})
        got = got.join(owned, F.expr("series <=> s AND _blk = k"), "left_semi").select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_windows_over_a_spread_grid_equal_those_over_days(spark, sf):
    p = supplier_daily(spark, sf).where("series < 4")
    families = lag_features((1, 30, 365)), centered_mean(21)
    for size in (100, 4096):
        want = over_blocks(G.fill_grid(p, K, size=size), K, *families, size=size)
        got = over_blocks(G.fill_grid(p, K, size=size, reach=(365, 10)), K, *families, size=size)
        assert got.columns == want.columns and got.count() == G.date_spine(p, K).count()
        assert got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        over_blocks(G.fill_grid(p, K, reach=(364, 10)), K, *families)
    with pytest.raises(ValueError):
        over_blocks(G.fill_grid(p, K, size=100, reach=(365, 10)), K, *families)


def test_supplier_features_shuffle_observations_not_days(spark, sf):
    """e2_eda_features_suppliers: no exchange above the step that makes the days."""
    from seriesloom.catalog import OPERATORS

    found = OPERATORS["e2_eda_features_suppliers"](spark, sf)
    days = G.fill_grid(supplier_daily(spark, sf), K).drop("real_value")
    want = eda.eda_features(days, K)
    assert found.columns == want.columns and found.count() == days.count()
    assert found.exceptAll(want).count() == 0
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    before, _, after = plan.partition("Generate explode(sequence(start")
    assert "Window" in before and "Exchange" not in before and "Exchange" in after
