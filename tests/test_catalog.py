import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
import check

# One query per catalog module; ``tools/check.py`` runs all of them.
NAMES = [
    "gf5_prepare_panel", "jn4_holiday_join", "win9_rolling_zscore", "agg8_calendar_rollup",
    "agg24_decompose_strength", "an4_clip_before_fill", "fs1_feature_selection", "ev3_time_series_split",
    "ev6_horizon_metrics", "sc3_weight_sweep", "snk5_report_table", "e2_eda_features", "snk1_write_forecast",
]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf, name):
    text, _, ok = check.compare(spark, con, name, sf)
    assert ok, text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["series", "year", "count", "mean", "std", "min", "max"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
