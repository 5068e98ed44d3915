"""Times the headline queries; prints one JSON line.

Every query is written to the ``noop`` sink, so all rows and columns are
computed and nothing is collected.  Results are not rounded: that is part of the
comparison with SQL, not of the operators.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from seriesloom.catalog import OPERATORS  # noqa: E402
from seriesloom.session import local_session  # noqa: E402

HEADLINE = [
    "src1_build_panel_supplier",
    "gf1_interpolate_time",
    "gf1_interpolate_time_suppliers",
    "gf5_prepare_panel",
    "cal15_time_features",
    "win_all_suppliers",
    "e2_eda_features",
    "e2_eda_features_suppliers",
    "win16_autocorrelation",
    "agg8_calendar_rollup",
    "agg16_boxplot_by_year",
    "dq3_describe_suppliers",
    "agg18_correlation_matrix",
    "fs1_feature_selection",
    "an3_trend_outliers",
    "an5_decompose",
    "an6_adf_test",
    "ev3_time_series_split",
    "ev4_cv_scores",
    "ev6_horizon_metrics",
    "sc3_weight_sweep",
    "md8_additive_fit",
    "ev5_rolling_origin_cv",
    "md5_forest_search",
    "md5_param_search",
    "e1_run_eda",
    "e4_train",
    "e7_analyze_timeseries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), spark__ui__showConsoleProgress="false")
    # Start the JVM, the Python workers and the parquet reader before timing.
    OPERATORS["agg18_correlation_matrix"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        OPERATORS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:34s} {times[name]:8.3f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
