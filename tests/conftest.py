import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from seriesloom.session import local_session

    session = local_session(
        "4",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def panel(spark):
    """Build a panel from ``{series: {date text: value}}``."""

    def make(series):
        rows = [(s, d, v) for s, points in series.items() for d, v in points.items()]
        df = spark.createDataFrame(rows, "series string, d string, y double")
        return df.selectExpr("series", "cast(d as date) ds", "y")

    return make


@pytest.fixture
def daily(spark):
    """A gap-free series of a SQL expression in ``t`` (0-based day) and ``ds``."""

    def make(expr, days, start="2015-01-01", series="a"):
        return spark.sql(
            f"""SELECT '{series}' AS series, ds, CAST({expr} AS DOUBLE) AS y FROM (
            SELECT CAST(id AS INT) AS t, date_add(DATE'{start}', CAST(id AS INT)) AS ds FROM range({days}))"""
        )

    return make
