"""The driver contract, and whole-result comparison with SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import compare
from checks.oracles import oracle_sql
from checks.queries import queries

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="driver tables not present")

# Results that no SQL over the tables can state.
ROWS_ONLY = set()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in Path(SMALL).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_sql_except_the_listed_ones():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries()) <= set(contract.queries())


def test_entry_reports_every_detector(spark):
    rows = contract.entry(spark).collect()
    assert {r["detector_name"] for r in rows} == {"capacity_fade", "stuck_sensor", "thermal_runaway"}


@pytest.mark.parametrize(
    "name",
    ["sat_minute_rollup", "fleet_health_snapshot", "eclipse_intervals", "inject_layered",
     "heat_residual", "detector_scorecard", "dq_model_checks", "json_dead_letter", "time_order_check"],
)
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SMALL, name).startswith("ok")
