"""A share of the catalog next to DuckDB on the smallest tables, and its contract."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

SAMPLE = [
    "dash_window", "kpi_sensor", "normalize", "risk_passthrough", "horizon_labels", "rul_seconds", "seconds_to_next_by_key",
    "interval_flags_by_table", "interval_stats", "toggles", "ordered_split", "average_precision", "threshold_sweep",
    "minute_features", "rolling_quantiles", "reconcile", "stream_dlq", "lead_time",
]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, tables, name):
    got = rows_of(entry.queries()[name](spark, SF).toArrow())
    want = rows_of(tables.execute(entry.oracle_sql()[name]).to_arrow_table())
    assert got == want


def test_contract_of_the_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    without_sql = set(QUERIES) - set(ORACLE)
    assert without_sql == {
        "compressor_feature_table", "model_logistic", "model_gradient", "model_forest", "model_iforest", "top_weights", "forest_importances", "score_table",
    }
    assert entry.entry(spark).columns[:2] == ["dt", "operating_state"]
