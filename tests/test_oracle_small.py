"""Spark query vs DuckDB oracle on the smallest driver tables (a subset; the
full set runs with ``python check_oracle.py``)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, digest, norm
from conftest import SF0001

NAMES = [
    "panel_orders", "panel_events", "full_features", "features_events", "dq_expectations", "month_spine",
    "last_record", "stratified_split", "ab_groups", "similar_accounts", "dq_report", "feature_psi", "split_rates", "cv_folds", "tier_distribution", "roc_auc", "pr_points",
    "threshold_custom", "compare_models", "segment_summary", "explain_zscore", "cohort_rollup", "what_if",
    "stream_scoring", "stream_raw_scoring", "campaign_impact", "io_roundtrip", "threshold_table", "feature_drift",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_a_callable():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 95


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF0001).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert digest(norm(s)) == digest(norm(o))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 112
    assert df.count() == 1411
