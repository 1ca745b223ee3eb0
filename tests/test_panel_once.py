"""Queries that read the panel in several jobs build it once; the panel's channels come from one aggregate."""

import datetime as dt

import pytest

from panelcast.plans import training
from panelcast.sources.adapters import orders_panel


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    orders, lines = [], []
    for i in range(240):
        day = dt.datetime(1992 + i // 48, i % 12 + 1, 5)
        orders.append((i, i % 4, "P" if i % 3 else "F", 100.0 + i, day, f"{i % 5 + 1}-X" if i % 12 else None))
        lines.append((i, "R" if i % 2 else "N", float(i % 50), "F" if i % 3 else "O"))
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
                          ).write.parquet(f"{base}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_returnflag string, l_quantity double, l_linestatus string").write.parquet(f"{base}/lineitem.parquet")
    return str(base)


def test_split_periods_come_from_the_written_panel(spark, tables, monkeypatch):
    seen = []
    real = training.labels.period_table

    def watched(df, period="month"):
        seen.extend(df.inputFiles())
        return real(df, period)

    monkeypatch.setattr(training.labels, "period_table", watched)
    assert training.train_test(spark, tables).columns[:3] == ["account_id", "month", "split"]
    assert seen and not [f for f in seen if "lineitem.parquet" in f or "orders.parquet" in f]


def test_round_trip_writes_from_one_panel(spark, tables, monkeypatch):
    seen = []
    real = training.io.save_table
    monkeypatch.setattr(training.io, "save_table", lambda df, *a, **k: (seen.extend(df.inputFiles()), real(df, *a, **k))[1])
    rows = training.q_io_roundtrip(spark, tables).drop("format").distinct().collect()
    assert len(rows) == 1 and rows[0]["n_accounts"] == 4
    assert seen and not [f for f in seen if "lineitem.parquet" in f or "orders.parquet" in f]


def test_channels_of_a_month_by_one_aggregate(spark, tables):
    panel = orders_panel(spark.read.parquet(f"{tables}/orders.parquet"), spark.read.parquet(f"{tables}/lineitem.parquet"))
    assert "bit_or" in panel._jdf.queryExecution().optimizedPlan().toString()
    rows = [(i % 4, dt.date(1992 + i // 48, i % 12 + 1, 1), ["web", "card", "agent", "ivr", "apple_pay"][i % 5] if i % 12 else None) for i in range(240)]
    want = {}
    for account, month, channel in rows:
        want.setdefault((f"ACC-{account:06d}", month), set()).update([channel] if channel else [])
    got = {(r.account_id, r.month): r.enabled_channels for r in panel.collect()}
    assert got == {k: "|".join(sorted(v)) for k, v in want.items()} and "" in got.values()
