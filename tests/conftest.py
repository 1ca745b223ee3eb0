import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelcast.session import get_spark

    s = get_spark(app="panelcast-tests", master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def panel_rows(spark, rows):
    """Tiny canonical panels for hand-computed goldens (FIXTURES.md section 2)."""
    import datetime as dt

    from panelcast.sources.io import PANEL_SCHEMA

    full = []
    for r in rows:
        base = {
            "account_id": "ACC-0001",
            "month": dt.date(2024, 1, 1),
            "current_month_transactions": 1,
            "current_month_revenue": 1.0,
            "total_tickets": 0,
            "escalated_tickets": 0,
            "late_payments": 0,
            "enabled_channels": "web",
            "self_service_percentage": 50.0,
            "last_touchbase_date": dt.datetime(2023, 12, 15),
            "average_resolution_time_hours": 1.0,
            "churned": 0,
        }
        base.update(r)
        full.append(tuple(base[f.name] for f in PANEL_SCHEMA.fields))
    return spark.createDataFrame(full, PANEL_SCHEMA)
