import datetime as dt

from conftest import panel_rows
from panelcast.operators import quality, spine


def test_month_spine_fills_gaps(spark):
    rows = [
        {"month": dt.date(2024, 1, 1), "current_month_transactions": 3, "enabled_channels": "web"},
        {"month": dt.date(2024, 4, 1), "current_month_transactions": 5, "churned": 1},
    ]
    s = spine.month_spine(panel_rows(spark, rows)).orderBy("month").collect()
    assert [r.month for r in s] == [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]
    assert [r.current_month_transactions for r in s] == [3, 0, 0, 5]
    assert [r.observed for r in s] == [1, 0, 0, 1]
    assert [r.enabled_channels for r in s] == ["web", "", "", "web"]
    assert [r.churned for r in s] == [0, 0, 0, 1]


def test_month_spine_ends_with_the_churn_row(spark):
    rows = [{"month": dt.date(2024, m, 1), "churned": int(m == 3)} for m in (1, 3, 4, 6)]
    s = spine.month_spine(panel_rows(spark, rows)).orderBy("month").collect()
    assert [(r.month.month, r.churned, r.observed) for r in s] == [(1, 0, 1), (2, 0, 0), (3, 1, 1)]


def test_last_record_takes_last_non_null_per_column(spark):
    rows = [
        {"month": dt.date(2024, 1, 1), "enabled_channels": "web", "current_month_revenue": 5.0},
        {"month": dt.date(2024, 2, 1), "enabled_channels": None, "current_month_revenue": 7.0},
    ]
    r = spine.last_record(panel_rows(spark, rows)).first()
    assert r.month == dt.date(2024, 2, 1)
    assert r.enabled_channels == "web" and r.current_month_revenue == 7.0


def test_dq_expectations_flag_violations(spark):
    rows = [
        {"account_id": "A", "month": dt.date(2024, 1, 1), "churned": 1},
        {"account_id": "A", "month": dt.date(2024, 2, 1), "churned": 1, "escalated_tickets": 3, "total_tickets": 1},
        {"account_id": "B", "month": dt.date(2024, 1, 1), "self_service_percentage": 120.0, "enabled_channels": "web|fax"},
        {"account_id": "C", "month": dt.date(2024, 1, 1), "late_payments": -1},
        {"account_id": "D", "month": dt.date(2024, 1, 1)},
        {"account_id": "D", "month": dt.date(2024, 1, 1)},
    ]
    dq = {r.rule: r.n_violations for r in quality.dq_expectations(panel_rows(spark, rows)).collect()}
    assert dq["one_churn_per_account"] == 1
    assert dq["no_row_after_churn"] == 1
    assert dq["escalated_le_total"] == 1
    assert dq["self_service_in_0_100"] == 1
    assert dq["channels_in_valid_set"] == 1
    assert dq["late_payments_non_negative"] == 1
    assert dq["churned_binary"] == 0
    assert dq["unique_account_period"] == 2
