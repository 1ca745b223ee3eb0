import datetime as dt

import pytest

from conftest import panel_rows
from panelcast.operators.features import feature_names, generate_features, recent_vs_historical, rolling_features, change_features


def months(n, start=2024):
    return [dt.date(start + (i // 12), i % 12 + 1, 1) for i in range(n)]


def by_month(df, col):
    return [r[col] for r in df.orderBy("account_id", "month").collect()]


def approx(xs, ys, tol=1e-4):
    assert len(xs) == len(ys)
    for x, y in zip(xs, ys):
        if y is None:
            assert x is None
        else:
            assert x is not None and abs(x - y) < tol, (xs, ys)


def test_rolling_min_periods(spark):
    df = panel_rows(spark, [{"month": m, "current_month_revenue": float(v)} for m, v in zip(months(4), [1, 2, 3, 4])])
    r = rolling_features(df, "current_month_revenue")
    approx(by_month(r, "current_month_revenue_180d_sum"), [None, None, 6.0, 10.0])
    approx(by_month(r, "current_month_revenue_180d_avg"), [None, None, 2.0, 2.5])
    approx(by_month(r, "current_month_revenue_180d_max"), [None, None, 3.0, 4.0])
    approx(by_month(r, "current_month_revenue_180d_min"), [None, None, 1.0, 1.0])
    approx(by_month(r, "current_month_revenue_volatility_90d"), [None, 0.7071, 1.0, 1.0])
    f = generate_features(df)
    approx(by_month(f, "current_month_revenue_180d_sum"), [0.0, 0.0, 6.0, 10.0])


def test_percent_change_and_acceleration(spark):
    df = panel_rows(spark, [{"month": m, "current_month_revenue": float(v)} for m, v in zip(months(5), [0, 0, 5, 0, 4])])
    c = change_features(df, "current_month_revenue")
    approx(by_month(c, "current_month_revenue_percent_change"), [None, None, None, -1.0, None])
    approx(by_month(c, "current_month_revenue_acceleration"), [None, None, None, None, None])
    f = generate_features(df)
    approx(by_month(f, "current_month_revenue_percent_change"), [0.0, 0.0, 0.0, -1.0, 0.0])
    approx(by_month(f, "current_month_revenue_acceleration"), [0.0] * 5)


def test_previous_two_rows_stay_in_account(spark):
    rows = [{"account_id": "A", "month": m, "current_month_revenue": v} for m, v in zip(months(3), [1.0, 2.0, 3.0])]
    rows += [{"account_id": "B", "month": m, "current_month_revenue": v} for m, v in zip(months(2), [100.0, 200.0])]
    r = recent_vs_historical(panel_rows(spark, rows), "current_month_revenue")
    approx(by_month(r, "current_month_revenue_prev_two"), [None, 1.0, 3.0, None, 100.0])
    approx(by_month(r, "current_month_revenue_recent_vs_historical"), [None, 1.0, 0.75, None, 200.0 / 101.0])


def test_days_since_contact_floor(spark):
    rows = [
        {"account_id": "A", "month": dt.date(2024, 2, 1), "last_touchbase_date": dt.datetime(2024, 1, 31, 15)},
        {"account_id": "B", "month": dt.date(2024, 2, 1), "last_touchbase_date": dt.datetime(2024, 2, 1, 15)},
        {"account_id": "C", "month": dt.date(2024, 2, 1), "last_touchbase_date": dt.datetime(2024, 1, 15)},
    ]
    f = generate_features(panel_rows(spark, rows))
    assert by_month(f, "days_since_last_contact") == [0, -1, 17]


def test_substring_channel_flags(spark):
    rows = [
        {"account_id": "A", "enabled_channels": "webchat|card"},
        {"account_id": "B", "enabled_channels": None},
        {"account_id": "C", "enabled_channels": "agent|apple_pay|ivr"},
    ]
    f = generate_features(panel_rows(spark, rows)).orderBy("account_id").collect()
    assert (f[0]["has_web"], f[0]["has_card"], f[0]["number_of_channels"]) == (1, 1, 2)
    assert f[1]["number_of_channels"] == 0
    assert (f[2]["has_agent"], f[2]["has_apple_pay"], f[2]["has_ivr"], f[2]["number_of_channels"]) == (1, 1, 1, 3)


def test_tenure_and_channel_history(spark):
    rows = [
        {"month": dt.date(2024, 1, 1), "enabled_channels": "web|card|ivr"},
        {"month": dt.date(2024, 3, 1), "enabled_channels": "web"},
        {"month": dt.date(2025, 2, 1), "enabled_channels": "web|card"},
    ]
    f = generate_features(panel_rows(spark, rows))
    assert by_month(f, "account_age_months") == [0, 2, 13]
    assert by_month(f, "max_channels_ever") == [3, 3, 3]
    assert by_month(f, "channels_dropped") == [0, 2, 1]


def test_feature_contract_on_driver_panel(spark):
    from conftest import SF0001
    from panelcast.plans.catalog import panel_o

    p = panel_o(spark, SF0001)
    f = generate_features(p)
    assert len(f.columns) == 112 and len(feature_names()) == 100
    assert f.count() == p.count() == 1411
    from pyspark.sql import functions as F

    numeric = [c for c, t in f.dtypes if t in ("int", "bigint", "double")]
    nulls = f.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in numeric]).first()
    assert all(v == 0 for v in nulls)
    flags = ["has_web", "has_card", "has_agent", "has_ivr", "has_apple_pay"]
    bad = f.where(" OR ".join(f"{c} NOT IN (0, 1)" for c in flags) + " OR number_of_channels <> " + " + ".join(flags))
    assert bad.count() == 0


def test_guards(spark):
    df = panel_rows(spark, [{}])
    with pytest.raises(ValueError, match="Missing required columns"):
        generate_features(df.drop("late_payments"))
    with pytest.raises(ValueError, match="empty"):
        generate_features(df.where("false"))
