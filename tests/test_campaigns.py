"""Campaign impact against brute force."""

import datetime as dt
import statistics

import numpy as np
import pytest

from panelcast.operators.campaigns import campaign_impact, campaign_scores

SCORES = "account_id string, month date, churn_risk_score double, churned int, campaign string"
CAMPAIGNS = "account_id string, campaign string, start_date date, end_date date, churned string"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=int(n))


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    scores = [(f"A{a}", day(n), None if rng.random() < 0.05 else float(rng.random()), int(rng.random() < 0.05), "x")
              for a in range(6) for n in range(60) if rng.random() < 0.6]
    camps = [(f"A{rng.integers(0, 8)}", f"c{rng.integers(0, 3)}", day(s := rng.integers(-5, 65)), day(s + rng.integers(0, 9)), "y") for _ in range(80)]
    rows = camp_rows(spark, scores, camps + camps[:5], 10)
    assert len(rows) == len(set(camps))
    for r in rows:
        mine = [x for x in scores if x[0] == r.account_id and x[2] is not None]
        before = [x[2] for x in mine if r.start_date - dt.timedelta(10) <= x[1] < r.start_date]
        after = [x for x in mine if r.end_date < x[1] <= r.end_date + dt.timedelta(10)]
        last = [x[2] for x in mine if x[1] < r.start_date][-1:]
        assert r.risk_at_start == (last[0] if last else None)
        assert r.risk_before == (pytest.approx(statistics.fmean(before)) if before else None)
        assert r.risk_after == (pytest.approx(statistics.fmean(x[2] for x in after)) if after else None)
        assert r.churned_after == (max(x[3] for x in after) if after else None)


def camp_rows(spark, scores, camps, days=60):
    return campaign_scores(spark.createDataFrame(scores, SCORES), spark.createDataFrame(camps, CAMPAIGNS), days).collect()


def test_nulls_ends_and_empty_tables(spark):
    scores = [("A", day(1), 0.9, 0, ""), ("A", day(9), 0.2, 0, ""), (None, day(1), 0.5, 1, ""), ("A", None, 0.1, 1, ""), ("B", day(2), 0.6, 0, ""), ("B", day(7), 0.7, 1, "")]
    camps = [("A", "c", day(5), None, ""), ("A", None, day(5), day(2), ""), (None, "c", day(5), day(5), ""), ("A", "c", None, day(5), ""), ("B", "c", day(5), day(5), "")]
    rows = {(r.account_id, r.campaign): r for r in camp_rows(spark, scores, camps)}
    assert set(rows) == {("A", "c"), ("A", None), ("B", "c")} and rows["A", "c"][3:] == rows["A", None][3:] == (day(5), 0.9, 0.9, 0.2, 0)
    assert camp_rows(spark, scores, []) == [] and camp_rows(spark, [], camps)[0].risk_at_start is None
    per = campaign_scores(spark.createDataFrame(scores, SCORES), spark.createDataFrame(camps, CAMPAIGNS))
    got = {r.campaign: r for r in campaign_impact(per, at_risk=0.5, value=100.0, cost=10.0).collect()}
    c = got["c"]
    assert (c.n_contacts, c.n_compared, c.n_at_risk, c.n_saved, c.save_rate, c.roi) == (2, 2, 2, 1, 0.5, 80.0)
    assert c.avg_change == pytest.approx(((0.2 - 0.9) + (0.7 - 0.6)) / 2)


def test_one_shuffle_for_the_windows_and_the_group(spark):
    s = spark.createDataFrame([("A", day(1), 0.9, 0, "")], SCORES)
    c = spark.createDataFrame([("A", "c", day(5), day(6), "")], CAMPAIGNS)
    plan = campaign_scores(s, c)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("ReusedExchange") <= 2 and "Join" not in plan  # the union, and the distinct campaigns
