import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from panelcast.operators import labels, quality
from panelcast.plans.catalog import features_o, panel_o


def test_horizon_label_by_hand(spark):
    from conftest import panel_rows
    import datetime as dt

    rows = [{"account_id": "A", "month": dt.date(2024, i + 1, 1), "churned": c} for i, c in enumerate([0, 0, 0, 0, 0, 1])]
    rows += [{"account_id": "B", "month": dt.date(2024, i + 1, 1), "churned": c} for i, c in enumerate([0, 1])]
    rows += [{"account_id": "C", "month": dt.date(2024, i + 1, 1), "churned": 0} for i in range(3)]
    lab = labels.horizon_labels(panel_rows(spark, rows)).orderBy("account_id", "month")
    assert [r.churned_next_3mo for r in lab.collect()] == [0, 0, 1, 1, 1, 1, 1, 1, 0, 0, 0]


def test_time_split_disjoint_and_ordered(spark):
    p = panel_o(spark, SF0001)
    s = labels.time_split(p, 40, 12, 16)
    rng = {r.split: (r.lo, r.hi) for r in s.groupBy("split").agg(F.min("month").alias("lo"), F.max("month").alias("hi")).collect()}
    assert rng["train"][1] < rng["val"][0] and rng["val"][1] < rng["test"][0]
    months = s.select("month").distinct().count()
    assert months == 68
    with pytest.raises(ValueError, match="Insufficient"):
        labels.time_split(p, 60, 20, 20)


def test_horizon_split_and_cv_blocks(spark):
    p = panel_o(spark, SF0001)
    s = labels.time_split_horizon(p, 40, horizon=12)
    n_test = s.where("split = 'test'").select("month").distinct().count()
    assert n_test == p.select("month").distinct().count() - 40 - 12
    blocks = labels.cv_blocks(s.where("split = 'train'").drop("split"), 3)
    per = {r.cv_block: r.n for r in blocks.groupBy("cv_block").agg(F.countDistinct("month").alias("n")).collect()}
    assert sorted(per) == [0, 1, 2, 3] and per[1] == per[2] == per[3] == 10


def test_class_weights_balance(spark):
    lab = labels.horizon_labels(panel_o(spark, SF0001))
    w = labels.class_weights(lab, "churned_next_3mo")
    tot = {r[0]: r[1] for r in w.groupBy("churned_next_3mo").agg(F.sum("class_weight")).collect()}
    assert tot[0] == pytest.approx(tot[1])


def test_panel_profile_and_quality(spark):
    prof = quality.panel_profile(panel_o(spark, SF0001)).first()
    assert (prof.n_rows, prof.n_accounts, prof.n_churned_accounts) == (1411, 150, 38)
    dq = {r.rule: r.n_violations for r in quality.dq_expectations(features_o(spark, SF0001)).collect()}
    assert len(dq) >= 15 and all(v == 0 for v in dq.values()), dq


def test_account_lookup_reports_samples(spark):
    from panelcast.operators import scoring

    p = panel_o(spark, SF0001)
    assert scoring.account_lookup(p, "ACC-000010").count() > 0
    with pytest.raises(ValueError, match="Sample ids"):
        scoring.account_lookup(p, "ACC-NOPE", check=True)


def test_long_keys_stay_apart(spark):
    from panelcast.sources.adapters import events_panel, orders_panel

    orders, lines = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("orders", "lineitem"))
    plain = orders_panel(orders, lines)
    for add in (1_000_000, 100_000_000):  # keys of 7 and 9 digits
        moved = orders_panel(orders.withColumn("o_custkey", F.col("o_custkey") + add), lines)
        assert (moved.count(), moved.select("account_id").distinct().count()) == (plain.count(), 150)
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    users = events.select("user_id").distinct().count()
    far = events_panel(events.withColumn("user_id", F.col("user_id") + 1_000_000))
    assert far.select("account_id").distinct().count() == users


def test_one_customer_panel_equals_the_filtered_panel(spark):
    from panelcast.sources.adapters import orders_panel

    orders, lines = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("orders", "lineitem"))
    one = orders_panel(orders, lines, customer=10)
    want = orders_panel(orders, lines).where("account_id = 'ACC-000010'")
    assert sorted(map(str, one.collect())) == sorted(map(str, want.collect())) and one.count() > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,10)" in plan


def test_stratified_split_is_exact_and_by_account(spark):
    lab = labels.horizon_labels(panel_o(spark, SF0001)).select("account_id", "month", "churned_next_3mo")
    s = labels.stratified_split(lab, "churned_next_3mo", 0.8, seed=1)
    assert s.count() == s.select("account_id").distinct().count() == 150
    for r in s.groupBy("churned_next_3mo").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("t")).collect():
        assert r.t == int(r.n * 0.8)


def test_training_weights_ignore_the_test_rows(spark):
    lab = labels.time_split_horizon(labels.horizon_labels(panel_o(spark, SF0001)), 40, horizon=12)
    train = lab.where("split = 'train'")
    n, n1 = train.count(), train.where("churned_next_3mo = 1").count()
    w = labels.class_weights(train, "churned_next_3mo").where("churned_next_3mo = 1").first().class_weight
    assert w == pytest.approx(n / (2 * n1))


def test_stratified_split_keeps_accounts_without_a_label(spark):
    import datetime as dt

    rows = [(f"A{i:03d}", dt.date(2024, 1, 1), None if i % 4 == 0 else i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "account_id string, month date, churned int")
    out = labels.stratified_split(df, "churned", 0.8).collect()
    assert len(out) == 40 and sum(r.split == "train" and r.churned is None for r in out) == 8
