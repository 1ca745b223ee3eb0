import pytest
from pyspark.sql import functions as F

from panelcast.operators.saved_segments import SegmentStore
from panelcast.plans.dashboard import similar_to_all


def test_save_reload_replace_remove(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0, "a"), (2, None, "b"), (3, 1.0, None)], "id int, x double, tier string")
    store = SegmentStore(spark, str(tmp_path / "store"))
    assert store.members(df, ["id"]).count() == 0 and store.in_force().count() == 0
    assert store.save("high", "x > 2", df) == 1 and store.save("b's", "tier = 'b'", df) == 1
    assert store.save("high", "x >= 1", df) == 2
    again = SegmentStore(spark, str(tmp_path / "store"))
    got = sorted(tuple(r) for r in again.members(df, ["id"]).collect())
    assert got == [("b's", 1, 2), ("high", 2, 1), ("high", 2, 3)]
    assert again.remove("high") == 3 and again.history().count() == 4
    assert [r.name for r in store.in_force().collect()] == ["b's"]
    with pytest.raises(KeyError):
        store.remove("high")
    assert store.save("high", "x < 0", df) == 4
    for bad in ("y > 1", "x + 1", "count(x) > 1", "x >", "row_number() over (order by x) > 1", "explode(array(true))"):
        with pytest.raises(ValueError):
            store.save("bad", bad, df)
    with pytest.raises(ValueError):
        store.save(" ", "x > 1", df)
    assert store.history().where(F.col("name") == "bad").count() == 0


def test_similar_accounts_of_all_segments(spark):
    import datetime as dt

    rows = [(f"A{i:02d}", dt.date(2024, m, 1), ["High", "Low"][i % 2] if i < 20 else "One", float(i * i % 17 + m), float(i % 5)) for i in range(21) for m in (1, 2)]
    s = spark.createDataFrame(rows, "account_id string, month date, risk_tier string, u double, v double")
    got = {}
    for r in similar_to_all(s, ["u", "v"], 3).collect():
        got.setdefault(r.target_account, {})[r["rank"]] = (r.account_id, r.distance)
    last = [r for r in rows if r[1].month == 2]
    import numpy as np

    z = np.array([r[3:] for r in last])
    z = (z - z.mean(axis=0)) / z.std(axis=0, ddof=1)
    for i, r in enumerate(last):
        near = sorted((round(float(np.sqrt(((z[i] - z[j]) ** 2).sum())), 9), o[0]) for j, o in enumerate(last) if j != i and o[2] == r[2])[:3]
        mine = [got.get(r[0], {})[k + 1] for k in range(len(near))]
        assert [round(d, 9) for _, d in mine] == [d for d, _ in near]
    assert "A20" not in got
