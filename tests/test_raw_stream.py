"""Raw rows scored in the stream: equal to the batch features, out of order, late, repeated, restarted."""

import datetime as dt
import uuid

import numpy as np
from conftest import panel_rows

from panelcast.operators.features import generate_features
from panelcast.session import scratch_root
from panelcast.sources.io import PANEL_SCHEMA
from panelcast.streaming import raw_rows as R


def months(n, start=2020):
    return [dt.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def folders(spark):
    base = f"{scratch_root(spark)}/streams/{uuid.uuid4().hex}"
    return f"{base}/source", base


def land(spark, src, rows):
    panel_rows(spark, rows).coalesce(1).write.mode("append").parquet(src)


def close(spark, src, base):
    R.punctuation(spark, PANEL_SCHEMA, dt.date(2035, 1, 1)).write.mode("append").parquet(src)
    return spark.read.parquet(R.run_raw_stream(spark, src, base, PANEL_SCHEMA, lambda f: f))


def some_rows(seed, accounts=3, n=14):
    rng = np.random.default_rng(seed)
    pick = lambda v, none=0.1: None if rng.random() < none else v
    return [
        {"account_id": f"A{a}", "month": m, "current_month_transactions": pick(int(rng.integers(0, 4))),
         "current_month_revenue": pick(float(rng.integers(0, 500)) / 7), "escalated_tickets": pick(int(rng.integers(0, 3))),
         "late_payments": pick(int(rng.integers(0, 3))), "enabled_channels": pick(str(rng.choice(["web", "web,email", "phone,web,email", ""]))),
         "self_service_percentage": pick(float(rng.random() * 100)), "average_resolution_time_hours": pick(float(rng.random())),
         "last_touchbase_date": pick(dt.datetime(2020, 1, 1, 5, 6, 7, 123456))}
        for a in range(accounts) for m in months(n) if rng.random() < 0.9
    ]


def test_streamed_features_are_the_batch_features_with_rows_out_of_order_and_restarts(spark):
    rows = some_rows(1)
    src, base = folders(spark)
    rng = np.random.default_rng(2)
    # three arrivals, each a run of its own; a row comes up to three months late
    at = [(r["month"].year - 2020) * 12 + r["month"].month - 1 + int(rng.integers(0, 4)) for r in rows]
    for part in (range(0, 6), range(6, 11), range(11, 99)):
        mine = [r for r, k in zip(rows, at) if k in part]
        land(spark, src, [mine[i] for i in rng.permutation(len(mine))])
        R.run_raw_stream(spark, src, base, PANEL_SCHEMA, lambda f: f)
    got = close(spark, src, base)
    want = generate_features(panel_rows(spark, rows))
    assert got.columns == want.columns
    key = lambda r: (r.account_id, r.month)
    a, b = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [key(r) for r in a] == [key(r) for r in b] and len(a) == len(rows)
    for x, y in zip(a, b):
        for c in want.columns:
            same = x[c] == y[c] or (isinstance(y[c], float) and abs(x[c] - y[c]) < 1e-7 * max(1, abs(y[c])))
            assert same, (c, key(x), x[c], y[c])


def test_late_repeated_and_odd_rows(spark):
    src, base = folders(spark)
    m = months(24)
    run = lambda: R.run_raw_stream(spark, src, base, PANEL_SCHEMA, lambda f: f)
    land(spark, src, [{"account_id": "A", "month": x, "current_month_revenue": 1.0} for x in (m[0], m[2], m[20])] + [{"account_id": "B", "month": None}])
    run()
    land(spark, src, [{"account_id": "A", "month": m[1], "current_month_revenue": 7.0},  # behind the watermark: dropped
                      {"account_id": "A", "month": m[19], "current_month_revenue": 3.0},  # out of order, in time
                      {"account_id": "A", "month": m[20], "current_month_revenue": 9.0}])  # the month has a row already
    run()
    run()  # nothing new
    got = {(r.account_id, r.month): r for r in close(spark, src, base).collect()}
    assert sorted(got) == [("A", m[0]), ("A", m[2]), ("A", m[19]), ("A", m[20])]
    assert got["A", m[20]].current_month_revenue == 1.0 and got["A", m[20]].current_month_revenue_180d_sum == 6.0
    assert got["A", m[19]].account_age_months == 19 and got["A", m[2]].current_month_revenue_percent_change == 0.0
    assert run() and spark.read.parquet(f"{base}/sink").count() == 4


def test_state_holds_a_bounded_number_of_rows():
    import json

    class State:
        exists, held = False, None
        def getCurrentWatermarkMs(self): return 10**15
        def update(self, v): self.held, self.exists = v, True
        @property
        def get(self): return self.held

    import pandas as pd
    s = State()
    out = list(R._release(("A",), [pd.DataFrame({"_at": range(1000), "_channels": [2] * 1000, "_row": ["{}"] * 1000})], s))[0]
    assert len(out) == 1000 and len(json.loads(s.held[0])[2]) == R.REACH and out["_recent"].iloc[-1].count("{}") == R.REACH


def test_accounts_of_a_shared_state_are_those_with_their_own():
    """A call for every account cost milliseconds each; now a call serves all accounts of a state."""
    import json
    import random

    import pandas as pd

    class State:
        def __init__(self): self.exists, self.held, self.mark, self.out = False, None, 0, None
        def getCurrentWatermarkMs(self): return self.mark
        def update(self, v): self.held, self.exists = v, True
        def setTimeoutTimestamp(self, t): self.out = t
        @property
        def get(self): return self.held

    def frame(rows):
        return pd.DataFrame([(k, at, at % 5, json.dumps({"at": at, "n": n})) for k, at, n in rows], columns=["_key", "_at", "_channels", "_row"])

    rng, shared, own, got, want = random.Random(3), State(), {}, [], []
    for batch in range(12):
        rows = [(rng.choice(["A", "B", "C", None]), batch * 10 + rng.randrange(1, 40), n) for n in range(rng.randrange(9))]
        mark = batch * 10
        shared.mark = mark
        for f in R._release_shared((7,), [frame(rows[:4]), frame(rows[4:])], shared):
            got += f.values.tolist()
        for k in "ABC":
            state = own.setdefault(k, State())
            state.mark = mark
            if state.exists or any(r[0] == k for r in rows):
                want += next(R._release((k,), [frame([r for r in rows if r[0] == k])], state)).values.tolist()
        outs = [s.out for s in own.values() if s.exists and json.loads(s.held[0])[3]]
        assert not outs or shared.out == min(outs)
        assert json.loads(shared.held[0]) == {k: json.loads(s.held[0]) for k, s in own.items() if s.exists}
    assert sorted(got) == sorted(want) and len(got) >= 15


def test_states_do_not_grow_with_the_accounts(spark):
    import datetime as dt

    rows = panel_rows(spark, [{"account_id": f"A{i:04d}", "month": dt.date(2024, 1, 1)} for i in range(300)])
    calls = spark.sparkContext.accumulator(0)
    real = R._release_shared

    def counted(key, frames, state):
        calls.add(1)
        yield from real(key, frames, state)

    import tempfile

    base = tempfile.mkdtemp()
    rows.write.parquet(f"{base}/src")
    R.punctuation(spark, rows.schema, dt.date(2200, 1, 1)).write.mode("append").parquet(f"{base}/src")
    R._release_shared = counted
    try:
        recent = R.recent_rows(spark.readStream.schema(rows.schema).parquet(f"{base}/src"), buckets=8)
        q = recent.writeStream.format("memory").queryName("shared_states").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        R._release_shared = real
    assert spark.table("shared_states").count() == 300 and 0 < calls.value <= 3 * 8
