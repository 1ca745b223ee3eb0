"""Plan-shape regression tests: the scale properties the design relies on."""

import re

from conftest import SF0001
import __spark_entry__ as E


def plan_of(spark, name):
    df = E.queries()[name](spark, SF0001)
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_stage_shuffles_once_by_account(spark):
    plan = plan_of(spark, "full_features")
    assert len(re.findall(r"Exchange hashpartitioning\(account_id#\d+, \d+\)", plan)) == 1
    assert len(re.findall(r"\bWindow \[", plan)) >= 4  # adapter + features + acceleration share it
    # the only single-partition exchange is the one-row global maximum
    assert plan.count("Exchange SinglePartition") == 1


def test_explanations_are_shuffle_free_after_materialize(spark):
    for name in ("explain_zscore", "top_factors"):
        plan = plan_of(spark, name)
        assert "hashpartitioning" not in plan, name
        # the statistics are global aggregates with a partial (map-side) step
        assert "partial_avg" in plan and "partial_stddev_samp" in plan


def test_curves_use_bucketed_prefix_sums(spark):
    plan = plan_of(spark, "roc_points")
    assert re.search(r"windowspecdefinition\(_bucket", plan)
    assert "partial_sum" in plan  # distinct-score counts are combined map-side
