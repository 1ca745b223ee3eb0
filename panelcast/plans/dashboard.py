"""Tier-2 dashboard operations (the data work behind the planned dashboard pages)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.functions.expressions import q
from panelcast.operators import explain, labels, metrics, scoring
from panelcast.operators.quantiles import column_quantiles, long_values
from panelcast.session import materialize
from panelcast.plans.catalog import (
    EVAL_LABEL,
    K_THRESHOLDS,
    LOOKUP_ACCOUNT,
    TOP_N_EXPLAIN,
    model_feature_names,
    query,
    scored_lazy,
    scored_o,
    SCORE_DIGITS,
    scored_stats,
    stats_with_importance,
    two_models,
)

# ---- parameters of the dashboard queries ---------------------------------------
HIST_BINS = 20
CONTACT_COST = 50.0          # cost per contacted account
ACCOUNT_VALUE = 1000.0       # value of an account kept
SAVE_RATE = 0.3              # share of contacted churners kept
TRAJECTORY_ROWS = 6
AGE_BUCKET = 6               # months
ALERT_RISE = 0.2             # relative rise of the score in one period
HIGH_VALUE_REVENUE = 500000.0
CUSTOM_SEGMENTS = {
    "late_payers": "late_payments > 0",
    "low_self_service": "self_service_percentage < 30",
    "high_value_at_risk": "current_month_revenue_90d_avg >= 500000 AND churn_risk_score >= 0.4",
    "dropped_channels": "channels_dropped > 0",
}
WHAT_IF = [
    ("no_late_payments", {"late_payments": "0"}),
    ("self_service_plus_20", {"self_service_percentage": "least(self_service_percentage + 20, 100)"}),
    ("channels_restored", {"channels_dropped": "0"}),
]
DRIFT_TRAIN_MONTHS = 40
DRIFT_RECENT_FROM = 53
DRIFT_RECENT_TO = 68
N_CLUSTERS = 4
N_NEIGHBOURS = 10
AB_GROUPS = 2
AB_SEED = 7
STREAM_FILES = 64  # files of a micro-batch
CLUSTER_FEATURES = [
    "current_month_transactions", "current_month_revenue", "total_tickets", "escalated_tickets", "late_payments",
    "self_service_percentage", "average_resolution_time_hours",
]
# ---------------------------------------------------------------------------------


@query("kpi_rollup")
def q_kpi(spark, d):
    s = scored_lazy(spark, d)
    return s.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("account_id").alias("n_accounts"),
        F.avg("churn_risk_score").alias("mean_risk"),
        F.count_if(F.col("risk_tier") == "High Risk").alias("n_high"),
        F.count_if(F.col("risk_tier") == "Medium Risk").alias("n_medium"),
        F.count_if(F.col("risk_tier") == "Low Risk").alias("n_low"),
        F.count_if(F.col("risk_tier") == "Very Safe").alias("n_safe"),
        F.count_if(F.col("churn_risk_score") >= 0.5).alias("predicted_churners"),
    )


@query("risk_histogram")
def q_hist(spark, d):
    s = scored_lazy(spark, d)
    b = F.least(F.floor(F.col("churn_risk_score") * HIST_BINS), F.lit(HIST_BINS - 1)).cast("int")
    return s.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "bin", (F.col("bin") / HIST_BINS).alias("bin_low"), ((F.col("bin") + 1) / HIST_BINS).alias("bin_high"), "n_rows"
    )


@query("high_risk_top_factor")
def q_high_risk_top_factor(spark, d):
    """High-risk rows with score >= 0.5 and their single strongest factor."""
    s = scored_o(spark, d)
    stats = stats_with_importance(scored_stats(spark, d, s))
    rows = scoring.high_risk(s).where(F.col("churn_risk_score") >= 0.5)
    top = explain.explain_deviation(rows, stats, None, model_feature_names(), top_n=1)
    return rows.select("account_id", "month", "churn_risk_score", "risk_tier").join(
        top.select("account_id", "month", F.col("feature").alias("top_factor"), "z_score"), ["account_id", "month"]
    )


@query("threshold_table")
def q_threshold_table(spark, d):
    return metrics.metrics_at_thresholds(scored_lazy(spark, d), K_THRESHOLDS, label=EVAL_LABEL)


@query("cost_benefit")
def q_cost_benefit(spark, d):
    t = metrics.metrics_at_thresholds(scored_lazy(spark, d), K_THRESHOLDS, label=EVAL_LABEL)
    saved = F.col("tp") * SAVE_RATE
    cost = (F.col("tp") + F.col("fp")) * CONTACT_COST
    benefit = saved * ACCOUNT_VALUE
    return t.select(
        "threshold",
        "tp",
        "fp",
        cost.alias("cost"),
        benefit.alias("benefit"),
        (benefit - cost).alias("net_value"),
        F.try_divide(benefit - cost, cost).alias("roi"),
    ).select("*", (F.row_number().over(Window.orderBy(F.desc_nulls_last("roi"), "threshold")) == 1).alias("best_roi"))  # a row for each threshold


@query("risk_trajectory")
def q_trajectory(spark, d):
    """Last TRAJECTORY_ROWS periods per account with the change vs the previous period."""
    s = scored_lazy(spark, d)
    w = Window.partitionBy("account_id").orderBy("month")
    wd = Window.partitionBy("account_id").orderBy(F.col("month").desc())
    x = s.select(
        "account_id",
        "month",
        "churn_risk_score",
        (F.col("churn_risk_score") - F.lag("churn_risk_score").over(w)).alias("score_change"),
        F.row_number().over(wd).alias("periods_back"),
    )
    return x.where(F.col("periods_back") <= TRAJECTORY_ROWS)


@query("cohort_rollup")
def q_cohort(spark, d):
    """Joining quarter x tenure bucket, with ROLLUP subtotals."""
    s = scored_lazy(spark, d)
    first = F.min("month").over(Window.partitionBy("account_id"))
    x = s.select(
        F.trunc(first, "quarter").alias("cohort_quarter"),
        (F.floor(F.col("account_age_months") / AGE_BUCKET) * AGE_BUCKET).cast("bigint").alias("age_bucket"),
        "churn_risk_score",
        EVAL_LABEL,
    )
    return x.rollup("cohort_quarter", "age_bucket").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("churn_risk_score").alias("avg_risk"),
        F.avg(F.col(EVAL_LABEL).cast("double")).alias("churn_rate"),
    )


@query("portfolio_risk")
def q_portfolio(spark, d):
    """Revenue-weighted risk per period and its change (window over the per-period table)."""
    s = scored_lazy(spark, d)
    per = s.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.sum("current_month_revenue").alias("revenue"),
        F.try_divide(F.sum(F.col("churn_risk_score") * F.col("current_month_revenue")), F.sum("current_month_revenue")).alias(
            "weighted_risk"
        ),
    )
    w = Window.orderBy("month")  # one row per period: bounded by the calendar
    return per.select("*", (F.col("weighted_risk") - F.lag("weighted_risk").over(w)).alias("risk_change"))


@query("feature_drift")
def q_drift(spark, d):
    """Mean shift (in training std units) and std ratio, recent vs training periods."""
    s = scored_o(spark, d)
    idx, _ = labels.period_table(s)
    x = s.join(F.broadcast(idx.select("month", "period_idx")), "month")
    feats = model_feature_names()
    tr = f"period_idx <= {DRIFT_TRAIN_MONTHS}"
    rc = f"period_idx BETWEEN {DRIFT_RECENT_FROM} AND {DRIFT_RECENT_TO}"
    parts = []
    for start in range(0, len(feats), explain.STATS_CHUNK):
        chunk = feats[start : start + explain.STATS_CHUNK]
        aggs = []
        for i, f in enumerate(chunk):
            v = f"CAST({q(f)} AS DOUBLE)"
            aggs += [
                f"avg(CASE WHEN {tr} THEN {v} END) AS _mt{i}",
                f"stddev_samp(CASE WHEN {tr} THEN {v} END) AS _st{i}",
                f"avg(CASE WHEN {rc} THEN {v} END) AS _mr{i}",
                f"stddev_samp(CASE WHEN {rc} THEN {v} END) AS _sr{i}",
            ]
        body = ", ".join(f"'{f}', _mt{i}, _st{i}, _mr{i}, _sr{i}" for i, f in enumerate(chunk))
        parts.append(
            x.selectExpr(*aggs).selectExpr(
                f"stack({len(chunk)}, {body}) AS (feature, train_mean, train_std, recent_mean, recent_std)"
            )
        )
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return long.select(
        "*",
        F.try_divide(F.col("recent_mean") - F.col("train_mean"), F.col("train_std")).alias("mean_shift"),
        F.try_divide(F.col("recent_std"), F.col("train_std")).alias("std_ratio"),
    )


@query("custom_segments")
def q_custom_segments(spark, d):
    """Named predicate strings -> members counted in one pass (segments may overlap)."""
    s = scored_lazy(spark, d)
    members = [F.when(F.coalesce(F.expr(pred), F.lit(False)), F.lit(name)) for name, pred in CUSTOM_SEGMENTS.items()]
    x = s.select(F.explode(F.array_compact(F.array(*members))).alias("segment"), "account_id", "churn_risk_score")
    return x.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("account_id").alias("n_accounts"),
        F.avg("churn_risk_score").alias("avg_risk"),
    )


#: A name saved again with another predicate.
REPLACED_SEGMENT = ("late_payers", "late_payments >= 2")


@query("saved_segments")
def q_saved_segments(spark, d):
    """The custom segments saved by name on shared storage, one of them replaced, one more removed, one refused; members
    of the definitions in force, reloaded, in one pass."""
    import uuid

    from panelcast.operators.saved_segments import SegmentStore
    from panelcast.session import scratch_root

    s = scored_lazy(spark, d)
    path = f"{scratch_root(spark)}/segments/store-{uuid.uuid4().hex}"
    store = SegmentStore(spark, path)
    for name, predicate in CUSTOM_SEGMENTS.items():
        store.save(name, predicate, s)
    store.save(REPLACED_SEGMENT[0], "late_payments >= 1", s)
    store.save(*REPLACED_SEGMENT, s)
    store.save("ended", "churn_risk_score > 0", s)
    store.remove("ended")
    refused = 0
    for bad in ("no_such_column > 1", "churn_risk_score + 1", "sum(late_payments) > 1", "churn_risk_score >"):
        try:
            store.save("bad", bad, s)
        except ValueError:
            refused += 1
    members = SegmentStore(spark, path).members(s, ["account_id", "churn_risk_score"])
    return members.groupBy("segment", "version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("account_id").alias("n_accounts"), F.avg("churn_risk_score").alias("avg_risk"),
        F.lit(refused).cast("bigint").alias("n_refused"))


@query("segment_comparison")
def q_segment_comparison(spark, d):
    """Features that differ most between high-risk rows and the rest (effect size)."""
    s = scored_o(spark, d)
    x = s.select("*", F.col("risk_tier").isin("High Risk", "Medium Risk").cast("int").alias("_in_segment"))
    st = explain.class_stats(x, model_feature_names(), "_in_segment")
    eff = F.try_divide(F.col("churned_avg") - F.col("safe_avg"), F.col("safe_std"))
    ranked = st.select(
        "feature",
        F.col("churned_avg").alias("segment_mean"),
        F.col("safe_avg").alias("rest_mean"),
        eff.alias("effect_size"),
    )
    w = Window.orderBy(F.abs(F.col("effect_size")).desc_nulls_last(), F.col("feature"))  # 107 rows
    return ranked.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= 10)


@query("what_if")
def q_what_if(spark, d):
    """Top-risk rows re-scored under fixed scenarios (feature overrides)."""
    s = scored_o(spark, d)
    top = scoring.top_risk(s, TOP_N_EXPLAIN)
    coefs, icpt = scoring.FIXED_COEFFICIENTS, scoring.FIXED_INTERCEPT
    parts = []
    for name, overrides in WHAT_IF:
        z = str(icpt)
        for f, c in coefs.items():
            v = overrides.get(f, q(f))
            z += f" + ({c!r}) * CAST({v} AS DOUBLE)"
        new = f"round(1.0D / (1.0D + exp(-({z}))) * 10000.0D, 0) / 10000.0D"
        parts.append(
            top.selectExpr(
                "account_id", "month", f"'{name}' AS scenario", "churn_risk_score AS base_score", f"{new} AS new_score"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("*", (F.col("new_score") - F.col("base_score")).alias("delta"))


@query("risk_alerts")
def q_alerts(spark, d):
    """Score up by more than ALERT_RISE vs the previous period, or a high-value account entering High Risk."""
    s = scored_lazy(spark, d)
    w = Window.partitionBy("account_id").orderBy("month")
    x = s.select(
        "account_id",
        "month",
        "churn_risk_score",
        "risk_tier",
        "current_month_revenue_90d_avg",
        F.lag("churn_risk_score").over(w).alias("prev_score"),
        F.lag("risk_tier").over(w).alias("prev_tier"),
    )
    rise = F.col("churn_risk_score") > F.col("prev_score") * (1 + ALERT_RISE)
    enters = (
        (F.col("risk_tier") == "High Risk")
        & (F.col("prev_tier") != "High Risk")
        & (F.col("current_month_revenue_90d_avg") >= HIGH_VALUE_REVENUE)
    )
    alert = F.when(enters, "high_value_enters_high_risk").when(rise, "risk_rising")
    return x.select("account_id", "month", "prev_score", "churn_risk_score", alert.alias("alert")).where(
        F.col("alert").isNotNull()
    )


@query("model_comparison")
def q_model_comparison(spark, d):
    """Old (linear_a) vs new (linear_b) metrics side by side with deltas, long by metric."""
    m = metrics.classification_metrics(two_models(spark, d), EVAL_LABEL, group="model_name")
    names = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc"]
    body = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in names)
    long = m.selectExpr("model_name", f"stack({len(names)}, {body}) AS (metric, value)")
    old = long.where(F.col("model_name") == "linear_a").select("metric", F.col("value").alias("old_value"))
    new = long.where(F.col("model_name") == "linear_b").select("metric", F.col("value").alias("new_value"))
    return old.join(new, "metric").select("*", (F.col("new_value") - F.col("old_value")).alias("delta"))


@query("ab_groups")
def q_ab(spark, d):
    """Deterministic A/B assignment per account (seeded md5), with group sizes and mean risk."""
    s = scored_lazy(spark, d)
    g = F.pmod(labels.account_hash("account_id", AB_SEED), F.lit(AB_GROUPS)).cast("int")
    return s.select(g.alias("ab_group"), "account_id", "churn_risk_score").groupBy("ab_group").agg(
        F.countDistinct("account_id").alias("n_accounts"), F.avg("churn_risk_score").alias("avg_risk")
    )


def _long(df, cols, keep=()):
    """(keep..., column, value double) of the given columns."""
    body = ", ".join(f"'{c}', CAST({q(c)} AS DOUBLE)" for c in cols)
    return df.selectExpr(*keep, f"stack({len(cols)}, {body}) AS (`column`, value)")


@query("dq_report")
def q_dq_report(spark, d):
    """Missing values, IQR outliers (exact quartiles), range and freshness of every raw metric.

    The raw columns are written once; one aggregate gives counts and ranges, one long prefix count
    all quartiles, one pass the outliers."""
    from panelcast.plans.catalog import panel_o

    raw = materialize(panel_o(spark, d).select("month", *CLUSTER_FEATURES), "dq-raw")
    long = _long(raw, CLUSTER_FEATURES, ["month"])
    base = long.groupBy("column").agg(
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max("month").alias("latest_period"),
    )
    qs = metrics.exact_quantiles(long.select("column", "value"), "value", [0.25, 0.75], group="column")
    quart = materialize(qs.groupBy("column").agg(  # a row for each metric
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"), F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3")
    ), "dq-quartiles")
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    outl = long.join(F.broadcast(quart), "column").groupBy("column").agg(
        F.count_if((F.col("value") < F.col("q1") - spread) | (F.col("value") > F.col("q3") + spread)).alias("n_outliers")
    )
    return base.join(quart, "column").join(outl, "column")


@query("dq_correlations")
def q_dq_correlations(spark, d):
    """Pearson correlation of every pair of raw metrics, in one aggregate."""
    from itertools import combinations

    from panelcast.plans.catalog import panel_o

    pairs = list(combinations(CLUSTER_FEATURES, 2))
    wide = panel_o(spark, d).agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    body = ", ".join(f"'{a}', '{b}', _c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {body}) AS (metric_a, metric_b, correlation)")


def _clustered(spark, d):
    """A k-means model of the standardised raw metrics, and the rows it was fitted on."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    s = scored_lazy(spark, d)
    cols = CLUSTER_FEATURES
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=cols, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
            KMeans(k=N_CLUSTERS, seed=1, featuresCol="features", predictionCol="cluster"),
        ]
    )
    data = materialize(s.select("account_id", "churn_risk_score", *cols), "cluster-features")
    return pipe.fit(data), data


@query("segment_clusters")
def q_clusters(spark, d):
    """K-means segments on standardised raw metrics: size and mean risk per cluster."""
    model, data = _clustered(spark, d)
    return model.transform(data).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("churn_risk_score").alias("avg_risk")
    )


@query("cluster_invariants")
def q_cluster_invariants(spark, d):
    """What holds for any k-means result: all rows have a cluster, no row is nearer to another centre, and no cluster
    number is out of range."""
    from pyspark.ml.functions import vector_to_array

    model, data = _clustered(spark, d)
    centres = [[float(v) for v in c] for c in model.stages[-1].clusterCenters()]
    x = model.transform(data).select("cluster", vector_to_array("features").alias("x"))
    away = [F.aggregate(F.zip_with("x", F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b) for c in centres]
    x = x.withColumn("away", F.array(*away))
    own = F.get("away", F.col("cluster"))
    return x.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(own > F.array_min("away") + 1e-9).alias("n_not_nearest"),
                 F.count_if(~F.col("cluster").between(0, N_CLUSTERS - 1)).alias("n_out_of_range"))


def similar_accounts(s, account: str, features=CLUSTER_FEATURES, n: int = N_NEIGHBOURS, segment: str = "risk_tier"):
    """The ``n`` rows nearest to an account's last row among the last rows of other accounts in its segment.

    Exact: Euclidean distance on metrics standardised over all last rows; one pass over the
    segment, a heap of ``n`` rows in each task."""
    from panelcast.operators.spine import last_record

    last = last_record(s.select("account_id", "month", "churn_risk_score", segment, *features))
    stats = last.agg(*[F.avg(c).alias(f"_m_{c}") for c in features], *[F.stddev_samp(c).alias(f"_s_{c}") for c in features])
    one = last.where(F.col("account_id") == account).select(
        F.col("account_id").alias("target_account"), F.col(segment).alias("_segment"), *[F.col(c).alias(f"_t_{c}") for c in features])
    x = last.crossJoin(F.broadcast(stats)).join(F.broadcast(one), (F.col(segment) == F.col("_segment")) & (F.col("account_id") != F.col("target_account")))
    z = sum((F.coalesce(F.try_divide(F.col(c) - F.col(f"_t_{c}"), F.col(f"_s_{c}")), F.lit(0.0)) ** 2 for c in features), F.lit(0.0))
    return x.select("target_account", "account_id", "month", "churn_risk_score", F.round(F.sqrt(z), 4).alias("distance")).orderBy(
        "distance", "account_id").limit(n)


def similar_to_all(s, features=CLUSTER_FEATURES, n: int = N_NEIGHBOURS, segment: str = "risk_tier"):
    """For every account the ``n`` most similar accounts of its segment: ``target_account, account_id, rank, distance``.

    The measure is that of ``similar_accounts``.  One exact neighbour search (``nearest.nearest_rows``) covers all segments:
    each has its own place on one more axis, farther apart than any two rows of a segment, so nearer rows are always of
    the same segment.  An account with fewer than ``n`` others in its segment has fewer rows; ties go to the smaller account."""
    from panelcast.operators.nearest import nearest_rows
    from panelcast.operators.spine import last_record

    last = last_record(s.select("account_id", "month", segment, *features))
    stats = last.agg(*[F.avg(c).alias(f"_m_{c}") for c in features], *[F.stddev_samp(c).alias(f"_s_{c}") for c in features])
    z = [F.coalesce(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")), F.lit(0.0)).alias(f"_z{i}") for i, c in enumerate(features)]
    axes = [f"_z{i}" for i in range(len(features))]
    rows = last.crossJoin(F.broadcast(stats)).select("account_id", segment, *z)
    # increasing with the account, so that ties are settled by it
    rows = materialize(rows.repartitionByRange("account_id").sortWithinPartitions("account_id").withColumn("_num", F.monotonically_increasing_id()), "similar-all")
    reach = rows.agg(*[F.max(F.abs(a)).alias(a) for a in axes]).first()
    gap = 4.0 * (1.0 + sum(v * v for v in reach if v is not None) ** 0.5)
    place = {r[0]: i * gap for i, r in enumerate(rows.select(segment).distinct().orderBy(segment).limit(1001).collect())}
    if len(place) > 1000:
        raise ValueError("more than 1000 segments")
    at = F.coalesce(*[F.when(F.col(segment).eqNullSafe(F.lit(k)), F.lit(v)) for k, v in place.items()], F.lit(0.0))
    rows = rows.withColumn("_at", at)
    near, _ = nearest_rows(rows, "_num", [*axes, "_at"], n)
    pairs = near.select("_num", F.posexplode("near").alias("_rank", "_other"))
    me = rows.select("_num", F.col("account_id").alias("target_account"), F.col("_at").alias("_my_at"), *[F.col(a).alias(f"_my{a}") for a in axes])
    you = rows.withColumnRenamed("_num", "_other")
    both = pairs.join(me, "_num").join(you, "_other").where(F.col("_at") == F.col("_my_at"))
    d2 = sum(((F.col(a) - F.col(f"_my{a}")) ** 2 for a in axes), F.lit(0.0))
    return both.select("target_account", "account_id", (F.col("_rank") + 1).alias("rank"), F.sqrt(d2).alias("distance"))


@query("similar_accounts_all")
def q_similar_all(spark, d):
    """Distances of every account to its ten most similar ones (which account stands at a rank depends on the last bit
    where two are equally far, so the checked rows leave its name out)."""
    s = materialize(scored_lazy(spark, d).select("account_id", "month", "risk_tier", *CLUSTER_FEATURES), "similar-rows")
    return similar_to_all(s).select("target_account", "rank", F.round("distance", 4).alias("distance"))


@query("similar_accounts")
def q_similar(spark, d):
    s = materialize(scored_lazy(spark, d).select("account_id", "month", "churn_risk_score", "risk_tier", *CLUSTER_FEATURES), "similar-rows")
    return similar_accounts(s, LOOKUP_ACCOUNT)


@query("stream_scoring")
def q_stream_scoring(spark, d):
    """Feature rows land as files; a streaming query scores each micro-batch into a sink."""
    import uuid

    from panelcast.plans.catalog import features_o
    from panelcast.session import scratch_root
    from panelcast.streaming.scoring import run_file_stream

    src = f"{scratch_root(spark)}/stream-src/{uuid.uuid4().hex}"
    features_o(spark, d).write.parquet(src)
    sink = run_file_stream(spark, src, max_files_per_trigger=STREAM_FILES, digits=SCORE_DIGITS)
    return spark.read.parquet(sink)


RAW_ARRIVALS = 3
RAW_LATE = 4  # a row arrives up to RAW_LATE - 1 periods after its month


@query("stream_raw_scoring")
def q_stream_raw_scoring(spark, d):
    """Raw panel rows arrive in parts, some out of order; a streaming query with state turns them into features and
    scores them, stopped and started again for each part."""
    import datetime as dt
    import uuid

    from panelcast.plans.catalog import panel_o
    from panelcast.session import scratch_root
    from panelcast.streaming.raw_rows import punctuation, run_raw_stream
    from panelcast.streaming.scoring import score_stream

    base = f"{scratch_root(spark)}/streams/{uuid.uuid4().hex}"
    panel = materialize(panel_o(spark, d), "raw-stream-panel")
    idx, n = labels.period_table(panel.select("month"))
    arrives = F.col("period_idx") + F.pmod(F.xxhash64("account_id", "month"), F.lit(RAW_LATE))
    part = F.least(F.floor((arrives - 1) * RAW_ARRIVALS / F.lit(max(n, 1))), F.lit(RAW_ARRIVALS - 1))
    landing = panel.join(F.broadcast(idx.select("month", "period_idx")), "month")
    end = dt.date(2200, 1, 1)
    for k in range(RAW_ARRIVALS + 1):
        rows = landing.where(part == k).select(*panel.columns) if k < RAW_ARRIVALS else punctuation(spark, panel.schema, end)
        rows.write.mode("append").parquet(f"{base}/source")
        sink = run_raw_stream(spark, f"{base}/source", base, panel.schema, lambda f: score_stream(f, digits=SCORE_DIGITS))
    return spark.read.parquet(sink)


CONTACT_WITHIN_DAYS = 31
IMPACT_PERIODS = 3


@query("intervention_impact")
def q_intervention_impact(spark, d):
    """Average risk over the periods before vs after a contact, by tier at contact time.

    The data has no campaign table, so a contact is a period whose last touch
    lies within CONTACT_WITHIN_DAYS before the period start."""
    s = scored_lazy(spark, d)
    w = Window.partitionBy("account_id").orderBy("month")
    n = IMPACT_PERIODS
    before = F.avg("churn_risk_score").over(w.rowsBetween(-n, -1))
    after = F.avg("churn_risk_score").over(w.rowsBetween(1, n))
    x = s.select(
        "risk_tier",
        (F.col("days_since_last_contact") <= CONTACT_WITHIN_DAYS).alias("_contact"),
        before.alias("risk_before"),
        after.alias("risk_after"),
    ).where(F.col("_contact") & F.col("risk_before").isNotNull() & F.col("risk_after").isNotNull())
    return x.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("n_contacts"),
        F.avg("risk_before").alias("avg_risk_before"),
        F.avg("risk_after").alias("avg_risk_after"),
        F.avg(F.col("risk_after") - F.col("risk_before")).alias("avg_change"),
    )


CAMPAIGN_DAYS = 7


@query("campaign_impact")
def q_campaign_impact(spark, d):
    """Mean risk before and after each campaign, accounts at risk that stayed, and the return, by campaign (events panel).

    The tables have no campaigns: the click events stand in for rows of a campaign table (account, name, first and last day)."""
    from panelcast.operators.campaigns import campaign_impact, campaign_scores
    from panelcast.operators.features import generate_features
    from panelcast.plans.catalog import panel_e, score_table, table
    from panelcast.sources.adapters import _keyed

    k = F.pmod(F.get_json_object("props", "$.k").cast("bigint"), F.lit(6))
    start = F.col("ts").cast("date")
    campaigns = table(spark, d, "events").where("event_type = 'click'").select(
        _keyed("USR-", "user_id").alias("account_id"), F.concat(F.lit("campaign "), (k % 3).cast("string")).alias("campaign"),
        start.alias("start_date"), F.date_add(start, F.floor(k / 3).cast("int")).alias("end_date"))
    scores = score_table(generate_features(panel_e(spark, d), check_empty=False))
    return campaign_impact(campaign_scores(scores, campaigns, CAMPAIGN_DAYS), at_risk=0.2, value=ACCOUNT_VALUE, cost=CONTACT_COST)


PSI_EPS = 1e-4
PSI_DIGITS = 6  # feature values are rounded so that equal values are equal in both engines
PSI_SLACK = 1e-8  # an interpolated edge may be a last bit off the value that it stands for
PSI_DECILES = [i / 10 for i in range(1, 10)]


@query("feature_psi")
def q_feature_psi(spark, d):
    """Population stability index of every model feature, recent vs training periods, over training-decile bins.

    Edges: exact deciles of the training rows by sketch and bracket (a row of nine numbers for each feature, broadcast);
    bin = number of edges below the value; PSI = sum (r - t) * ln((r + eps) / (t + eps)).  Rows are counted by
    feature and bin before the shuffle."""
    s = scored_lazy(spark, d)
    feats = model_feature_names()
    rounded = [F.round(F.round(F.col(f).cast("double"), 10), PSI_DIGITS).alias(f) for f in feats]
    table = materialize(s.select("month", *rounded), "psi-rows")
    idx, _ = labels.period_table(table.select("month"))
    is_train = F.col("period_idx") <= DRIFT_TRAIN_MONTHS
    is_recent = F.col("period_idx").between(DRIFT_RECENT_FROM, DRIFT_RECENT_TO)
    rows = table.join(F.broadcast(idx.select("month", is_train.alias("train")).where(is_train | is_recent)), "month")
    edges = column_quantiles(rows.where("train"), feats, PSI_DECILES)
    flat = materialize(edges.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("e")).selectExpr(
        "`column`", *[f"e[{i}] + {PSI_SLACK!r}D AS _e{i}" for i in range(len(PSI_DECILES))]), "psi-edges")
    place = "CASE " + " ".join(f"WHEN value <= _e{i} THEN {i}" for i in range(len(PSI_DECILES))) + f" ELSE {len(PSI_DECILES)} END AS bin"
    binned = (long_values(rows, feats, ["train"]).join(F.broadcast(flat), "column").selectExpr("train", "`column` AS feature", place)
              .groupBy("feature", "bin").agg(F.count_if("train").alias("n_train"), F.count_if(~F.col("train")).alias("n_recent")))
    wf = Window.partitionBy("feature")  # at most 10 bins per feature
    pt = F.col("n_train") / F.sum("n_train").over(wf)
    pr = F.col("n_recent") / F.sum("n_recent").over(wf)
    term = (pr - pt) * F.log((pr + PSI_EPS) / (pt + PSI_EPS))
    return binned.select("feature", term.alias("_t")).groupBy("feature").agg(
        F.sum("_t").alias("psi"), F.count(F.lit(1)).alias("n_bins")
    )
