"""Classification metrics, exact ROC / PR curves, AUCs and threshold search.

Curves need cumulative counts over all distinct scores in descending order.
A plain ``Window.orderBy(score)`` would move every row into one task, so the
cumulative sums are computed in two levels:

1. ``groupBy(score)`` -> one row per distinct score with positive / negative
   counts (partial aggregation, so a hot score is combined map-side);
2. the distinct scores are cut into ``n_buckets`` buckets at approximate
   quantiles of the distinct values (a bounded list of cut points), so the
   buckets are balanced whatever the score distribution;
3. cumulative sums inside each bucket (a window partitioned by bucket);
4. per-bucket totals (at most ``n_buckets + 1`` rows) get their running
   offsets on that tiny table, which is broadcast back.

The result is exact: no sampling, no binning of the scores themselves.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Least number of buckets; a session with more shuffle partitions gets four for each of them.
DEFAULT_BUCKETS = 512


def _div0(num, den):
    """num / den, 0 when den == 0 (scikit-learn's zero_division=0)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def _bucketize(pts: DataFrame, value: str, n_buckets: int) -> DataFrame:
    n_buckets = max(n_buckets, 4 * int(pts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = pts.approxQuantile(value, probs, 1.0 / (4 * n_buckets)) if n_buckets > 1 else []
    inner = sorted({c for c in cuts if c == c and abs(c) != float("inf")})
    if not inner:  # one bucket
        return pts.select("*", F.lit(0.0).alias("_bucket"))
    splits = [float("-inf")] + inner + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=value, outputCol="_bucket", handleInvalid="keep")
    return b.transform(pts)


def prefix_counts(
    df: DataFrame,
    value: str,
    weights: dict[str, F.Column],
    descending: bool = True,
    group: str | None = None,
    n_buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Per (group, distinct value): the summed ``weights`` and their inclusive
    running sums ``cum_<w>`` in value order, plus group totals ``tot_<w>``."""
    keys = ([group] if group else []) + [value]
    pts = df.groupBy(*keys).agg(*[F.sum(expr).alias(name) for name, expr in weights.items()])
    pts = pts.where(F.col(value).isNotNull())
    pts = _bucketize(pts, value, n_buckets)
    part = ([group] if group else []) + ["_bucket"]
    order = F.col(value).desc() if descending else F.col(value).asc()
    w_in = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = pts.select("*", *[F.sum(n).over(w_in).alias(f"_in_{n}") for n in weights])
    totals = pts.groupBy(*part).agg(*[F.sum(n).alias(f"_b_{n}") for n in weights])
    b_order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    w_b = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy(b_order)
    before = w_b.rowsBetween(Window.unboundedPreceding, -1)
    whole = (Window.partitionBy(group) if group else Window.partitionBy()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.select(
        *part,
        *[F.coalesce(F.sum(f"_b_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in weights],
        *[F.sum(f"_b_{n}").over(whole).alias(f"tot_{n}") for n in weights],
    )
    joined = local.join(offsets, on=part, how="inner")  # both sides lie by bucket
    return joined.select(
        *keys,
        *weights.keys(),
        *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(f"cum_{n}") for n in weights],
        *[F.col(f"tot_{n}") for n in weights],
    )


def curve_counts(
    scored: DataFrame, score: str = "churn_risk_score", label: str = "churned", group: str | None = None, n_buckets=DEFAULT_BUCKETS
) -> DataFrame:
    """Per distinct score: pos/neg counts, tp/fp at threshold = score (predict >= score), P, N."""
    y = F.col(label).cast("bigint")
    pc = prefix_counts(
        scored, score, {"pos": y, "neg": F.lit(1) - y}, descending=True, group=group, n_buckets=n_buckets
    )
    return pc.select(
        *([group] if group else []),
        F.col(score).alias("threshold"),
        "pos",
        "neg",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.col("tot_pos").alias("n_pos"),
        F.col("tot_neg").alias("n_neg"),
    )


def roc_points(counts: DataFrame, group: str | None = None) -> DataFrame:
    g = [group] if group else []
    return counts.select(
        *g,
        "threshold",
        _div0(F.col("fp"), F.col("n_neg")).alias("fpr"),
        _div0(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )


def _roc_area():
    """The ROC area's sum over the points."""
    return F.sum(F.col("pos") * (F.col("n_neg") - F.col("fp") + F.lit(0.5) * F.col("neg")))


def _pr_area():
    """The PR area's sum over the points (see ``pr_auc``)."""
    tp, fp = F.col("tp"), F.col("fp")
    tp_prev, fp_prev = tp - F.col("pos"), fp - F.col("neg")
    p_now = _div0(tp, tp + fp)
    p_prev = F.when(tp_prev + fp_prev > 0, tp_prev / (tp_prev + fp_prev)).otherwise(F.lit(1.0))
    r_now = F.when(F.col("n_pos") > 0, tp / F.col("n_pos")).otherwise(F.lit(1.0))
    r_prev = F.when(F.col("n_pos") > 0, tp_prev / F.col("n_pos")).otherwise(
        F.when(tp_prev + fp_prev > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    return F.sum((r_now - r_prev) * (p_now + p_prev) / 2)


def curve_areas(counts: DataFrame, group: str | None = None) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` from one aggregate over the points; NULL for one class."""
    g = [group] if group else []
    agg = counts.groupBy(*g).agg(
        _roc_area().alias("_s"), _pr_area().alias("_a"), F.max("n_pos").alias("_p"), F.max("n_neg").alias("_n")
    )
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    return agg.select(
        *g,
        F.when(both, F.col("_s") / (F.col("_p") * F.col("_n"))).cast("double").alias("roc_auc"),
        F.when(both, F.col("_a")).cast("double").alias("pr_auc"),
    )


def roc_auc(counts: DataFrame, group: str | None = None) -> DataFrame:
    """Rank statistic with ties at 1/2 (= trapezoid ROC AUC); NULL for one class."""
    return curve_areas(counts, group).drop("pr_auc")


def pr_points(counts: DataFrame, group: str | None = None, end_point: bool = True) -> DataFrame:
    """precision/recall/F1 per distinct threshold, plus the end point (precision 1, recall 0)."""
    g = [group] if group else []
    precision = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(F.lit(1.0))
    pts = counts.select(*g, "threshold", precision.alias("precision"), recall.alias("recall"))
    if end_point:
        ends = counts.groupBy(*g).agg(F.lit(None).cast("double").alias("threshold")).select(
            *g, "threshold", F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
        )
        pts = pts.unionByName(ends)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-10))
    return pts.select("*", f1.alias("f1"))


def pr_auc(counts: DataFrame, group: str | None = None) -> DataFrame:
    """Trapezoid area under the PR points (not average precision).

    The neighbouring point of threshold s is the next higher threshold, whose
    counts are the cumulative counts minus s's own counts (no lag needed);
    for the highest score it is the end point (precision 1, recall 0).
    """
    return curve_areas(counts, group).drop("roc_auc")


def pr_baseline(df: DataFrame, label: str = "churned", group: str | None = None) -> DataFrame:
    """The PR curve's no-skill line: the share of positives."""
    g = [group] if group else []
    return df.groupBy(*g).agg(F.avg(F.col(label).cast("double")).alias("pr_baseline"), F.count(F.lit(1)).alias("n_rows"))


def confusion(df: DataFrame, label: str = "churned", prediction: str = "prediction", group: str | None = None) -> DataFrame:
    """tn/fp/fn/tp as sums (0 for a missing class, unlike a 2x2 matrix index)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    g = [group] if group else []
    return df.groupBy(*g).agg(
        F.sum(((y == 0) & (p == 0)).cast("bigint")).alias("tn"),
        F.sum(((y == 0) & (p == 1)).cast("bigint")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("bigint")).alias("fn"),
        F.sum(((y == 1) & (p == 1)).cast("bigint")).alias("tp"),
    )


def _ratios(cm: DataFrame, g: list[str]) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    return cm.select(
        *g,
        _div0(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "tn",
        "fp",
        "fn",
        "tp",
    )


def classification_metrics(
    df: DataFrame,
    label: str = "churned",
    prediction: str = "prediction",
    score: str | None = "churn_risk_score",
    group: str | None = None,
    n_buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """accuracy, precision, recall, F1 (positive class), ROC AUC, PR AUC, confusion counts."""
    g = [group] if group else []
    out = _ratios(confusion(df, label, prediction, group), g)
    if score:
        counts = curve_counts(df, score, label, group, n_buckets)
        aucs = curve_areas(counts, group)
        out = out.join(aucs, on=g, how="left") if g else out.crossJoin(aucs)
    return out


def classification_report(df: DataFrame, label: str = "churned", prediction: str = "prediction") -> DataFrame:
    """Per-class precision/recall/f1/support, accuracy, macro and weighted averages (long form)."""
    cm = confusion(df, label, prediction)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1_1, f1_0 = _div0(2 * tp, 2 * tp + fp + fn), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _div0(tp + tn, n)
    wide = cm.select(
        p0.alias("p0"), r0.alias("r0"), f1_0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1_1.alias("f1"), s1.alias("s1"),
        acc.alias("acc"), n.alias("n"),
    )
    rows = [
        ("'0'", "p0", "r0", "f0", "s0"),
        ("'1'", "p1", "r1", "f1", "s1"),
        ("'accuracy'", "acc", "acc", "acc", "n"),
        ("'macro avg'", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
        (
            "'weighted avg'",
            "try_divide(p0 * s0 + p1 * s1, n)",
            "try_divide(r0 * s0 + r1 * s1, n)",
            "try_divide(f0 * s0 + f1 * s1, n)",
            "n",
        ),
    ]
    body = ", ".join(f"{a}, CAST({b} AS DOUBLE), CAST({c} AS DOUBLE), CAST({d} AS DOUBLE), CAST({e} AS BIGINT)" for a, b, c, d, e in rows)
    return wide.selectExpr(f"stack(5, {body}) AS (class_label, precision, recall, f1_score, support)")


def optimal_threshold(
    scored: DataFrame,
    score: str = "churn_risk_score",
    label: str = "churned",
    metric: str = "f1",
    min_precision: float = 0.5,
    group: str | None = None,
    n_buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Best threshold on the PR table; ties go to the lowest threshold.

    ``f1`` maximises F1; ``recall`` maximises recall among thresholds with
    precision >= min_precision; ``custom`` maximises F1 under the same
    constraint.  When no real threshold meets the constraint, best F1 is used.
    Metrics at the chosen threshold come from the same cumulative counts.
    """
    g = [group] if group else []
    counts = curve_counts(scored, score, label, group, n_buckets)
    pts = counts.select(
        *g,
        "threshold",
        _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(F.lit(1.0)).alias("recall"),
        _div0(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("n_pos")).alias("f1_score"),
        ((F.col("tp") + F.col("fp")) / (F.col("n_pos") + F.col("n_neg"))).alias("predicted_churn_rate"),
    )
    f1_eps = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-10))
    valid = F.col("precision") >= F.lit(min_precision)
    if metric == "f1":
        target = f1_eps
        cond = F.lit(True)
    elif metric == "recall":
        target, cond = F.col("recall"), valid
    elif metric == "custom":
        target, cond = f1_eps, valid
    else:
        raise ValueError(f"unknown metric {metric!r}")
    ranked = pts.select("*", target.alias("_t"), cond.alias("_ok"))
    # order key: valid first, then target, then the lowest threshold
    rank_key = F.struct(F.col("_ok").cast("int"), F.col("_t"), -F.col("threshold"))
    fallback_key = F.struct(f1_eps, -F.col("threshold"))
    chosen = ranked.groupBy(*g).agg(
        F.max(F.col("_ok").cast("int")).alias("_any_ok"),
        F.max_by(F.struct(*[c for c in ("threshold", "precision", "recall", "f1_score", "predicted_churn_rate")]), rank_key).alias("_best"),
        F.max_by(F.struct("threshold", "precision", "recall", "f1_score", "predicted_churn_rate"), fallback_key).alias("_fb"),
    )
    pick = F.when(F.col("_any_ok") == 1, F.col("_best")).otherwise(F.col("_fb"))
    return chosen.select(*g, pick.alias("_p")).select(
        *g,
        F.col("_p.threshold").alias("threshold"),
        F.col("_p.precision").alias("precision"),
        F.col("_p.recall").alias("recall"),
        F.col("_p.f1_score").alias("f1_score"),
        F.col("_p.predicted_churn_rate").alias("predicted_churn_rate"),
    )


def metrics_at_thresholds(
    scored: DataFrame, thresholds: list[float], score: str = "churn_risk_score", label: str = "churned", group: str | None = None
) -> DataFrame:
    """precision/recall/F1/predicted rate at a short, explicit list of thresholds.

    One pass: four conditional counts per threshold (partial aggregation),
    stacked to one row per threshold -- rows are never multiplied."""
    from panelcast.functions.expressions import q

    g = [group] if group else []
    s, y = q(score), q(label)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = f"{s} >= CAST({float(t)!r} AS DOUBLE)"
        aggs += [
            f"count_if({hit} AND {y} = 1) AS _tp{i}",
            f"count_if({hit} AND {y} = 0) AS _fp{i}",
            f"count_if(NOT ({hit}) AND {y} = 1) AS _fn{i}",
            f"count_if(NOT ({hit}) AND {y} = 0) AS _tn{i}",
        ]
    wide = scored.groupBy(*g).agg(*[F.expr(a) for a in aggs])
    body = ", ".join(f"CAST({float(t)!r} AS DOUBLE), _tp{i}, _fp{i}, _fn{i}, _tn{i}" for i, t in enumerate(thresholds))
    cm = wide.selectExpr(*[q(c) for c in g], f"stack({len(thresholds)}, {body}) AS (threshold, tp, fp, fn, tn)")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cm.select(
        *g,
        "threshold",
        _div0(tp, tp + fp).alias("precision"),
        _div0(tp, tp + fn).alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        _div0(tp + fp, tp + fp + fn + tn).alias("predicted_churn_rate"),
        "tp",
        "fp",
        "fn",
        "tn",
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    group: str | None = None,
    n_buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas' default), distributed.

    Ascending prefix counts of the distinct values: the k-th smallest value (0-based) is
    the value whose running-count range covers k; nothing is held in one task.  Output:
    one row per (group, q) with ``q`` and ``value``.
    """
    g = [group] if group else []
    return weighted_quantiles(df.select(*g, value, F.lit(1).alias("_one")), value, "_one", probs, group, n_buckets)


def weighted_quantiles(
    df: DataFrame, value: str, weight: str, probs: list[float], group: str | None = None, n_buckets: int = DEFAULT_BUCKETS
) -> DataFrame:
    """``exact_quantiles`` of a table in which each row stands for ``weight`` (an integer column) equal values."""
    g = [group] if group else []
    pc = prefix_counts(df.where(F.col(value).isNotNull()), value, {"n": F.col(weight)}, descending=False, group=group, n_buckets=n_buckets)
    start = F.col("cum_n") - F.col("n")  # 0-based rank of the first copy of this value
    covers = lambda k: (start <= k) & (k < F.col("cum_n"))
    aggs = []
    for i, qv in enumerate(probs):
        pos = F.lit(float(qv)) * (F.col("tot_n") - 1)
        aggs += [
            F.max(pos).alias(f"_pos{i}"),
            F.max(F.when(covers(F.floor(pos)), F.col(value))).alias(f"_lo{i}"),
            F.max(F.when(covers(F.ceil(pos)), F.col(value))).alias(f"_hi{i}"),
        ]
    agg = pc.groupBy(*g).agg(*aggs)  # one pass, no rows x quantiles product
    body = ", ".join(f"CAST({float(qv)!r} AS DOUBLE), _pos{i}, _lo{i}, _hi{i}" for i, qv in enumerate(probs))
    long = agg.selectExpr(*g, f"stack({len(probs)}, {body}) AS (q, _pos, _vlo, _vhi)")
    frac = F.col("_pos") - F.floor(F.col("_pos"))
    return long.select(
        *g, "q", (F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))).cast("double").alias("value")
    )
