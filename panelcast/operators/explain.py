"""Per-account explanations.

* deviation explanation: each feature's z-score against the safe population,
  weighted by importance, top 10 per row;
* linear attribution: coef * (x - population mean) for a linear scorer;
* occlusion attribution for any fitted model: replace one feature by its safe
  mean, re-score, take the difference (one batch ``transform``).

Class statistics are one wide aggregate over the population (two partial
aggregates per feature), broadcast as a (feature -> stats) table; only the rows
being explained are unpivoted, so the 107x row blow-up is limited to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.expressions import concern_label, q


# Features per aggregate: smaller generated methods stay under the JIT's
# size limit, and every chunk scans only its own columns.
STATS_CHUNK = 27


def class_stats(population: DataFrame, features: Sequence[str], label: str = "churned") -> DataFrame:
    """(feature, safe_avg, safe_std, churned_avg, n_safe, n_churned), one row per feature.

    Global aggregates with three conditional aggregates per feature (partial
    aggregation on every task), in chunks of ``STATS_CHUNK`` features, each
    stacked to one row per feature.  Expressions are SQL strings, so any
    number of features costs one JVM call per chunk.
    """
    y = q(label)
    feats = list(features)
    parts = []
    for start in range(0, len(feats), STATS_CHUNK):
        chunk = feats[start : start + STATS_CHUNK]
        aggs = [f"count_if({y} = 0) AS _n0", f"count_if({y} = 1) AS _n1"]
        for i, f in enumerate(chunk):
            x = f"CAST({q(f)} AS DOUBLE)"
            aggs += [
                f"avg(CASE WHEN {y} = 0 THEN {x} END) AS _a{i}",
                f"stddev_samp(CASE WHEN {y} = 0 THEN {x} END) AS _s{i}",
                f"avg(CASE WHEN {y} = 1 THEN {x} END) AS _c{i}",
            ]
        wide = population.selectExpr(*aggs)
        body = ", ".join(f"'{f}', _a{i}, _s{i}, _c{i}" for i, f in enumerate(chunk))
        parts.append(
            wide.selectExpr(
                f"stack({len(chunk)}, {body}) AS (feature, safe_avg, safe_std, churned_avg)",
                "_n0 AS n_safe",
                "_n1 AS n_churned",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unpivot_features(rows: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(ids..., feature, value double) for the given rows."""
    cast = rows.selectExpr(*[q(i) for i in ids], *[f"CAST({q(f)} AS DOUBLE) AS {q(f)}" for f in features])
    return cast.unpivot(list(ids), list(features), "feature", "value")


def explain_deviation(
    rows: DataFrame,
    stats: DataFrame,
    importance: DataFrame | None,
    features: Sequence[str],
    ids: Sequence[str] = ("account_id", "month"),
    top_n: int = 10,
) -> DataFrame:
    """Top ``top_n`` factors per row by |z| * importance (ties by feature name).

    Shuffle-free: the per-feature statistics and importances are packed into
    one array (one row, bounded by the number of features) and broadcast;
    each row puts its feature values in an array, computes every factor with
    ``transform``, sorts the array and keeps the first ``top_n`` -- no
    rows x features explode before the cut and no shuffle.
    """
    feats = list(features)
    names = F.array(*[F.lit(f) for f in feats])
    if importance is None:  # importance already a column of ``stats`` (one branch)
        st = stats.select("feature", "safe_avg", "safe_std", "churned_avg", "importance")
    else:
        st = stats.select("feature", "safe_avg", "safe_std", "churned_avg").join(
            importance.select("feature", "importance"), "feature", "left"
        )
    packed = st.select(
        F.struct(
            F.array_position(names, F.col("feature")).cast("int").alias("p"),
            F.col("feature"),
            F.col("safe_avg").alias("a"),
            F.col("safe_std").alias("s"),
            F.col("churned_avg").alias("c"),
            F.coalesce(F.col("importance"), F.lit(0.0)).alias("w"),
        ).alias("st")
    ).where(F.col("st.p") > 0)
    one = packed.agg(F.collect_list("st").alias("_stats"))  # <= len(features) entries
    values = "array(" + ", ".join(f"CAST({q(f)} AS DOUBLE)" for f in feats) + ")"
    x = rows.selectExpr(*[q(i) for i in ids], f"{values} AS _values").crossJoin(F.broadcast(one))
    v = "element_at(_values, t.p)"
    z = f"CASE WHEN t.s > 0 THEN ({v} - t.a) / t.s ELSE 0.0D END"
    factor = (
        f"named_struct('neg_risk', -(abs({z}) * t.w), 'feature', t.feature, 'value', {v}, 'safe_avg', t.a,"
        f" 'churned_avg', t.c, 'z_score', {z}, 'importance', t.w,"
        f" 'closer_to_churned', coalesce(abs({v} - t.c) < abs({v} - t.a), false))"
    )
    top = f"slice(array_sort(transform(_stats, t -> {factor})), 1, {int(top_n)})"
    ranked = x.selectExpr(*[q(i) for i in ids], f"posexplode({top}) AS (pos, f)")
    return ranked.select(
        *ids,
        (F.col("pos") + 1).alias("rank"),
        F.col("f.feature").alias("feature"),
        F.col("f.value").alias("value"),
        F.col("f.safe_avg").alias("safe_avg"),
        F.col("f.churned_avg").alias("churned_avg"),
        F.col("f.z_score").alias("z_score"),
        F.col("f.importance").alias("importance"),
        (F.lit(0.0) - F.col("f.neg_risk")).alias("risk_score"),
        F.col("f.closer_to_churned").alias("closer_to_churned"),
        concern_label(F.col("f.z_score")).alias("concern"),
    )


def linear_attribution(
    rows: DataFrame,
    population: DataFrame,
    coefficients: dict[str, float],
    ids: Sequence[str] = ("account_id", "month"),
) -> DataFrame:
    """coef * (x - population mean) per feature and row (exact for a linear logit)."""
    feats = list(coefficients)
    means = population.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in feats])
    mean_long = means.unpivot([], feats, "feature", "pop_mean")
    spark = rows.sparkSession
    coef = spark.createDataFrame([(f, float(c)) for f, c in coefficients.items()], "feature string, coefficient double")
    long = unpivot_features(rows, ids, feats)
    out = long.join(F.broadcast(mean_long), "feature").join(F.broadcast(coef), "feature")
    contrib = F.col("coefficient") * (F.col("value") - F.col("pop_mean"))
    w = Window.partitionBy(*ids).orderBy(F.abs(contrib).desc(), F.col("feature"))
    return out.select(*ids, "feature", "value", "pop_mean", "coefficient", contrib.alias("contribution")).select(
        "*", F.row_number().over(w).alias("rank")
    )


def occlusion_attribution(
    model,
    rows: DataFrame,
    stats: DataFrame,
    features: Sequence[str],
    ids: Sequence[str] = ("account_id", "month"),
    score_fn=None,
) -> DataFrame:
    """Score change when one feature is set to its safe-population mean.

    Rows are replicated once per feature (rows x features, for the explained
    rows only) and scored in one batch ``transform``.
    """
    from panelcast.operators.ml import probability_of_positive

    means = stats.select("feature", "safe_avg")
    base = rows.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    feat_df = rows.sparkSession.createDataFrame([(f,) for f in features], "occluded string")
    rep = base.crossJoin(F.broadcast(feat_df)).join(
        F.broadcast(means.withColumnRenamed("feature", "occluded")), "occluded", "left"
    )
    swapped = rep.select(
        *ids,
        "occluded",
        *[
            F.when(F.col("occluded") == f, F.coalesce(F.col("safe_avg"), F.col(f))).otherwise(F.col(f)).alias(f)
            for f in features
        ],
    )
    # ``model`` is a fitted pipeline that assembles its own feature vector
    score = score_fn or (lambda d: probability_of_positive(model.transform(d)))
    base_scores = score(base).select(*ids, F.col("p1").alias("base_score"))
    occ = score(swapped).select(*ids, "occluded", F.col("p1").alias("occluded_score"))
    return occ.join(base_scores, list(ids)).select(
        *ids,
        F.col("occluded").alias("feature"),
        "base_score",
        "occluded_score",
        (F.col("base_score") - F.col("occluded_score")).alias("attribution"),
    )
