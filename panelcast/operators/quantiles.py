"""Quantiles of many columns at once, exact without shuffling rows x columns.

A mergeable sketch of every column (one row of summaries, partial aggregation) gives a bracket round
each quantile.  A second pass counts: values inside a bracket by value, all others by the gap
they fall in, so what is shuffled is a few thousandths of the values and ``2 x quantiles + 1`` gap rows of each
column and task.  The brackets are checked against the counts; a column with a bracket that missed is counted by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.expressions import q
from panelcast.operators.metrics import weighted_quantiles
from panelcast.session import materialize

#: Ranks of the sketch are within rows / ACCURACY; columns of one aggregate.
ACCURACY, CHUNK = 2000, 27


def _value(column: str) -> str:
    return f"CASE WHEN NOT isnan(CAST({q(column)} AS DOUBLE)) THEN CAST({q(column)} AS DOUBLE) END"


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value double) of the given columns; nulls and NaN left out."""
    body = ", ".join(f"'{c}', {_value(c)}" for c in columns)
    return df.selectExpr(*[q(k) for k in keep], f"stack({len(columns)}, {body}) AS (`column`, value)").where("value IS NOT NULL")


def sketched_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """(column, values): approximate quantiles, each a value of the column whose rank is off by at most rows / ``accuracy``.

    One pass in chunks of columns; a column without values has null."""
    at = ", ".join(f"{min(1.0, max(0.0, p))!r}D" for p in probs)
    parts = []
    for i in range(0, len(columns), CHUNK):
        some = columns[i : i + CHUNK]
        one = df.selectExpr(*[f"percentile_approx({_value(c)}, array({at}), {accuracy}) AS _{k}" for k, c in enumerate(some)])
        body = ", ".join(f"'{c}', _{k}" for k, c in enumerate(some))
        parts.append(one.selectExpr(f"stack({len(some)}, {body}) AS (`column`, `values`)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """(column, q, value): exact quantiles with linear interpolation of every column; ``df`` should be a written table.

    Nulls and NaN are left out; a column without values has no rows.  An empty table gives an empty result."""
    probs, k = sorted(probs), len(probs)
    wide = 2.0 / accuracy
    brackets = sketched_quantiles(df, columns, [p - wide for p in probs] + [p + wide for p in probs], accuracy).where("values IS NOT NULL")
    # a row of 2 k numbers for each column, broadcast
    flat = materialize(brackets.selectExpr("`column`", *[f"values[{i}] AS _lo{i}" for i in range(k)], *[f"values[{k + i}] AS _hi{i}" for i in range(k)]),
                       "quantile-brackets")
    slot = "CASE " + " ".join(f"WHEN value < _lo{i} THEN {2 * i} WHEN value <= _hi{i} THEN {2 * i + 1}" for i in range(k)) + f" ELSE {2 * k} END"
    placed = long_values(df, columns).join(F.broadcast(flat), "column").selectExpr("`column`", "value", f"{slot} AS _slot")
    counts = materialize(
        placed.groupBy("column", "_slot", F.expr("CASE WHEN _slot % 2 = 1 THEN value END").alias("_inside"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value")).select("column", "value", "n"), "quantile-counts")
    total = F.sum("n")
    missed = [
        (F.coalesce(F.sum(F.when(F.col("value") < F.col(f"_lo{i}"), F.col("n"))), F.lit(0)) > F.floor(F.lit(p) * (total - 1)))
        | (F.sum(F.when(F.col("value") <= F.col(f"_hi{i}"), F.col("n"))) <= F.ceil(F.lit(p) * (total - 1)))
        for i, p in enumerate(probs)
    ]
    bad = counts.join(F.broadcast(flat), "column").groupBy("column").agg(F.greatest(*missed, F.lit(False)).alias("bad")).where("bad").select("column").collect()
    if bad:  # at most the columns
        names = [r["column"] for r in bad]
        again = long_values(df, names).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        counts = materialize(counts.where(~F.col("column").isin(names)).unionByName(again), "quantile-counts")
    return weighted_quantiles(counts, "value", "n", list(probs), group="column")
