"""Horizon labels, chronological splits, CV folds and class statistics.

Splits depend only on month membership: the distinct-period table (one row per
period, so its size is bounded by the time range, not by the data) gets its
positions from a window over that tiny table and is broadcast back.  No global
sort of the panel is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.guards import require_periods

# Most periods that a period table may have (calendar months or days: more than
# this is not a calendar); checked before it is broadcast.
MAX_PERIODS = 1_000_000


def horizon_labels(
    df: DataFrame,
    horizon: int = 3,
    label: str = "churned",
    out: str | None = None,
    key: str = "account_id",
    period: str = "month",
) -> DataFrame:
    """1 when the event happens in the current row or the next ``horizon`` rows."""
    out = out or f"{label}_next_{horizon}mo"
    w = Window.partitionBy(key).orderBy(period).rowsBetween(Window.currentRow, horizon)
    return df.select("*", (F.coalesce(F.max(F.col(label)).over(w), F.lit(0)) > 0).cast("int").alias(out))


def swap_label(df: DataFrame, source: str = "churned_next_3mo", target: str = "churned") -> DataFrame:
    """target := source, then drop source so it cannot leak into the features."""
    cols = [F.col(source).alias(target) if c == target else F.col(c) for c in df.columns if c != source]
    return df.select(*cols)


def month_index(df: DataFrame, period: str = "month") -> DataFrame:
    """(period, period_idx 1-based, n_periods) over the distinct periods."""
    periods = df.select(period).distinct()
    w = Window.orderBy(period)  # over the tiny distinct-period table only
    return periods.select(
        period,
        F.row_number().over(w).alias("period_idx"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n_periods"),
    )


def _with_index(df: DataFrame, period: str, n_needed: int | None = None) -> DataFrame:
    idx, n = period_table(df, period)
    if n_needed is not None:
        require_periods(n, n_needed)
    return df.join(F.broadcast(idx), on=period, how="inner")


def period_table(df: DataFrame, period: str = "month") -> tuple[DataFrame, int]:
    """``month_index`` and its number of periods, checked to be a calendar's (so it can be broadcast)."""
    idx = month_index(df, period)
    n = idx.count()
    if n > MAX_PERIODS:
        raise ValueError(f"{n} distinct values of {period!r}: not a period column")
    return idx, n


def time_split(
    df: DataFrame,
    train_months: int,
    val_months: int,
    test_months: int,
    period: str = "month",
    check: bool = True,
) -> DataFrame:
    """Chronological three-way split by distinct periods -> adds ``split``.

    Periods after train+val+test are dropped (as in the original).
    """
    total = train_months + val_months + test_months
    j = _with_index(df, period, total if check else None)
    i = F.col("period_idx")
    split = (
        F.when(i <= train_months, "train")
        .when(i <= train_months + val_months, "val")
        .when(i <= total, "test")
    )
    return j.select(*df.columns, split.alias("split")).where(F.col("split").isNotNull())


def time_split_horizon(
    df: DataFrame, train_months: int, horizon: int = 3, period: str = "month", check: bool = True
) -> DataFrame:
    """train = first n periods; test = periods n+1 .. total-horizon -> adds ``split``."""
    j = _with_index(df, period, train_months + horizon if check else None)
    i, n = F.col("period_idx"), F.col("n_periods")
    split = F.when(i <= train_months, "train").when(i <= n - horizon, "test")
    return j.select(*df.columns, split.alias("split")).where(F.col("split").isNotNull())


def cv_blocks(df: DataFrame, n_splits: int = 3, period: str = "month") -> DataFrame:
    """Forward-chaining CV by period blocks -> adds ``cv_block``.

    With n periods and size = n // (n_splits + 1), the last n_splits blocks of
    ``size`` periods are the validation blocks 1..n_splits; block 0 is the
    training-only prefix.  Fold f trains on blocks < f and validates on f.
    """
    idx, _ = period_table(df, period)
    size = F.floor(F.col("n_periods") / (n_splits + 1))
    first_val = F.col("n_periods") - size * n_splits
    block = F.when(F.col("period_idx") <= first_val, F.lit(0)).otherwise(
        F.ceil((F.col("period_idx") - first_val) / size)
    )
    idx = idx.select(period, block.cast("int").alias("cv_block"))
    return df.join(F.broadcast(idx), on=period, how="inner")


def class_distribution(df: DataFrame, label: str = "churned") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def class_weights(df: DataFrame, label: str = "churned", out: str = "class_weight") -> DataFrame:
    """Balanced weights n / (2 * n_class), joined back by broadcast (a row for each class).

    Weights for training must come from training rows only: pass those."""
    w = Window.partitionBy()  # over the class table only
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    weights = counts.select(label, (F.sum("_n").over(w) / (F.count(F.lit(1)).over(w) * F.col("_n"))).alias(out))
    return df.join(F.broadcast(weights), on=label, how="left")


def split_rates(df: DataFrame, labels: list[str], split: str = "split") -> DataFrame:
    """Rows and positive share per split for each label, plus the uplift ratio of the last two."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.avg(F.col(lab).cast("double")).alias(f"{lab}_rate") for lab in labels]
    out = df.groupBy(split).agg(*aggs)
    if len(labels) >= 2:
        a, b = labels[0], labels[1]
        out = out.select("*", F.try_divide(F.col(f"{b}_rate"), F.col(f"{a}_rate")).alias("uplift"))
    return out


def account_hash(key: str, seed: int):
    """A number of 52 bits from a seeded md5 of the key: the same in any engine, exact as a double."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 13), 16, 10).cast("bigint")


def stratified_split(
    df: DataFrame, label: str = "churned", train_fraction: float = 0.8, seed: int = 42, key: str = "account_id", period: str = "month"
) -> DataFrame:
    """Exact stratified split of the accounts' last records -> adds ``split``.

    In each class the accounts are ordered by a seeded hash of their key, and the first
    floor(fraction x class size) of them are train, so no account is on both sides and both
    sides have the class shares.  Accounts without a label are a class of their own.  The cut
    comes from two-level prefix counts of the hash values: no class is sorted in one task.
    """
    from panelcast.operators.metrics import prefix_counts
    from panelcast.operators.spine import last_record

    last = last_record(df, key, period).withColumn("_h", account_hash(key, seed).cast("double")).withColumn(
        "_class", F.coalesce(F.col(label).cast("string"), F.lit("")))
    places = prefix_counts(last, "_h", {"n": F.lit(1)}, descending=False, group="_class").select(
        "_class", "_h", (F.col("cum_n") <= F.floor(F.col("tot_n") * F.lit(train_fraction))).alias("_train")
    )
    split = F.when(F.col("_train"), "train").otherwise("test")
    return last.join(places, ["_class", "_h"]).select(*df.columns, split.alias("split"))
