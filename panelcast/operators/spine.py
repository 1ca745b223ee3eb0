"""Period spine and last record per account."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRIC_COLUMNS = [
    "current_month_transactions",
    "current_month_revenue",
    "total_tickets",
    "escalated_tickets",
    "late_payments",
    "self_service_percentage",
    "average_resolution_time_hours",
]


def month_spine(df: DataFrame, key: str = "account_id", period: str = "month", step: str = "month", event: str = "churned") -> DataFrame:
    """One row per account per period from its first to its last row, missing metrics 0 and
    ``observed`` = 0.  The event row (churn) is the last one: later rows are cut.

    One window over the account and an explode of the gap up to the next row; no join."""
    interval = F.expr("INTERVAL 1 MONTH") if step == "month" else F.expr("INTERVAL 1 DAY")
    w = Window.partitionBy(key).orderBy(period)
    gone = F.coalesce(F.max(event).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    rows = df.select("*", F.lead(period).over(w).alias("_next"), gone.alias("_gone")).where(~F.col("_gone"))
    last = F.col("_next").isNull() | (F.col(event) == 1)
    until = F.when(last, F.col(period)).otherwise((F.col("_next") - interval).cast(df.schema[period].dataType))
    filled = rows.select("*", F.explode(F.sequence(F.col(period), F.greatest(until, F.col(period)), interval)).alias("_at"))
    seen = F.col("_at") == F.col(period)
    zero = set(METRIC_COLUMNS + [event])

    def value(c: str):
        if c == key:
            return F.col(c)
        if c == period:
            return F.col("_at").alias(c)
        missing = F.lit(0).cast(df.schema[c].dataType) if c in zero else F.lit("") if c == "enabled_channels" else F.lit(None)
        here = F.coalesce(F.col(c), missing) if c in zero or c == "enabled_channels" else F.col(c)
        return F.when(seen, here).otherwise(missing).alias(c)

    return filled.select(*[value(c) for c in df.columns], seen.cast("int").alias("observed"))


def last_record(df: DataFrame, key: str = "account_id", period: str = "month") -> DataFrame:
    """Per account: the last non-null value of every column (ordered by period).

    Partial aggregation (max_by) instead of a window, so a hot account is
    combined map-side before the shuffle.
    """
    cols = [c for c in df.columns if c != key]
    aggs = []
    for c in cols:
        if c == period:
            aggs.append(F.max(period).alias(period))
        else:
            order = F.when(F.col(c).isNotNull(), F.col(period))
            aggs.append(F.max_by(F.col(c), order).alias(c))
    return df.groupBy(key).agg(*aggs).select(*df.columns)
