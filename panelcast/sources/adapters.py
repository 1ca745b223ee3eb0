"""Adapters: raw transactional tables -> canonical account x period panel.

Both adapters aggregate first (map-side partial aggregation, so a hot key is
combined before it is shuffled) and then run one window over the compact
panel.  The panel holds at most one row per (account, period), so a window
partition is bounded by the number of periods, whatever the raw skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.expressions import CHANNELS, round_half_away

PANEL_COLUMNS = [
    "account_id",
    "month",
    "current_month_transactions",
    "current_month_revenue",
    "total_tickets",
    "escalated_tickets",
    "late_payments",
    "enabled_channels",
    "self_service_percentage",
    "last_touchbase_date",
    "average_resolution_time_hours",
    "churned",
]

# Order priority code (first character) -> channel, for the orders adapter.
PRIORITY_CHANNEL = {"1": "web", "2": "card", "3": "agent", "4": "ivr", "5": "apple_pay"}


def _channel_string(bits_col: str = "_channels"):
    """Sorted distinct channels joined by '|' from the group's channel bits; sorting is fixed by the name order."""
    parts = [F.when(F.col(bits_col).bitwiseAND(1 << CHANNELS.index(c)) != 0, F.lit(c)) for c in sorted(CHANNELS)]
    return F.concat_ws("|", *parts)


def _channel_bits(channel_col: str = "channel", bits_col: str = "_channels"):
    """One integer ``bit_or`` for all channels: a group-by on the code-generated hash aggregate, whose generated method
    stays small enough to be compiled (one flag for each channel made it too large)."""
    bit = F.lit(0)
    for i, c in enumerate(CHANNELS):
        bit = F.when(F.col(channel_col) == c, F.lit(1 << i)).otherwise(bit)
    return F.bit_or(bit).alias(bits_col)


def _keyed(prefix: str, key: str, width: int = 6):
    """Prefix + key, short keys padded with zeros to ``width``; longer keys stay whole."""
    text = F.col(key).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def _finish_panel(monthly: DataFrame, last_period: DataFrame, churn_gap, *, months: bool) -> DataFrame:
    """Add last_touchbase_date and churned with one window over (account, period)."""
    w = Window.partitionBy("account_id").orderBy("month")
    w_all = Window.partitionBy("account_id")
    if months:
        observable = F.add_months(F.col("month"), churn_gap) <= F.col("_global_last")
    else:
        observable = F.date_add(F.col("month"), churn_gap) <= F.col("_global_last")
    is_last = F.col("month") == F.max("month").over(w_all)
    panel = (
        monthly.crossJoin(F.broadcast(last_period))  # one row: proven size bound
        .select(
            "*",
            _channel_string().alias("enabled_channels"),
            F.coalesce(F.lag("_last_ts").over(w), F.col("month").cast("timestamp_ntz")).alias("last_touchbase_date"),
            F.when(is_last & observable, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("churned"),
        )
    )
    return panel.select(*PANEL_COLUMNS)


def orders_panel(orders: DataFrame, lineitem: DataFrame, churn_gap_months: int = 12, customer: int | None = None) -> DataFrame:
    """Panel O: one row per customer and calendar month with orders.

    transactions / revenue = orders and their total price; tickets = returned
    lines, escalated = returned lines with quantity > 40; late payments =
    orders in status 'P'; channels = order priorities mapped to channels;
    self-service = share of lines with status 'F' (x100); resolution time =
    mean line quantity; churned = 1 on the last month of an account when at
    least ``churn_gap_months`` further months are observed in the data.

    ``customer`` keeps one customer's rows: the filter reaches the scan of the orders, and
    only the lines of those orders are aggregated.  The last observed month stays that of all orders.
    """
    last_period = orders.agg(F.trunc(F.max("o_orderdate").cast("date"), "month").alias("_global_last"))
    if customer is not None:
        orders = orders.where(F.col("o_custkey") == customer)
        lineitem = lineitem.join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"),
        F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40), 1).otherwise(0)).alias(
            "n_escalated"
        ),
        F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("n_final"),
        F.sum("l_quantity").alias("qty"),
    )
    channel_map = F.create_map(*[F.lit(x) for kv in PRIORITY_CHANNEL.items() for x in kv])
    o = orders.select(
        "o_orderkey",
        _keyed("ACC-", "o_custkey").alias("account_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        F.element_at(channel_map, F.substring("o_orderpriority", 1, 1)).alias("channel"),
    )
    joined = o.join(per_order, o["o_orderkey"] == per_order["l_orderkey"], "left")
    monthly = joined.groupBy("account_id", "month").agg(
        F.count("o_orderkey").alias("current_month_transactions"),
        round_half_away(F.sum("o_totalprice"), 2).alias("current_month_revenue"),
        F.coalesce(F.sum("n_returned"), F.lit(0)).cast("bigint").alias("total_tickets"),
        F.coalesce(F.sum("n_escalated"), F.lit(0)).cast("bigint").alias("escalated_tickets"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).cast("bigint").alias("late_payments"),
        _channel_bits(),
        F.coalesce(F.sum("n_final") * 100.0 / F.sum("n_lines"), F.lit(0.0)).alias("self_service_percentage"),
        F.coalesce(F.sum("qty") / F.sum("n_lines"), F.lit(0.0)).alias("average_resolution_time_hours"),
        F.max("o_orderdate").alias("_last_ts"),
    )
    return _finish_panel(monthly, last_period, churn_gap_months, months=True)


def events_panel(events: DataFrame, churn_gap_days: int = 7) -> DataFrame:
    """Panel E: one row per user and day with events (dense daily panel).

    transactions / revenue = purchases and their value; tickets = errors,
    escalated = errors with value > 40; late payments = signup events;
    channels = ``k % 5`` of the JSON property ``k``; self-service = share of
    view/click events (x100); resolution time = mean error value; churned = 1
    on the last day of a user when ``churn_gap_days`` further days are observed.
    """
    channels = F.array(*[F.lit(c) for c in CHANNELS])
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = events.select(
        _keyed("USR-", "user_id").alias("account_id"),
        F.col("ts").cast("date").alias("month"),
        "ts",
        "event_type",
        "value",
        F.element_at(channels, (F.pmod(k, F.lit(5)) + 1).cast("int")).alias("channel"),
    )
    is_purchase = F.col("event_type") == "purchase"
    is_error = F.col("event_type") == "error"
    daily = e.groupBy("account_id", "month").agg(
        F.count_if(is_purchase).alias("current_month_transactions"),
        round_half_away(F.coalesce(F.sum(F.when(is_purchase, F.col("value"))), F.lit(0.0)), 2).alias(
            "current_month_revenue"
        ),
        F.count_if(is_error).alias("total_tickets"),
        F.count_if(is_error & (F.col("value") > 40)).alias("escalated_tickets"),
        F.count_if(F.col("event_type") == "signup").alias("late_payments"),
        _channel_bits(),
        (F.avg(F.col("event_type").isin("view", "click").cast("double")) * 100.0).alias("self_service_percentage"),
        F.coalesce(F.avg(F.when(is_error, F.col("value"))), F.lit(0.0)).alias("average_resolution_time_hours"),
        F.max("ts").alias("_last_ts"),
    )
    last_period = events.agg(F.max("ts").cast("date").alias("_global_last"))
    return _finish_panel(daily, last_period, churn_gap_days, months=False)
