"""Impact of retention campaigns: campaign intervals meet the scores of their accounts as of their dates.

One union of scores and campaign marks, partitioned by account and ordered by day, answers all as-of questions:
the last score before a campaign starts, the mean before its start and the mean and churn after its end are
range frames over the same sort, so nothing is joined on an inequality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Days before the start and after the end that are compared.
DAYS = 60


def campaign_scores(scores: DataFrame, campaigns: DataFrame, days: int = DAYS, period: str = "month",
                    score: str = "churn_risk_score", churned: str = "churned") -> DataFrame:
    """One row for each distinct campaign row (``account_id, campaign, start_date, end_date``): ``risk_at_start`` (the account's
    last score dated before the start, however old), ``risk_before`` / ``risk_after`` (mean scores of the ``days`` days before
    the start / after the end) and ``churned_after`` (1 if a churn falls in the latter).

    A null end is the start; an end before the start counts as the start.  A campaign without an account or a start is left out.
    Without scores in a frame its column is null.  Null scores and scores without account or date are not read.  Further
    columns are not read."""
    c = campaigns.select("account_id", "campaign", F.col("start_date").cast("date").alias("start_date"), F.col("end_date").cast("date").alias("end_date"))
    c = c.where("account_id IS NOT NULL AND start_date IS NOT NULL").withColumn("end_date", F.greatest("start_date", "end_date")).distinct()
    marks = c.select("*", F.inline(F.array(F.struct(F.lit("start").alias("_mark"), F.unix_date("start_date").alias("_day")),
                                           F.struct(F.lit("end").alias("_mark"), F.unix_date("end_date").alias("_day")))))
    dated = scores.select("account_id", F.unix_date(F.col(period).cast("date")).alias("_day"), F.col(score).cast("double").alias("_score"),
                          F.col(churned).cast("int").alias("_churned")).where("account_id IS NOT NULL AND _day IS NOT NULL AND _score IS NOT NULL")
    w = Window.partitionBy("account_id").orderBy("_day")
    x = dated.unionByName(marks, allowMissingColumns=True).select(
        "*",
        F.last("_score", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, -1)).alias("_at"),
        F.avg("_score").over(w.rangeBetween(-days, -1)).alias("_before"),
        F.avg("_score").over(w.rangeBetween(1, days)).alias("_after"),
        F.max("_churned").over(w.rangeBetween(1, days)).alias("_lost"),
    ).where("_mark IS NOT NULL")
    at = lambda mark, col: F.max(F.when(F.col("_mark") == mark, F.col(col)))
    # grouped within the accounts' partitions
    return x.groupBy("account_id", "campaign", "start_date", "end_date").agg(
        at("start", "_at").alias("risk_at_start"), at("start", "_before").alias("risk_before"),
        at("end", "_after").alias("risk_after"), at("end", "_lost").alias("churned_after"))


def campaign_impact(per_campaign: DataFrame, at_risk: float = 0.5, value: float = 1000.0, cost: float = 50.0) -> DataFrame:
    """By campaign: contacts, compared contacts (scores before and after), mean risk before and after and its change, contacts
    that stood at risk (``risk_at_start`` >= ``at_risk``) and have scores after, how many of them did not churn (``n_saved``,
    ``save_rate``, null without any), and ``roi`` = saved x ``value`` - contacts x ``cost``."""
    both = F.col("risk_before").isNotNull() & F.col("risk_after").isNotNull()
    risky = (F.col("risk_at_start") >= at_risk) & F.col("risk_after").isNotNull()
    saved = risky & (F.coalesce("churned_after", F.lit(0)) == 0)
    out = per_campaign.groupBy("campaign").agg(
        F.count(F.lit(1)).alias("n_contacts"), F.count_if(both).alias("n_compared"),
        F.avg(F.when(both, F.col("risk_before"))).alias("avg_risk_before"), F.avg(F.when(both, F.col("risk_after"))).alias("avg_risk_after"),
        F.avg(F.when(both, F.col("risk_after") - F.col("risk_before"))).alias("avg_change"),
        F.count_if(risky).alias("n_at_risk"), F.count_if(saved).alias("n_saved"))
    return out.select("*", F.try_divide("n_saved", "n_at_risk").alias("save_rate"),
                      (F.col("n_saved") * F.lit(float(value)) - F.col("n_contacts") * F.lit(float(cost))).alias("roi"))
