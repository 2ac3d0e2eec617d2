"""Customers by the time they hold open accounts: who is lost, and who comes back.

A customer whose last open account closes is lost on that day, also if another account follows later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.plans.measures import count_if, percent, period_start, running_total
from ledgermill.plans.metrics import account_owners

# stands for an opening day that is not known: before all others
UNKNOWN_DAY = "0001-01-01"


def _unknown_day() -> Column:
    return F.lit(UNKNOWN_DAY).cast("date")


def account_days(fact_accounts: DataFrame, dim_account_status: DataFrame) -> DataFrame:
    """(customer_id, account_id, opened, closed): the days an account is open, the closing day excluded.

    An account listed several times opens on its earliest and closes on its latest day; without a closing
    day it is open still. An account that closes on its opening day or before it is never open and left out.
    """
    return (
        account_owners(fact_accounts)
        .where(F.col("customer_id").isNotNull())
        .join(dim_account_status.select("account_id", "account_opening_date", "account_closing_date"), "account_id")
        .groupBy("customer_id", "account_id")
        .agg(
            F.min(F.coalesce("account_opening_date", _unknown_day())).alias("opened"),
            F.max("account_closing_date").alias("closed"),
        )
        .where(F.col("closed").isNull() | (F.col("closed") > F.col("opened")))
    )


def customer_periods(fact_accounts: DataFrame, dim_account_status: DataFrame) -> DataFrame:
    """(customer_id, period_number, started, ended): unbroken stretches of days with an open account.

    ``ended`` is the first day without one, NULL while the stretch lasts; ``started`` is NULL if the opening
    day is not known. Openings and closings are summed per customer and day before any window, so a
    customer with very many accounts brings at most one row per calendar day to it.
    """
    moves = F.array(
        F.struct(F.col("opened").alias("day"), F.lit(1).alias("change")),
        F.struct(F.col("closed").alias("day"), F.lit(-1).alias("change")),
    )
    daily = (
        account_days(fact_accounts, dim_account_status)
        .select("customer_id", F.inline(moves))
        .where(F.col("day").isNotNull())
        .groupBy("customer_id", "day")
        .agg(F.sum("change").alias("change"))
        .where(F.col("change") != 0)
    )
    by_day = Window.partitionBy("customer_id").orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_accounts = daily.withColumn("accounts", F.sum("change").over(so_far))
    starts = (F.col("accounts") == F.col("change")).alias("starts")
    turns = open_accounts.where((F.col("accounts") == 0) | (F.col("accounts") == F.col("change"))).select(
        "customer_id", "day", starts
    )
    # starts and ends take turns from here on
    paired = turns.withColumns(
        {"ended": F.lead("day").over(by_day), "period_number": F.sum(count_if(F.col("starts"))).over(so_far)}
    )
    return paired.where("starts").select(
        "customer_id", "period_number", F.nullif(F.col("day"), _unknown_day()).alias("started"), "ended"
    )


def customer_turnover(periods: DataFrame) -> DataFrame:
    """(period, start_customers, new_customers, returned_customers, lost_customers, end_customers) per month.

    The first and the last day of a month are compared: a customer with an open account before the month and
    none at its end is lost; one with none before it and one at its end is new, or has returned after an
    earlier stretch. Who comes and goes, or goes and comes back, within a month changes no number of it.
    Months in which nobody comes or goes have no row.
    """
    moves = F.array(
        F.struct(F.coalesce("started", _unknown_day()).alias("day"), F.lit(True).alias("starts"), "period_number"),
        F.struct(F.col("ended").alias("day"), F.lit(False).alias("starts"), "period_number"),
    )
    month = period_start(F.col("day"), "month").alias("period")
    by_customer = (
        periods.select("customer_id", F.inline(moves))
        .where(F.col("day").isNotNull())
        .groupBy("customer_id", month)
        .agg(
            F.min_by("starts", "day").alias("came"),
            F.max_by("starts", "day").alias("stayed"),
            F.min("period_number").alias("period_number"),
        )
    )
    gained = F.col("came") & F.col("stayed")
    monthly = (
        by_customer.groupBy("period")
        .agg(
            F.sum(count_if(gained & (F.col("period_number") == 1))).alias("new_customers"),
            F.sum(count_if(gained & (F.col("period_number") > 1))).alias("returned_customers"),
            F.sum(count_if(~F.col("came") & ~F.col("stayed"))).alias("lost_customers"),
        )
        .withColumn("net", F.col("new_customers") + F.col("returned_customers") - F.col("lost_customers"))
    )
    return (
        running_total(monthly, "period", "net", "end_customers")
        .where(F.col("period") > _unknown_day())
        .select(
            "period",
            (F.col("end_customers") - F.col("net")).alias("start_customers"),
            "new_customers",
            "returned_customers",
            "lost_customers",
            "end_customers",
        )
    )


def retention_of_turnover(turnover: DataFrame) -> DataFrame:
    """M4 and M5 by stretches: (period, …, kept_customers, churn_pct, retention_pct); both add up to 100."""
    kept = F.col("start_customers") - F.col("lost_customers")
    return turnover.select(
        "period",
        "start_customers",
        "lost_customers",
        "returned_customers",
        kept.alias("kept_customers"),
        percent(F.col("lost_customers"), F.col("start_customers")).alias("churn_pct"),
        percent(kept, F.col("start_customers")).alias("retention_pct"),
    )
