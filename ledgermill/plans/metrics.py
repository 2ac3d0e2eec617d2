"""Gold metrics over silver tables; frames that silver lacks are passed in by the caller.

Facts are summed per account or customer before they are joined, so a busy account or a
customer with many accounts reaches each join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.plans.measures import (
    average,
    count_if,
    growth_rate,
    number,
    percent,
    period_start,
    product,
    quotient,
    ratio,
    running_total,
)

# --- fixed values -----------------------------------------------------------------------

FEE_COLUMNS = ["transaction_fee", "fx_fee", "swift_fee", "correspondent_fee"]
DIGITAL_CHANNELS = ["MOBILE", "MOBILE APP", "EWALLET", "ONLINE", "INTERNET BANKING"]
NON_PERFORMING_DAYS = 90
EARLY_DELINQUENCY_DAYS = (1, 30)
DAYS_PER_YEAR = 365.25


def fees() -> Column:
    """All fees of a transaction; missing ones count as zero."""
    zero = F.lit(0).cast("decimal(5,2)")
    parts = [F.coalesce(F.col(c), zero) for c in FEE_COLUMNS]
    return sum(parts[1:], parts[0])


def account_owners(fact_accounts: DataFrame) -> DataFrame:
    return fact_accounts.select("account_id", "customer_id").distinct()


def revenue_per_customer(transactions: DataFrame, fact_accounts: DataFrame) -> DataFrame:
    """(customer_id, revenue) from transaction fees."""
    per_account = transactions.groupBy("account_id").agg(F.sum(fees()).alias("revenue"))
    return (
        per_account.join(account_owners(fact_accounts), "account_id")
        .groupBy("customer_id")
        .agg(F.sum("revenue").alias("revenue"))
    )


# --- customers --------------------------------------------------------------------------


def new_customers(fact_customers: DataFrame, unit: str = "month") -> DataFrame:
    """(period, new_customers) per day, week, month or year of registration."""
    return (
        fact_customers.where(F.col("customer_registration_date").isNotNull())
        .groupBy(period_start(F.col("customer_registration_date"), unit).alias("period"))
        .agg(F.count(F.lit(1)).alias("new_customers"))
    )


def customer_base_growth(fact_customers: DataFrame) -> DataFrame:
    """M1: growth of the total number of customers per month."""
    totals = running_total(new_customers(fact_customers), "period", "new_customers", "total_customers")
    before = F.col("total_customers") - F.col("new_customers")
    return totals.select(
        "period",
        "total_customers",
        before.alias("previous_total"),
        percent(F.col("new_customers"), before).alias("growth_pct"),
    )


def new_customer_growth(fact_customers: DataFrame, unit: str = "month") -> DataFrame:
    """M2: new customers against the period before."""
    return growth_rate(new_customers(fact_customers, unit), "period", "new_customers", unit)


def new_customer_growth_yoy(fact_customers: DataFrame) -> DataFrame:
    """M3: new customers of a month against the same month a year earlier."""
    return growth_rate(new_customers(fact_customers), "period", "new_customers", "month", 12)


def lost_customers(fact_accounts: DataFrame, dim_account_status: DataFrame) -> DataFrame:
    """(customer_id, lost_date): customers without any open account left."""
    closings = dim_account_status.select("account_id", "account_closing_date")
    return (
        account_owners(fact_accounts)
        .join(closings, "account_id")
        .groupBy("customer_id")
        .agg(
            F.sum(count_if(F.col("account_closing_date").isNull())).alias("open_accounts"),
            F.max("account_closing_date").alias("lost_date"),
        )
        .where(F.col("open_accounts") == 0)
        .select("customer_id", "lost_date")
    )


def customer_movement(
    fact_customers: DataFrame, fact_accounts: DataFrame, dim_account_status: DataFrame
) -> DataFrame:
    """(period, start_customers, new_customers, lost_customers, end_customers) per month."""
    gained = new_customers(fact_customers).withColumn("lost_customers", F.lit(0).cast("long"))
    lost = (
        lost_customers(fact_accounts, dim_account_status)
        .groupBy(period_start(F.col("lost_date"), "month").alias("period"))
        .agg(F.lit(0).cast("long").alias("new_customers"), F.count(F.lit(1)).alias("lost_customers"))
    )
    monthly = (
        gained.unionByName(lost)
        .groupBy("period")
        .agg(
            F.sum("new_customers").alias("new_customers"),
            F.sum("lost_customers").alias("lost_customers"),
        )
        .withColumn("net", F.col("new_customers") - F.col("lost_customers"))
    )
    return running_total(monthly, "period", "net", "end_customers").select(
        "period",
        (F.col("end_customers") - F.col("net")).alias("start_customers"),
        "new_customers",
        "lost_customers",
        "end_customers",
    )


def churn_rate(movement: DataFrame) -> DataFrame:
    """M4: customers lost in a month against those at its start."""
    rate = percent(F.col("lost_customers"), F.col("start_customers"))
    return movement.select("period", "start_customers", "lost_customers", rate.alias("churn_pct"))


def retention_rate(movement: DataFrame) -> DataFrame:
    """M5: customers at the end of a month that were there at its start."""
    kept = F.col("end_customers") - F.col("new_customers")
    rate = percent(kept, F.col("start_customers"))
    return movement.select("period", "start_customers", kept.alias("kept_customers"), rate.alias("retention_pct"))


def products_per_customer(
    fact_customers: DataFrame, dim_account_products: DataFrame, dim_account_status: DataFrame
) -> DataFrame:
    """M6: products on active accounts per customer."""
    active = dim_account_status.where(F.col("account_status") == "ACTIVE").select("account_id")
    customers = fact_customers.agg(F.countDistinct("customer_id")).scalar()
    return (
        dim_account_products.join(active, "account_id", "left_semi")
        .agg(F.count(F.lit(1)).alias("active_products"))
        .withColumn("customers", customers)
        .withColumn("products_per_customer", quotient(F.col("active_products"), F.col("customers")))
    )


def customer_lifetime_value(
    fact_customers: DataFrame, fact_accounts: DataFrame, transactions: DataFrame, as_of: str
) -> DataFrame:
    """M7: average revenue times average tenure in years, per customer type.

    Tenure is averaged over the customers whose registration date is known.
    """
    tenure = F.datediff(F.lit(as_of).cast("date"), F.col("customer_registration_date"))
    per_type = (
        fact_customers.select("customer_id", "customer_type", tenure.alias("days"))
        .join(revenue_per_customer(transactions, fact_accounts), "customer_id", "left")
        .groupBy("customer_type")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
            F.sum("days").alias("days"),
            F.count("days").alias("dated"),
        )
    )
    avg_revenue = quotient(F.col("revenue"), F.col("customers"))
    avg_years = quotient(F.col("days"), F.col("dated")) / DAYS_PER_YEAR
    averages = per_type.select(
        "customer_type",
        "customers",
        avg_revenue.alias("avg_revenue"),
        avg_years.alias("avg_tenure_years"),
    )
    return product(averages, "avg_revenue", "avg_tenure_years", "lifetime_value")


# --- products and portfolio -------------------------------------------------------------


def product_penetration(
    fact_customers: DataFrame, fact_accounts: DataFrame, dim_account_products: DataFrame
) -> DataFrame:
    """M8: share of customers using each product."""
    customers = fact_customers.agg(F.countDistinct("customer_id")).scalar()
    return (
        dim_account_products.select("account_id", "product_type")
        .join(account_owners(fact_accounts), "account_id")
        .groupBy("product_type")
        .agg(F.countDistinct("customer_id").alias("product_customers"))
        .withColumn("customers", customers)
        .withColumn("penetration_pct", percent(F.col("product_customers"), F.col("customers")))
    )


def loan_utilisation(loans: DataFrame, keys: list[str]) -> DataFrame:
    """M9: outstanding balance against the approved limit."""
    return ratio(loans, keys, F.col("outstanding"), F.col("approved_limit"), "utilisation_pct")


def active_accounts_ratio(dim_account_status: DataFrame) -> DataFrame:
    """Share of accounts that are active."""
    active = count_if(F.col("account_status") == "ACTIVE")
    return ratio(dim_account_status, [], active, F.lit(1), "active_pct")


# --- revenue ----------------------------------------------------------------------------


def net_interest_margin(positions: DataFrame, keys: list[str]) -> DataFrame:
    """Interest income less expense, against earning assets."""
    net = F.col("interest_income") - F.col("interest_expense")
    return ratio(positions, keys, net, F.col("earning_assets"), "nim_pct")


def fee_income(transactions: DataFrame, unit: str = "month") -> DataFrame:
    return (
        transactions.where(F.col("transaction_date").isNotNull())
        .groupBy(period_start(F.col("transaction_date"), unit).alias("period"))
        .agg(F.sum(fees()).alias("fee_income"))
    )


def fee_income_growth(transactions: DataFrame) -> DataFrame:
    """Monthly fee income against the month before."""
    return growth_rate(fee_income(transactions), "period", "fee_income")


def customer_profitability(
    transactions: DataFrame, costs: DataFrame, fact_accounts: DataFrame
) -> DataFrame:
    """Fee revenue less cost per customer; ``costs`` holds account_id and cost.

    Both kinds of rows are united first, so accounts are summed up and shuffled once.
    """
    wide, single = "decimal(38,4)", "decimal(28,4)"
    zero = F.lit(0).cast(single)
    earned = transactions.select("account_id", fees().cast(single).alias("revenue"), zero.alias("cost"))
    spent = costs.select("account_id", zero.alias("revenue"), F.col("cost").cast(single).alias("cost"))
    booked = (
        earned.unionByName(spent)
        .groupBy("account_id")
        .agg(*(F.sum(c).cast(wide).alias(c) for c in ("revenue", "cost")))
    )
    return (
        booked.join(account_owners(fact_accounts), "account_id")
        .groupBy("customer_id")
        .agg(*(F.sum(c).cast(wide).alias(c) for c in ("revenue", "cost")))
        .withColumn("profit", F.col("revenue") - F.col("cost"))
    )


# --- credit and risk --------------------------------------------------------------------


def npl_ratio(loans: DataFrame, keys: list[str], days: int = NON_PERFORMING_DAYS) -> DataFrame:
    """Outstanding balance of loans past due for at least ``days``, against all loans."""
    bad = F.when(F.col("days_past_due") >= days, F.col("outstanding"))
    return ratio(loans, keys, bad, F.col("outstanding"), "npl_pct")


def approval_rate(applications: DataFrame, keys: list[str]) -> DataFrame:
    """Approved against all applications; ``is_approved`` is 0 or 1."""
    return ratio(applications, keys, F.col("is_approved"), F.lit(1), "approval_pct")


def early_delinquency_rate(loans: DataFrame, keys: list[str]) -> DataFrame:
    """Amounts 1 to 30 days past due against all loans."""
    early = F.when(F.col("days_past_due").between(*EARLY_DELINQUENCY_DAYS), F.col("outstanding"))
    return ratio(loans, keys, early, F.col("outstanding"), "early_delinquency_pct")


def charge_off_rate(loans: DataFrame) -> DataFrame:
    """Written-off amounts of a year against its average monthly portfolio."""
    monthly = loans.groupBy(period_start(F.col("book_date"), "month").alias("month")).agg(
        F.sum("written_off").alias("written_off"), F.sum("outstanding").alias("portfolio")
    )
    yearly = monthly.groupBy(F.year("month").alias("year")).agg(
        F.sum("written_off").alias("written_off"),
        F.sum("portfolio").alias("portfolio"),
        F.count(F.lit(1)).alias("months"),
    )
    mean = quotient(F.col("portfolio"), F.col("months"))
    rate = number(F.col("written_off")) * 100 / F.nullif(mean, F.lit(0.0))
    return yearly.select("year", "written_off", mean.alias("avg_portfolio"), rate.alias("charge_off_pct"))


# --- operations -------------------------------------------------------------------------


def account_opening_days(dim_account_status: DataFrame) -> DataFrame:
    """Average days from opening to approval."""
    days = F.datediff("account_approval_date", "account_opening_date")
    return average(dim_account_status, [], days, "avg_days")


def transaction_success_rate(transactions: DataFrame, keys: list[str]) -> DataFrame:
    """Successful against all transactions."""
    success = count_if(F.col("transaction_status") == "SUCCESS")
    return ratio(transactions, keys, success, F.lit(1), "success_pct")


def call_resolution_rate(cases: DataFrame, keys: list[str]) -> DataFrame:
    """Resolved against all cases; ``is_resolved`` is 0 or 1."""
    return ratio(cases, keys, F.col("is_resolved"), F.lit(1), "resolution_pct")


# --- digital ----------------------------------------------------------------------------


def digital_adoption_rate(
    fact_customers: DataFrame,
    fact_accounts: DataFrame,
    transactions: DataFrame,
    channels: list[str] = DIGITAL_CHANNELS,
) -> DataFrame:
    """Customers that used a digital channel against all customers, per customer type."""
    digital = transactions.where(F.col("transaction_channel").isin(channels)).select("account_id").distinct()
    users = (
        digital.join(account_owners(fact_accounts), "account_id")
        .select("customer_id")
        .distinct()
        .withColumn("is_digital", F.lit(1))
    )
    known = fact_customers.select("customer_id", "customer_type").join(users, "customer_id", "left")
    return ratio(known, ["customer_type"], F.coalesce("is_digital", F.lit(0)), F.lit(1), "adoption_pct")


def app_engagement_rate(activity: DataFrame) -> DataFrame:
    """Daily against monthly active users; ``activity`` holds user_id and at."""
    daily_users = activity.select(F.col("at").cast("date").alias("day"), "user_id").distinct()
    daily = daily_users.groupBy("day").agg(F.count("user_id").alias("dau"))
    monthly = daily_users.groupBy(period_start(F.col("day"), "month").alias("month")).agg(
        F.countDistinct("user_id").alias("mau")
    )
    return (
        daily.withColumn("month", period_start(F.col("day"), "month"))
        .join(monthly, "month")
        .select("day", "dau", "mau", percent(F.col("dau"), F.col("mau")).alias("engagement_pct"))
    )


def failed_login_rate(logins: DataFrame, keys: list[str]) -> DataFrame:
    """Failed against all logins; ``is_failed`` is 0 or 1."""
    return ratio(logins, keys, F.col("is_failed"), F.lit(1), "failed_pct")


# --- report card ------------------------------------------------------------------------


def distinct_accounts(accounts: DataFrame) -> DataFrame:
    """Number of distinct account numbers, a missing one counting as one more member."""
    missing = F.coalesce(F.max(count_if(F.col("account_number").isNull())), F.lit(0))
    return accounts.agg((F.countDistinct("account_number") + missing).alias("distinct_accounts"))
