"""Department reports over silver tables and caller-supplied loan tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.plans.measures import count_if, running_total

# --- fixed values -----------------------------------------------------------------------

# (fewest days past due, label)
PAST_DUE_BUCKETS = [(90, "90+"), (60, "60-89"), (30, "30-59"), (1, "1-29")]
# (most days to maturity, label)
MATURITY_BUCKETS = [(0, "MATURED"), (30, "0-30 DAYS"), (90, "31-90 DAYS"), (365, "91-365 DAYS")]
LONG_MATURITY = "OVER 365 DAYS"


def branch_performance(
    transactions: DataFrame, fact_accounts: DataFrame, dim_addresses: DataFrame
) -> DataFrame:
    """Accounts, transactions and amounts per branch and province of the primary address.

    Transactions are summed per account and accounts per branch and customer before the
    joins, so busy accounts and large customers arrive as few rows.
    """
    per_account = transactions.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("transaction_amount").alias("amount")
    )
    accounts = fact_accounts.select("account_id", "branch_code", "customer_id").distinct()
    per_owner = (
        accounts.join(per_account, "account_id", "left")
        .groupBy("branch_code", "customer_id")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"),
        )
    )
    homes = (
        dim_addresses.where(F.col("is_primary_address") == 1).select("customer_id", "province").distinct()
    )
    return (
        per_owner.join(homes, "customer_id", "left")
        .groupBy("branch_code", "province")
        .agg(
            F.sum("accounts").alias("accounts"),
            F.sum("transactions").alias("transactions"),
            F.sum("amount").alias("amount"),
        )
    )


def customer_segments(fact_customers: DataFrame, dim_customer_risks: DataFrame) -> DataFrame:
    """Customers per type, age group and risk level."""
    return (
        fact_customers.select("customer_id", "customer_type", "age_group", "fixed_age_at_opening")
        .join(dim_customer_risks.select("customer_id", "risk_level"), "customer_id")
        .groupBy("customer_type", "age_group", "risk_level")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("fixed_age_at_opening").alias("total_age"),
            F.count("fixed_age_at_opening").alias("aged_customers"),
        )
    )


def _bucket(c: Column, buckets: list[tuple[int, str]], last: Column, below: bool) -> Column:
    out = F
    for bound, name in buckets:
        out = out.when(c <= bound if below else c >= bound, name)
    return out.otherwise(last)


def past_due_buckets(loans: DataFrame) -> DataFrame:
    """Loans and outstanding amounts per past-due bucket; current loans are left out."""
    days = F.col("days_past_due")
    return (
        loans.where(days >= 1)
        .groupBy(_bucket(days, PAST_DUE_BUCKETS, F.lit(None), below=False).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("loans"), F.sum("outstanding").alias("outstanding"))
    )


def daily_liquidity(transactions: DataFrame) -> DataFrame:
    """Inflow, outflow, net and running net per day; credits flow in, debits out."""
    amount, kind = F.col("transaction_amount"), F.col("transaction_type")
    zero = F.lit(0).cast("decimal(15,2)")
    daily = (
        transactions.where(F.col("transaction_date").isNotNull())
        .groupBy(F.col("transaction_date").alias("day"))
        .agg(
            F.sum(F.when(kind == "CREDIT", amount).otherwise(zero)).alias("inflow"),
            F.sum(F.when(kind == "DEBIT", amount).otherwise(zero)).alias("outflow"),
        )
        .withColumn("net", F.col("inflow") - F.col("outflow"))
    )
    return running_total(daily, "day", "net", "running_net")


def maturity_profile(loans: DataFrame, as_of: str) -> DataFrame:
    """Outstanding amounts per time to maturity."""
    days = F.datediff("maturity_date", F.lit(as_of).cast("date"))
    return (
        loans.where(F.col("maturity_date").isNotNull())
        .groupBy(_bucket(days, MATURITY_BUCKETS, F.lit(LONG_MATURITY), below=True).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("loans"), F.sum("outstanding").alias("outstanding"))
    )


def kyc_summary(fact_accounts: DataFrame, dim_customer_risks: DataFrame) -> DataFrame:
    """KYC and FICA state of accounts per risk level of their owner.

    Accounts are counted per customer before the join.
    """
    per_owner = fact_accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum(count_if(F.col("is_kyc_verified") == 1)).alias("kyc_verified"),
        F.sum(count_if(F.col("is_fica_verified") == 1)).alias("fica_verified"),
    )
    risks = dim_customer_risks.select("customer_id", "risk_level", "is_pep", "is_sanctioned_country")
    return (
        per_owner.join(risks, "customer_id")
        .groupBy("risk_level")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("accounts").alias("accounts"),
            F.sum("kyc_verified").alias("kyc_verified"),
            F.sum("fica_verified").alias("fica_verified"),
            F.sum(count_if(F.col("is_pep") == 1)).alias("pep_customers"),
            F.sum(count_if(F.col("is_sanctioned_country") == 1)).alias("sanctioned_customers"),
        )
    )
