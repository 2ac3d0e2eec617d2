"""Account star schema: staging accounts to nine silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.accounts import (
    explode_beneficiaries,
    explode_joint,
    explode_products,
)
from ledgermill.operators.keys import add_surrogate_key
from ledgermill.operators.skew import distinct_rows, row_tag, spread_join


def build_dim_account_type(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Account types that ``existing`` lacks, numbered on from its largest key."""
    types = stg.select("account_type").where(F.col("account_type").isNotNull()).distinct()
    if existing is None:
        return add_surrogate_key(types, "account_type_id", ["account_type"])
    new = types.join(existing.select("account_type"), "account_type", "left_anti")
    last = existing.agg(F.coalesce(F.max("account_type_id"), F.lit(0))).scalar()
    numbered = add_surrogate_key(new, "account_type_id", ["account_type"])
    return numbered.withColumn("account_type_id", F.col("account_type_id") + last)


def build_fact_accounts(
    stg: DataFrame, dim_account_type: DataFrame, slice_rows: int | None = None
) -> DataFrame:
    """One row per account with the key of its type.

    A few types cover all accounts: Spark broadcasts the dimension by its size, and adaptive execution
    splits the rows of a frequent type if it cannot. With ``slice_rows`` the rows of a type are dealt over
    slices of that size, for sessions without adaptive execution.
    """
    facts = stg.select(
        "account_id",
        "account_number",
        "customer_id",
        "account_purpose",
        "account_type",
        "is_primary_account",
        "branch_code",
        F.col("kyc_verified").alias("is_kyc_verified"),
        F.col("fica_verified").alias("is_fica_verified"),
        "expected_amount",
        "currency",
        "swift_code",
        "iban",
        "statement_frequency",
        F.col("cross_border_enabled").alias("is_cross_border_enabled"),
        F.col("minimum_deposit_met").alias("is_minimum_deposit_met"),
        "account_opening_channel",
    )
    types = dim_account_type.select("account_type", "account_type_id")
    if slice_rows is None:
        return distinct_rows(facts.join(types, "account_type").drop("account_type"))
    keyed = spread_join(
        row_tag(facts), types, "account_type", "account_type", how="inner", slice_rows=slice_rows
    )
    return distinct_rows(keyed.drop("account_type", "_row"))


def build_dim_account_status(stg: DataFrame) -> DataFrame:
    return stg.select(
        "account_id",
        "account_status",
        "account_opening_date",
        "account_approval_date",
        "account_status_change_date",
        "account_closing_date",
        "account_status_change_reason",
    ).transform(distinct_rows)


def build_dim_account_joint_customers(stg: DataFrame) -> DataFrame:
    return (
        stg.select("account_id", "linked_joint_accounts")
        .transform(explode_joint)
        .where(F.col("joint_customer_id").isNotNull())
        .select("account_id", "joint_customer_id")
        .transform(distinct_rows)
    )


def build_dim_account_type_details(stg: DataFrame) -> DataFrame:
    return stg.select(
        "account_id",
        "account_tier",
        F.col("interest_rate").alias("annual_interest_rate"),
        F.col("monthly_charges").alias("monthly_maintenance_fee"),
        F.col("transactions_rate").alias("transaction_fee_rate"),
        F.col("negative_balance_rate").alias("overdraft_interest_rate"),
        F.col("overdraft_limit").alias("approved_overdraft_limit"),
    ).transform(distinct_rows)


def build_dim_account_products(stg: DataFrame) -> DataFrame:
    """Bundled products, active from online activation or else from approval."""
    online = F.col("online_banking_enabled") == 1
    activated = F.when(online, F.col("online_banking_activation_date")).otherwise(
        F.col("account_approval_date")
    )
    return (
        stg.select("account_id", "bundled_products", activated.alias("product_activation_date"))
        .transform(explode_products)
        .where(F.col("bundled_product").isNotNull())
        .select("account_id", F.col("bundled_product").alias("product_type"), "product_activation_date")
        .transform(distinct_rows)
    )


def build_dim_account_card_details(stg: DataFrame) -> DataFrame:
    return (
        stg.where(F.col("card_number").isNotNull())
        .select(
            "account_id",
            "card_number",
            "card_type",
            "card_issue_date",
            "card_expiry_date",
            F.col("card_replaced").alias("is_card_replaced"),
            "card_replacement_date",
            "credit_card_limit",
        )
        .transform(distinct_rows)
    )


def build_dim_account_beneficiary(stg: DataFrame) -> DataFrame:
    return (
        stg.select("account_id", "beneficiaries")
        .transform(explode_beneficiaries)
        .where(F.col("beneficiary_name").isNotNull())
        .drop("beneficiaries")
        .transform(distinct_rows)
    )


def build_dim_account_documents(stg: DataFrame) -> DataFrame:
    """Delivered documents; the score is missing when any of the five flags is."""
    papers = [
        "proof_of_income_provided",
        "bank_statements_provided",
        "employer_letter_provided",
        "business_registration_provided",
        "tax_certificate_provided",
    ]
    score = sum((F.col(c) for c in papers[1:]), F.col(papers[0]))
    return stg.select(
        "account_id",
        *(F.col(c).alias(f"is_{c}") for c in papers),
        score.try_cast("decimal(5,2)").alias("document_status_score"),
    ).transform(distinct_rows)


# fact_accounts is built apart: it also needs dim_account_type
ACCOUNT_TABLES = {
    "dim_account_type": build_dim_account_type,
    "dim_account_status": build_dim_account_status,
    "dim_account_joint_customers": build_dim_account_joint_customers,
    "dim_account_type_details": build_dim_account_type_details,
    "dim_account_products": build_dim_account_products,
    "dim_account_card_details": build_dim_account_card_details,
    "dim_account_beneficiary": build_dim_account_beneficiary,
    "dim_account_documents": build_dim_account_documents,
}
