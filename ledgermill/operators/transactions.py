"""Transaction cleaning and the transaction fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgermill.functions.dates import time_text
from ledgermill.functions.fixed_values import ACCOUNT_ID_PATTERN
from ledgermill.functions.text import norm, yes_flag
from ledgermill.operators.skew import distinct_rows, row_tag, spread_join
from ledgermill.sources.schemas import TRANSACTIONS, conform

# --- fixed values -----------------------------------------------------------------------

# staging name -> bronze name, upper-trimmed
STANDARD_TEXT = {
    "transaction_id": "transaction_id",
    "account_id": "account_id",
    "transaction_type": "debit_credit",
    "transaction_category": "category",
    "transaction_status": "status",
    "transaction_description": "description",
    "transaction_channel": "channel",
    "merchant_name": "merchant_name",
    "merchant_category": "merchant_category",
    "batch_reference": "batch_reference",
    "atm_location": "atm_location",
    "branch_location": "branch_location",
}
# staging name -> bronze name, YES becomes 1
YES_FLAGS = {
    "is_international_transaction": "is_international",
    "is_instant_payment": "instant_payment",
    "is_reversal": "is_reversal",
}
FACT_COLUMNS = [
    "transaction_id", "account_id", "transaction_date", "transaction_time",
    "transaction_amount", "transaction_fee", "fx_fee", "swift_fee", "correspondent_fee",
    "transaction_type", "transaction_category", "transaction_status",
    "transaction_description", "transaction_channel", "merchant_name", "merchant_category",
    "receiving_account_number", "receiving_bank", "is_international_transaction",
    "is_instant_payment", "batch_reference", "recipient_phone", "atm_location",
    "branch_location", "is_reversal", "cashback_amount", "loyalty_points",
]


def _is_ewallet() -> Column:
    return F.coalesce(norm(F.col("channel")) == "EWALLET", F.lit(False))


def resolve_receiving_account(
    tx: DataFrame, fact_accounts: DataFrame, slice_rows: int | None = None
) -> DataFrame:
    """Adds receiving_account_number.

    Account ids are looked up, other numbers are kept, and e-wallet payments have none. Only
    rows that need the lookup take part in the join; all others pass by without a shuffle. An
    account id listed with several numbers gives one row per entry.
    """
    given = F.col("receiving_account")
    needs_lookup = F.coalesce(F.upper(given).like(ACCOUNT_ID_PATTERN), F.lit(False)) & ~_is_ewallet()
    tagged = tx if "_row" in tx.columns else row_tag(tx)
    numbers = fact_accounts.select(
        norm(F.col("account_id")).alias("_account_id"), F.col("account_number").alias("_number")
    )
    looked_up = spread_join(
        tagged.where(needs_lookup).withColumn("_lookup", norm(given)),
        numbers,
        "_lookup",
        "_account_id",
        slice_rows=slice_rows,
    ).withColumn("receiving_account_number", F.coalesce("_number", F.lit("")))
    kept = F.when(_is_ewallet(), "").otherwise(F.coalesce(given, F.lit("")))
    passed = tagged.where(~needs_lookup).withColumn("receiving_account_number", kept)
    columns = [*tx.columns, "receiving_account_number"]
    return looked_up.select(*columns).unionByName(passed.select(*columns))


def clean_receiving_bank(bank: Column) -> Column:
    """Empty for transfers inside the bank and for e-wallets."""
    own = F.coalesce(norm(bank) == "SAME BANK", F.lit(False))
    return F.when(own | _is_ewallet(), "").otherwise(norm(bank))


def with_amount(bronze: DataFrame) -> DataFrame:
    """Rows delivered with an amount other than zero.

    An amount that is there but does not fit its type is none the less an amount: the row stays,
    and the cast check reports the value.
    """
    if "amount" not in bronze.columns:
        return bronze.limit(0)
    if isinstance(bronze.schema["amount"].dataType, NumericType):
        return bronze.where(F.col("amount") != 0)
    given = F.trim(F.col("amount").cast("string"))
    return bronze.where((given != "") & F.coalesce(given.try_cast("double") != 0, F.lit(True)))


def clean_transactions(
    bronze: DataFrame,
    fact_accounts: DataFrame,
    slice_rows: int | None = None,
    amounts_checked: bool = False,
) -> DataFrame:
    """Staging transactions; rows delivered without an amount or with amount zero are left out.

    ``amounts_checked``: the rows went through :func:`with_amount` before their types were fixed.
    """
    delivered = bronze if amounts_checked else with_amount(bronze)
    moved = row_tag(conform(delivered, TRANSACTIONS))
    resolved = resolve_receiving_account(moved, fact_accounts, slice_rows)
    meta = [c for c in resolved.columns if c.startswith("_") and c != "_row"]
    return resolved.select(
        *(norm(F.col(source)).alias(name) for name, source in STANDARD_TEXT.items()),
        *(yes_flag(F.col(source)).alias(name) for name, source in YES_FLAGS.items()),
        "transaction_date",
        time_text(F.col("transaction_time")).alias("transaction_time"),
        F.abs("amount").alias("transaction_amount"),
        "transaction_fee",
        "fx_fee",
        "swift_fee",
        "correspondent_fee",
        "receiving_account_number",
        clean_receiving_bank(F.col("receiving_bank")).alias("receiving_bank"),
        "recipient_phone",
        F.abs("cashback_amount").alias("cashback_amount"),
        "loyalty_points",
        *meta,
    )


def build_fact_transactions(stg: DataFrame) -> DataFrame:
    return distinct_rows(stg.select(*FACT_COLUMNS))
