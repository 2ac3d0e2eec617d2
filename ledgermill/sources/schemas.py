"""Bronze column names and types the silver layer reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values: bronze column names per type -----------------------------------------

CUSTOMERS = {
    "string": [
        "customer_id", "customer_type", "full_name", "citizenship", "nationality", "gender",
        "ethnicity", "marital_status", "education_level", "next_of_kin",
        "preferred_contact_method", "residential_address", "commercial_address",
        "principal_place_of_business", "registered_office_address", "email", "phone_number",
        "id_type", "id_number", "visa_type", "tax_id_number", "pep_type",
        "industry_risk_rating", "occupation", "employer_name", "source_of_funds",
        "trading_name", "website", "fatca_giin", "swift_bic_code", "industry",
        "city_of_incorporation", "country_of_incorporation", "bee_level", "vat_registered",
        "external_auditor", "legal_representative_name", "contact_person_name",
        "contact_person_title", "contact_person_phone", "contact_person_email",
        "contact_person_customer_id", "license_info", "major_shareholders",
        "director_customer_ids", "director_of_companies",
    ],
    "date": [
        "birth_date", "date_of_entry", "expiry_date", "visa_expiry_date",
        "date_of_incorporation",
    ],
    "int": [
        "is_pep", "sanctioned_country", "has_sanctioned_relationship", "is_director",
        "is_supervised_aml_cft", "contact_person_is_customer", "is_publicly_listed",
        "requires_license", "company_age", "number_of_employees", "directors_count",
        "shareholders_count", "num_branches_local", "num_branches_foreign",
        "num_subsidiaries_local", "num_subsidiaries_foreign",
    ],
    "decimal(15,4)": ["risk_score"],
    "decimal(15,2)": ["annual_income", "annual_turnover"],
}

ACCOUNTS = {
    "string": [
        "account_id", "account_number", "customer_id", "account_type", "account_purpose",
        "branch_code", "account_status", "status_reason", "currency", "swift_code", "iban",
        "account_tier", "statement_frequency", "card_number", "card_type", "opening_channel",
        "linked_joint_accounts", "bundled_products", "beneficiaries",
    ],
    "date": [
        "opening_date", "approval_date", "status_change_date", "closure_date",
        "online_banking_activation_date", "card_issue_date", "card_expiry_date",
        "card_replacement_date",
    ],
    "int": [
        "is_primary_account", "kyc_verified", "fica_verified", "online_banking_enabled",
        "card_replaced", "cross_border_enabled", "proof_of_income_provided",
        "bank_statements_provided", "employer_letter_provided",
        "business_registration_provided", "tax_certificate_provided", "minimum_deposit_met",
    ],
    "decimal(5,3)": ["interest_rate", "transactions_rate", "negative_balance_rate"],
    "decimal(10,2)": ["monthly_charges"],
    "decimal(15,2)": ["expected_amount", "overdraft_limit", "credit_card_limit"],
}

TRANSACTIONS = {
    "string": [
        "transaction_id", "account_id", "transaction_time", "debit_credit", "category",
        "status", "description", "channel", "merchant_name", "merchant_category",
        "receiving_account", "receiving_bank", "is_international", "instant_payment",
        "is_reversal", "batch_reference", "recipient_phone", "atm_location",
        "branch_location",
    ],
    "date": ["transaction_date"],
    "decimal(15,2)": ["amount"],
    "decimal(5,2)": ["transaction_fee", "fx_fee", "swift_fee", "correspondent_fee"],
    "decimal(8,2)": ["cashback_amount"],
    "int": ["loyalty_points"],
}

METADATA = {
    "string": ["_source_file_url", "_source_hash"],
    "timestamp_ntz": ["_ingestion_timestamp"],
}


def columns(spec: dict[str, list[str]]) -> dict[str, str]:
    """Column name -> type."""
    return {name: kind for kind, names in spec.items() for name in names}


def struct_type(spec: dict[str, list[str]]) -> StructType:
    return StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in columns(spec).items()))


def conform(df: DataFrame, spec: dict[str, list[str]]) -> DataFrame:
    """Fixed column list and types; columns the input lacks become typed NULLs.

    Values that do not fit their type become NULL; ``quality.check_casts`` reports them.
    """
    present = dict(df.dtypes)
    wanted = columns(spec) | {n: t for n, t in columns(METADATA).items() if n in present}

    def column(name: str, kind: str):
        if name not in present:
            return F.lit(None).cast(kind).alias(name)
        if present[name] == kind:
            return F.col(name)
        return F.col(name).try_cast(kind).alias(name)

    return df.select(*(column(n, t) for n, t in wanted.items()))


def lost_text(df: DataFrame, spec: dict[str, list[str]]) -> dict[str, Column]:
    """Column -> delivered text that :func:`conform` turns to NULL; NULL where it fits."""
    present, lost = dict(df.dtypes), {}
    for name, kind in columns(spec).items():
        if name in present and present[name] != kind and kind != "string":
            given = F.trim(F.col(name).cast("string"))
            lost[name] = F.when((given != "") & given.try_cast(kind).isNull(), given)
    return lost


def rescued(df: DataFrame, spec: dict[str, list[str]]):
    """Map column: delivered text that :func:`conform` turns to NULL, and what was lost before."""
    from ledgermill.sources.bronze import RESCUED, rescued_map

    return rescued_map(lost_text(df, spec), F.col(RESCUED) if RESCUED in df.columns else None)
