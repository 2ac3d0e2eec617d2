"""Customer cleaning: bronze rows to staging rows, one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.contact import (
    address_fields,
    address_parts,
    bad_email,
    default_country,
    normalise_phone,
)
from ledgermill.functions.dates import fix_birth_date, year_gap
from ledgermill.functions.text import flag, json_fields, json_list, norm
from ledgermill.sources.schemas import CUSTOMERS, conform

# --- fixed values -----------------------------------------------------------------------

# address column -> prefix of the columns split out of it
ADDRESSES = {
    "residential_address": "residential",
    "commercial_address": "commercial",
    "registered_office_address": "office",
    "principal_place_of_business": "principal",
}
LICENSE_FIELDS = ["license_number", "issue_date", "expiry_date", "regulatory_body"]
SHAREHOLDER = "struct<shareholder_id:string,shareholder_name:string,ownership_percentage:string>"
# bronze name -> staging name
RENAMED = {
    "birth_date": "date_of_birth",
    "new_birth_date": "new_date_of_birth",
    "date_of_entry": "customer_registration_date",
    "id_type": "document_type",
    "id_number": "document_number",
    "expiry_date": "document_expiry_date",
    "sanctioned_country": "is_sanctioned_country",
    "trading_name": "company_trading_name",
    "invalid_email_format": "is_invalid_email_format",
}
# text that staging keeps as delivered
KEPT_TEXT = [
    "bee_level",
    "vat_registered",
    "license_info",
    "director_customer_ids",
    "major_shareholders",
]


def repair_birth_dates(df: DataFrame) -> DataFrame:
    """Adds new_birth_date."""
    return df.withColumn("new_birth_date", fix_birth_date(F.col("birth_date"), F.col("date_of_entry")))


def add_ages(df: DataFrame) -> DataFrame:
    """Adds the age at entry from the given and from the repaired birth date."""
    return df.withColumns(
        {
            "age_at_opening": year_gap(F.col("birth_date"), F.col("date_of_entry")),
            "new_age_at_opening": year_gap(F.col("new_birth_date"), F.col("date_of_entry")),
        }
    )


def split_addresses(df: DataFrame) -> DataFrame:
    """Adds <prefix>_street_name, _city, _province and _country for the four addresses."""
    split = df.withColumns({f"_{p}": address_parts(F.col(c)) for c, p in ADDRESSES.items()})
    return split.withColumns(
        {
            f"{prefix}_{name}": value
            for column, prefix in ADDRESSES.items()
            for name, value in address_fields(F.col(column), F.col(f"_{prefix}")).items()
        }
    ).drop(*(f"_{p}" for p in ADDRESSES.values()))


def check_contacts(df: DataFrame) -> DataFrame:
    """Adds invalid_email_format and new_phone_number."""
    return df.withColumns(
        {
            "invalid_email_format": bad_email(F.col("email")),
            "new_phone_number": normalise_phone(F.col("phone_number"), F.col("citizenship")),
        }
    )


def check_expiry(df: DataFrame) -> DataFrame:
    """Adds flags for a document or visa that had expired when the customer entered."""
    return df.withColumns(
        {
            "registered_expired_document": flag(F.col("expiry_date") <= F.col("date_of_entry")),
            "registered_expired_visa": flag(F.col("visa_expiry_date") <= F.col("date_of_entry")),
        }
    )


def check_employment(df: DataFrame) -> DataFrame:
    """Adds check_employment: an occupation other than unemployed and a named employer."""
    works = ~F.upper("occupation").startswith("UNEMPLOYED")
    return df.withColumn("check_employment", flag(works & F.col("employer_name").isNotNull()))


def license_fields(df: DataFrame) -> DataFrame:
    """Adds the four licence fields of the JSON object in license_info."""
    parsed = df.withColumn("_license", json_fields(F.col("license_info"), LICENSE_FIELDS))
    return parsed.withColumns(
        {
            "license_number": F.col("_license.license_number"),
            "license_issue_date": F.col("_license.issue_date"),
            "license_expiry_date": F.col("_license.expiry_date"),
            "license_regulatory_body": F.col("_license.regulatory_body"),
        }
    ).drop("_license")


def parse_lists(df: DataFrame) -> DataFrame:
    """Adds the three encoded lists as arrays: shareholders, directors and companies."""
    return df.withColumns(
        {
            "shareholders": json_list(F.col("major_shareholders"), SHAREHOLDER),
            "directors": json_list(F.col("director_customer_ids"), "string"),
            "companies": json_list(F.col("director_of_companies"), "string"),
        }
    )


def explode_shareholders(df: DataFrame) -> DataFrame:
    """One row per shareholder; a customer without any keeps one row of NULLs."""
    listed = df.withColumn("_s", F.explode_outer(json_list(F.col("major_shareholders"), SHAREHOLDER)))
    return listed.select(*df.columns, "_s.*")


def explode_directors(df: DataFrame) -> DataFrame:
    """One row per director id; unknown ids and empty lists give a NULL row."""
    ids = json_list(F.col("director_customer_ids"), "string")
    return df.withColumn("director_customer_id", F.explode_outer(ids))


def explode_companies(df: DataFrame) -> DataFrame:
    """One row per company the customer directs; none gives a NULL row."""
    companies = json_list(F.col("director_of_companies"), "string")
    return df.withColumn("directed_company", F.explode_outer(companies))


def standardise(df: DataFrame) -> DataFrame:
    """Upper-trimmed text, a residential country filled from the province, staging names."""
    parts = ("street_name", "city", "province", "country")
    split = [f"{prefix}_{part}" for prefix in ADDRESSES.values() for part in parts]
    text = [name for name in CUSTOMERS["string"] if name not in KEPT_TEXT]
    cleaned = {c: norm(F.col(c)) for c in [*text, *split]}
    cleaned["residential_country"] = default_country(
        F.col("residential_country"), F.col("residential_province")
    )
    return df.withColumns(cleaned).withColumnsRenamed(RENAMED)


def clean_customers(bronze: DataFrame) -> DataFrame:
    """Staging customers: one row per bronze row, nested lists as arrays.

    Each list is exploded only by the builder that needs it; exploding all three here would
    multiply shareholders by directors by companies.
    """
    return (
        conform(bronze, CUSTOMERS)
        .transform(repair_birth_dates)
        .transform(add_ages)
        .transform(split_addresses)
        .transform(check_contacts)
        .transform(check_expiry)
        .transform(license_fields)
        .transform(parse_lists)
        .transform(standardise)
    )
