"""Customer star schema: staging customers to eleven silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.fixed_values import (
    ADULT_AGE,
    COMPANY_AGE_ABOVE,
    COMPANY_AGE_BANDS,
    INDIVIDUAL_AGE_ABOVE,
    INDIVIDUAL_AGE_BANDS,
    RISK_MEDIUM_FROM,
    RISK_MEDIUM_TO,
    SETTLED_COMPANY_TO,
    YOUNG_COMPANY_BELOW,
    ZA_COUNTRY_CODE,
    ZA_COUNTRY_NAME,
)
from ledgermill.functions.text import any_of, band, concat_text, flag
from ledgermill.operators.skew import distinct_rows


def is_company() -> Column:
    return F.col("customer_type") == "COMPANY"


def is_individual() -> Column:
    return F.col("customer_type") == "INDIVIDUAL"


def _unpivot(stg: DataFrame, branches: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """One scan: every row yields one output row per branch whose condition holds."""
    rows = F.array(
        *(
            F.struct(keep.alias("keep"), *(c.alias(n) for n, c in fields.items()))
            for keep, fields in branches
        )
    )
    kept = stg.select("customer_id", F.inline(F.filter(rows, lambda r: r["keep"])))
    return distinct_rows(kept.drop("keep"))


def age_group() -> Column:
    age, company_age = F.col("new_age_at_opening"), F.col("company_age")
    person = F.when(age < ADULT_AGE, None).otherwise(
        band(age, INDIVIDUAL_AGE_BANDS, INDIVIDUAL_AGE_ABOVE)
    )
    firm = F.when(company_age.isNotNull(), band(company_age, COMPANY_AGE_BANDS, COMPANY_AGE_ABOVE))
    return F.when(is_individual(), person).when(is_company(), firm)


def build_fact_customers(stg: DataFrame) -> DataFrame:
    """One row per customer; companies take their incorporation date and company age."""

    def unless_company(column: str, instead: Column) -> Column:
        return F.when(is_company(), instead).otherwise(F.col(column))

    contact = F.col("preferred_contact_method")
    unreachable = (contact == "EMAIL") & (F.col("is_invalid_email_format") == 1)
    founded, company_age = F.col("date_of_incorporation"), F.col("company_age")
    return stg.select(
        "customer_id",
        "customer_type",
        F.col("full_name").alias("customer_name"),
        unless_company("date_of_birth", founded).alias("original_date_of_birth"),
        unless_company("new_date_of_birth", founded).alias("fixed_date_of_birth"),
        unless_company("age_at_opening", company_age).alias("original_age_at_opening"),
        unless_company("new_age_at_opening", company_age).alias("fixed_age_at_opening"),
        "citizenship",
        "nationality",
        flag(
            (F.col("citizenship") == ZA_COUNTRY_CODE) & (F.col("nationality") != ZA_COUNTRY_NAME)
        ).alias("is_dual_or_transfered"),
        unless_company("gender", F.lit("NOT APPLICABLE")).alias("gender"),
        unless_company("ethnicity", F.lit("NOT APPLICABLE")).alias("ethnicity"),
        F.when(unreachable | contact.isNull(), "UNKNOWN").otherwise(contact).alias(
            "preferred_contact_method"
        ),
        "customer_registration_date",
        age_group().alias("age_group"),
    ).transform(distinct_rows)


def build_dim_addresses(stg: DataFrame) -> DataFrame:
    """Up to four address rows per customer.

    PRINCIPAL and OFFICE are added only when their street and city differ from the
    addresses before them; a comparison with a missing part is unknown and drops the row.
    """

    def street(prefix: str) -> Column:
        return F.col(f"{prefix}_street_name")

    def differs(prefix: str, others: list[str]) -> Column:
        return ~any_of(
            [
                (street(o) == street(prefix)) & (F.col(f"{o}_city") == F.col(f"{prefix}_city"))
                for o in others
            ]
        )

    lives_here = is_individual() & street("residential").isNull()
    keep = {
        "residential": street("residential").isNotNull(),
        "commercial": street("commercial").isNotNull(),
        "principal": street("principal").isNotNull()
        & differs("principal", ["commercial", "residential"]),
        "office": street("office").isNotNull()
        & differs("office", ["commercial", "residential", "principal"]),
    }
    primary = {
        "residential": flag(is_individual()),
        "commercial": flag(is_company() | lives_here),
        "principal": F.lit(0),
        "office": F.lit(0),
    }
    return _unpivot(
        stg,
        [
            (
                keep[prefix],
                {
                    "address_type": F.lit(prefix.upper()),
                    "street_name": street(prefix),
                    "city": F.col(f"{prefix}_city"),
                    "province": F.col(f"{prefix}_province"),
                    "country": F.col(f"{prefix}_country"),
                    "is_primary_address": primary[prefix],
                    "effective_date": F.col("customer_registration_date"),
                },
            )
            for prefix in keep
        ],
    )


def build_dim_contacts(stg: DataFrame) -> DataFrame:
    """Phone, e-mail and next of kin as contact rows."""
    preferred = F.col("preferred_contact_method")
    bad = F.col("is_invalid_email_format") == 1

    def contact(kind: str, value: str, status: Column, primary: Column):
        fields = {
            "contact_type": F.lit(kind),
            "contact": F.col(value),
            "contact_status": status,
            "is_primary_contact": primary,
        }
        return F.col(value).isNotNull(), fields

    active = F.lit("ACTIVE")
    return _unpivot(
        stg,
        [
            contact("PHONE", "new_phone_number", active, flag(preferred.isin("PHONE", "SMS"))),
            contact(
                "EMAIL",
                "email",
                F.when(bad, "INVALID").otherwise("ACTIVE"),
                flag((preferred == "EMAIL") & ~bad),
            ),
            contact("NEXT OF KIN", "next_of_kin", active, F.lit(0)),
        ],
    )


def build_dim_documents(stg: DataFrame) -> DataFrame:
    """Identity documents and visas with their review state."""
    kind = F.col("document_type")
    never = F.lit(None).cast("date")

    def document(keep: Column, name: Column, expired: Column, expiry: Column):
        fields = {
            "document_type": name,
            "document_number": F.col("document_number"),
            "document_status": F.when(expired, "EXPIRED").otherwise("VERIFIED"),
            "expiry_review_required": flag(expired),
            "document_expiry_date": expiry,
        }
        return keep, fields

    return _unpivot(
        stg,
        [
            document(kind.isin("NATIONAL ID", "REGISTRATION NUMBER"), kind, F.lit(False), never),
            document(
                kind == "PASSPORT",
                kind,
                F.col("registered_expired_document") == 1,
                F.col("document_expiry_date"),
            ),
            document(
                F.col("visa_type").isNotNull(),
                concat_text(F.lit("VISA - "), F.col("visa_type")),
                F.col("registered_expired_visa") == 1,
                F.col("visa_expiry_date"),
            ),
        ],
    )


def build_dim_customer_risks(stg: DataFrame) -> DataFrame:
    """Risk flags and level; a missing score counts as HIGH.

    The score is kept as delivered; the limit check reports scores that are too large.
    """
    score = F.col("risk_score")
    low, top = (F.lit(bound).cast("decimal(8,5)") for bound in (RISK_MEDIUM_FROM, RISK_MEDIUM_TO))
    level = F.when(score < low, "LOW").when(score <= top, "MEDIUM").otherwise("HIGH")
    return stg.select(
        "customer_id",
        "is_pep",
        "pep_type",
        "is_sanctioned_country",
        "is_director",
        "is_supervised_aml_cft",
        "risk_score",
        level.alias("risk_level"),
    ).transform(distinct_rows)


def build_dim_customer_profile(stg: DataFrame) -> DataFrame:
    """Work, education and income of individuals."""
    return (
        stg.where(is_individual())
        .select(
            "customer_id",
            "occupation",
            "employer_name",
            "source_of_funds",
            "marital_status",
            "education_level",
            F.col("annual_income").alias("annual_expected_income"),
        )
        .transform(distinct_rows)
    )


def build_dim_business_details(stg: DataFrame) -> DataFrame:
    """Company details; a missing company age counts as LOW age risk."""
    age = F.col("company_age")
    age_risk = (
        F.when(age < YOUNG_COMPANY_BELOW, "HIGH").when(age <= SETTLED_COMPANY_TO, "MEDIUM").otherwise("LOW")
    )
    return (
        stg.where(is_company())
        .select(
            "customer_id",
            F.col("company_trading_name").alias("trading_name"),
            "website",
            "has_sanctioned_relationship",
            "fatca_giin",
            "swift_bic_code",
            "industry",
            "date_of_incorporation",
            "city_of_incorporation",
            "country_of_incorporation",
            "number_of_employees",
            F.col("directors_count").alias("director_count"),
            "annual_turnover",
            F.col("shareholders_count").alias("shareholder_count"),
            "bee_level",
            "vat_registered",
            F.col("industry_risk_rating").alias("industry_risk_level"),
            F.col("is_publicly_listed").alias("is_public"),
            "external_auditor",
            "legal_representative_name",
            F.col("contact_person_name").alias("contact_person"),
            "contact_person_title",
            "contact_person_phone",
            "contact_person_email",
            "contact_person_customer_id",
            "num_branches_local",
            "num_branches_foreign",
            "num_subsidiaries_local",
            "num_subsidiaries_foreign",
            age_risk.alias("age_related_risk"),
            F.col("requires_license").alias("is_license_required"),
        )
        .transform(distinct_rows)
    )


def build_dim_business_licensing(stg: DataFrame) -> DataFrame:
    return (
        stg.where(F.col("license_number").isNotNull())
        .select(
            "customer_id",
            "license_number",
            F.col("license_issue_date").try_cast("date").alias("license_issue_date"),
            F.col("license_expiry_date").try_cast("date").alias("license_expiry_date"),
            "license_regulatory_body",
        )
        .transform(distinct_rows)
    )


def build_dim_business_shareholders(stg: DataFrame) -> DataFrame:
    """Named shareholders; the share keeps its decimals and unreadable shares are NULL."""
    holder = F.col("holder")
    return (
        stg.select("customer_id", F.explode("shareholders").alias("holder"))
        .where(holder.shareholder_name.isNotNull())
        .select(
            "customer_id",
            holder.shareholder_id.alias("shareholder_id"),
            holder.shareholder_name.alias("shareholder_name"),
            holder.ownership_percentage.try_cast("decimal(8,5)").alias("ownership_percentage"),
        )
        .transform(distinct_rows)
    )


def build_dim_business_directors(stg: DataFrame) -> DataFrame:
    return (
        stg.select("customer_id", F.explode("directors").alias("director_customer_id"))
        .where(F.col("director_customer_id").isNotNull())
        .transform(distinct_rows)
    )


def build_dim_director_information(stg: DataFrame) -> DataFrame:
    return (
        stg.select("customer_id", F.explode("companies").alias("directed_company"))
        .where(F.col("directed_company").isNotNull())
        .transform(distinct_rows)
    )


CUSTOMER_TABLES = {
    "fact_customers": build_fact_customers,
    "dim_addresses": build_dim_addresses,
    "dim_contacts": build_dim_contacts,
    "dim_documents": build_dim_documents,
    "dim_customer_risks": build_dim_customer_risks,
    "dim_customer_profile": build_dim_customer_profile,
    "dim_business_details": build_dim_business_details,
    "dim_business_licensing": build_dim_business_licensing,
    "dim_business_shareholders": build_dim_business_shareholders,
    "dim_business_directors": build_dim_business_directors,
    "dim_director_information": build_dim_director_information,
}
