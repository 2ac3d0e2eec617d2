"""Labels, bands, pairs and limits that results depend on."""

# --- fixed values -----------------------------------------------------------------------

ZA_COUNTRY_CODE = "ZA"
ZA_COUNTRY_NAME = "SOUTH AFRICA"
ZA_DIAL_PREFIX = "+27"
ZA_PROVINCES = [
    "EASTERN CAPE",
    "FREE STATE",
    "GAUTENG",
    "KWAZULU-NATAL",
    "LIMPOPO",
    "MPUMALANGA",
    "NORTH WEST",
    "NORTHERN CAPE",
    "WESTERN CAPE",
]

EMAIL_PATTERN = "%@%.%"
LONG_ADDRESS_PATTERN = "%,%,%,%"
ACCOUNT_ID_PATTERN = "ACC%"

MAX_CUSTOMER_AGE = 120
ADULT_AGE = 18

# (highest age in the band, label); older people fall into INDIVIDUAL_AGE_ABOVE
INDIVIDUAL_AGE_BANDS = [
    (24, "YOUNG ADULT"),
    (34, "EARLY CAREER"),
    (44, "ESTABLISHED PROFESSIONAL"),
    (54, "MID-CAREER"),
    (64, "PRE-RETIREMENT"),
]
INDIVIDUAL_AGE_ABOVE = "RETIREES"

# (highest company age in the band, label); older companies fall into COMPANY_AGE_ABOVE
COMPANY_AGE_BANDS = [
    (0, "STARTUP"),
    (1, "1 YEAR OLD"),
    (2, "2 YEARS OLD"),
    (5, "3-5 YEARS OLD"),
    (10, "6-10 YEARS OLD"),
    (20, "11-20 YEARS OLD"),
    (50, "21-50 YEARS OLD"),
]
COMPANY_AGE_ABOVE = "OVER 50 YEARS OLD"

# the day given to a time of day that comes without a date
TIME_ONLY_DAY = "1900-01-01"
RISK_MEDIUM_FROM = "0.3"
RISK_MEDIUM_TO = "0.5"

YOUNG_COMPANY_BELOW = 2
SETTLED_COMPANY_TO = 5

# a date (key) that must not be later than any of the listed dates
DATE_ORDER = {
    "customer_registration_date": [
        "opening_date",
        "approval_date",
        "status_change_date",
        "closure_date",
        "online_banking_activation_date",
        "card_issue_date",
        "card_replacement_date",
    ],
    "opening_date": [
        "approval_date",
        "status_change_date",
        "closure_date",
        "online_banking_activation_date",
        "card_issue_date",
        "card_replacement_date",
    ],
    "approval_date": [
        "status_change_date",
        "closure_date",
        "online_banking_activation_date",
        "card_replacement_date",
    ],
    "closure_date": [
        "online_banking_activation_date",
        "card_issue_date",
        "card_replacement_date",
    ],
    "card_issue_date": ["card_expiry_date", "card_replacement_date"],
}

CUSTOMER_FILE_MARK = "customers"
CUSTOMER_PREFIX = "crm_"
OTHER_PREFIX = "erp_"

# column-name keyword -> target type, first hit wins
TYPE_RULES = [
    (["amount", "balance", "price", "value"], "DECIMAL(15,2)"),
    (["address", "location"], "TEXT"),
    (["date", "time"], "DATE"),
    (["id", "num", "no", "code"], "NVARCHAR(50)"),
]
# plain type -> target type where no keyword fits
TYPE_TARGETS = {
    "int": "BIGINT",
    "float": "DECIMAL(15,4)",
    "bool": "BIT",
    "datetime": "DATETIME",
}
METADATA_TYPES = {
    "_source_file_url": "NVARCHAR(1000)",
    "_ingestion_timestamp": "DATETIME",
    "_source_hash": "NVARCHAR(32)",
}
TEXT_WIDTH_FACTOR = "1.2"
TEXT_WIDTH_MIN = 50
TEXT_WIDTH_MAX = 4000
TEXT_WIDTH_DEFAULT = 500

# allowed labels per silver column; NULL always passes
DOMAINS = {
    "fact_customers": {
        "customer_type": ["INDIVIDUAL", "COMPANY", "ORGANIZATION"],
        "gender": ["F", "M", "NOT APPLICABLE", "PREFER NOT TO SAY"],
        "age_group": [
            *(label for _, label in INDIVIDUAL_AGE_BANDS),
            INDIVIDUAL_AGE_ABOVE,
            *(label for _, label in COMPANY_AGE_BANDS),
            COMPANY_AGE_ABOVE,
        ],
    },
    "dim_addresses": {"address_type": ["RESIDENTIAL", "COMMERCIAL", "PRINCIPAL", "OFFICE"]},
    "dim_contacts": {
        "contact_type": ["PHONE", "EMAIL", "NEXT OF KIN"],
        "contact_status": ["ACTIVE", "INVALID", "INACTIVE"],
    },
    "dim_documents": {
        "document_status": [
            "PENDING",
            "VERIFIED",
            "REJECTED",
            "EXPIRED",
            "UNDER_REVIEW",
            "ARCHIVED",
        ]
    },
    "dim_customer_risks": {"risk_level": ["LOW", "MEDIUM", "HIGH"]},
}

# columns that must be filled, per silver table
REQUIRED = {
    "fact_customers": [
        "customer_id",
        "customer_type",
        "customer_name",
        "original_date_of_birth",
        "fixed_date_of_birth",
        "original_age_at_opening",
        "fixed_age_at_opening",
        "citizenship",
        "nationality",
        "ethnicity",
        "preferred_contact_method",
    ],
    "dim_addresses": ["customer_id", "address_type"],
    "dim_contacts": ["customer_id", "contact_type", "contact"],
    "dim_documents": ["customer_id", "document_type", "document_number"],
    "dim_customer_risks": ["customer_id"],
    "dim_customer_profile": [
        "customer_id",
        "occupation",
        "source_of_funds",
        "marital_status",
        "education_level",
        "annual_expected_income",
    ],
    "dim_business_details": ["customer_id", "country_of_incorporation"],
    "dim_business_licensing": ["customer_id"],
    "dim_business_shareholders": ["customer_id"],
    "dim_business_directors": ["customer_id", "director_customer_id"],
    "dim_director_information": ["customer_id", "directed_company"],
    "dim_account_type": ["account_type"],
    "fact_accounts": ["account_id", "account_number", "customer_id"],
    "dim_account_status": ["account_id", "account_status", "account_opening_date"],
    "dim_account_joint_customers": ["account_id", "joint_customer_id"],
    "dim_account_type_details": ["account_id"],
    "dim_account_products": ["account_id"],
    "dim_account_card_details": [
        "account_id",
        "card_number",
        "card_type",
        "card_issue_date",
        "card_expiry_date",
    ],
    "dim_account_beneficiary": ["account_id", "beneficiary_name"],
    "dim_account_documents": ["account_id"],
    "fact_transactions": ["transaction_id", "account_id", "transaction_type"],
}

# natural keys that may occur once, per silver table
UNIQUE_KEYS = {
    "fact_customers": ["customer_id"],
    "dim_contacts": ["customer_id", "contact_type", "contact"],
    "dim_account_type": ["account_type"],
    "fact_accounts": ["account_id", "account_number", "customer_id"],
    "dim_account_status": ["account_id"],
    "dim_account_joint_customers": ["account_id", "joint_customer_id"],
    "dim_account_type_details": ["account_id"],
    "dim_account_products": ["account_id", "product_type"],
    "dim_account_card_details": ["card_number"],
    "dim_account_beneficiary": ["account_id", "beneficiary_name"],
    "dim_account_documents": ["account_id"],
    "fact_transactions": ["transaction_id"],
}

# child table -> (column, parent table, parent column)
REFERENCES = {
    "dim_addresses": ("customer_id", "fact_customers", "customer_id"),
    "dim_contacts": ("customer_id", "fact_customers", "customer_id"),
    "dim_documents": ("customer_id", "fact_customers", "customer_id"),
    "dim_customer_risks": ("customer_id", "fact_customers", "customer_id"),
    "dim_customer_profile": ("customer_id", "fact_customers", "customer_id"),
    "dim_business_details": ("customer_id", "fact_customers", "customer_id"),
    "dim_business_licensing": ("customer_id", "fact_customers", "customer_id"),
    "dim_business_shareholders": ("customer_id", "fact_customers", "customer_id"),
    "dim_business_directors": ("customer_id", "fact_customers", "customer_id"),
    "dim_director_information": ("customer_id", "fact_customers", "customer_id"),
    "fact_accounts": ("account_type_id", "dim_account_type", "account_type_id"),
}

# longest text per silver column
TEXT_LIMITS = {
    "fact_customers": {
        "customer_id": 50,
        "customer_type": 20,
        "customer_name": 50,
        "citizenship": 3,
        "nationality": 50,
        "gender": 20,
        "ethnicity": 20,
        "preferred_contact_method": 20,
        "age_group": 50,
    },
    "dim_addresses": {"customer_id": 50, "city": 50, "province": 50, "country": 50},
    "dim_contacts": {"customer_id": 50, "contact": 100},
    "dim_documents": {"customer_id": 50, "document_type": 50, "document_number": 50},
    "dim_customer_risks": {"pep_type": 200},
    "dim_customer_profile": {
        "occupation": 50,
        "employer_name": 50,
        "source_of_funds": 50,
        "marital_status": 20,
        "education_level": 50,
    },
    "dim_business_details": {
        "trading_name": 50,
        "website": 50,
        "fatca_giin": 50,
        "swift_bic_code": 50,
        "industry": 50,
        "city_of_incorporation": 50,
        "country_of_incorporation": 50,
        "bee_level": 20,
        "vat_registered": 20,
        "industry_risk_level": 20,
        "external_auditor": 50,
        "legal_representative_name": 50,
        "contact_person": 50,
        "contact_person_title": 50,
        "contact_person_phone": 50,
        "contact_person_email": 50,
        "contact_person_customer_id": 50,
    },
    "dim_business_licensing": {"license_number": 50},
    "dim_business_shareholders": {"shareholder_id": 50, "shareholder_name": 50},
    "dim_business_directors": {"director_customer_id": 50},
    "dim_director_information": {"directed_company": 50},
    "dim_account_type": {"account_type": 50},
    "fact_accounts": {
        "account_id": 50,
        "account_number": 200,
        "customer_id": 50,
        "account_purpose": 50,
        "branch_code": 50,
        "currency": 4,
        "swift_code": 100,
        "iban": 100,
        "statement_frequency": 50,
        "account_opening_channel": 50,
    },
    "dim_account_status": {"account_status": 50, "account_status_change_reason": 255},
    "dim_account_joint_customers": {"joint_customer_id": 50},
    "dim_account_type_details": {"account_tier": 50},
    "dim_account_products": {"product_type": 50},
    "dim_account_card_details": {"card_number": 100, "card_type": 50},
    "dim_account_beneficiary": {"beneficiary_name": 100, "beneficiary_relationship": 50},
    "fact_transactions": {
        "transaction_id": 50,
        "account_id": 50,
        "transaction_type": 50,
        "transaction_category": 50,
        "transaction_status": 50,
        "transaction_description": 200,
        "transaction_channel": 50,
        "merchant_name": 50,
        "merchant_category": 50,
        "receiving_account_number": 50,
        "receiving_bank": 50,
        "batch_reference": 50,
        "recipient_phone": 50,
    },
}

# (precision, scale) per silver column; risk_score and ownership_percentage are widened
NUMBER_LIMITS = {
    "dim_customer_risks": {"risk_score": (8, 5)},
    "dim_customer_profile": {"annual_expected_income": (15, 2)},
    "dim_business_details": {"annual_turnover": (15, 2)},
    "dim_business_shareholders": {"ownership_percentage": (8, 5)},
    "fact_accounts": {"expected_amount": (15, 2)},
    "dim_account_type_details": {
        "annual_interest_rate": (5, 3),
        "monthly_maintenance_fee": (10, 2),
        "transaction_fee_rate": (5, 3),
        "overdraft_interest_rate": (5, 3),
        "approved_overdraft_limit": (15, 2),
    },
    "dim_account_card_details": {"credit_card_limit": (15, 2)},
    "dim_account_beneficiary": {"beneficiary_percentage": (5, 2)},
    "dim_account_documents": {"document_status_score": (5, 2)},
    "fact_transactions": {
        "transaction_amount": (15, 2),
        "transaction_fee": (5, 2),
        "fx_fee": (5, 2),
        "swift_fee": (5, 2),
        "correspondent_fee": (5, 2),
        "cashback_amount": (8, 2),
    },
}
