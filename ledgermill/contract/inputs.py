"""Banking inputs derived from the test tables.

Each column is ``cast(<expression> as <type>)``; the expressions read the same in Spark SQL
and in DuckDB. Bronze columns that are not listed become typed NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.sources.schemas import ACCOUNTS, CUSTOMERS, TRANSACTIONS, columns


# fx_customers, derived from customer
CUSTOMER_COLUMNS = {
    "customer_id": "concat(' cust', lpad(cast(c_custkey as string), 6, '0'), ' ')",
    "customer_type": "case when c_custkey % 5 = 0 then 'company' else 'individual' end",
    "full_name": "concat(' ', c_name)",
    "birth_date": "date '1940-01-01' + cast((c_custkey * 37) % 25000 + case when c_custkey % 11 = 0 then 36525 when c_custkey % 13 = 0 then -36525 else 0 end as int)",
    "date_of_entry": "case when c_custkey % 41 = 0 then null else date '2018-01-01' + cast((c_custkey * 7) % 2500 as int) end",
    "citizenship": "case when c_custkey % 3 = 0 then 'ZA' else 'GB' end",
    "nationality": "case when c_custkey % 6 = 0 then 'South Africa' else 'United Kingdom' end",
    "residential_address": "case c_custkey % 6 when 0 then concat(cast(c_custkey as string), ' Main Rd, City', cast(c_nationkey as string), ', Gauteng, South Africa') when 1 then concat(cast(c_custkey as string), ' Oak St, City', cast(c_nationkey as string), ', Western Cape') when 2 then 'Durban, KwaZulu-Natal' when 3 then concat('Flat ', cast(c_custkey as string), ', 1 High St, Leeds, Yorkshire, United Kingdom') when 4 then concat(cast(c_custkey as string), ' Elm Ave, Paris, Ile') end",
    "commercial_address": "case when c_custkey % 5 = 0 then concat(cast(c_custkey as string), ' Trade Rd, City', cast(c_nationkey as string), ', Limpopo, South Africa') when c_custkey % 7 = 0 then '9 Shop St, Pretoria, Gauteng' end",
    "registered_office_address": "case when c_custkey % 10 = 0 then concat(cast(c_custkey as string), ' Trade Rd, City', cast(c_nationkey as string), ', Limpopo, South Africa') when c_custkey % 5 = 0 then '1 Office Park, Sandton, Gauteng, South Africa' end",
    "principal_place_of_business": "case when c_custkey % 15 = 0 then '2 Works Rd, Durban, KwaZulu-Natal, South Africa' when c_custkey % 5 = 0 then concat(cast(c_custkey as string), ' Trade Rd, City', cast(c_nationkey as string), ', Limpopo, South Africa') end",
    "email": "case when c_custkey % 7 = 0 then 'bad.email' when c_custkey % 17 = 0 then null else concat('user', cast(c_custkey as string), '@example.org') end",
    "phone_number": "case c_custkey % 4 when 0 then concat('082', lpad(cast(c_custkey as string), 7, '0')) when 1 then concat('+2783', lpad(cast(c_custkey as string), 7, '0')) when 2 then concat('84', lpad(cast(c_custkey as string), 7, '0')) end",
    "id_type": "case when c_custkey % 5 = 0 then 'registration number' when c_custkey % 3 = 0 then 'national id' else 'passport' end",
    "id_number": "concat('id', lpad(cast(c_custkey as string), 8, '0'))",
    "expiry_date": "case when c_custkey % 3 <> 0 then date '2018-06-01' + cast((c_custkey * 11) % 3000 as int) end",
    "visa_type": "case when c_custkey % 8 = 1 then 'work' when c_custkey % 8 = 2 then 'study' end",
    "visa_expiry_date": "case when c_custkey % 8 in (1, 2) then date '2018-03-01' + cast((c_custkey * 13) % 3000 as int) end",
    "is_pep": 'case when c_custkey % 19 = 0 then 1 else 0 end',
    "pep_type": "case when c_custkey % 19 = 0 then 'domestic' end",
    "sanctioned_country": 'case when c_custkey % 23 = 0 then 1 else 0 end',
    "risk_score": 'case when c_custkey % 29 = 0 then null else cast(c_custkey % 100 as decimal(15,4)) / 100 end',
    "occupation": "case when c_custkey % 5 = 0 then null when c_custkey % 9 = 0 then 'Unemployed' else 'Engineer' end",
    "employer_name": "case when c_custkey % 5 = 0 or c_custkey % 9 = 0 then null else concat('Employer ', cast(c_custkey % 20 as string)) end",
    "source_of_funds": "case when c_custkey % 2 = 0 then 'salary' else 'business' end",
    "marital_status": "case when c_custkey % 2 = 0 then 'single' else 'married' end",
    "gender": "case when c_custkey % 5 = 0 then null when c_custkey % 2 = 0 then 'f' else 'm' end",
    "ethnicity": "case when c_custkey % 5 = 0 then null else concat('group ', cast(c_custkey % 4 as string)) end",
    "preferred_contact_method": "case c_custkey % 5 when 0 then 'email' when 1 then 'phone' when 2 then 'sms' when 3 then 'email' end",
    "next_of_kin": "case when c_custkey % 5 = 0 then null else concat('kin ', cast(c_custkey as string)) end",
    "annual_income": 'cast(c_acctbal as decimal(15,2))',
    "education_level": "case when c_custkey % 2 = 0 then 'degree' else 'matric' end",
    "is_director": 'case when c_custkey % 12 = 1 then 1 else 0 end',
    "director_of_companies": "case when c_custkey % 12 = 1 then replace('[~Acme Ltd~, ~Beta Ltd~]', '~', chr(39)) when c_custkey % 12 = 2 then '[]' end",
    "trading_name": "case when c_custkey % 5 = 0 then concat('trader ', cast(c_custkey as string)) end",
    "website": "case when c_custkey % 5 = 0 then concat('www.t', cast(c_custkey as string), '.example.org') end",
    "industry": 'case when c_custkey % 5 = 0 then lower(c_mktsegment) end',
    "date_of_incorporation": "case when c_custkey % 5 = 0 then date '1960-01-01' + cast((c_custkey * 91) % 20000 as int) end",
    "company_age": 'case when c_custkey % 35 = 0 then null when c_custkey % 5 = 0 then cast(c_custkey % 60 as int) end',
    "license_info": 'case when c_custkey % 10 = 0 then concat(\'{"license_number":"L\', cast(c_custkey as string), \'","issue_date":"2019-01-01","expiry_date":"2029-01-01","regulatory_body":"FSCA"}\') end',
    "director_customer_ids": "case when c_custkey % 5 = 0 then replace(concat('[~CUST', lpad(cast(c_custkey + 1 as string), 6, '0'), '~, None, ~CUST', lpad(cast(c_custkey + 2 as string), 6, '0'), '~]'), '~', chr(39)) end",
    "major_shareholders": "case when c_custkey % 10 = 5 then '[]' when c_custkey % 5 = 0 then replace(concat('[{~shareholder_id~: ~S', cast(c_custkey as string), '~, ~shareholder_name~: ~Ann~, ~ownership_percentage~: 0.45}, {~shareholder_id~: ~S', cast(c_custkey + 1 as string), '~, ~shareholder_name~: ~Ben~, ~ownership_percentage~: 0.25}]'), '~', chr(39)) end",
}


# fx_accounts, derived from orders
ACCOUNT_COLUMNS = {
    "account_id": "concat('ACC', lpad(cast(o_orderkey as string), 8, '0'))",
    "account_number": 'cast(1000000 + o_orderkey % 1200 as string)',
    "customer_id": "case when o_orderkey % 97 = 0 then 'CUST999999' else concat('CUST', lpad(cast(o_custkey as string), 6, '0')) end",
    "account_type": "case o_orderkey % 4 when 0 then ' savings' when 1 then 'Cheque' when 2 then 'fixed_deposit' else 'credit ' end",
    "account_purpose": "case o_orderkey % 2 when 0 then 'daily_use' else 'long_term_saving' end",
    "is_primary_account": 'case when o_orderkey % 3 = 0 then 1 else 0 end',
    "opening_date": 'cast(o_orderdate as date) + 9000',
    "approval_date": 'cast(o_orderdate as date) + cast(9000 + o_orderkey % 15 - 2 as int)',
    "account_status": "case o_orderkey % 5 when 0 then 'closed' when 1 then 'dormant' else 'active' end",
    "status_change_date": 'case when o_orderkey % 5 = 0 then cast(o_orderdate as date) + 9400 when o_orderkey % 10 = 1 then cast(o_orderdate as date) + 9300 end',
    "closure_date": 'case when o_orderkey % 5 = 0 then cast(o_orderdate as date) + 9400 end',
    "status_reason": "case when o_orderkey % 5 = 0 then 'customer_request' end",
    "branch_code": "concat('B', cast(o_orderkey % 12 as string))",
    "kyc_verified": 'case when o_orderkey % 11 = 0 then 0 else 1 end',
    "fica_verified": 'case when o_orderkey % 13 = 0 then 0 else 1 end',
    "expected_amount": 'cast(o_totalprice as decimal(15,2))',
    "linked_joint_accounts": "case when o_orderkey % 6 = 0 then concat('cust', lpad(cast((o_custkey + 1) % 100 as string), 6, '0'), '; cust', lpad(cast((o_custkey + 2) % 100 as string), 6, '0')) when o_orderkey % 6 = 1 then '' end",
    "bundled_products": "case o_orderkey % 4 when 0 then 'debit_card;online_banking' when 1 then 'insurance' end",
    "beneficiaries": "case o_orderkey % 5 when 0 then 'Ann Lee|SPOUSE|60%;Ben Lee|CHILD|40%' when 1 then 'Cy Roe|PARENT|100%' end",
    "currency": "'ZAR'",
    "account_tier": "case o_orderkey % 3 when 0 then 'gold' else 'basic' end",
    "interest_rate": 'cast(o_orderkey % 12 as decimal(5,3))',
    "overdraft_limit": 'cast((o_orderkey % 10) * 100 as decimal(15,2))',
    "online_banking_enabled": 'case when o_orderkey % 2 = 0 then 1 else 0 end',
    "online_banking_activation_date": 'case when o_orderkey % 2 = 0 then cast(o_orderdate as date) + cast(9000 + o_orderkey % 30 as int) end',
    "card_number": "case when o_orderkey % 4 = 3 then null else concat('4', lpad(cast(o_orderkey % 1100 as string), 15, '0')) end",
    "card_type": "case when o_orderkey % 4 = 3 then null else 'debit_card' end",
    "card_issue_date": 'case when o_orderkey % 4 = 3 then null else cast(o_orderdate as date) + 9010 end',
    "card_expiry_date": 'case when o_orderkey % 4 = 3 then null else cast(o_orderdate as date) + cast(9010 + case when o_orderkey % 50 = 0 then -5 else 1460 end as int) end',
    "card_replaced": 'case when o_orderkey % 20 = 0 then 1 else 0 end',
    "card_replacement_date": 'case when o_orderkey % 20 = 0 then cast(o_orderdate as date) + 9200 end',
    "proof_of_income_provided": 'cast(o_orderkey % 2 as int)',
    "bank_statements_provided": 'case when o_orderkey % 3 = 0 then 1 else 0 end',
    "employer_letter_provided": 'case when o_orderkey % 5 = 0 then 1 else 0 end',
    "business_registration_provided": 'case when o_orderkey % 7 = 0 then 1 else 0 end',
    "tax_certificate_provided": 'case when o_orderkey % 17 = 0 then null when o_orderkey % 2 = 0 then 1 else 0 end',
    "opening_channel": "case o_orderkey % 2 when 0 then 'mobile_app' else 'branch' end",
}


# fx_transactions, derived from lineitem
TRANSACTION_COLUMNS = {
    "transaction_id": "concat(' txn', cast(l_orderkey as string), '-', cast(l_linenumber as string))",
    "account_id": "concat('acc', lpad(cast(l_orderkey as string), 8, '0'))",
    "transaction_date": 'cast(l_shipdate as date)',
    "transaction_time": "concat(lpad(cast(l_orderkey % 24 as string), 2, '0'), ':', lpad(cast(l_partkey % 60 as string), 2, '0'), ':00')",
    "amount": "case when l_quantity = 1 then 0 when l_returnflag = 'R' then -cast(l_extendedprice as decimal(15,2)) else cast(l_extendedprice as decimal(15,2)) end",
    "transaction_fee": 'cast(l_linenumber as decimal(5,2))',
    "debit_credit": "case when l_returnflag = 'A' then 'credit' else 'debit' end",
    "status": "case when l_linestatus = 'O' then 'success' when l_partkey % 9 = 0 then 'failed' else 'success' end",
    "channel": "case l_partkey % 4 when 0 then 'eWallet' when 1 then 'mobile' when 2 then 'ATM' else 'branch' end",
    "receiving_account": "case l_suppkey % 4 when 0 then concat('ACC', lpad(cast((l_orderkey + 1) as string), 8, '0')) when 1 then '62001234' when 2 then 'ACC99999999' end",
    "receiving_bank": "case l_suppkey % 3 when 0 then 'same bank' when 1 then 'Other Bank ' end",
    "is_international": "case when l_partkey % 10 = 0 then 'Yes' else 'No' end",
    "instant_payment": "case when l_partkey % 3 = 0 then 'yes' end",
    "is_reversal": "case when l_returnflag = 'R' then 'YES' else 'NO' end",
    "cashback_amount": '-cast(l_linenumber as decimal(8,2))',
    "loyalty_points": 'cast(l_quantity as int)',
}


FRAMES = {
    "fx_customers": ("customer", CUSTOMER_COLUMNS, CUSTOMERS),
    "fx_accounts": ("orders", ACCOUNT_COLUMNS, ACCOUNTS),
    "fx_transactions": ("lineitem", TRANSACTION_COLUMNS, TRANSACTIONS),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def banking_frame(spark: SparkSession, sf_dir: str, frame: str, parts: int | None = None) -> DataFrame:
    """One of fx_customers, fx_accounts and fx_transactions, dealt over ``parts`` if given.

    Rows are dealt while they are as narrow as the test table, and by their content: dealing them in turn
    would sort each task's rows.
    """
    source, given, spec = FRAMES[frame]
    rows = table(spark, sf_dir, source)
    if parts:
        rows = rows.repartition(parts, *rows.columns)
    return rows.select(
        *(
            F.expr(given.get(name, "null")).cast(kind).alias(name)
            for name, kind in columns(spec).items()
        )
    )


def banking_sql(frame: str) -> str:
    """The same frame as DuckDB SQL."""
    source, given, spec = FRAMES[frame]
    kinds = {"string": "varchar"}
    cells = ", ".join(
        f"cast({given.get(name, 'null')} as {kinds.get(kind, kind)}) as {name}"
        for name, kind in columns(spec).items()
    )
    return f"select {cells} from {source}"
