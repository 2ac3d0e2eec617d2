import datetime as dt
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.operators import customers
from ledgermill.operators.customers import clean_customers
from ledgermill.operators.star_customers import (
    CUSTOMER_TABLES,
    build_dim_addresses,
    build_dim_business_directors,
    build_dim_business_shareholders,
    build_dim_contacts,
    build_dim_customer_risks,
    build_dim_director_information,
    build_dim_documents,
    build_fact_customers,
)
from ledgermill.operators.unions import union_conformed, union_tagged
from ledgermill.sources.schemas import CUSTOMERS, columns, conform

D = dt.date


def staged(spark, rows, schema):
    return clean_customers(spark.createDataFrame(rows, schema))


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_staging_keeps_one_row_per_customer(spark):
    stg = staged(
        spark,
        [(" a ", "['X', None]", "['C1', 'C2']"), ("b", None, "[]"), ("b", "bad", None)],
        "customer_id string, director_customer_ids string, director_of_companies string",
    )
    out = [tuple(r) for r in stg.select("customer_id", "directors", "companies").collect()]
    assert sorted(o[0] for o in out) == ["A", "B", "B"]
    assert ("A", ["X", None], ["C1", "C2"]) in out


def test_staging_has_every_column(spark):
    stg = staged(spark, [("a",)], "customer_id string")
    renamed = {customers.RENAMED.get(c, c) for c in columns(CUSTOMERS)}
    assert renamed <= set(stg.columns) and len(stg.columns) == len(set(stg.columns))


def test_website_is_its_own_column(spark):
    stg = staged(spark, [("a", "shop", "www.x")], "customer_id string, trading_name string, website string")
    assert tuple(stg.select("company_trading_name", "website").first()) == ("SHOP", "WWW.X")


def test_fact_customers_rules(spark):
    schema = (
        "customer_id string, customer_type string, birth_date date, date_of_entry date, date_of_incorporation date, "
        "company_age int, citizenship string, nationality string, gender string, email string, "
        "preferred_contact_method string"
    )
    day = D(2020, 1, 1)
    rows = [
        ("i1", "individual", D(2003, 1, 1), day, None, None, "ZA", "Kenya", "f", "bad", "email"),
        ("i2", "individual", None, day, None, None, "ZA", None, "m", None, "email"),
        ("c1", "company", D(1990, 1, 1), day, D(2010, 1, 1), 51, "GB", "x", "m", "a@b.c", None),
        ("c2", "company", None, day, None, None, None, None, None, None, "sms"),
        ("o1", "organization", D(1990, 1, 1), day, None, 3, None, None, None, "a@b.c", "email"),
    ]
    out = {r.customer_id: r for r in build_fact_customers(staged(spark, rows, schema)).collect()}
    assert (out["I1"].age_group, out["I1"].is_dual_or_transfered) == (None, 1)
    assert out["I1"].preferred_contact_method == "UNKNOWN"
    # a missing age falls into the last individual band, an unknown nationality is not dual
    assert (out["I2"].age_group, out["I2"].is_dual_or_transfered) == ("RETIREES", 0)
    assert out["I2"].preferred_contact_method == "EMAIL"
    assert out["C1"].original_date_of_birth == D(2010, 1, 1) and out["C1"].fixed_age_at_opening == 51
    assert (out["C1"].gender, out["C1"].age_group) == ("NOT APPLICABLE", "OVER 50 YEARS OLD")
    assert out["C1"].preferred_contact_method == "UNKNOWN"
    assert out["C2"].age_group is None
    assert out["O1"].age_group is None and out["O1"].original_date_of_birth == D(1990, 1, 1)


def test_address_comparisons_are_three_valued(spark):
    schema = (
        "customer_id string, customer_type string, residential_address string, commercial_address string, "
        "principal_place_of_business string, registered_office_address string"
    )
    here, there = "1 Main Rd, City, Limpopo", "2 Side Rd, City, Limpopo"
    rows = [
        ("c1", "company", here, here, there, there),
        ("c2", "company", here, here, here, there),
        # without a commercial address the comparison is unknown unless the residence settles it
        ("c3", "company", None, None, there, None),
        ("i1", "individual", None, here, None, None),
        ("i2", "individual", here, there, None, None),
    ]
    out = build_dim_addresses(staged(spark, rows, schema))
    assert {(r.customer_id, r.address_type, r.is_primary_address) for r in out.collect()} == {
        ("C1", "RESIDENTIAL", 0),
        ("C1", "COMMERCIAL", 1),
        ("C1", "PRINCIPAL", 0),
        ("C2", "RESIDENTIAL", 0),
        ("C2", "COMMERCIAL", 1),
        ("C2", "OFFICE", 0),
        ("I1", "COMMERCIAL", 1),
        ("I2", "RESIDENTIAL", 1),
        ("I2", "COMMERCIAL", 0),
    }


def test_one_scan_unpivot_equals_union_of_branches(spark):
    schema = "customer_id string, email string, phone_number string, next_of_kin string, preferred_contact_method string"
    rows = [
        ("a", "x@y.z", "1", "kin", "email"),
        ("a", "x@y.z", "1", "kin", "email"),
        ("b", "bad", None, None, "email"),
        ("c", None, "2", "kin", "sms"),
        ("d", "x@y.z", "3", None, None),
    ]
    stg = staged(spark, rows, schema).cache()
    branches = {
        "PHONE": ("new_phone_number", "'ACTIVE'", "case when preferred_contact_method in ('PHONE', 'SMS') then 1 else 0 end"),
        "EMAIL": (
            "email",
            "case when is_invalid_email_format = 1 then 'INVALID' else 'ACTIVE' end",
            "case when preferred_contact_method = 'EMAIL' and is_invalid_email_format = 0 then 1 else 0 end",
        ),
        "NEXT OF KIN": ("next_of_kin", "'ACTIVE'", "0"),
    }
    expected = Counter()
    for kind, (value, status, primary) in branches.items():
        part = stg.where(f"{value} is not null").selectExpr("customer_id", f"'{kind}'", value, status, primary)
        expected += rows_of(part.distinct())
    assert rows_of(build_dim_contacts(stg)) == expected
    stg.unpersist()


def test_documents(spark):
    schema = "customer_id string, id_type string, id_number string, expiry_date date, visa_type string, visa_expiry_date date, date_of_entry date"
    day = D(2020, 1, 1)
    rows = [
        ("a", "passport", "p1", day, "work", D(2021, 1, 1), day),
        ("b", "national id", "n1", day, None, None, day),
        ("c", "passport", "p2", None, "study", day, day),
        ("d", "driving licence", "x", None, None, None, day),
    ]
    out = {(r.customer_id, r.document_type): tuple(r)[3:] for r in build_dim_documents(staged(spark, rows, schema)).collect()}
    assert out == {
        ("A", "PASSPORT"): ("EXPIRED", 1, day),
        ("A", "VISA - WORK"): ("VERIFIED", 0, D(2021, 1, 1)),
        ("B", "NATIONAL ID"): ("VERIFIED", 0, None),
        ("C", "PASSPORT"): ("VERIFIED", 0, None),
        ("C", "VISA - STUDY"): ("EXPIRED", 1, day),
    }


def test_missing_risk_score_is_high(spark):
    rows = [(c, Decimal(s) if s else None) for c, s in (("a", "0.29"), ("b", "0.3"), ("c", "0.5"), ("d", "0.51"), ("e", None), ("f", "1.0"))]
    out = build_dim_customer_risks(staged(spark, rows, "customer_id string, risk_score decimal(15,4)"))
    assert {r.customer_id: r.risk_level for r in out.collect()} == {
        "A": "LOW",
        "B": "MEDIUM",
        "C": "MEDIUM",
        "D": "HIGH",
        "E": "HIGH",
        "F": "HIGH",
    }


def test_independent_lists_equal_the_chained_explode(spark):
    holders = "[{'shareholder_id': 'S1', 'shareholder_name': 'Ann', 'ownership_percentage': 0.45}, {'shareholder_id': 'S2', 'shareholder_name': None, 'ownership_percentage': 'x'}]"
    schema = "customer_id string, major_shareholders string, director_customer_ids string, director_of_companies string"
    rows = [
        ("A", holders, "['D1', None, 'D2']", "['Acme', 'Beta']"),
        ("B", "[]", None, "['Acme']"),
        ("B", "[]", None, "['Acme']"),
        ("C", None, "[]", None),
    ]
    bronze = conform(spark.createDataFrame(rows, schema), CUSTOMERS)
    chained = (
        bronze.select("customer_id", "major_shareholders", "director_customer_ids", "director_of_companies")
        .transform(customers.explode_shareholders)
        .transform(customers.explode_directors)
        .transform(customers.explode_companies)
        .cache()
    )
    assert chained.count() == 2 * 3 * 2 + 1 + 1 + 1
    stg = clean_customers(bronze)
    holders_expected = chained.where("shareholder_name is not null").select(
        "customer_id",
        "shareholder_id",
        "shareholder_name",
        F.col("ownership_percentage").try_cast("decimal(8,5)"),
    )
    assert rows_of(build_dim_business_shareholders(stg)) == rows_of(holders_expected.distinct())
    directors = chained.where("director_customer_id is not null").select("customer_id", "director_customer_id")
    assert rows_of(build_dim_business_directors(stg)) == rows_of(directors.distinct())
    companies = chained.where("directed_company is not null").select("customer_id", "directed_company")
    assert rows_of(build_dim_director_information(stg)) == rows_of(companies.distinct())
    chained.unpersist()


def test_every_builder_is_distinct(spark):
    schema = "customer_id string, customer_type string, license_info string"
    stg = staged(spark, [("a", "company", '{"license_number": "L1", "issue_date": "nonsense"}')] * 3, schema).cache()
    for name, build in CUSTOMER_TABLES.items():
        assert build(stg).count() <= 1, name
    licence = CUSTOMER_TABLES["dim_business_licensing"](stg).first()
    assert (licence.license_number, licence.license_issue_date) == ("L1", None)
    stg.unpersist()


def test_yearly_frames_are_conformed_by_name(spark):
    one = spark.createDataFrame([("a", "2020-01-01", "7")], "customer_id string, birth_date string, company_age string")
    two = spark.createDataFrame([(9, "b", "x")], "company_age int, customer_id string, extra string")
    out = union_conformed([one, two], CUSTOMERS)
    assert out.columns == list(columns(CUSTOMERS))
    assert rows_of(out.select("customer_id", "birth_date", "company_age")) == Counter(
        [("a", D(2020, 1, 1), 7), ("b", None, 9)]
    )


def test_tagged_union_keeps_copies(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([("x", 1)], "b string, a int")
    out = union_tagged({"f_2020": one, "f_2021": two})
    assert rows_of(out) == Counter([(1, "x", "f_2020"), (1, "x", "f_2021")])
