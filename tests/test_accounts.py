import datetime as dt
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermill.operators import accounts
from ledgermill.operators.star_accounts import (
    build_dim_account_beneficiary,
    build_dim_account_documents,
    build_dim_account_joint_customers,
    build_dim_account_products,
    build_dim_account_type,
    build_fact_accounts,
)
from ledgermill.sources.schemas import ACCOUNTS, conform

D = dt.date


def bronze(spark, rows, schema):
    return conform(spark.createDataFrame(rows, schema), ACCOUNTS)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_duplicate_counts_equal_windows(spark):
    """One number and the missing cards hold a large share of the rows."""
    rows = [(f"a{i}", "hot" if i % 3 == 0 else f"n{i % 7}", None if i % 2 else f"c{i % 5}") for i in range(90)]
    rows += [("b1", None, "c0"), ("b2", None, None), (None, None, None), (None, "hot", "c0")]
    df = spark.createDataFrame(rows, "account_id string, account_number string, card_number string")
    by = Window.partitionBy
    expected = df.select(
        "*",
        F.count("account_number").over(by("account_number")),
        F.count("account_id").over(by("account_number")),
        F.count("card_number").over(by("card_number")),
    )
    for slice_rows in (2, 10, None):
        assert rows_of(accounts.add_duplicate_counts(df, slice_rows)) == rows_of(expected)


def test_primary_sanity_equals_window(spark):
    rows = [(f"a{i}", "big " if i % 2 else f"c{i % 4}", i % 3 == 0) for i in range(40)] + [("x", None, True), ("y", None, True)]
    df = spark.createDataFrame(rows, "account_id string, customer_id string, p boolean").select(
        "account_id", "customer_id", F.col("p").cast("int").alias("is_primary_account")
    )
    total = F.sum("is_primary_account").over(Window.partitionBy(F.upper(F.trim("customer_id"))))
    expected = df.select("*", total.alias("n")).withColumn("f", F.when(F.col("n") > 1, 1).otherwise(0))
    for slice_rows in (3, None):
        assert rows_of(accounts.add_primary_sanity(df, slice_rows)) == rows_of(expected)


def test_date_sequence_ignores_missing_dates(spark):
    df = bronze(
        spark,
        [
            ("ok", D(2020, 1, 1), D(2020, 1, 2), None, None),
            ("approved early", D(2020, 1, 2), D(2020, 1, 1), None, None),
            ("none", None, None, None, None),
            ("card expired", None, None, D(2020, 1, 2), D(2020, 1, 1)),
            # approval after card issue is allowed
            ("issued early", None, D(2020, 1, 2), D(2020, 1, 1), None),
        ],
        "account_id string, opening_date date, approval_date date, card_issue_date date, card_expiry_date date",
    ).withColumn("customer_registration_date", F.lit(D(2019, 1, 1)))
    out = {r.account_id: r.invalid_date for r in accounts.flag_date_sequence(df).collect()}
    assert out == {"ok": 0, "approved early": 1, "none": 0, "card expired": 1, "issued early": 0}


def test_missing_status_date(spark):
    df = bronze(
        spark,
        [("a", "active", None), ("b", "closed", None), ("c", "closed", D(2020, 1, 1)), ("d", None, None)],
        "account_id string, account_status string, status_change_date date",
    )
    out = [r[-1] for r in accounts.flag_missing_status_date(df).orderBy("account_id").collect()]
    assert out == [0, 1, 0, 0]


def test_explodes_keep_accounts_without_entries(spark):
    df = spark.createDataFrame(
        [("a", "c1; c2"), ("b", ""), ("c", None)], "account_id string, linked_joint_accounts string"
    )
    out = rows_of(accounts.explode_joint(df).select("account_id", "joint_customer_id"))
    assert out == Counter([("a", "C1"), ("a", "C2"), ("b", ""), ("c", None)])
    assert rows_of(build_dim_account_joint_customers(df)) == Counter([("a", "C1"), ("a", "C2"), ("b", "")])


def test_beneficiaries(spark):
    text = "Ann Lee|SPOUSE|60%;Ben|CHILD| 40 %;only name;Cy||5%;Di|AUNT|half;a|b|c|d|9%"
    df = spark.createDataFrame([("a", text), ("b", None)], "account_id string, beneficiaries string")
    out = [
        (r.beneficiary_name, r.beneficiary_relationship, None if r.beneficiary_percentage is None else float(r.beneficiary_percentage))
        for r in accounts.explode_beneficiaries(df).collect()
    ]
    assert out == [
        ("Ann Lee", "SPOUSE", 0.6),
        ("Ben", "CHILD", 0.4),
        (None, None, None),
        ("Cy", None, 0.05),
        ("Di", "AUNT", None),
        (None, None, None),
        (None, None, None),
    ]
    assert build_dim_account_beneficiary(df).count() == 4


def staged(spark, rows, schema, customers=("C1", "C2")):
    fact = spark.createDataFrame([(c, D(2019, 1, 1)) for c in customers], "customer_id string, customer_registration_date date")
    return accounts.clean_accounts(spark.createDataFrame(rows, schema), fact, slice_rows=2)


def test_unknown_customers_drop_out(spark):
    out = staged(
        spark,
        [("a1", " c1 "), ("a2", "c2"), ("a3", "c9"), ("a4", None)],
        "account_id string, customer_id string",
    )
    assert {(r.account_id, r.customer_id) for r in out.collect()} == {("a1", "C1"), ("a2", "C2")}


def test_independent_lists_equal_the_chained_explode(spark):
    rows = [
        ("a1", "c1", "j1;j2", "p_1;p2", "Ann|X|50%;Ben|Y|50%"),
        ("a2", "c2", None, "p2", None),
        ("a2", "c2", None, "p2", None),
        ("a3", "c1", "", None, "Cy|Z|100%"),
    ]
    stg = staged(
        spark,
        rows,
        "account_id string, customer_id string, linked_joint_accounts string, bundled_products string, beneficiaries string",
    )
    chained = (
        stg.transform(accounts.explode_joint)
        .transform(accounts.explode_products)
        .transform(accounts.explode_beneficiaries)
        .cache()
    )
    joint = chained.where("joint_customer_id is not null").select("account_id", "joint_customer_id").distinct()
    assert rows_of(build_dim_account_joint_customers(stg)) == rows_of(joint)
    named = chained.where("beneficiary_name is not null").select(
        "account_id", "beneficiary_name", "beneficiary_relationship", "beneficiary_percentage"
    )
    assert rows_of(build_dim_account_beneficiary(stg)) == rows_of(named.distinct())
    products = chained.where("bundled_product is not null").select("account_id", "bundled_product").distinct()
    assert rows_of(build_dim_account_products(stg).drop("product_activation_date")) == rows_of(products)
    chained.unpersist()


def test_products_activate_online_or_on_approval(spark):
    stg = staged(
        spark,
        [("a1", "c1", "p", 1, D(2020, 5, 5), D(2020, 1, 1)), ("a2", "c2", "p", 0, D(2020, 5, 5), D(2020, 1, 1))],
        "account_id string, customer_id string, bundled_products string, online_banking_enabled int, "
        "online_banking_activation_date date, approval_date date",
    )
    out = {r.account_id: r.product_activation_date for r in build_dim_account_products(stg).collect()}
    assert out == {"a1": D(2020, 5, 5), "a2": D(2020, 1, 1)}


def test_document_score_needs_every_flag(spark):
    names = (
        "proof_of_income_provided bank_statements_provided employer_letter_provided "
        "business_registration_provided tax_certificate_provided"
    ).split()
    stg = staged(
        spark,
        [("a1", "c1", 1, 1, 0, 0, 1), ("a2", "c2", 1, 1, 0, 0, None)],
        "account_id string, customer_id string, " + ", ".join(f"{n} int" for n in names),
    )
    out = {r.account_id: r.document_status_score for r in build_dim_account_documents(stg).collect()}
    assert float(out["a1"]) == 3.0 and out["a2"] is None


def test_account_types_are_only_added(spark):
    stg = staged(
        spark,
        [("a1", "c1", " savings"), ("a2", "c2", "Cheque"), ("a3", "c1", "SAVINGS"), ("a4", "c1", None)],
        "account_id string, customer_id string, account_type string",
    )
    first = build_dim_account_type(stg)
    assert {tuple(r) for r in first.collect()} == {(1, "CHEQUE"), (2, "SAVINGS")}
    known = spark.createDataFrame([(7, "CHEQUE")], "account_type_id long, account_type string")
    assert {tuple(r) for r in build_dim_account_type(stg, known).collect()} == {(8, "SAVINGS")}
    facts = build_fact_accounts(stg, first, slice_rows=1)
    assert {(r.account_id, r.account_type_id) for r in facts.collect()} == {("a1", 2), ("a2", 1), ("a3", 2)}
