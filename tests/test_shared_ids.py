"""Customer ids held by several customers: their accounts are cleaned, joined and dealt once."""

import datetime as dt
from collections import Counter

from ledgermill.operators import accounts, star_accounts
from ledgermill.plans import bitmaps

D = dt.date
SCHEMA = "account_id string, customer_id string, opening_date date, account_type string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def delivered(spark):
    rows = [("a1", " c1 ", D(2020, 1, 1), "x "), ("a2", "C2", D(2020, 1, 1), "y"), ("a2", "C2", D(2020, 1, 1), "y")]
    rows += [("a3", "c9", None, None), ("a4", None, None, None), ("a5", "c1", None, " x")]
    customers = [("c1", D(2019, 1, 1)), ("C1", D(2019, 1, 1)), ("C1 ", D(2021, 1, 1)), ("C2", None), (None, None)]
    return (
        spark.createDataFrame(rows, SCHEMA),
        spark.createDataFrame(customers, "customer_id string, customer_registration_date date"),
    )


def test_an_account_comes_once_per_customer_of_its_id(spark):
    for slice_rows in (1, None):
        stg = accounts.clean_accounts(*delivered(spark), slice_rows=slice_rows)
        assert "_first" not in stg.columns
        found = Counter((r.account_id, r.customer_id, r.account_type, r.invalid_date) for r in stg.collect())
        assert found == {
            ("a1", "C1", "X", 0): 2, ("a1", "C1", "X", 1): 1, ("a2", "C2", "Y", 0): 2, ("a5", "C1", "X", 0): 3
        }


def test_builders_read_one_row_of_every_account(spark):
    stg = accounts.clean_accounts(*delivered(spark), mark_copies=True)
    once = accounts.first_copies(stg)
    assert sorted(r.account_id for r in once.collect()) == ["a1", "a2", "a2", "a5"]
    assert stg.count() == 8
    status = star_accounts.build_dim_account_status
    assert sorted(map(str, status(once).collect())) == sorted(map(str, status(stg).collect()))
    assert accounts.first_copies(stg.drop("_first")).count() == 8


def test_texts_are_cleaned_before_accounts_are_repeated(spark):
    frames = delivered(spark)
    joined = accounts.join_customers(accounts.conform(frames[0], accounts.ACCOUNTS), frames[1])
    assert joined.count() == 4  # known accounts, whatever the number of customers of an id
    plan = plan_of(accounts.clean_accounts(*frames)).splitlines()
    last_generate = max(k for k, line in enumerate(plan) if "Generate" in line)
    assert not any("translate(" in line for line in plan[:last_generate])


def test_numbers_that_come_once_are_dealt_once(spark):
    rows = spark.range(200).selectExpr("id as n", "id % 3 as g")
    once, again = (bitmaps.bitmaps(rows, "n", ["g"], repeated=r) for r in (False, True))
    assert plan_of(once).count("Exchange") == plan_of(again).count("Exchange") - 1
    counts = [{r.g: r.c for r in bitmaps.counted(b, ["g"], "c").collect()} for b in (once, again)]
    assert counts[0] == counts[1] == {0: 67, 1: 67, 2: 66}
