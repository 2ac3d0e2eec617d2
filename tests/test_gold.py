import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermill.plans import metrics, reports
from ledgermill.plans.measures import average, growth_rate, ratio

D = dt.date


def test_growth_needs_the_calendar_period_before(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 10), (D(2024, 2, 1), 15), (D(2024, 4, 1), 3)], "p date, n long")
    out = {r.p: (r.n, r.previous_value, r.growth_pct) for r in growth_rate(df, "p", "n").collect()}
    assert out == {
        D(2024, 1, 1): (10, None, None),
        D(2024, 2, 1): (15, 10, 50.0),
        D(2024, 4, 1): (3, None, None),
    }


@pytest.mark.parametrize(
    ("unit", "back", "earlier"),
    [("day", 1, D(2024, 2, 28)), ("week", 1, D(2024, 2, 22)), ("month", 12, D(2023, 2, 28)), ("year", 1, D(2023, 2, 28))],
)
def test_growth_over_other_periods(spark, unit, back, earlier):
    day = D(2024, 2, 28) if unit in ("month", "year") else D(2024, 2, 29)
    df = spark.createDataFrame([(earlier, 4), (day, 2)], "p date, n long")
    assert {r.p: r.growth_pct for r in growth_rate(df, "p", "n", unit, back).collect()}[day] == -50.0


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 0), (D(2024, 2, 1), 5)], "p date, n long")
    assert {r.growth_pct for r in growth_rate(df, "p", "n").collect()} == {None}
    assert ratio(df.where("n > 9"), [], F.col("n"), F.lit(1)).first().pct is None
    assert average(df.where("n > 9"), [], F.col("n"), "mean").first().mean is None


def test_distinct_accounts_counts_a_missing_number_once(spark):
    rows = [("ACC001",), ("ACC002",), ("ACC001",), ("ACC003",)]
    df = spark.createDataFrame(rows, "account_number string")
    assert metrics.distinct_accounts(df).first()[0] == 3
    more = df.unionByName(spark.createDataFrame([(None,), (None,)], "account_number string"))
    assert metrics.distinct_accounts(more).first()[0] == 4


@pytest.fixture(scope="module")
def bank(spark):
    """Five customers; c1 and c2 close everything, c4 keeps one account, c5 has none."""
    customers = spark.createDataFrame(
        [
            ("c1", "INDIVIDUAL", D(2023, 1, 10)),
            ("c2", "INDIVIDUAL", D(2023, 1, 20)),
            ("c3", "COMPANY", D(2023, 2, 1)),
            ("c4", "COMPANY", D(2023, 4, 1)),
            ("c5", "COMPANY", D(2023, 4, 1)),
        ],
        "customer_id string, customer_type string, customer_registration_date date",
    )
    accounts = spark.createDataFrame(
        [("a1", "c1"), ("a2", "c1"), ("a3", "c2"), ("a4", "c3"), ("a5", "c4"), ("a6", "c4")],
        "account_id string, customer_id string",
    )
    status = spark.createDataFrame(
        [
            ("a1", "CLOSED", D(2023, 2, 1)),
            ("a2", "CLOSED", D(2023, 4, 2)),
            ("a3", "CLOSED", D(2023, 2, 3)),
            ("a4", "ACTIVE", None),
            ("a5", "CLOSED", D(2023, 5, 1)),
            ("a6", "ACTIVE", None),
        ],
        "account_id string, account_status string, account_closing_date date",
    )
    return customers, accounts, status


def test_movement_churn_and_retention(bank):
    moved = metrics.customer_movement(*bank)
    out = {r.period: tuple(r)[1:] for r in moved.collect()}
    # start, new, lost, end
    assert out == {
        D(2023, 1, 1): (0, 2, 0, 2),
        D(2023, 2, 1): (2, 1, 1, 2),
        D(2023, 4, 1): (2, 2, 1, 3),
    }
    churn = {r.period: r.churn_pct for r in metrics.churn_rate(moved).collect()}
    kept = {r.period: r.retention_pct for r in metrics.retention_rate(moved).collect()}
    assert churn == {D(2023, 1, 1): None, D(2023, 2, 1): 50.0, D(2023, 4, 1): 50.0}
    assert kept == {D(2023, 1, 1): None, D(2023, 2, 1): 50.0, D(2023, 4, 1): 50.0}


def test_base_growth(bank):
    out = {r.period: (r.total_customers, r.growth_pct) for r in metrics.customer_base_growth(bank[0]).collect()}
    assert out == {D(2023, 1, 1): (2, None), D(2023, 2, 1): (3, 50.0), D(2023, 4, 1): (5, 2 * 100 / 3)}


def test_products(spark, bank):
    customers, accounts, status = bank
    products = spark.createDataFrame(
        [("a4", "CARD"), ("a6", "CARD"), ("a6", "LOAN"), ("a1", "CARD"), ("a2", "CARD")],
        "account_id string, product_type string",
    )
    row = metrics.products_per_customer(customers, products, status).first()
    assert (row.active_products, row.customers, row.products_per_customer) == (3, 5, 0.6)
    out = {r.product_type: r.penetration_pct for r in metrics.product_penetration(customers, accounts, products).collect()}
    assert out == {"CARD": 60.0, "LOAN": 20.0}


def tx(spark, rows):
    return spark.createDataFrame(
        rows, "account_id string, transaction_channel string, fee int, transaction_date date"
    ).select(
        "account_id",
        "transaction_channel",
        "transaction_date",
        F.col("fee").cast("decimal(5,2)").alias("transaction_fee"),
        *(F.lit(None).cast("decimal(5,2)").alias(c) for c in ("fx_fee", "swift_fee", "correspondent_fee")),
    )


def test_value_profit_and_adoption(spark, bank):
    customers, accounts, _ = bank
    day = D(2023, 6, 1)
    moves = tx(spark, [("a1", "MOBILE", 3, day), ("a2", "ATM", 4, day), ("a4", "ATM", 5, day), ("zz", "MOBILE", 90, day)])
    value = {r.customer_type: r for r in metrics.customer_lifetime_value(customers, accounts, moves, "2024-01-10").collect()}
    assert value["INDIVIDUAL"].avg_revenue == 3.5
    assert value["INDIVIDUAL"].avg_tenure_years == (365 + 355) / 2 / 365.25
    assert value["COMPANY"].customers == 3
    costs = spark.createDataFrame([("a1", 1), ("a6", 2)], "account_id string, cost int")
    profit = {r.customer_id: float(r.profit) for r in metrics.customer_profitability(moves, costs, accounts).collect()}
    assert profit == {"c1": 6.0, "c3": 5.0, "c4": -2.0}
    adoption = {r.customer_type: r.adoption_pct for r in metrics.digital_adoption_rate(customers, accounts, moves).collect()}
    assert adoption == {"INDIVIDUAL": 50.0, "COMPANY": 0.0}
    assert float(metrics.fee_income(moves).first().fee_income) == 102.0


def test_loans(spark):
    loans = spark.createDataFrame(
        [(100, 200, 0, D(2023, 1, 5), None), (50, 100, 15, D(2023, 1, 9), None), (25, 50, 45, D(2023, 2, 1), 25), (75, 100, 90, D(2023, 2, 2), None)],
        "outstanding int, approved_limit int, days_past_due int, book_date date, written_off int",
    )
    assert metrics.loan_utilisation(loans, []).first().utilisation_pct == 250 * 100 / 450
    assert metrics.npl_ratio(loans, []).first().npl_pct == 30.0
    assert metrics.early_delinquency_rate(loans, []).first().early_delinquency_pct == 20.0
    assert metrics.charge_off_rate(loans).first().charge_off_pct == 20.0
    assert {r.bucket: (r.loans, r.outstanding) for r in reports.past_due_buckets(loans).collect()} == {
        "1-29": (1, 50),
        "30-59": (1, 25),
        "90+": (1, 75),
    }


def test_maturity(spark):
    days = [-1, 0, 1, 30, 31, 90, 91, 365, 366, None]
    due = [(None if d is None else D(2024, 1, 1) + dt.timedelta(d), 1) for d in days]
    loans = spark.createDataFrame(due, "maturity_date date, outstanding int")
    out = {r.bucket: r.loans for r in reports.maturity_profile(loans, "2024-01-01").collect()}
    assert out == {"MATURED": 2, "0-30 DAYS": 2, "31-90 DAYS": 2, "91-365 DAYS": 2, "OVER 365 DAYS": 1}


def test_engagement(spark):
    at = [(1, "2024-01-01"), (1, "2024-01-01"), (2, "2024-01-01"), (1, "2024-01-02"), (3, "2024-02-01")]
    activity = spark.createDataFrame(at, "user_id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    out = {r.day: (r.dau, r.mau, r.engagement_pct) for r in metrics.app_engagement_rate(activity).collect()}
    assert out == {D(2024, 1, 1): (2, 2, 100.0), D(2024, 1, 2): (1, 2, 50.0), D(2024, 2, 1): (1, 1, 100.0)}


def test_branches_keep_accounts_without_transactions(spark):
    accounts = spark.createDataFrame(
        [("a1", "B1", "c1"), ("a2", "B1", "c1"), ("a3", "B2", "c2")], "account_id string, branch_code string, customer_id string"
    )
    moves = spark.createDataFrame([("a1", 5), ("a1", 7), ("zz", 9)], "account_id string, transaction_amount int")
    homes = spark.createDataFrame([("c1", 1, "LIMPOPO"), ("c1", 0, "GAUTENG")], "customer_id string, is_primary_address int, province string")
    out = {(r.branch_code, r.province): (r.accounts, r.transactions, r.amount) for r in reports.branch_performance(moves, accounts, homes).collect()}
    assert out == {("B1", "LIMPOPO"): (2, 2, 12), ("B2", None): (1, 0, 0)}
