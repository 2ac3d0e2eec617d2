import datetime as dt
from collections import Counter
from decimal import Decimal

from ledgermill.operators.transactions import (
    build_fact_transactions,
    clean_transactions,
    resolve_receiving_account,
)
from ledgermill.sources.schemas import TRANSACTIONS, conform


def facts(spark, rows):
    return spark.createDataFrame(rows, "account_id string, account_number string")


def test_receiving_accounts(spark):
    rows = [
        ("t1", "mobile", "ACC1"),
        ("t2", "eWallet ", "ACC1"),
        ("t3", "mobile", "ACC9"),
        ("t4", "mobile", "62001"),
        ("t5", "mobile", None),
        ("t6", None, "ACC2"),
        ("t7", "eWallet", "62001"),
        ("t8", "mobile", "acc1 "),
    ]
    tx = spark.createDataFrame(rows, "transaction_id string, channel string, receiving_account string")
    # ACC2 is listed with two numbers: one row per entry
    fa = facts(spark, [("ACC1", "111"), ("ACC2", "221"), ("ACC2", "222"), (None, "0")])
    for slice_rows in (1, None):
        out = resolve_receiving_account(tx, fa, slice_rows)
        assert Counter((r.transaction_id, r.receiving_account_number) for r in out.collect()) == Counter(
            [
                ("t1", "111"),
                ("t2", ""),
                ("t3", ""),
                ("t4", "62001"),
                ("t5", ""),
                ("t6", "221"),
                ("t6", "222"),
                ("t7", ""),
                ("t8", "111"),
            ]
        )


def test_cleaning(spark):
    schema = (
        "transaction_id string, amount decimal(15,2), channel string, receiving_bank string, is_reversal string, "
        "instant_payment string, cashback_amount decimal(8,2), transaction_time string, transaction_date date"
    )
    day = dt.date(2024, 1, 1)
    rows = [
        (" t1", Decimal("-5.00"), "mobile", " same bank", "Yes", None, Decimal("-1.00"), "10:11:12", day),
        ("t2", Decimal("0.00"), "mobile", "Other", "No", "yes", None, None, day),
        ("t3", None, "mobile", "Other", "No", "yes", None, None, day),
        ("t4", Decimal("7.50"), "EWALLET", "Other", "no", "YES ", None, "25:00:00", None),
        ("t5", Decimal("7.50"), None, "other ", None, "YES ", None, None, None),
    ]
    stg = clean_transactions(spark.createDataFrame(rows, schema), facts(spark, []))
    out = {r.transaction_id: r for r in stg.collect()}
    assert set(out) == {"T1", "T4", "T5"}
    first = out["T1"]
    assert (first.transaction_amount, first.cashback_amount) == (Decimal("5.00"), Decimal("1.00"))
    assert (first.receiving_bank, first.is_reversal, first.is_instant_payment) == ("", 1, 0)
    assert first.transaction_time == "10:11:12"
    assert (out["T4"].receiving_bank, out["T4"].transaction_time) == ("", None)
    assert out["T5"].receiving_bank == "OTHER"


def test_copies_collapse_in_the_fact_table(spark):
    tx = conform(
        spark.createDataFrame([("t1", Decimal("1.00"))] * 5 + [("t2", Decimal("1.00"))], "transaction_id string, amount decimal(15,2)"),
        TRANSACTIONS,
    )
    stg = clean_transactions(tx, facts(spark, []))
    assert stg.count() == 6 and build_fact_transactions(stg).count() == 2
