"""Customers by the time they hold open accounts, on edge cases and against a day-by-day count."""

from datetime import date as D
from datetime import timedelta

from ledgermill.plans.periods import customer_periods, customer_turnover, retention_of_turnover


def frames(spark, accounts):
    owners = spark.createDataFrame([(a, c) for a, c, _, _ in accounts], "account_id string, customer_id string")
    status = spark.createDataFrame(
        [(a, o, e) for a, _, o, e in accounts],
        "account_id string, account_opening_date date, account_closing_date date",
    )
    return owners, status


def stretches(spark, accounts):
    out = customer_periods(*frames(spark, accounts)).collect()
    return sorted([(r.customer_id, r.period_number, r.started, r.ended) for r in out], key=str)


def test_stretches_break_where_no_account_is_open(spark):
    J, F, M, A = D(2023, 1, 10), D(2023, 2, 10), D(2023, 3, 10), D(2023, 4, 10)
    assert stretches(spark, [("a", "back", J, F), ("b", "back", M, None)]) == [("back", 1, J, F), ("back", 2, M, None)]
    # the second account opens on the day the first one closes
    assert stretches(spark, [("a", "c", J, F), ("b", "c", F, M)]) == [("c", 1, J, M)]
    # one account lies within another
    assert stretches(spark, [("a", "c", J, A), ("b", "c", F, M)]) == [("c", 1, J, A)]
    # two close on the day that two others open
    assert stretches(spark, [("a", "c", J, F), ("b", "c", J, F), ("d", "c", F, M), ("e", "c", F, A)]) == [("c", 1, J, A)]


def test_days_that_are_missing_or_turned_around(spark):
    J, F, M = D(2023, 1, 10), D(2023, 2, 10), D(2023, 3, 10)
    assert stretches(spark, [("a", "c", F, J), ("b", "c", F, F)]) == []
    assert stretches(spark, [("a", "c", None, F), ("b", "c", M, None)]) == [("c", 1, None, F), ("c", 2, M, None)]
    assert stretches(spark, [("a", "c", None, None)]) == [("c", 1, None, None)]
    assert stretches(spark, [("a", None, J, None)]) == []
    # an account of two yearly extracts: open in the first, closed in the second
    assert stretches(spark, [("a", "c", J, None), ("a", "c", J, F)]) == [("c", 1, J, F)]
    assert stretches(spark, []) == []


def test_lost_and_returned_customers_per_month(spark):
    accounts = [
        ("a", "back", D(2023, 1, 5), D(2023, 2, 5)),
        ("b", "back", D(2023, 4, 5), None),
        ("c", "short", D(2023, 2, 3), D(2023, 2, 20)),
        ("d", "pause", D(2023, 1, 1), D(2023, 4, 2)),
        ("e", "pause", D(2023, 4, 20), D(2023, 5, 1)),
        ("f", "old", None, D(2023, 2, 28)),
    ]
    turned = customer_turnover(customer_periods(*frames(spark, accounts)))
    out = {r.period: tuple(r)[1:] for r in turned.collect()}
    # start, new, returned, lost, end
    assert out == {
        D(2023, 1, 1): (1, 2, 0, 0, 3),
        D(2023, 2, 1): (3, 0, 0, 2, 1),
        D(2023, 4, 1): (1, 0, 1, 0, 2),
        D(2023, 5, 1): (2, 0, 0, 1, 1),
    }
    rates = {r.period: (r.kept_customers, r.churn_pct, r.retention_pct) for r in retention_of_turnover(turned).collect()}
    assert rates[D(2023, 4, 1)] == (1, 0.0, 100.0) and rates[D(2023, 5, 1)] == (1, 50.0, 50.0)


def test_turnover_equals_a_count_day_by_day(spark):
    first = D(2022, 1, 1)
    accounts = []
    for i in range(400):
        opened = first + timedelta(days=(i * 7919) % 700)
        closed = None if i % 11 == 0 else opened + timedelta(days=(i * 31) % 90 - 3)
        # one customer holds a third of all accounts
        accounts.append((f"a{i}", "hot" if i % 3 == 0 else f"c{i % 60}", opened, closed))
    owned = {}
    for _, c, o, e in accounts:
        owned.setdefault(c, []).append((o, e))

    def there(c, day):  # at the end of the day
        return any(o <= day and (e is None or e > day) for o, e in owned[c])

    turned = {r.period: tuple(r)[1:] for r in customer_turnover(customer_periods(*frames(spark, accounts))).collect()}
    seen, moved = set(), 0
    for m in range(30):
        start = D(2022 + m // 12, m % 12 + 1, 1)
        after = D(2022 + (m + 1) // 12, (m + 1) % 12 + 1, 1)
        days = [start + timedelta(days=k) for k in range((after - start).days)]
        before = {c for c in owned if there(c, start - timedelta(days=1))}
        end = {c for c in owned if there(c, days[-1])}
        expected = (len(before), len(end - before - seen), len((end - before) & seen), len(before - end), len(end))
        seen |= {c for c in owned if any(there(c, d) for d in days)}
        if start in turned:
            assert turned[start] == expected, start
            moved += expected[2]
        else:
            assert before == end
    assert moved > 20


def test_a_customer_with_many_accounts_brings_one_row_a_day(spark):
    """The window sees days, not accounts."""
    accounts = [(f"a{i}", "hot", D(2023, 1, 1 + i % 5), D(2023, 2, 1 + i % 3)) for i in range(500)]
    plan = customer_periods(*frames(spark, accounts))._jdf.queryExecution().optimizedPlan().toString()
    window, below = plan.split("Window", 1)
    assert "Aggregate [customer_id" in below and "day" in below
    assert stretches(spark, accounts) == [("hot", 1, D(2023, 1, 1), D(2023, 2, 3))]
