"""Mergeable distinct counts against plain ones."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgermill.plans import bitmaps, metrics
from ledgermill.sources.layers import Lake


def activity(spark, first, days, users):
    start = datetime(2023, 1, 28)
    rows = [
        (None if u % 13 == 0 else (u * 40_009) % 200_000 - 1000, start + timedelta(days=d, hours=u % 24))
        for d in range(first, first + days)
        for u in range(d % 5, users, 3)
    ]
    return spark.createDataFrame(rows, "user_id long, at timestamp")


def by_day(df):
    return {r.day: (r.dau, r.mau, r.engagement_pct) for r in df.collect()}


def test_days_that_come_in_parts_count_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    whole = activity(spark, 0, 40, 300)
    for first, days in ((0, 20), (15, 15), (30, 10), (30, 10)):
        bitmaps.add_bitmaps(lake, "gold", "daily_users", bitmaps.daily_users(activity(spark, first, days, 300)))
    stored = lake.read("gold", "daily_users")
    assert stored.groupBy("day", "bucket").count().where("count > 1").count() == 0
    expected = by_day(metrics.app_engagement_rate(whole.where("user_id is not null")))
    assert len(expected) == 40 and by_day(bitmaps.engagement_of(stored)) == expected


def test_numbers_at_the_edges_of_a_bitmap(spark):
    numbers = [-32769, -32768, -1, 0, 1, 32767, 32768, 32769, 65536, 65537, 2**40, None]
    df = spark.createDataFrame([(g, n) for g in "ab" for n in numbers * 2], "g string, n long")
    bits = bitmaps.bitmaps(df, "n", ["g"])
    assert {r.g: r.c for r in bitmaps.counted(bits, ["g"], "c").collect()} == {"a": 11, "b": 11}
    both = bitmaps.merged(bits, [])
    assert bitmaps.counted(both, [], "c").first().c == 11
    assert bitmaps.counted(bitmaps.bitmaps(df.where("false"), "n", ["g"]), ["g"], "c").count() == 0


def test_customers_without_a_type_and_types_without_users(spark):
    customers = spark.createDataFrame(
        [("c1", "A", 1), ("c2", "A", 2), ("c2", "A", 3), ("c3", None, 4), ("c4", "B", 5)],
        "customer_id string, customer_type string, customer_key long",
    )
    accounts = spark.createDataFrame([("a1", "c1"), ("a2", "c2"), ("a3", "c3"), ("a4", "c4")], "account_id string, customer_id string")
    paid = spark.createDataFrame(
        [("a2", "ONLINE", "2023-01-01"), ("a2", "ONLINE", "2023-02-01"), ("a3", "MOBILE", None), ("a4", "BRANCH", "2023-01-01")],
        "account_id string, transaction_channel string, day string",
    ).select("account_id", "transaction_channel", F.col("day").cast("date").alias("transaction_date"))
    daily = bitmaps.daily_digital_customers(customers, accounts, paid)
    out = {r.customer_type: (r.numerator, r.denominator) for r in bitmaps.adoption_of(daily, customers).collect()}
    plain = metrics.digital_adoption_rate(customers, accounts, paid)
    assert out == {"A": (2, 3), None: (1, 1), "B": (0, 1)}
    assert out == {r.customer_type: (r.numerator, r.denominator) for r in plain.collect()}
