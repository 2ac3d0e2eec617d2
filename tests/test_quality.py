from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.operators import quality
from ledgermill.operators.keys import add_audit_columns, add_defaults, add_surrogate_key


def found(df):
    return Counter((r.rule, r.table_name, r.key, r.detail) for r in df.collect())


def test_not_null(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "x", None), (None, "x", 1)], "k string, s string, n int")
    assert found(quality.check_not_null(df, "t", "k", ["k", "s", "n"])) == Counter(
        [("NOT_NULL", "t", "a", "s"), ("NOT_NULL", "t", "b", "n"), ("NOT_NULL", "t", None, "k")]
    )


def test_domain_passes_null(spark):
    df = spark.createDataFrame([("a", "F"), ("b", "it's"), ("c", None)], "k string, g string")
    assert found(quality.check_domain(df, "t", "k", {"g": ["F", "M"]})) == Counter([("DOMAIN", "t", "b", "g=it's")])
    assert not found(quality.check_domain(df, "t", "k", {"g": ["F", "it's"]}))


def test_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, n int")
    assert found(quality.check_unique(df, "t", ["k", "n"])) == Counter(
        [("UNIQUE", "t", "a|1", "2"), ("UNIQUE", "t", "|1", "2")]
    )


def test_reference_counts_children(spark):
    child = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "p string")
    parent = spark.createDataFrame([("y",), ("y",)], "id string")
    assert found(quality.check_reference(child, "t", "p", parent, "id")) == Counter([("REFERENCE", "t", "x", "2")])


def test_current_address(spark):
    df = spark.createDataFrame(
        [("a", "OFFICE", 1), ("a", "OFFICE", 1), ("b", "OFFICE", 1), ("b", "OFFICE", 0)],
        "customer_id string, address_type string, is_current_address int",
    )
    assert found(quality.check_current_address(df)) == Counter([("UNIQUE", "dim_addresses", "a|OFFICE", "2")])


def test_limits(spark):
    df = spark.createDataFrame(
        [("a", "short", Decimal("999.99")), ("b", "much longer", Decimal("1000.00")), ("c", None, None)],
        "k string, s string, n decimal(15,2)",
    )
    out = found(quality.check_limits(df, "t", "k", {"s": 5}, {"n": (5, 2)}))
    assert out == Counter([("TEXT_LIMIT", "t", "b", "s=11"), ("NUMBER_LIMIT", "t", "b", "n=1000.00")])


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v")).repartition(7)
    out = add_surrogate_key(df, "row_key", ["k"])
    assert out.columns == ["row_key", "k", "v"]
    assert sorted((r.row_key, r.k) for r in out.collect()) == [(i + 1, i) for i in range(5000)]
    # the same rows read twice carry the same keys
    assert out.exceptAll(out).count() == 0


def test_surrogate_keys_without_order_are_dense(spark):
    df = spark.range(5000).repartition(7)
    out = add_surrogate_key(df, "row_key")
    assert sorted(r.row_key for r in out.collect()) == list(range(1, 5001))
    assert out.select("id").distinct().count() == 5000


def test_surrogate_keys_of_an_empty_frame(spark):
    assert add_surrogate_key(spark.range(0), "row_key", ["id"]).count() == 0


def test_surrogate_keys_with_a_hot_prefix(spark):
    df = spark.range(900).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    out = add_surrogate_key(df, "row_key", ["a", "b"])
    assert sorted((r.row_key, r.b) for r in out.collect()) == [(i + 1, i) for i in range(900)]


def test_defaults_fill_only_omitted_columns(spark):
    df = spark.createDataFrame([("a", None)], "customer_id string, end_date date")
    row = add_defaults(df, "dim_addresses").first()
    assert row.is_current_address == 1 and row.end_date is None
    assert add_defaults(df, "fact_customers").columns == df.columns
    assert {"created_date", "update_date"} <= set(add_audit_columns(df).columns)


def test_summary(spark):
    customers = spark.createDataFrame(
        [(1, 0, 0), (0, 1, 0)], "is_invalid_email_format int, registered_expired_document int, registered_expired_visa int"
    )
    accounts = spark.createDataFrame(
        [(2, 1, 0, 1, 0), (1, 1, 0, 0, 0)],
        "account_number_count int, account_id_count int, card_number_count int, over_one_primary_acc int, invalid_date int",
    )
    out = {r.flag: (r.flagged, r["rows"]) for r in quality.quality_summary(customers, accounts).collect()}
    assert out == {
        "is_invalid_email_format": (1, 2),
        "registered_expired_document": (1, 2),
        "registered_expired_visa": (0, 2),
        "duplicate_account_number": (1, 2),
        "duplicate_account_id": (0, 2),
        "duplicate_card_number": (0, 2),
        "over_one_primary_acc": (1, 2),
        "invalid_date": (0, 2),
    }
