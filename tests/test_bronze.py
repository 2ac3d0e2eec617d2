import datetime as dt

from pyspark.sql import functions as F

from ledgermill.sources import bronze
from ledgermill.sources.layers import Lake


def frame(spark, rows):
    return spark.createDataFrame(rows, "_source_file_url string, a int, b string")


def hashes(df):
    return {r["source"]: r["source_hash"] for r in bronze.source_hash(df).collect()}


def test_hash_ignores_order_and_counts_copies(spark):
    rows = [("f", 1, "x"), ("f", 2, None), ("f", 2, ""), ("g", 1, "x")]
    base = hashes(frame(spark, rows))
    assert hashes(frame(spark, rows[::-1]).repartition(4)) == base
    assert hashes(frame(spark, rows + [rows[0]]))["f"] != base["f"]
    assert hashes(frame(spark, [("f", 1, "x"), ("f", 2, ""), ("f", 2, "")]))["f"] != base["f"]
    # a pair of copies does not cancel out
    assert hashes(frame(spark, [("f", 1, "x")] * 3))["f"] != hashes(frame(spark, [("f", 1, "x")]))["f"]


def test_hash_keeps_column_borders(spark):
    one = spark.createDataFrame([("f", "ab", "c")], "_source_file_url string, a string, b string")
    two = spark.createDataFrame([("f", "a", "bc")], "_source_file_url string, a string, b string")
    assert hashes(one) != hashes(two)


def test_metadata_does_not_change_the_hash(spark):
    df = frame(spark, [("f", 1, "x"), ("g", 2, "y")])
    tagged = bronze.add_ingest_metadata(df)
    assert hashes(tagged) == hashes(df)
    assert {(r._source_file_url, r._source_hash) for r in tagged.collect()} == set(hashes(df).items())
    assert dict(tagged.dtypes)["_ingestion_timestamp"] == "timestamp_ntz"


def test_changes(spark):
    schema = "source string, source_hash string"
    before = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], schema)
    after = spark.createDataFrame([("b", "1"), ("c", "2"), ("d", "1")], schema)
    out = {r["source"]: r["change"] for r in bronze.detect_changes(before, after).collect()}
    assert out == {"a": "REMOVED", "b": "UNCHANGED", "c": "CHANGED", "d": "NEW"}


def test_routing(spark):
    files = ["x/customers_2023.parquet", "accounts_2024.parquet", "y/z/loans_2023.parquet"]
    df = spark.createDataFrame([(f,) for f in files], "f string")
    out = [r[0] for r in df.select(bronze.bronze_table_name(F.col("f"))).collect()]
    assert out == ["crm_customers_2023", "erp_accounts_2024", "erp_loans_2023"]


def test_profile_follows_the_name_rules(spark):
    df = spark.createDataFrame(
        [(1.5, "x" * 100, "", 1, True, dt.date(2020, 1, 1), 2.5, 7, "k" * 5000, None, dt.datetime(2020, 1, 1))],
        "negative_balance_rate double, full_text string, empty_text string, number_of_staff int, is_open boolean, "
        "birth_date date, annual_turnover double, score int, huge_text string, home_address string, seen_time timestamp",
    )
    out = {r["column"]: r["target_type"] for r in bronze.profile_types(df).collect()}
    assert out == {
        "negative_balance_rate": "DECIMAL(15,2)",
        "full_text": "NVARCHAR(120)",
        "empty_text": "NVARCHAR(500)",
        "number_of_staff": "INTEGER",
        "is_open": "BIT",
        "birth_date": "DATE",
        "annual_turnover": "NVARCHAR(50)",
        "score": "BIGINT",
        "huge_text": "NVARCHAR(4000)",
        "home_address": "TEXT",
        "seen_time": "DATETIME",
    }


def test_profile_of_metadata_and_short_text(spark):
    df = spark.createDataFrame([("u", "h", "ab")], "_source_file_url string, _source_hash string, label string")
    out = {r["column"]: (r["max_len"], r["target_type"]) for r in bronze.profile_types(df).collect()}
    assert out == {
        "_source_file_url": (1, "NVARCHAR(1000)"),
        "_source_hash": (1, "NVARCHAR(32)"),
        "label": (2, "NVARCHAR(50)"),
    }


def test_preprocess(spark):
    df = spark.sql(
        "select true as flag, timestamp '2020-01-01 10:00:00' as at, '2020-02-30' as bad_date, "
        "'2020-02-28 11:00:00' as good_time, 'date' as label"
    )
    out = bronze.preprocess(df)
    assert dict(out.dtypes) == {
        "flag": "bigint",
        "at": "timestamp_ntz",
        "bad_date": "timestamp_ntz",
        "good_time": "timestamp_ntz",
        "label": "string",
    }
    assert tuple(out.first()) == (1, dt.datetime(2020, 1, 1, 10), None, dt.datetime(2020, 2, 28, 11), "date")


def test_read_and_summarise_files(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for year, n in ((2023, 3), (2024, 5)):
        lake.write(spark.range(n).coalesce(1), "bronze", f"customers_{year}")
    df = bronze.read_bronze(spark, [lake.path("bronze", f"customers_{y}") for y in (2023, 2024)])
    out = bronze.ingest_summary(df)
    assert sorted((r["rows"], r["columns"]) for r in out.collect()) == [(3, 1), (5, 1)]


def test_full_load_replaces(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(10), "silver", "t")
    assert lake.write(spark.range(4).withColumn("p", F.col("id") % 2), "silver", "t", ["p"]).count() == 4
