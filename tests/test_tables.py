"""Sessions and files of a lake, and rows of transactions read without detours."""

import datetime as dt
import os
import time
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.functions.dates import moment, time_text
from ledgermill.operators.keys import add_surrogate_key
from ledgermill.operators.transactions import with_amount
from ledgermill.session import TUNED, scratch, shared_folder, tune
from ledgermill.sources.layers import Lake


def files(folder, ending):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(ending)]


def test_sessions_are_tuned_unless_told_otherwise(spark, tmp_path):
    before = {name: spark.conf.get(name, default) for name, (default, _) in TUNED.items()}
    method = next(iter(TUNED))
    try:
        spark.conf.set(method, "1234")
        tune(spark)
        assert spark.conf.get(method) == "1234"  # a limit that was given
        for name in TUNED:
            spark.conf.unset(name)
        Lake(spark, str(tmp_path))
        assert all(spark.conf.get(name) == value != default for name, (default, value) in TUNED.items())
        wide = spark.range(3).select(*(F.concat(F.lit(f"{k}-"), F.upper(F.col("id").cast("string"))).alias(f"c{k}") for k in range(200)))
        assert [r.c199 for r in wide.collect()] == ["199-0", "199-1", "199-2"]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_shuffle_files_go_with_their_execution(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    blocks = os.path.join(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    known = set(files(blocks, ".data"))
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("k")).repartition(5, "id").groupBy("k").agg(F.sum("id").alias("s"))
    assert lake.write(rows, "silver", "sums").count() == 7
    assert rows.count() == 7  # an execution of its own
    for _ in range(100):  # files are removed in the background
        left = set(files(blocks, ".data")) - known
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_tables_are_written_small(spark, tmp_path):
    rows = spark.range(100).select(F.concat(F.lit("TXN"), "id").alias("t"))
    Lake(spark, str(tmp_path)).write(rows, "silver", "told")
    assert files(tmp_path / "silver", ".zstd.parquet") and not files(tmp_path / "silver", ".snappy.parquet")
    with scratch(spark):
        place = os.path.join(shared_folder(spark), "tables")
        known = set(files(place, ".parquet"))
        keyed = add_surrogate_key(rows, "small_key")
        assert all(f.endswith(".zstd.parquet") for f in set(files(place, ".parquet")) - known)
        assert sorted(r.small_key for r in keyed.collect()) == list(range(1, 101))


def test_numbers_are_amounts_without_being_spelled_out(spark):
    given = [1.5, -0.0, 0.0, float("nan"), float("inf"), None, -3.0, 1e-300]
    numbers = spark.createDataFrame([(k, v) for k, v in enumerate(given)], "k int, amount double")
    texts = numbers.withColumn("amount", F.col("amount").cast("string"))
    kept = [sorted(r.k for r in with_amount(df).collect()) for df in (numbers, texts)]
    assert kept[0] == kept[1] == [0, 3, 4, 6, 7]
    decimals = spark.createDataFrame([(Decimal("0.00"),), (Decimal("0.01"),), (None,)], "amount decimal(15,2)")
    plan = with_amount(decimals)._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan and with_amount(decimals).count() == 1


def test_times_of_day_stay_as_they_are(spark):
    texts = ["05:12:00", " 23:59:59 ", "24:00:00", "5:12", "05:12:60", "2024-01-02 03:04:05", "", None, "05:12:00\n", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = rows.select(time_text(F.col("t")).alias("a"), F.date_format(moment(F.col("t")), "HH:mm:ss").alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]
    assert [r.a for r in both][:3] == ["05:12:00", "23:59:59", None]
    stamped = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    assert stamped.select(time_text(F.col("t"))).first()[0] == "03:04:05"
