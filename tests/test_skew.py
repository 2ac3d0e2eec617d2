from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.operators import skew
from ledgermill.operators.skew import hot_keys, key_counts, row_tag, spread_join

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))


def brute(left, right, how):
    out = Counter()
    for i, key in left:
        matches = [v for k, v in right if key is not None and k == key]
        for v in matches:
            out[(i, key, v)] += 1
        if how == "left" and not matches:
            out[(i, key, None)] += 1
    return out


def joined(spark, left, right, how, slice_rows):
    l_df = row_tag(spark.createDataFrame([*left], "i int, k string").repartition(3))
    r_df = spark.createDataFrame([*right], "rk string, v int")
    out = spread_join(l_df, r_df, "k", "rk", how, slice_rows=slice_rows).select("i", "k", "v")
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("slice_rows", [1, 3, 1000])
def test_spread_join_equals_plain_join(spark, how, slice_rows):
    left = [(i, "hot") for i in range(40)] + [(100 + i, None) for i in range(20)] + [(200, "x"), (201, "y")]
    right = [("hot", 1), ("hot", 2), ("x", 3), (None, 4), ("z", 5)]
    assert joined(spark, left, right, how, slice_rows) == brute(left, right, how)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(KEYS, min_size=1, max_size=25),
    right=st.lists(st.tuples(KEYS, st.integers(0, 3)), min_size=1, max_size=6),
    how=st.sampled_from(["left", "inner"]),
)
def test_spread_join_on_random_rows(spark, left, right, how):
    rows = list(enumerate(left))
    assert joined(spark, rows, right, how, 2) == brute(rows, right, how)


def test_many_large_keys_are_all_cut(spark, monkeypatch):
    """More large keys than the list may hold: slices grow, every key is still joined whole."""
    monkeypatch.setattr(skew, "SLICED_KEYS", 3)
    left = [(10 * k + i, f"k{k}") for k in range(8) for i in range(5)] + [(900 + i, "k0") for i in range(60)]
    right = [(f"k{k}", k) for k in range(8)]
    assert joined(spark, left, right, "left", 1) == brute(left, right, "left")


def test_given_counts_are_used(spark):
    left = row_tag(spark.createDataFrame([(i, "ab"[i % 3 == 0]) for i in range(30)], "i int, k string"))
    counts = key_counts(left, F.col("k"))
    right = counts.withColumnsRenamed({"key": "rk", "rows": "n"})
    out = spread_join(left, right, "k", "rk", counts=counts, slice_rows=2)
    assert {(r.k, r.n) for r in out.collect()} == {("a", 20), ("b", 10)} and out.count() == 30


def test_hot_keys_are_complete_and_bounded(spark, monkeypatch):
    counts = spark.createDataFrame([("a", 10), ("b", 30), ("c", 20), ("d", 1), (None, 99)], "key string, rows long")
    assert {tuple(r) for r in hot_keys(counts, 5).collect()} == {("a", 2), ("b", 6), ("c", 4)}
    monkeypatch.setattr(skew, "SLICED_KEYS", 4)  # a quarter of 160 rows
    assert {r._hot_key for r in hot_keys(counts, 5).collect()} == set()


def test_building_the_join_runs_nothing(spark):
    left = row_tag(spark.range(50).select((F.col("id") % 3).cast("string").alias("k")))
    spark.sparkContext.setJobGroup("plan-only", "no job may start")
    try:
        spread_join(left, left.select(F.col("k").alias("rk")).distinct(), "k", "rk", slice_rows=2)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_rows_land_in_many_partitions(spark):
    """A third of the rows on one key, a third without key: no partition takes most of them."""
    rows = 3000
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    left = row_tag(spark.range(rows).select("id", key.alias("k")))
    right = left.where(F.col("k").isNotNull()).select(F.col("k").alias("rk")).distinct().withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = spread_join(left, right, "k", "rk", slice_rows=20)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == rows and max(sizes) < rows / 4


def test_unknown_join_type(spark):
    df = row_tag(spark.range(1).withColumn("k", F.lit("a")))
    with pytest.raises(ValueError):
        spread_join(df, df, "k", "k", how="full")
