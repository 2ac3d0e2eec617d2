"""Plans whose tasks must not collect wide rows."""

import datetime as dt

from pyspark.sql import functions as F

from ledgermill.contract.layers import Layers
from ledgermill.operators import quality, star_accounts, star_customers
from ledgermill.operators.transactions import FACT_COLUMNS, build_fact_transactions
from ledgermill.plans import bitmaps
from ledgermill.sources.schemas import TRANSACTIONS, columns

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_rows_are_dealt_before_their_columns_are_derived(spark, tmp_path):
    day = dt.datetime(1997, 1, 2)
    rows = [(k, 2 * k, k % 7, 1, 2.0, 10.5, "A", "O", day) for k in range(40)] + [(0, 0, 0, 1, 2.0, 10.5, "A", "O", day), (None,) * 9]
    spark.createDataFrame(rows, LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    frame = Layers(spark, str(tmp_path)).build("bronze_transactions")
    plan = plan_of(frame)
    assert "RoundRobinPartitioning" not in plan  # it would sort the rows of every task
    exchange = plan.splitlines().index(next(line for line in plan.splitlines() if "Exchange" in line))
    derived = [k for k, line in enumerate(plan.splitlines()) if "txn" in line]
    assert derived and max(derived) < exchange
    assert frame.columns == list(columns(TRANSACTIONS))
    assert frame.count() == len(rows)
    assert frame.where("transaction_id = ' txn0-1'").count() == 2
    assert frame.where("transaction_id is null").count() == 1


def test_copies_of_facts_are_found_after_the_shuffle(spark):
    """No task collects the wide rows of its input split; rows without any value and copies come once."""
    rows = spark.range(60).select(
        *(F.when(F.col("id") > 9, F.concat(F.lit(f"{c}-"), F.col("id") % 20)).alias(c) for c in FACT_COLUMNS)
    )
    facts = build_fact_transactions(rows)
    plan = plan_of(facts).splitlines()
    exchange = next(k for k, line in enumerate(plan) if "Exchange" in line)
    assert not any("HashAggregate" in line for line in plan[exchange:])
    assert facts.columns == FACT_COLUMNS
    assert sorted(r.transaction_id or "" for r in facts.collect()) == sorted(["", *(f"transaction_id-{k}" for k in range(20))])


def below_exchange(df):
    plan = plan_of(df).splitlines()
    return plan[next(k for k, line in enumerate(plan) if "Exchange" in line) :]


def test_copies_of_account_and_customer_rows_are_found_after_the_shuffle(spark):
    status = "account_id account_status account_opening_date account_approval_date account_status_change_date "
    status += "account_closing_date account_status_change_reason"
    risks = "customer_id is_pep pep_type is_sanctioned_country is_director is_supervised_aml_cft risk_score"
    for names, build in ((status, star_accounts.build_dim_account_status), (risks, star_customers.build_dim_customer_risks)):
        given = F.when(F.col("id") > 9, F.col("id") % 20).cast("string")
        stg = spark.range(40).select(*(given.alias(c) for c in names.split()))
        rows = build(stg)
        assert not any("HashAggregate" in line for line in below_exchange(rows))
        assert sorted(r[0] or "" for r in rows.collect()) == sorted(["", *map(str, range(20))])


def test_bitmaps_are_built_where_all_numbers_of_one_meet(spark):
    rows = spark.range(200).selectExpr("case when id % 7 > 0 then id % 90 * 1000 end as n", "id % 2 = 0 as g")
    bits = bitmaps.bitmaps(rows, "n", ["g"])
    assert not any("bitmap_construct_agg" in line for line in below_exchange(bits))
    expected = {r.g: r.c for r in rows.groupBy("g").agg(F.countDistinct("n").alias("c")).collect()}
    assert {r.g: r.c for r in bitmaps.counted(bits, ["g"], "c").collect()} == expected


def test_details_are_spelled_out_for_broken_rows_only(spark):
    rows = spark.createDataFrame([("a", None, "X"), ("b", "1", "Y"), (None, "1", None), ("c", None, "Z")], "k string, v string, d string")
    found = quality.check_not_null(rows, "t", "k", ["k", "v"])
    plan = plan_of(found).splitlines()
    generate = next(k for k, line in enumerate(plan) if "Generate" in line)
    assert any("Filter" in line for line in plan[generate:])
    assert sorted((r.key or "", r.detail) for r in found.collect()) == [("", "k"), ("a", "v"), ("c", "v")]
    outside = quality.check_domain(rows, "t", "k", {"d": ["X", "Y"]})
    assert [tuple(r) for r in outside.collect()] == [("DOMAIN", "t", "c", "d=Z")]
