import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgermill.contract.inputs import banking_frame
from ledgermill.functions.fixed_values import REQUIRED
from ledgermill.operators.audit import audited, logged, run_log
from ledgermill.operators.keys import add_surrogate_key
from ledgermill.plans.checks import check_silver
from ledgermill.plans.ingest import run_ingest
from ledgermill.plans.runs import SURROGATE_KEYS, LoadRejected, run_all, run_customers
from ledgermill.session import scratch, shared_folder, written
from ledgermill.sources.layers import Lake
from ledgermill.sources.schemas import TRANSACTIONS

SMALL = "/root/testdata/sf0.001"


def test_whole_run_writes_every_table_and_logs_it(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    frames = {n: banking_frame(spark, SMALL, n) for n in ("fx_customers", "fx_accounts", "fx_transactions")}
    even = frames["fx_customers"].where("company_age is null")
    rest = frames["fx_customers"].where("company_age is not null")
    tables = run_all(lake, [even, rest], [frames["fx_accounts"]], [frames["fx_transactions"]])
    assert set(tables) == set(REQUIRED) == set(SURROGATE_KEYS) and len(tables) == 21
    sizes = {name: df.count() for name, df in tables.items()}
    assert all(sizes.values())
    for name, key in SURROGATE_KEYS.items():
        keys = sorted(r[0] for r in lake.read("silver", name).select(key).collect())
        assert keys == list(range(1, sizes[name] + 1)), name
    assert tables["dim_contacts"].first().is_opted_in_marketing == 0

    lake.publish("silver", list(tables))
    sql = "select count(*) from silver.fact_accounts a join silver.dim_account_type t using (account_type_id)"
    assert spark.sql(sql).first()[0] == sizes["fact_accounts"]

    found = check_silver({name: lake.read("silver", name) for name in tables})
    rules = {(r.rule, r.table_name) for r in found.select("rule", "table_name").distinct().collect()}
    assert ("UNIQUE", "dim_account_card_details") in rules and ("NOT_NULL", "dim_customer_profile") not in rules
    assert not [t for rule, t in rules if rule in ("REFERENCE", "DOMAIN")]

    entries = run_log(lake).collect()
    assert len({r.batch_id for r in entries}) == 1 and {r.log_date for r in entries}
    assert sorted(r.status for r in entries) == ["STARTED"] * 24 + ["SUCCESS"] * 24
    log = {r.procedure_name: r for r in entries if r.status == "SUCCESS"}
    assert len(log) == 24
    for name, size in sizes.items():
        assert log[f"load_{name}"].rows_processed == size
    assert log["clean_customers"].rows_processed == frames["fx_customers"].count()


def test_a_failed_step_is_logged_and_raised(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))

    def fail(df):
        raise RuntimeError("disk is gone")

    with pytest.raises(RuntimeError):
        audited(lake, "load_x", lambda: spark.range(3), fail)
    rows = {r.status: r for r in run_log(lake).collect()}
    row = rows["FAILED"]
    assert (row.error_message, row.rows_processed) == ("disk is gone", 0) and row.end_time >= row.start_time
    assert rows["STARTED"].batch_id == row.batch_id and rows["STARTED"].end_time is None


def test_intermediate_tables_are_gone_after_a_step(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    written(spark.range(1), "first")
    folder = os.path.join(shared_folder(spark), "tables", spark.sparkContext.applicationId)
    before = set(os.listdir(folder))
    numbered = audited(lake, "load_x", lambda: add_surrogate_key(spark.range(5), "k"), lambda df: lake.write(df, "silver", "x"))
    assert sorted(r.k for r in numbered.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(RuntimeError), scratch(spark):
        written(spark.range(3), "t")
        raise RuntimeError
    assert set(os.listdir(folder)) == before


def test_an_empty_table_is_logged_with_no_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    empty = spark.createDataFrame([], "a int").where("a > 1")
    assert audited(lake, "load_x", lambda: empty, lambda df: lake.write(df, "silver", "x")).count() == 0
    rows = {r.status: r.rows_processed for r in run_log(lake).collect()}
    assert rows == {"STARTED": None, "SUCCESS": 0}


def test_a_failed_load_leaves_the_table_as_it_was(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.write(spark.range(3), "silver", "x").count() == 3
    broken = spark.range(3).selectExpr("raise_error('broken row') as id")
    with pytest.raises(Exception, match="broken row"):
        lake.write(broken, "silver", "x")
    assert lake.read("silver", "x").count() == 3
    assert lake.write(spark.range(5), "silver", "x").count() == 5
    assert not [p.name for p in (tmp_path / "silver").iterdir() if ".old-" in p.name]


def test_extracts_become_bronze_tables(spark, tmp_path):
    landing = tmp_path / "landing"
    spark.range(4).selectExpr("id", "id > 1 as flag").write.parquet(str(landing / "customers_2023.parquet"))
    spark.range(2).write.parquet(str(landing / "loans_2023.parquet"))
    (landing / "broken_2023.parquet").write_text("this is no parquet file")
    lake = Lake(spark, str(tmp_path / "lake"))
    paths = [str(landing / f"{n}_2023.parquet") for n in ("customers", "loans", "broken", "missing")]
    out = {r.table_name: r for r in run_ingest(lake, paths).collect()}
    assert {n: (r.status, r["rows"], r["columns"]) for n, r in out.items()} == {
        "crm_customers_2023": ("LOADED", 4, 2),
        "erp_loans_2023": ("LOADED", 2, 1),
        "erp_broken_2023": ("FAILED", None, None),
        "erp_missing_2023": ("FAILED", None, None),
    }
    assert out["erp_missing_2023"].error
    loaded = lake.read("bronze", "crm_customers_2023")
    assert dict(loaded.dtypes)["flag"] == "bigint"
    row = loaded.select("_source_file_url", "_source_hash").distinct().collect()
    assert len(row) == 1 and row[0]._source_file_url == paths[0] and len(row[0]._source_hash) == 32


def test_text_lost_on_ingest_is_rescued(spark, tmp_path):
    from ledgermill.operators.quality import rescued_values

    lake = Lake(spark, str(tmp_path / "lake"))
    path = str(tmp_path / "transactions_2023.parquet")
    rows = [(" t1", "31/12/1997", "10:15", "5.00", "x"), ("t2", "2023-02-01", None, "many", None), ("t3", "", " ", None, None)]
    spark.createDataFrame(
        rows, "transaction_id string, transaction_date string, transaction_time string, amount string, loyalty_points string"
    ).write.parquet(path)
    assert run_ingest(lake, [path]).first()["columns"] == 5
    bronze = lake.read("bronze", "erp_transactions_2023")
    found = rescued_values(bronze, "transactions", "transaction_id", TRANSACTIONS, "_source_file_url").collect()
    assert {tuple(r)[2:] for r in found} == {
        (" t1", "transaction_date", "31/12/1997"),
        (" t1", "loyalty_points", "x"),
        ("t2", "amount", "many"),
    }
    assert {(r.table_name, r.source) for r in found} == {("transactions", path)}
    typed = bronze.select("transaction_id").withColumn("amount", F.lit(1).cast("decimal(15,2)"))
    assert rescued_values(typed, "transactions", "transaction_id", TRANSACTIONS).count() == 0


def test_a_load_is_seen_whole_or_not_at_all(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with lake.load() as load:
        load.write(spark.range(3), "silver", "a")
        load.write(spark.range(3), "silver", "b")
        assert lake.manifest() == (0, {})
    old = lake.read("silver", "a")
    with pytest.raises(RuntimeError), lake.load() as load:
        assert load.write(spark.range(5), "silver", "a").count() == 5
        load.drop("silver", "b")
        raise RuntimeError
    assert [lake.read("silver", t).count() for t in "ab"] == [3, 3] and lake.manifest()[0] == 1
    lake.write(lake.read("silver", "a").union(spark.range(1)), "silver", "a")
    assert (old.count(), lake.read("silver", "a").count()) == (3, 4)  # the version before stays readable
    lake.write(spark.range(9), "silver", "a")
    versions = [p.name for p in (tmp_path / "silver").iterdir()]
    assert sorted(v.split(".v-")[0] for v in versions) == ["a", "a", "b"]


def test_loads_that_commit_at_the_same_time_keep_each_others_tables(spark, tmp_path):
    lakes = [Lake(spark, str(tmp_path)) for _ in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: lakes[k].write(spark.range(k + 1), "bronze", f"t{k}"), range(6)))
    assert [lakes[0].read("bronze", f"t{k}").count() for k in range(6)] == [1, 2, 3, 4, 5, 6]
    assert lakes[0].manifest()[0] == 6


def test_a_manifest_that_is_not_complete_does_not_count(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(2), "silver", "a")
    (tmp_path / "_manifests" / "0000000002").write_text("abc")
    assert lake.manifest()[0] == 1 and lake.read("silver", "a").count() == 2


def test_a_broken_gate_publishes_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    customers = banking_frame(spark, SMALL, "fx_customers").limit(40)
    run_customers(lake, [customers], "first", gates=["UNIQUE:fact_customers", "REFERENCE"])
    before = lake.manifest()
    # the eight companies have no birth date, so their rows are equal and count once
    with pytest.raises(LoadRejected, match="UNIQUE of fact_customers: 32"):
        run_customers(lake, [customers, customers.withColumn("birth_date", F.date_add("birth_date", 400))], "second", gates=["UNIQUE"])
    assert lake.manifest() == before
    report = {(r.rule, r.table_name): (r.violations, r.blocking) for r in logged(lake, "quality_report", "second").collect()}
    assert report["UNIQUE", "fact_customers"] == (32, True)
    assert logged(lake, "violations", "second").where("rule = 'UNIQUE' and table_name = 'fact_customers'").count() == 32


def test_layers_are_fixed(spark, tmp_path):
    with pytest.raises(ValueError):
        Lake(spark, str(tmp_path)).path("copper", "t")


def test_least_type_of_two():
    from ledgermill.sources.registry import merge, wider

    cases = [
        ("BIGINT", "BIGINT", "BIGINT"), ("INTEGER", "BIGINT", "BIGINT"), ("BIT", "INTEGER", "INTEGER"),
        ("DATE", "DATETIME", "DATETIME"), ("DECIMAL(15,2)", "DECIMAL(15,4)", "DECIMAL(17,4)"),
        ("INTEGER", "DECIMAL(15,2)", "DECIMAL(15,2)"), ("BIGINT", "DECIMAL(15,4)", "DECIMAL(23,4)"),
        ("DECIMAL(38,0)", "DECIMAL(15,4)", "NVARCHAR(40)"), ("NVARCHAR(50)", "NVARCHAR(60)", "NVARCHAR(60)"),
        ("NVARCHAR(10)", "BIGINT", "NVARCHAR(20)"), ("DATE", "BIT", "NVARCHAR(10)"), ("TEXT", "DATE", "TEXT"),
    ]
    for one, other, least in cases:
        assert wider(one, other) == wider(other, one) == least
        assert wider(least, one) == wider(least, other) == least
    assert merge([{"a": "BIT", "B": "DATE"}, {}, {"b": "DATETIME", "c": "TEXT"}]) == {"a": "BIT", "B": "DATETIME", "c": "TEXT"}


def test_years_with_other_types_load_into_one_schema(spark, tmp_path):
    from ledgermill.sources.registry import read_entity, type_registry

    lake, landing = Lake(spark, str(tmp_path / "lake")), tmp_path / "landing"
    frames = {
        2021: spark.createDataFrame([(1, 5, "10.50", "x")], "k long, n int, amount string, _rescue_me string"),
        2022: spark.createDataFrame([("k2", 2.25, "much")], "K string, n double, amount string"),
        2023: spark.createDataFrame([], "k long, extra string"),
    }
    paths = []
    for year, df in frames.items():
        paths.append(str(landing / f"loans_{year}.parquet"))
        df.write.parquet(paths[-1])
    paths.append(str(landing / "loans_2024.parquet"))  # never delivered
    first = {r.table_name: r.status for r in run_ingest(lake, paths[:1], only_changed=True, typed=True).collect()}
    assert first == {"erp_loans_2021": "LOADED"} and dict(lake.read("bronze", "erp_loans_2021").dtypes)["k"] == "bigint"
    out = {r.table_name[-4:]: (r.status, r["rows"]) for r in run_ingest(lake, paths, only_changed=True, typed=True).collect()}
    assert out == {"2021": ("SKIPPED", 1), "2022": ("LOADED", 1), "2023": ("LOADED", 0), "2024": ("FAILED", None)}
    types = {r.column: r.target_type for r in type_registry(lake).where("entity = 'erp_loans'").collect()}
    assert types == {
        "k": "NVARCHAR(50)", "n": "DECIMAL(23,4)", "amount": "DECIMAL(15,2)", "_rescue_me": "NVARCHAR(50)", "extra": "NVARCHAR(500)",
    }
    whole = read_entity(lake, "erp_loans")
    rows = {(r.k, str(r.n), str(r.amount), r._rescued and r._rescued["amount"]) for r in whole.collect()}
    assert rows == {("1", "5.0000", "10.50", None), ("k2", "2.2500", "None", "much")}
    written = [dict(lake.read("bronze", f"erp_loans_{y}").dtypes) for y in (2022, 2023)]
    assert written[0] == written[1] and written[0]["k"] == "string" and written[0]["n"] == "decimal(23,4)"


def test_lost_values_are_found_by_compiled_code_and_the_latest_counts(spark, tmp_path):
    from ledgermill.operators.quality import check_domain, rescued_values
    from ledgermill.sources.schemas import rescued

    rows = [
        ("a", "x", "1", {"amount": "old", "note": "n"}),
        ("b", "1.00", "y", None),
        ("c", "2.00", "2", {"amount": "old", "note": None}),
        ("d", "z", "z", {}),
        ("e", None, "", None),
    ]
    frame = spark.createDataFrame(rows, "transaction_id string, amount string, loyalty_points string, _rescued map<string,string>")
    frame.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = rescued_values(df, "t", "transaction_id", TRANSACTIONS)
    assert sorted((r.key, r.column_name, r.value or "-") for r in found.collect()) == [
        ("a", "amount", "x"), ("a", "note", "n"), ("b", "loyalty_points", "y"),
        ("c", "amount", "old"), ("c", "note", "-"), ("d", "amount", "z"), ("d", "loyalty_points", "z"),
    ]
    maps = {r.transaction_id: r.m for r in df.select("transaction_id", rescued(df, TRANSACTIONS).alias("m")).collect()}
    assert maps == {
        "a": {"amount": "x", "note": "n"}, "b": {"loyalty_points": "y"}, "c": {"amount": "old", "note": None},
        "d": {"amount": "z", "loyalty_points": "z"}, "e": None,
    }
    # no function that Spark does not compile
    outside = check_domain(df, "t", "transaction_id", {"amount": ["1.00"]})
    assert sorted((r.key, r.detail) for r in outside.collect()) == [("a", "amount=x"), ("c", "amount=2.00"), ("d", "amount=z")]
    for checked in (found, outside):
        assert "lambda" not in checked._jdf.queryExecution().optimizedPlan().toString()
