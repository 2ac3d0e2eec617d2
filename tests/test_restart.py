"""A run that died goes on after the steps it has finished."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgermill.contract.inputs import banking_frame
from ledgermill.operators.audit import QUALITY_TABLE, logged, run_log
from ledgermill.plans import runs
from ledgermill.plans.journal import Journal, inputs_digest
from ledgermill.sources.layers import Lake

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def bronze(spark, tmp_path):
    frames = []
    for name in ("fx_customers", "fx_accounts", "fx_transactions"):
        place = str(tmp_path / "landing" / name)
        banking_frame(spark, SMALL, name).write.parquet(place)
        frames.append(spark.read.parquet(place))
    return frames


def told(lake, batch):
    return Counter((r.procedure_name, r.status) for r in run_log(lake).where(F.col("batch_id") == batch).collect())


def rows_of(lake, table):
    return sorted(map(str, lake.read("silver", table).collect()))


def test_a_whole_run_goes_on_after_a_failure(spark, tmp_path, bronze, monkeypatch):
    lake, (customers, accounts, transactions) = Lake(spark, str(tmp_path / "lake")), bronze
    whole = runs.build_fact_accounts

    def dies(*_):
        raise RuntimeError("executors are gone")

    monkeypatch.setattr(runs, "build_fact_accounts", dies)
    with pytest.raises(RuntimeError, match="executors are gone"):
        runs.run_all(lake, [customers], [accounts], [transactions], batch_id="b", restartable=True)
    assert lake.entry("silver", "fact_customers") and not lake.entry("silver", "dim_account_type")
    before = {t: rows_of(lake, t) for t in ("fact_customers", "dim_addresses")}
    monkeypatch.setattr(runs, "build_fact_accounts", whole)
    tables = runs.run_all(lake, [customers], [accounts], [transactions], batch_id="b", restartable=True)
    assert set(tables) == set(runs.SURROGATE_KEYS) and all(df.count() for df in tables.values())
    log = told(lake, "b")
    # every table was written once; loads of customers were not even looked at
    assert all(log[(f"load_{t}", "SUCCESS")] == 1 for t in tables)
    assert log[("run_customers", "REUSED")] == 1 and log[("clean_customers", "REUSED")] == 0
    assert log[("clean_accounts", "REUSED")] == 1 and log[("load_dim_account_status", "REUSED")] == 1
    assert log[("load_fact_accounts", "FAILED")] == 1 and log[("load_fact_accounts", "REUSED")] == 0
    assert {t: rows_of(lake, t) for t in before} == before
    quality = logged(lake, QUALITY_TABLE, "b")
    assert quality.count() == quality.select("flag").distinct().count()

    # the run is over: all of it is taken over, and no version is left that no manifest names
    again = runs.run_all(lake, [customers], [accounts], [transactions], batch_id="b", restartable=True)
    assert told(lake, "b")[("run_transactions", "REUSED")] == 1 and set(again) == set(tables)
    named = {e["path"] for e in lake.manifest()[1].values()}
    assert {f"silver/{p.name}" for p in (tmp_path / "lake" / "silver").iterdir()} <= named


def test_changed_inputs_are_loaded_again(spark, tmp_path, bronze, monkeypatch):
    lake, customers = Lake(spark, str(tmp_path / "lake")), bronze[0]

    def rejects(*_):
        raise RuntimeError("not yet")

    monkeypatch.setattr(runs, "inspect_load", rejects)
    with pytest.raises(RuntimeError):
        runs.run_customers(lake, [customers], "b", restartable=True)
    left = Journal(lake, "b").paths()
    assert len(left) == 12 and not lake.manifest()[1]
    monkeypatch.undo()
    fewer = customers.where("customer_type = 'company'")
    tables = runs.run_customers(lake, [fewer], "b", restartable=True)
    assert tables["fact_customers"].count() == fewer.count()
    assert not [s for (_, s) in told(lake, "b") if s == "REUSED"]
    # what the first trial had written is gone
    assert not any(lake.exists(f"{lake.root}/{path}") for path in left)


def test_a_run_does_not_go_on_over_later_loads(spark, tmp_path, bronze):
    lake, customers = Lake(spark, str(tmp_path / "lake")), bronze[0]
    runs.run_customers(lake, [customers], "old", restartable=True)
    runs.run_customers(lake, [customers.where("customer_type = 'company'")], "new")
    now = lake.manifest()
    with pytest.raises(runs.RunReplaced, match="old"):
        runs.run_customers(lake, [customers], "old", restartable=True)
    assert lake.manifest() == now


def test_a_run_that_is_given_up_leaves_nothing(spark, tmp_path, bronze, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))

    def dies(*_):
        raise RuntimeError("stop")

    monkeypatch.setattr(runs, "inspect_load", dies)
    for restartable, left in ((False, 0), (True, 12)):
        with pytest.raises(RuntimeError):
            runs.run_customers(lake, [bronze[0]], "b", restartable=restartable)
        assert len(lake.names(f"{lake.root}/silver")) + len(lake.names(f"{lake.root}/staging")) == left
    Journal(lake, "b").forget()
    assert not lake.names(f"{lake.root}/silver") and not lake.names(f"{lake.root}/staging")


def test_digest_of_inputs(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    place = str(tmp_path / "x")
    spark.range(5).coalesce(1).write.parquet(place)
    read = lambda: spark.read.parquet(place)
    first = inputs_digest(lake, [read()])
    assert first == inputs_digest(lake, [read()]) and first != inputs_digest(lake, [read()], ["other"])
    assert inputs_digest(lake, [read().where("id > 1")]) not in (first, inputs_digest(lake, [read().where("id > 2")]))
    spark.range(6).coalesce(1).write.mode("overwrite").parquet(place)
    assert inputs_digest(lake, [read()]) != first
    # rows that come from the program
    assert inputs_digest(lake, [spark.range(3)]) is None
    assert inputs_digest(lake, [read().union(spark.createDataFrame([(1,)], "id long"))]) is None


def test_half_an_entry_counts_as_none(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    journal = Journal(lake, "b")
    journal.note("step", "f" * 64, paths=[], rows=1)
    assert journal.find("step", "f" * 64)["rows"] == 1 and journal.find("step", None) is None
    place = journal._place("step", "f" * 64)
    text = lake.get(place)
    lake.remove(place)
    lake.put(place, text[:20])
    assert journal.find("step", "f" * 64) is None and journal.entries() == []
    journal.note("step", "f" * 64, paths=["silver/gone.v-1"], rows=2)
    assert journal.find("step", "f" * 64) is None and journal.entry("step", "f" * 64)["rows"] == 2
