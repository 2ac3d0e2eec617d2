"""Queries of the package against DuckDB, and the tasks that read archives and shards back."""

import re

import pytest
from compare import connect, differences

from ledgermill.llm import token_store, warc
from ledgermill.llm.queries import ORACLES, QUERIES, tokenizer_path


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, folder):
    path = f"/root/testdata/{folder}"
    assert differences(QUERIES[name](spark, path), connect(path), ORACLES[name]) == ""


def test_every_archive_is_read_by_a_task_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    archives = warc.write_archives(spark, pages)
    assert archives.count() > 4
    assert warc.read_headers(archives).rdd.getNumPartitions() == archives.count()


def test_shards_are_read_by_as_many_tasks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one shard
    try:
        store = token_store.write_store(spark, docs, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert store.shards.count() > 4
    places = store.entries.select("doc_id", "file", "start", "n_tokens")
    read = store.read(places)
    plan = read._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(file#\d+, (\d+)\), REPARTITION_BY_NUM", plan)
    assert dealt == [str(store.shards.count())], plan
    assert read.count() == docs.count()
