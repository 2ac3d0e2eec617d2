"""Registered queries, one or more per operator."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.contract.inputs import table
from ledgermill.contract.layers import Layers
from ledgermill.functions.contact import default_country
from ledgermill.functions.dates import time_text
from ledgermill.functions.fixed_values import DOMAINS
from ledgermill.functions.text import json_fields, norm, yes_flag
from ledgermill.operators import accounts, customers, quality, transactions
from ledgermill.operators.audit import QUALITY_TABLE, audited, logged, run_log
from ledgermill.operators.keys import add_surrogate_key
from ledgermill.operators.skew import row_tag, spread_join
from ledgermill.operators.star_accounts import ACCOUNT_TABLES, build_dim_account_type
from ledgermill.operators.star_customers import CUSTOMER_TABLES
from ledgermill.operators.unions import union_conformed, union_tagged
from ledgermill.plans import bitmaps, checks, metrics, periods, reports
from ledgermill.plans.ingest import run_ingest
from ledgermill.plans.journal import Journal, inputs_digest
from ledgermill.sources.registry import read_entity, type_registry
from ledgermill.plans.runs import (
    ACCOUNT_AUDIT,
    CUSTOMER_AUDIT,
    QUARANTINE,
    REPORT,
    SURROGATE_KEYS,
    LoadRejected,
    inspect_load,
    load_tables,
    run_all,
    run_transactions,
    stage,
)
from ledgermill.session import CODEC, shared_folder
from ledgermill.sources import bronze
from ledgermill.sources.layers import Lake
from ledgermill.sources.schemas import ACCOUNTS, TRANSACTIONS

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2026-01-01"
LOAN_DATE = "2000-06-30"


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, other numbers as DOUBLE, nested columns left out."""

    def column(field: T.StructField):
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.IntegralType):
            return c.cast("long").alias(field.name)
        if isinstance(kind, T.FractionalType):
            return c.cast("double").alias(field.name)
        if isinstance(kind, T.NullType):
            return c.cast("string").alias(field.name)
        return c

    return df.select(
        *(column(f) for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType)))
    )


def _on_layers(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(Layers(spark, sf_dir)))


def _select(df: DataFrame, names: str) -> DataFrame:
    return df.select(*names.split())


# --- bronze -----------------------------------------------------------------------------


def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string")).alias("_source_file_url"),
    )


def _years(orders: DataFrame) -> list[int]:
    """The calendar years there are: one extract each."""
    return [row.year for row in orders.select(F.year("o_orderdate").alias("year")).distinct().orderBy("year").collect()]


def _second_load(orders: DataFrame) -> DataFrame:
    """A later load: 1995 is gone and the prices of 1997 changed."""
    year = F.year("o_orderdate")
    raised = F.when(year == 1997, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders.where(year > 1995).withColumn("o_totalprice", raised.cast("decimal(15,2)"))


def _ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = bronze.add_ingest_metadata(yearly_orders(spark, sf_dir))
    loaded = F.col("_ingestion_timestamp").isNotNull().cast("int").alias("has_timestamp")
    return tagged.select("o_orderkey", "_source_file_url", "_source_hash", loaded)


def _read_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per bronze table of two differently shaped files, each scanned with its origin."""
    scans = [bronze.read_bronze(spark, [f"{sf_dir}/{n}.parquet"]) for n in ("orders", "customer")]
    named = [df.select(bronze.bronze_table_name(F.col("_source_file_url")).alias("table_name")) for df in scans]
    return checks.together([df.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows")) for df in named])


def _full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full loads of one partitioned table; the second replaces the first."""
    lake = _lake(spark)
    orders = yearly_orders(spark, sf_dir).withColumn("year", F.year("o_orderdate"))
    lake.write(orders, "bronze", "erp_orders", ["year"])
    return lake.write(orders.where(F.col("year") > 1996), "bronze", "erp_orders", ["year"]).drop("_source_file_url")


def _ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly extracts as folders of files, loaded as bronze tables."""
    lake, orders = _lake(spark), yearly_orders(spark, sf_dir).drop("_source_file_url")
    landing = []
    for year in _years(orders):
        landing.append(os.path.join(lake.root, "landing", f"orders_{year}.parquet"))
        orders.where(F.year("o_orderdate") == year).write.parquet(landing[-1])
    done = run_ingest(lake, landing)
    return done.select("table_name", "status", "rows", "columns")


def _detect_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = yearly_orders(spark, sf_dir)
    first = bronze.source_hash(orders.where(F.year("o_orderdate") < 2001))
    return bronze.detect_changes(first, bronze.source_hash(_second_load(orders)))


def _route_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    entity = F.when(F.col("o_orderkey") % 3 == 0, "customers").when(F.col("o_orderkey") % 3 == 1, "accounts")
    file = F.concat(
        F.lit("data/"), entity.otherwise("loans"), F.lit("_"), F.year("o_orderdate").cast("string"), F.lit(".parquet")
    )
    files = table(spark, sf_dir, "orders").select(file.alias("file")).distinct()
    return files.withColumn("table_name", bronze.bronze_table_name(F.col("file")))


def _preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("event_type") == "error").alias("is_error"),
        F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("zoned"),
        F.when(F.col("event_id") % 7 == 0, "not a date")
        .otherwise(F.col("ts").cast("date").cast("string"))
        .alias("event_date"),
    )
    done = bronze.preprocess(events)
    return done.select(
        "event_id", "is_error", F.col("zoned").cast("date").alias("zoned"), F.col("event_date").cast("date").alias("event_date")
    )


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(spark, sf_dir)
    frames = {
        "events": layers.source("events"),
        "bronze_accounts": layers["bronze_accounts"],
        "bronze_customers": layers["bronze_customers"],
    }
    profiles = [bronze.profile_types(df).withColumn("table_name", F.lit(n)) for n, df in frames.items()]
    return reduce(DataFrame.unionByName, profiles).withColumnRenamed("column", "column_name")


def _union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = yearly_orders(spark, sf_dir).drop("_source_file_url")
    frames = {f"orders_{y}": orders.where(F.year("o_orderdate") == y) for y in _years(orders)}
    return union_tagged(frames)


def _union_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly account frames; early years lack some columns and deliver others as text."""
    rows = Layers(spark, sf_dir)["bronze_accounts"]
    year = F.year("opening_date")
    early = (
        rows.where(year < 2022)
        .drop("account_tier", "iban")
        .withColumn("expected_amount", F.col("expected_amount").cast("string"))
    )
    late = rows.where(F.coalesce(year >= 2022, F.lit(True)))
    joined = union_conformed([early, late], ACCOUNTS)
    return _select(joined, "account_id customer_id opening_date expected_amount account_tier iban is_primary_account")


# --- customers --------------------------------------------------------------------------


def _customer_op(step: Callable[[DataFrame], DataFrame], names: str) -> Query:
    return _on_layers(lambda t: _select(step(t["bronze_customers"]), f"customer_id {names}"))


def _ages(df: DataFrame) -> DataFrame:
    return df.transform(customers.repair_birth_dates).transform(customers.add_ages)


def _country(df: DataFrame) -> DataFrame:
    split = customers.split_addresses(df)
    country = default_country(F.col("residential_country"), F.col("residential_province"))
    return split.withColumn("residential_country", country)


def _standard_text(df: DataFrame) -> DataFrame:
    """Standard form of the account texts (upper-trimmed) and codes (blanks for underscores)."""
    names = [*accounts.STANDARD_TEXT, *accounts.CODE_TEXT]
    return accounts.standardise(df).select("account_id", *(accounts.RENAMED.get(n, n) for n in names))


ADDRESS_COLUMNS = " ".join(
    f"{p}_{n}" for p in customers.ADDRESSES.values() for n in ("street_name", "city", "province", "country")
)


# --- accounts ---------------------------------------------------------------------------


def _duplicates_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("account_id"),
        F.col("l_suppkey").cast("string").alias("account_number"),
        F.expr("case when l_partkey % 3 > 0 then cast(l_partkey as string) end").alias("card_number"),
        "l_orderkey",
        "l_linenumber",
    )
    return comparable(accounts.add_duplicate_counts(lines).drop("account_id"))


def _date_sequence(t: Layers) -> DataFrame:
    joined = accounts.join_registration(t["bronze_accounts"], t["fact_customers"])
    return _select(
        accounts.flag_date_sequence(joined),
        "account_id customer_registration_date primary_acc_count over_one_primary_acc invalid_date",
    )


def _ship_before_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = spread_join(row_tag(lines), orders, "l_orderkey", "o_orderkey", how="inner")
    checked = accounts.flag_date_sequence(joined, {"o_orderdate": ["l_shipdate"]})
    return comparable(
        checked.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("rows"), F.sum("invalid_date").alias("invalid"))
    )


# --- quality ----------------------------------------------------------------------------


def _dq_domain(t: Layers) -> DataFrame:
    raw = {k: DOMAINS["fact_customers"][k] for k in ("customer_type", "gender")}
    unclean = quality.check_domain(t["bronze_customers"], "bronze_customers", "customer_id", raw)
    return checks.together([*checks.domain(t), unclean])


def _dq_fk(t: Layers) -> DataFrame:
    owners = t["bronze_accounts"].withColumn("customer_id", norm(F.col("customer_id")))
    unknown = quality.check_reference(
        owners, "bronze_accounts", "customer_id", t["fact_customers"], "customer_id"
    )
    return checks.together([*checks.reference(t), unknown])


def _text_transactions(t: Layers) -> DataFrame:
    """Transactions as some sources deliver them: everything as text, some of it out of range."""
    rows = t["bronze_transactions"]
    tail = F.substring(F.col("transaction_id"), -1, 1)
    return rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns)).withColumns(
        {
            "transaction_fee": F.when(tail == "7", "1500.00").otherwise(F.col("transaction_fee")),
            "amount": F.when((tail == "6") & (F.col("amount").cast("double") != 0), "99999999999999.00")
            .when(tail == "5", "")
            .otherwise(F.col("amount")),
            "transaction_date": F.when(tail == "4", "31/12/1997").otherwise(F.col("transaction_date")),
        }
    )


def _dq_cast_loss(t: Layers) -> DataFrame:
    """Values lost to a cast, and for each transaction that stays what became of its amount."""
    delivered = _text_transactions(t)
    lost = quality.check_casts(delivered, "bronze_transactions", "transaction_id", TRANSACTIONS)
    staged = transactions.clean_transactions(delivered, t["fact_accounts"])
    facts = transactions.build_fact_transactions(staged)
    kept = facts.groupBy(
        F.lit("KEPT").alias("rule"),
        F.lit("fact_transactions").alias("table_name"),
        F.col("transaction_id").alias("key"),
        F.when(F.col("transaction_amount").isNull(), "no amount").otherwise("amount").alias("detail"),
    ).count()
    return lost.unionByName(kept.drop("count"))


def _ingest_to_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction files to bronze tables to facts; the time of day is that of the files."""
    t, lake = Layers(spark, sf_dir), _lake(spark)
    rows = t["bronze_transactions"]
    names = ["erp_transactions_early", "erp_transactions_late"]
    # one extract delivers a time, the other a full timestamp
    full = F.concat(F.col("transaction_date").cast("string"), F.lit(" "), F.col("transaction_time"))
    early = F.col("transaction_date") < "1997-01-01"
    frames = [rows.where(early), rows.where(~early).withColumn("transaction_time", full)]
    landing = [os.path.join(lake.root, "landing", f"{n.removeprefix('erp_')}.parquet") for n in names]
    for frame, path in zip(frames, landing):
        frame.write.parquet(path, compression=CODEC)
    run_ingest(lake, landing)
    tables = run_transactions(lake, [lake.read("bronze", n) for n in names], t["fact_accounts"])
    return _select(
        tables["fact_transactions"], "transaction_id transaction_date transaction_time transaction_amount transaction_fee"
    )


def _new_account_types(t: Layers) -> DataFrame:
    """A second load meets types it knows, which keep their numbers, and new ones."""
    stg = t["stg_accounts"]
    known = build_dim_account_type(stg.where(F.col("account_type") > "D"))
    return known.unionByName(build_dim_account_type(stg, known))


def _skewed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of order lines where one key holds a third of all rows and a third has none."""
    third = F.col("l_orderkey") % 3
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(third == 0, F.lit(1)).when(third == 1, F.col("l_suppkey")).alias("supplier")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return spread_join(row_tag(lines), suppliers, "supplier", "s_suppkey", slice_rows=100).drop("_row")


def _two_current(t: Layers) -> DataFrame:
    """Addresses where every tenth customer kept an old one that was not closed."""
    rows = t["dim_addresses"]
    left_open = rows.where(F.col("customer_id").endswith("0")).withColumn("street_name", F.lit("OLD ROAD"))
    return rows.unionByName(left_open)


def _dq_limits(t: Layers) -> DataFrame:
    tight = quality.check_limits(
        t["fact_customers"], "tight_customers", "customer_id", {"age_group": 10}, {"fixed_age_at_opening": (2, 0)}
    )
    return checks.together([*checks.limits(t), tight])


# --- keys, log and whole runs -----------------------------------------------------------


def _surrogate_keys(t: Layers) -> DataFrame:
    return add_surrogate_key(t["fact_accounts"].select("account_id"), "account_key", ["account_id"])


def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, os.path.join(shared_folder(spark), f"lake-{uuid.uuid4().hex}"))


def _etl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    step = Layers(spark, sf_dir)
    batch = uuid.uuid4().hex

    def store(df: DataFrame) -> DataFrame:
        return lake.write(df, "staging", "customers")

    audited(lake, "clean_customers", lambda: step.build("stg_customers"), store, batch)
    unreadable = F.raise_error(F.lit("unreadable extract")).cast("string")
    try:
        audited(lake, "clean_broken", lambda: step["bronze_customers"].select(unreadable.alias("c")), store, batch)
    except Exception:  # noqa: BLE001 - the log is the result
        pass
    log = run_log(lake)
    told = F.when(F.col("error_message").contains("unreadable extract"), "unreadable extract")
    return log.groupBy("procedure_name", "status", "rows_processed", told.alias("error_message")).agg(
        F.countDistinct("batch_id").alias("batches"),
        F.count("log_date").alias("dated"),
        F.count("end_time").alias("ended"),
    )


# (application, test folder) -> lake, silver tables and batch of one whole run
_runs: dict[tuple[str, str], tuple[Lake, dict[str, DataFrame], str]] = {}


def _whole_run(spark: SparkSession, sf_dir: str) -> tuple[Lake, dict[str, DataFrame], str]:
    """One run over the bronze tables, shared by the queries that look at its results."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _runs:
        t, lake, batch = Layers(spark, sf_dir), _lake(spark), uuid.uuid4().hex
        frames = ([t[f"bronze_{n}"]] for n in ("customers", "accounts", "transactions"))
        _runs[key] = lake, run_all(lake, *frames, batch_id=batch), batch
    return _runs[key]


def _run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables, _ = _whole_run(spark, sf_dir)
    counted = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(SURROGATE_KEYS[n]).alias("first_key"),
            F.max(SURROGATE_KEYS[n]).alias("last_key"),
        ).withColumn("table_name", F.lit(n))
        for n, df in tables.items()
    ]
    return comparable(checks.together(counted))


def _digest(df: DataFrame, left_out: str) -> DataFrame:
    """Rows and a sum of row digests over all columns but one key and the timestamps, in any order of rows."""

    def cell(field: T.StructField):
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.FractionalType):
            c = c.cast("decimal(24,6)")
        return F.coalesce(c.cast("string"), F.lit("~"))

    untimed = [f for f in df.schema.fields if not isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    cells = [cell(f) for f in sorted(untimed, key=lambda f: f.name) if f.name != left_out]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("digest"))


def _run_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the 21 tables of a run hold, apart from surrogate keys and load times."""
    _, tables, _ = _whole_run(spark, sf_dir)
    found = [_digest(df, SURROGATE_KEYS[n]).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    return checks.together(found)


def _load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load times of every table of a run, and whether the log's seconds are those between its two times."""
    lake, tables, batch = _whole_run(spark, sf_dir)
    stamped = []
    for name, df in tables.items():
        created, updated = ACCOUNT_AUDIT if ACCOUNT_AUDIT[0] in df.columns else CUSTOMER_AUDIT
        stamped.append(
            df.agg(
                F.count(created).alias("dated"),
                F.countDistinct(created).alias("times"),
                F.count(F.when(F.col(created) == F.col(updated), 1)).alias("unchanged"),
            ).withColumn("procedure_name", F.lit(f"load_{name}"))
        )
    log = run_log(lake).where((F.col("batch_id") == batch) & (F.col("status") == "SUCCESS"))
    between = F.floor((F.unix_micros("end_time") - F.unix_micros("start_time")) / 1_000_000)
    right = (F.col("duration_seconds") >= 0) & (F.col("duration_seconds") == between)
    return checks.together(stamped).join(log.select("procedure_name", right.alias("_right")), "procedure_name").select(
        "procedure_name", "dated", "times", "unchanged", F.col("_right").cast("long").alias("seconds_right")
    )


def _customer_lists(t: Layers) -> DataFrame:
    """The three list columns of the staging customers as text."""
    told = F.transform(
        "shareholders",
        lambda s: F.concat_ws(
            ":", *(F.coalesce(s[n], F.lit("~")) for n in ("shareholder_id", "shareholder_name", "ownership_percentage"))
        ),
    )
    named = lambda c: F.array_join(c, ";", "~")
    return t.build("stg_customers").select(
        "customer_id",
        F.array_join(told, ";").alias("shareholders"),
        named("directors").alias("directors"),
        named("companies").alias("companies"),
        F.size("shareholders").alias("n_shareholders"),
    )


def _run_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags a run counted while it wrote its staging tables."""
    lake, _, batch = _whole_run(spark, sf_dir)
    return logged(lake, QUALITY_TABLE, batch).select("flag", "flagged", "rows")


def _published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the silver tables as SQL finds them after a run."""
    lake, tables, _ = _whole_run(spark, sf_dir)
    if len(_runs) > 1:  # a run over another folder has published its own tables since
        lake.publish("silver", list(tables))
    return checks.together([spark.sql(f"select '{n}' as table_name, count(*) as rows from silver.{n}") for n in tables])


def _rescued_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files to bronze to facts: every value that did not fit, with its key and source."""
    t, lake, batch = Layers(spark, sf_dir), _lake(spark), uuid.uuid4().hex
    path = os.path.join(lake.root, "landing", "transactions_text.parquet")
    _text_transactions(t).write.parquet(path, compression=CODEC)
    run_ingest(lake, [path])
    run_transactions(lake, [lake.read("bronze", "erp_transactions_text")], t["fact_accounts"], batch)
    source = F.regexp_replace("source", "^.*/", "").alias("source")
    return logged(lake, QUARANTINE, batch).select("table_name", source, "key", "column_name", "value")


def _in_lake(lake: Lake, tables: list[str]) -> list[DataFrame]:
    read = F.lit("READ").alias("status")
    return [
        lake.read("silver", n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), read, "rows") for n in tables
    ]


def _customer_tables(stg: DataFrame, names: list[str]) -> dict[str, Callable[[], DataFrame]]:
    return {n: (lambda build=CUSTOMER_TABLES[n]: build(stg)) for n in names}


def _restarted_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose third table fails is started again: what it had finished is taken over, not written again."""
    delivered, lake, batch = Layers(spark, sf_dir)["bronze_customers"], _lake(spark), uuid.uuid4().hex
    journal, names = Journal(lake, batch), ["fact_customers", "dim_addresses", "dim_contacts"]

    def run(broken: bool) -> None:
        with lake.load(journal.paths) as load:
            given = inputs_digest(lake, [delivered])
            stg = stage(load, "customers", lambda: customers.clean_customers(delivered), batch, None, journal, given)
            builders = _customer_tables(stg, names)
            if broken:
                whole = builders["dim_contacts"]
                broken_row = F.raise_error(F.lit("broken row")).cast("string")
                builders["dim_contacts"] = lambda: whole().withColumn("contact", broken_row)
            load_tables(load, builders, CUSTOMER_AUDIT, batch, journal, inputs_digest(lake, [stg]))

    try:
        run(broken=True)
    except PySparkException:
        pass
    run(broken=False)
    log = run_log(lake).groupBy(F.col("procedure_name").alias("name"), "status", F.col("rows_processed").alias("rows"))
    times = log.agg(F.count(F.lit(1)).alias("times"))
    read = [df.withColumn("times", F.lit(1).cast("long")) for df in _in_lake(lake, names)]
    return checks.together([*read, times])


def _failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables are loaded; then a load of fewer rows fails in one builder, and all three read as before."""
    stg, lake, batch = Layers(spark, sf_dir)["stg_customers"], _lake(spark), uuid.uuid4().hex
    names = ["fact_customers", "dim_addresses", "dim_contacts"]
    with lake.load() as load:
        load_tables(load, _customer_tables(stg, names), CUSTOMER_AUDIT, batch)
    fewer = _customer_tables(stg.where(F.col("customer_type") == "COMPANY"), names)
    whole = fewer["dim_contacts"]
    fewer["dim_contacts"] = lambda: whole().withColumn("contact", F.raise_error(F.lit("broken row")).cast("string"))
    try:
        with lake.load() as load:
            load_tables(load, fewer, CUSTOMER_AUDIT, batch)
    except PySparkException:
        pass
    failed = run_log(lake).where(F.col("status") == "FAILED")
    failed = failed.select(F.col("procedure_name").alias("name"), "status", F.col("rows_processed").alias("rows"))
    return checks.together([*_in_lake(lake, names), failed])


def _gated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with customers that are there twice is reported and not published."""
    stg, lake, batch = Layers(spark, sf_dir)["stg_customers"], _lake(spark), uuid.uuid4().hex
    names, gates = ["fact_customers", "dim_contacts"], ["UNIQUE:fact_customers"]
    with lake.load() as load:
        inspect_load(lake, load_tables(load, _customer_tables(stg, names), CUSTOMER_AUDIT, batch), gates, batch)
    twice, batch = _customer_tables(stg, names), uuid.uuid4().hex
    once = twice["fact_customers"]
    twice["fact_customers"] = lambda: once().unionByName(once().where(F.col("customer_type") == "COMPANY"))
    try:
        with lake.load() as load:
            inspect_load(lake, load_tables(load, twice, CUSTOMER_AUDIT, batch), gates, batch)
    except LoadRejected:
        pass
    report = logged(lake, REPORT, batch).where("blocking")
    report = report.select(F.concat_ws(":", "rule", "table_name").alias("name"), F.lit("REJECTED").alias("status"), F.col("violations").alias("rows"))
    return checks.together([*_in_lake(lake, names), report])


def _changed_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second ingest: early years are delivered no more, 1997 has changed, the rest is as before."""
    lake, orders = _lake(spark), yearly_orders(spark, sf_dir).drop("_source_file_url")
    landing = os.path.join(lake.root, "landing")

    def deliver(rows: DataFrame, years: list[int]) -> None:
        for year in years:
            part = rows.where(F.year("o_orderdate") == year)
            part.write.mode("overwrite").parquet(os.path.join(landing, f"orders_{year}.parquet"))

    years = _years(orders)
    deliver(orders, years)
    run_ingest(lake, [os.path.join(landing, f"orders_{y}.parquet") for y in years], only_changed=True)
    later = _second_load(orders)
    deliver(later, [1997])
    done = run_ingest(lake, [os.path.join(landing, f"orders_{y}.parquet") for y in _years(later)], only_changed=True)
    return done.select("table_name", "status", "rows", "columns")


def _typed_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Years whose layouts differ, ingested in two goes into one schema.

    In 1995 customers are text, 1996 has no status, 1997 has remarks, weights are whole until 1997.
    """
    lake, orders = _lake(spark), yearly_orders(spark, sf_dir).drop("_source_file_url")
    paths = {}
    for year in _years(orders):
        part = orders.where(F.year("o_orderdate") == year)
        if year == 1995:
            part = part.withColumn("o_custkey", F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
        if year == 1996:
            part = part.drop("o_orderstatus")
        if year == 1997:
            part = part.withColumn("o_remark", F.repeat(F.lit("x"), (F.col("o_orderkey") % 90).cast("int")))
        weight = F.col("o_orderkey") % 100
        part = part.withColumn("o_weight", weight.cast("bigint") if year < 1998 else (weight / 8).cast("double"))
        paths[year] = os.path.join(lake.root, "landing", f"orders_{year}.parquet")
        part.write.parquet(paths[year])
    later = [path for year, path in paths.items() if year != 1995]
    run_ingest(lake, later, only_changed=True, typed=True)
    run_ingest(lake, list(paths.values()), only_changed=True, typed=True)
    return lake


def _type_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = type_registry(_typed_lake(spark, sf_dir))
    return found.select("entity", F.col("column").alias("column_name"), "target_type")


def _typed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years read in one schema, by table."""
    return read_entity(_typed_lake(spark, sf_dir), "erp_orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_weight",
        F.length("o_remark").alias("remark_length"), F.col("_table").alias("table_name"),
        F.col("_rescued").isNull().cast("int").alias("nothing_lost"),
    )


def _movement(t: Layers) -> DataFrame:
    return metrics.customer_movement(t["fact_customers"], t["fact_accounts"], t["dim_account_status"])


def _periods(t: Layers) -> DataFrame:
    return periods.customer_periods(t["fact_accounts"], t["dim_account_status"])


def _stored_bitmaps(spark: SparkSession, parts: list[DataFrame], table_name: str) -> DataFrame:
    """Bitmaps that reach a stored table in parts."""
    lake = _lake(spark)
    for part in parts:
        stored = bitmaps.add_bitmaps(lake, "gold", table_name, part)
    return stored


def _engagement_of_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity arrives in two overlapping deliveries; the rates come from the stored bitmaps alone."""
    activity = Layers(spark, sf_dir).build("activity")
    days = activity.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    middle = days.select(F.date_add("first", F.floor(F.datediff("last", "first") / 2).cast("int"))).scalar()
    early, late = activity.where(F.col("day") <= middle), activity.where(F.col("day") >= F.date_sub(middle, 3))
    stored = _stored_bitmaps(spark, [bitmaps.daily_users(early), bitmaps.daily_users(late)], "daily_users")
    return comparable(bitmaps.engagement_of(stored))


def _adoption_of_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digital customers, stored per day in one delivery for every transaction type."""
    _, t, _ = _whole_run(spark, sf_dir)
    paid = t["fact_transactions"]
    credit = F.col("transaction_type").eqNullSafe("CREDIT")
    parts = [
        bitmaps.daily_digital_customers(t["fact_customers"], t["fact_accounts"], paid.where(rows))
        for rows in (credit, ~credit)
    ]
    stored = _stored_bitmaps(spark, parts, "daily_digital_customers")
    return comparable(bitmaps.adoption_of(stored, t["fact_customers"]))


def _penetration_of_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, t, _ = _whole_run(spark, sf_dir)
    bits = bitmaps.product_customers(t["fact_customers"], t["fact_accounts"], t["dim_account_products"])
    stored = _stored_bitmaps(spark, [bits], "product_customers")
    return comparable(bitmaps.penetration_of(stored, t["fact_customers"]))


def _minimum_slice(t: Layers) -> DataFrame:
    """Success rate per channel straight from bronze."""
    kept = t["bronze_transactions"].where(F.col("amount") != 0)
    named = kept.select(
        norm(F.col("channel")).alias("transaction_channel"), norm(F.col("status")).alias("transaction_status")
    )
    return metrics.transaction_success_rate(named, ["transaction_channel"])


def _events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", json_fields(F.col("props"), ["k"])["k"].alias("k"))


QUERIES: dict[str, Query] = {
    "success_rate_slice": _on_layers(_minimum_slice),
    # bronze
    "ingest_summary": lambda s, d: comparable(bronze.ingest_summary(yearly_orders(s, d))),
    "source_hash": lambda s, d: comparable(bronze.source_hash(yearly_orders(s, d))),
    "ingest_metadata": lambda s, d: comparable(_ingest_metadata(s, d)),
    "read_bronze_files": lambda s, d: comparable(_read_files(s, d)),
    "full_load_replace": lambda s, d: comparable(_full_load(s, d)),
    "ingest_run": lambda s, d: comparable(_ingest_run(s, d)),
    "detect_changes": _detect_changes,
    "type_profile": lambda s, d: comparable(_profile(s, d)),
    "route_sources": _route_sources,
    "preprocess_types": lambda s, d: comparable(_preprocess(s, d)),
    "union_yearly_tagged": lambda s, d: comparable(_union_tagged(s, d)),
    "union_yearly_columns": lambda s, d: comparable(_union_conformed(s, d)),
    # customers
    "fix_birth_dates": _customer_op(customers.repair_birth_dates, "birth_date new_birth_date"),
    "age_at_opening": _customer_op(_ages, "age_at_opening new_age_at_opening"),
    "split_addresses": _customer_op(customers.split_addresses, ADDRESS_COLUMNS),
    "default_country": _customer_op(_country, "residential_country"),
    "email_flag": _customer_op(customers.check_contacts, "email invalid_email_format"),
    "normalise_phone": _customer_op(customers.check_contacts, "phone_number new_phone_number"),
    "expiry_flags": _customer_op(customers.check_expiry, "registered_expired_document registered_expired_visa"),
    "employment_flag": _customer_op(customers.check_employment, "check_employment"),
    "license_fields": _customer_op(
        customers.license_fields, "license_number license_issue_date license_expiry_date license_regulatory_body"
    ),
    "explode_shareholders": _customer_op(
        customers.explode_shareholders, "shareholder_id shareholder_name ownership_percentage"
    ),
    "explode_directors": _customer_op(customers.explode_directors, "director_customer_id"),
    "explode_companies": _customer_op(customers.explode_companies, "directed_company"),
    "events_json_value": _events_json,
    "clean_customers": _on_layers(lambda t: t.build("stg_customers")),
    "clean_customers_lists": _on_layers(_customer_lists),
    **{f"build_{n}": _on_layers(lambda t, n=n: t.build(n)) for n in CUSTOMER_TABLES},
    # accounts
    "standard_text": _on_layers(lambda t: _standard_text(t["bronze_accounts"])),
    "duplicate_counts": _on_layers(
        lambda t: _select(
            accounts.add_duplicate_counts(t["bronze_accounts"]),
            "account_id account_number card_number account_number_count account_id_count card_number_count",
        )
    ),
    "duplicate_counts_lineitem": _duplicates_lineitem,
    "primary_sanity": _on_layers(
        lambda t: _select(
            accounts.add_primary_sanity(t["bronze_accounts"]),
            "account_id customer_id primary_acc_count over_one_primary_acc",
        )
    ),
    "date_sequence": _on_layers(_date_sequence),
    "date_sequence_lineitem": _ship_before_order,
    "missing_status_date": _on_layers(
        lambda t: _select(
            accounts.flag_missing_status_date(t["bronze_accounts"]), "account_id missing_status_change_date"
        )
    ),
    "explode_joint": _on_layers(
        lambda t: _select(accounts.explode_joint(t["bronze_accounts"]), "account_id joint_customer_id")
    ),
    "explode_products": _on_layers(
        lambda t: _select(accounts.explode_products(t["bronze_accounts"]), "account_id bundled_product")
    ),
    "explode_beneficiaries": _on_layers(
        lambda t: _select(
            accounts.explode_beneficiaries(t["bronze_accounts"]),
            "account_id beneficiary_name beneficiary_relationship beneficiary_percentage",
        )
    ),
    "clean_accounts": _on_layers(lambda t: t.build("stg_accounts")),
    **{f"build_{n}": _on_layers(lambda t, n=n: t.build(n)) for n in ACCOUNT_TABLES},
    "build_fact_accounts": _on_layers(lambda t: t.build("fact_accounts")),
    # transactions
    "resolve_receiving": _on_layers(
        lambda t: _select(
            transactions.resolve_receiving_account(t["bronze_transactions"], t["fact_accounts"]),
            "transaction_id channel receiving_account receiving_account_number",
        )
    ),
    "receiving_bank": _on_layers(
        lambda t: t["bronze_transactions"].select(
            "transaction_id",
            "channel",
            transactions.clean_receiving_bank(F.col("receiving_bank")).alias("receiving_bank"),
        )
    ),
    "transaction_amounts_and_flags": _on_layers(
        lambda t: t["bronze_transactions"].select(
            "transaction_id",
            F.abs("amount").alias("transaction_amount"),
            F.abs("cashback_amount").alias("cashback_amount"),
            time_text(F.col("transaction_time")).alias("transaction_time"),
            *(yes_flag(F.col(c)).alias(n) for n, c in transactions.YES_FLAGS.items()),
        )
    ),
    "clean_transactions": _on_layers(lambda t: t.build("stg_transactions")),
    "build_fact_transactions": _on_layers(lambda t: t.build("fact_transactions")),
    # quality, keys, log
    "dq_not_null": _on_layers(lambda t: checks.together(checks.not_null(t))),
    "dq_domain": _on_layers(_dq_domain),
    "dq_unique": _on_layers(lambda t: checks.together(checks.unique(t))),
    "dq_fk": _on_layers(_dq_fk),
    "dq_current_address": _on_layers(lambda t: quality.check_current_address(_two_current(t))),
    "dq_cast_loss": _on_layers(_dq_cast_loss),
    "ingest_to_fact_transactions": lambda s, d: comparable(_ingest_to_facts(s, d)),
    "new_account_types": _on_layers(_new_account_types),
    "skewed_lookup": lambda s, d: comparable(_skewed_lookup(s, d)),
    "dq_limits": _on_layers(_dq_limits),
    "dq_summary": _on_layers(lambda t: quality.quality_summary(t["stg_customers"], t["stg_accounts"])),
    "surrogate_keys": _on_layers(_surrogate_keys),
    "etl_log": lambda s, d: comparable(_etl_log(s, d)),
    "run_all": _run_all,
    "run_digests": _run_digests,
    "load_times": _load_times,
    "restarted_run": _restarted_run,
    "run_quality": lambda s, d: comparable(_run_quality(s, d)),
    "published_counts": lambda s, d: comparable(_published_counts(s, d)),
    "rescued_values": _rescued_values,
    "failed_load": lambda s, d: comparable(_failed_load(s, d)),
    "gated_load": lambda s, d: comparable(_gated_load(s, d)),
    "changed_extracts": lambda s, d: comparable(_changed_extracts(s, d)),
    "type_registry": lambda s, d: comparable(_type_registry(s, d)),
    "typed_years": lambda s, d: comparable(_typed_years(s, d)),
    "distinct_accounts": _on_layers(lambda t: metrics.distinct_accounts(t["bronze_accounts"])),
    # gold metrics
    "m01_customer_base_growth": _on_layers(lambda t: metrics.customer_base_growth(t["fact_customers"])),
    "m02_new_customer_growth": _on_layers(lambda t: metrics.new_customer_growth(t["fact_customers"])),
    "m02_new_customers_daily": _on_layers(lambda t: metrics.new_customer_growth(t["fact_customers"], "day")),
    "m02_new_customers_weekly": _on_layers(lambda t: metrics.new_customer_growth(t["fact_customers"], "week")),
    "m03_new_customer_growth_yoy": _on_layers(lambda t: metrics.new_customer_growth_yoy(t["fact_customers"])),
    "m04_churn_rate": _on_layers(lambda t: metrics.churn_rate(_movement(t))),
    "m05_retention_rate": _on_layers(lambda t: metrics.retention_rate(_movement(t))),
    "m04_customer_periods": _on_layers(_periods),
    "m04_customer_turnover": _on_layers(lambda t: periods.customer_turnover(_periods(t))),
    "m05_retention_of_turnover": _on_layers(
        lambda t: periods.retention_of_turnover(periods.customer_turnover(_periods(t)))
    ),
    "m06_products_per_customer": _on_layers(
        lambda t: metrics.products_per_customer(t["fact_customers"], t["dim_account_products"], t["dim_account_status"])
    ),
    "m07_customer_lifetime_value": _on_layers(
        lambda t: metrics.customer_lifetime_value(
            t["fact_customers"], t["fact_accounts"], t["fact_transactions"], AS_OF
        )
    ),
    "m08_product_penetration": _on_layers(
        lambda t: metrics.product_penetration(t["fact_customers"], t["fact_accounts"], t["dim_account_products"])
    ),
    "m08_penetration_of_bitmaps": _penetration_of_bitmaps,
    "m09_loan_utilisation": _on_layers(lambda t: metrics.loan_utilisation(t.build("loans"), ["loan_status"])),
    "m10_active_accounts_ratio": _on_layers(lambda t: metrics.active_accounts_ratio(t["dim_account_status"])),
    "m11_net_interest_margin": _on_layers(lambda t: metrics.net_interest_margin(t.build("positions"), ["year"])),
    "m12_fee_income_growth": _on_layers(lambda t: metrics.fee_income_growth(t["fact_transactions"])),
    "m13_customer_profitability": _on_layers(
        lambda t: metrics.customer_profitability(t["fact_transactions"], t.build("costs"), t["fact_accounts"])
    ),
    "m14_npl_ratio": _on_layers(lambda t: metrics.npl_ratio(t.build("loans"), ["loan_status"])),
    "m15_approval_rate": _on_layers(lambda t: metrics.approval_rate(t.build("loans"), ["book_date"])),
    "m16_early_delinquency_rate": _on_layers(lambda t: metrics.early_delinquency_rate(t.build("loans"), ["loan_status"])),
    "m17_charge_off_rate": _on_layers(lambda t: metrics.charge_off_rate(t.build("loans"))),
    "m18_account_opening_days": _on_layers(lambda t: metrics.account_opening_days(t["dim_account_status"])),
    "m19_transaction_success_rate": _on_layers(
        lambda t: metrics.transaction_success_rate(t["fact_transactions"], ["transaction_channel"])
    ),
    "m20_call_resolution_rate": _on_layers(lambda t: metrics.call_resolution_rate(t.build("activity"), ["day"])),
    "m21_digital_adoption_rate": _on_layers(
        lambda t: metrics.digital_adoption_rate(t["fact_customers"], t["fact_accounts"], t["fact_transactions"])
    ),
    "m21_adoption_of_bitmaps": _adoption_of_bitmaps,
    "m22_engagement_of_bitmaps": _engagement_of_bitmaps,
    "m22_app_engagement_rate": _on_layers(lambda t: metrics.app_engagement_rate(t.build("activity"))),
    "m23_failed_login_rate": _on_layers(lambda t: metrics.failed_login_rate(t.build("activity"), ["day"])),
    # department reports
    "n1_branch_performance": _on_layers(
        lambda t: reports.branch_performance(t["fact_transactions"], t["fact_accounts"], t["dim_addresses"])
    ),
    "n2_customer_segments": _on_layers(
        lambda t: reports.customer_segments(t["fact_customers"], t["dim_customer_risks"])
    ),
    "n3_past_due_buckets": _on_layers(lambda t: reports.past_due_buckets(t.build("loans"))),
    "n4_daily_liquidity": _on_layers(lambda t: reports.daily_liquidity(t["fact_transactions"])),
    "n5_maturity_profile": _on_layers(lambda t: reports.maturity_profile(t.build("loans"), LOAN_DATE)),
    "n6_kyc_summary": _on_layers(lambda t: reports.kyc_summary(t["fact_accounts"], t["dim_customer_risks"])),
}
