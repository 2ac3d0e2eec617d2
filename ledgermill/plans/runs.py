"""Pipeline entry points: bronze frames to written silver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.accounts import clean_accounts, first_copies
from ledgermill.operators.audit import add_to_log, audited, log_entry
from ledgermill.operators.customers import clean_customers
from ledgermill.operators.keys import add_audit_columns, add_defaults, add_surrogate_key
from ledgermill.operators.quality import account_flags, customer_flags, rescued_values
from ledgermill.operators.star_accounts import ACCOUNT_TABLES, build_dim_account_type, build_fact_accounts
from ledgermill.operators.star_customers import CUSTOMER_TABLES
from ledgermill.operators.transactions import build_fact_transactions, clean_transactions, with_amount
from ledgermill.operators.unions import union_conformed
from ledgermill.plans.checks import check_tables, together
from ledgermill.plans.journal import Journal, inputs_digest
from ledgermill.sources.layers import Lake, Load
from ledgermill.sources.schemas import ACCOUNTS, CUSTOMERS, TRANSACTIONS

# --- fixed values: surrogate key and audit column names ---------------------------------

SURROGATE_KEYS = {
    "fact_customers": "customer_key",
    "dim_addresses": "address_key",
    "dim_contacts": "contact_key",
    "dim_documents": "document_key",
    "dim_customer_risks": "risk_key",
    "dim_customer_profile": "profile_key",
    "dim_business_details": "business_key",
    "dim_business_licensing": "licensing_key",
    "dim_business_shareholders": "shareholder_key",
    "dim_business_directors": "director_key",
    "dim_director_information": "director_info_key",
    "dim_account_type": "account_type_id",
    "fact_accounts": "account_key",
    "dim_account_status": "account_status_key",
    "dim_account_joint_customers": "joint_customer_key",
    "dim_account_type_details": "account_details_key",
    "dim_account_products": "account_product_key",
    "dim_account_card_details": "card_key",
    "dim_account_beneficiary": "beneficiary_key",
    "dim_account_documents": "document_key",
    "fact_transactions": "transaction_key",
}
ACCOUNT_AUDIT = ("created_at", "updated_at")
CUSTOMER_AUDIT = ("created_date", "update_date")

VIOLATIONS, REPORT, QUARANTINE = "violations", "quality_report", "quarantine"

# tables written side by side; each write is a Spark job of its own
PARALLEL_WRITES = 4


def _finished(df: DataFrame, table: str, audit: tuple[str, str]) -> DataFrame:
    """Surrogate key, defaults and audit columns of a built table."""
    key = SURROGATE_KEYS[table]
    if key not in df.columns:
        df = add_surrogate_key(df, key)
    return add_audit_columns(add_defaults(df, table), *audit)


class LoadRejected(Exception):
    """A load broke rules that it must keep; none of its tables was published."""


class RunReplaced(Exception):
    """A run cannot go on: later loads have replaced tables it had loaded."""


def _once(
    load: Load,
    layer: str,
    table: str,
    name: str,
    step: Callable[[], DataFrame],
    batch_id: str,
    flags: dict[str, Column] | None = None,
    journal: Journal | None = None,
    inputs: str | None = None,
) -> DataFrame:
    """Runs one audited step of a load, or takes over what it wrote before the run died."""
    known = journal.find(name, inputs) if journal else None
    if known:
        taken = load.adopt(layer, table, known["paths"][0])
        log_entry(load.lake, batch_id, name, datetime.now(timezone.utc), "REUSED", known["rows"])
        return taken

    def done(rows: int) -> None:
        if journal:
            journal.note(name, inputs, paths=[load.version(layer, table)], rows=rows)

    return audited(load.lake, name, step, lambda df: load.write(df, layer, table), batch_id, flags, done)


def load_tables(
    load: Load,
    tables: dict[str, Callable[[], DataFrame]],
    audit: tuple[str, str],
    batch_id: str,
    journal: Journal | None = None,
    inputs: str | None = None,
) -> dict[str, DataFrame]:
    """Builds and writes silver tables side by side; they are seen by this load only until it commits.

    With a ``journal`` tables that the batch has written from the same ``inputs`` are taken over.
    """

    def one(item):
        table, build = item
        finished = lambda: _finished(build(), table, audit)
        return table, _once(load, "silver", table, f"load_{table}", finished, batch_id, None, journal, inputs)

    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        return dict(pool.map(one, tables.items()))


def stage(
    load: Load,
    table: str,
    step: Callable[[], DataFrame],
    batch_id: str,
    flags: dict[str, Column] | None = None,
    journal: Journal | None = None,
    inputs: str | None = None,
) -> DataFrame:
    """Writes a staging table, or takes over that of a run that died."""
    return _once(load, "staging", table, f"clean_{table}", step, batch_id, flags, journal, inputs)


def _inputs(journal: Journal | None, *frames: DataFrame) -> str | None:
    return inputs_digest(journal.lake, frames) if journal else None


def _loaded_before(journal: Journal | None, name: str, inputs: str | None) -> dict[str, DataFrame] | None:
    """The tables of a load that the batch has committed from the same inputs."""
    known = journal.entry(name, inputs) if journal else None
    if known is None:
        return None
    lake, now = journal.lake, journal.lake.manifest()[1]
    tables = {}
    for table, path in known["tables"].items():
        if now.get(f"silver/{table}", {}).get("path") != path:
            raise RunReplaced(f"{table} of batch {journal.batch_id} was replaced by a later load")
        tables[table] = lake.read("silver", table)
    log_entry(lake, journal.batch_id, name, datetime.now(timezone.utc), "REUSED")
    return tables


@contextmanager
def _loading(
    lake: Lake, journal: Journal | None, name: str, inputs: str | None, tables: dict[str, DataFrame]
) -> Iterator[Load]:
    """One load whose finished steps outlive its failure if there is a journal; ``tables`` are filled inside."""
    with lake.load(journal.paths if journal else tuple) as load:
        yield load
    if journal:
        journal.note(name, inputs, tables={table: load.version("silver", table) for table in tables})
        journal.sweep()


def inspect_load(lake: Lake, tables: Mapping[str, DataFrame], gates: Collection[str], batch_id: str) -> None:
    """Checks written tables before they are published.

    Violations go to ``error_log/violations``, their numbers per rule and table to
    ``error_log/quality_report``. A violation of a rule among the ``gates`` rejects the load; a gate is a
    rule such as UNIQUE, or a rule of one table such as UNIQUE:fact_customers.
    """
    found = check_tables(tables)
    if found is None:
        return
    place = add_to_log(lake, VIOLATIONS, found, batch_id)
    rows = lake.spark.read.schema(found.schema).parquet(place)
    gate = F.concat_ws(":", "rule", "table_name")
    blocking = F.col("rule").isin(list(gates)) | gate.isin(list(gates))
    counted = rows.groupBy("rule", "table_name").agg(F.count(F.lit(1)).alias("violations"), F.min("key").alias("example"))
    report = add_to_log(lake, REPORT, counted.withColumn("blocking", blocking), batch_id)
    broken = lake.spark.read.parquet(report).where("blocking").orderBy("rule", "table_name").collect()
    if broken:
        named = ", ".join(f"{r.rule} of {r.table_name}: {r.violations}" for r in broken)
        raise LoadRejected(f"not published, {named}")


def quarantine(
    lake: Lake, table: str, key: str, frames: list[DataFrame], spec: dict[str, list[str]], batch_id: str
) -> None:
    """Lists every delivered value that ingest or the cast to the specified types loses."""
    lost = [rescued_values(df, table, key, spec, "_source_file_url") for df in frames]
    if lost:
        add_to_log(lake, QUARANTINE, together(lost), batch_id)


def _journal(lake: Lake, batch_id: str, restartable: bool) -> Journal | None:
    return Journal(lake, batch_id) if restartable else None


def _quarantine_once(
    lake: Lake,
    table: str,
    key: str,
    frames: list[DataFrame],
    spec: dict[str, list[str]],
    batch_id: str,
    journal: Journal | None,
    inputs: str | None,
) -> None:
    if journal is None or journal.entry(f"quarantine_{table}", inputs) is None:
        quarantine(lake, table, key, frames, spec, batch_id)
        if journal:
            journal.note(f"quarantine_{table}", inputs)


def run_customers(
    lake: Lake,
    bronze: list[DataFrame],
    batch_id: str | None = None,
    gates: Collection[str] = (),
    restartable: bool = False,
) -> dict[str, DataFrame]:
    """Clean the yearly customer frames and load eleven tables, all or none."""
    batch_id = batch_id or uuid.uuid4().hex
    journal = _journal(lake, batch_id, restartable)
    given = _inputs(journal, *bronze)
    if (before := _loaded_before(journal, "run_customers", given)) is not None:
        return before
    _quarantine_once(lake, "customers", "customer_id", bronze, CUSTOMERS, batch_id, journal, given)
    tables: dict[str, DataFrame] = {}
    with _loading(lake, journal, "run_customers", given, tables) as load:
        clean = lambda: clean_customers(union_conformed(bronze, CUSTOMERS))
        stg = stage(load, "customers", clean, batch_id, customer_flags(), journal, given)
        builders = {name: (lambda build=build: build(stg)) for name, build in CUSTOMER_TABLES.items()}
        tables |= load_tables(load, builders, CUSTOMER_AUDIT, batch_id, journal, _inputs(journal, stg))
        inspect_load(lake, tables, gates, batch_id)
    return tables


def run_accounts(
    lake: Lake,
    bronze: list[DataFrame],
    fact_customers: DataFrame,
    batch_id: str | None = None,
    known_types: DataFrame | None = None,
    gates: Collection[str] = (),
    restartable: bool = False,
) -> dict[str, DataFrame]:
    """R2: clean the yearly account frames and load nine tables, all or none.

    ``known_types`` are account types of an earlier load; they keep their numbers.
    """
    batch_id = batch_id or uuid.uuid4().hex
    journal = _journal(lake, batch_id, restartable)
    others = [] if known_types is None else [known_types]
    given = _inputs(journal, *bronze, fact_customers, *others)
    if (before := _loaded_before(journal, "run_accounts", given)) is not None:
        return before
    _quarantine_once(lake, "accounts", "account_id", bronze, ACCOUNTS, batch_id, journal, given)
    tables: dict[str, DataFrame] = {}
    with _loading(lake, journal, "run_accounts", given, tables) as load:
        clean = lambda: clean_accounts(union_conformed(bronze, ACCOUNTS), fact_customers, mark_copies=True)
        stg = stage(load, "accounts", clean, batch_id, account_flags(), journal, given)
        given_once = first_copies(stg)
        builders = {name: (lambda build=build: build(given_once)) for name, build in ACCOUNT_TABLES.items()}
        if known_types is not None:
            types = known_types.select("account_type_id", "account_type")
            builders["dim_account_type"] = lambda: types.unionByName(build_dim_account_type(given_once, types))
        tables |= load_tables(load, builders, ACCOUNT_AUDIT, batch_id, journal, _inputs(journal, stg, *others))
        fact = {"fact_accounts": lambda: build_fact_accounts(given_once, tables["dim_account_type"])}
        typed = _inputs(journal, stg, tables["dim_account_type"])
        tables |= load_tables(load, fact, ACCOUNT_AUDIT, batch_id, journal, typed)
        inspect_load(lake, tables, gates, batch_id)
    return tables


def run_transactions(
    lake: Lake,
    bronze: list[DataFrame],
    fact_accounts: DataFrame,
    batch_id: str | None = None,
    gates: Collection[str] = (),
    restartable: bool = False,
) -> dict[str, DataFrame]:
    """Clean the transaction frames and load the transaction facts, with their staging table or not at all."""
    batch_id = batch_id or uuid.uuid4().hex
    journal = _journal(lake, batch_id, restartable)
    given = _inputs(journal, *bronze, fact_accounts)
    if (before := _loaded_before(journal, "run_transactions", given)) is not None:
        return before
    _quarantine_once(lake, "transactions", "transaction_id", bronze, TRANSACTIONS, batch_id, journal, given)
    tables: dict[str, DataFrame] = {}
    with _loading(lake, journal, "run_transactions", given, tables) as load:
        clean = lambda: clean_transactions(
            union_conformed([with_amount(df) for df in bronze], TRANSACTIONS), fact_accounts, amounts_checked=True
        )
        stg = stage(load, "transactions", clean, batch_id, None, journal, given)
        facts = {"fact_transactions": lambda: build_fact_transactions(stg)}
        tables |= load_tables(load, facts, CUSTOMER_AUDIT, batch_id, journal, _inputs(journal, stg))
        inspect_load(lake, tables, gates, batch_id)
    return tables


def run_all(
    lake: Lake,
    customers: list[DataFrame],
    accounts: list[DataFrame],
    transactions: list[DataFrame],
    gates: Collection[str] = (),
    batch_id: str | None = None,
    restartable: bool = False,
) -> dict[str, DataFrame]:
    """Customers, then accounts, then transactions; returns the 21 silver tables.

    Each of the three is loaded as a whole or not at all. The entries of a run in the log, in the quality
    tables and in the quarantine share one batch. At the end the silver tables are published for SQL.

    A ``restartable`` run that died goes on when it is called again with its ``batch_id``: steps and loads
    that it has finished from the same inputs are taken over (REUSED in the log), a rejected load is only
    checked again. ``Journal.forget`` gives such a run up. After a change of the code take a new batch.
    """
    batch_id = batch_id or uuid.uuid4().hex
    tables = run_customers(lake, customers, batch_id, gates, restartable)
    tables |= run_accounts(
        lake, accounts, tables["fact_customers"], batch_id, gates=gates, restartable=restartable
    )
    tables |= run_transactions(lake, transactions, tables["fact_accounts"], batch_id, gates, restartable)
    lake.publish("silver", list(tables))
    return tables
