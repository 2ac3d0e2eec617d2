"""Bronze, staging and silver tables of a test folder, each written once per session."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgermill.contract.inputs import banking_frame, table
from ledgermill.operators.accounts import clean_accounts, first_copies
from ledgermill.operators.customers import clean_customers
from ledgermill.operators.keys import add_defaults
from ledgermill.operators.star_accounts import ACCOUNT_TABLES, build_fact_accounts
from ledgermill.operators.star_customers import CUSTOMER_TABLES
from ledgermill.operators.transactions import build_fact_transactions, clean_transactions
from ledgermill.session import CODEC, tune, write_shared

# (application, test folder, table) -> path and schema
_written: dict[tuple[str, str, str], tuple[str, StructType]] = {}

BRONZE = {"bronze_customers": "fx_customers", "bronze_accounts": "fx_accounts", "bronze_transactions": "fx_transactions"}


class Layers:
    """Tables derived from the test tables in ``sf_dir``, read back from the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        tune(spark)
        self.spark = spark
        self.sf_dir = os.path.abspath(sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key in _written:
            path, schema = _written[key]
            try:
                return self.spark.read.schema(schema).parquet(path)
            except AnalysisException:
                # the folder was cleared in between
                del _written[key]
        built = self._accounts(mark_copies=True) if name == "stg_accounts" else self.build(name)
        _written[key] = write_shared(built, name, CODEC), built.schema
        return self[name]

    def source(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def build(self, name: str) -> DataFrame:
        """The table as a plan over its inputs, not yet written."""
        if name in BRONZE:
            # the test tables are single files; bronze extracts arrive in many
            return banking_frame(self.spark, self.sf_dir, BRONZE[name], self.spark.sparkContext.defaultParallelism)
        if name == "stg_customers":
            return clean_customers(self["bronze_customers"])
        if name == "stg_accounts":
            return self._accounts()
        if name == "stg_transactions":
            return clean_transactions(self["bronze_transactions"], self["fact_accounts"])
        if name in CUSTOMER_TABLES:
            return add_defaults(CUSTOMER_TABLES[name](self["stg_customers"]), name)
        if name in ACCOUNT_TABLES:
            return ACCOUNT_TABLES[name](first_copies(self["stg_accounts"]))
        if name == "fact_accounts":
            return build_fact_accounts(first_copies(self["stg_accounts"]), self["dim_account_type"])
        if name == "fact_transactions":
            return build_fact_transactions(self["stg_transactions"])
        return self._contract(name)

    def _accounts(self, mark_copies: bool = False) -> DataFrame:
        return clean_accounts(self["bronze_accounts"], self["fact_customers"], mark_copies=mark_copies)

    def _contract(self, name: str) -> DataFrame:
        """Tables the caller supplies: loans, positions, costs and app activity."""
        builders: dict[str, Callable[[], DataFrame]] = {
            "loans": lambda: self.source("orders").select(
                F.col("o_orderkey").alias("loan_id"),
                F.col("o_orderstatus").alias("loan_status"),
                F.col("o_orderdate").cast("date").alias("book_date"),
                F.expr("cast(o_orderdate as date) + cast(o_orderkey % 2000 as int)").alias("maturity_date"),
                F.col("o_totalprice").cast("decimal(15,2)").alias("outstanding"),
                F.expr("cast(o_totalprice * 2 as decimal(15,2))").alias("approved_limit"),
                F.expr("cast(o_orderkey % 120 as int)").alias("days_past_due"),
                F.expr("case when o_orderstatus <> 'P' then 1 else 0 end").alias("is_approved"),
                F.expr(
                    "case when o_orderkey % 120 >= 115 then cast(o_totalprice as decimal(15,2)) end"
                ).alias("written_off"),
            ),
            "positions": lambda: self.source("lineitem").select(
                F.year("l_shipdate").alias("year"),
                F.expr(
                    "cast(l_extendedprice as decimal(15,2)) * cast(l_discount as decimal(5,2))"
                ).alias("interest_income"),
                F.expr(
                    "cast(l_extendedprice as decimal(15,2)) * cast(l_tax as decimal(5,2))"
                ).alias("interest_expense"),
                F.col("l_extendedprice").cast("decimal(15,2)").alias("earning_assets"),
            ),
            "costs": lambda: self.source("lineitem").select(
                F.expr("concat('ACC', lpad(cast(l_orderkey as string), 8, '0'))").alias("account_id"),
                F.expr(
                    "cast(l_extendedprice as decimal(15,2)) * cast(l_tax as decimal(5,2))"
                ).alias("cost"),
            ),
            "activity": lambda: self.source("events").select(
                "user_id",
                F.col("ts").alias("at"),
                F.col("ts").cast("date").alias("day"),
                "event_type",
                F.expr("case when event_type = 'error' then 1 else 0 end").alias("is_failed"),
                F.expr("case when event_type <> 'error' then 1 else 0 end").alias("is_resolved"),
            ),
        }
        return builders[name]()
