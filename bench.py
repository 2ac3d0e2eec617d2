"""Times the headline steps at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A run over the smallest tables warms the JVM. Layer steps then build a table and write it
once, as the pipeline does. Queries run over the written layers into a sink that keeps
nothing; the faster of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from ledgermill.contract.layers import Layers
from ledgermill.contract.queries import QUERIES
from ledgermill.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

LAYERS = [
    "bronze_customers",
    "bronze_accounts",
    "bronze_transactions",
    "stg_customers",
    "fact_customers",
    "stg_accounts",
    "dim_account_type",
    "fact_accounts",
    "stg_transactions",
    "fact_transactions",
    "dim_addresses",
    "dim_customer_risks",
    "dim_account_status",
    "dim_account_products",
]
HEADLINE = [
    "success_rate_slice",
    "source_hash",
    "detect_changes",
    "type_profile",
    "clean_customers",
    "build_fact_customers",
    "build_dim_addresses",
    "build_dim_contacts",
    "build_dim_documents",
    "build_dim_business_shareholders",
    "duplicate_counts",
    "duplicate_counts_lineitem",
    "primary_sanity",
    "date_sequence",
    "clean_accounts",
    "build_fact_accounts",
    "build_dim_account_products",
    "build_dim_account_beneficiary",
    "resolve_receiving",
    "clean_transactions",
    "build_fact_transactions",
    "dq_unique",
    "dq_summary",
    "m01_customer_base_growth",
    "m04_churn_rate",
    "m07_customer_lifetime_value",
    "m08_product_penetration",
    "m12_fee_income_growth",
    "m13_customer_profitability",
    "m19_transaction_success_rate",
    "m21_digital_adoption_rate",
    "m22_app_engagement_rate",
    "n1_branch_performance",
    "n4_daily_liquidity",
    "n6_kyc_summary",
    "skewed_lookup",
    "dq_cast_loss",
    "surrogate_keys",
]
# whole runs write many tables; they are timed once
RUNS_ONCE = ["ingest_run", "ingest_to_fact_transactions", "run_all"]


def timed(step) -> float:
    start = time.perf_counter()
    step()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "ledgermill-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = Layers(spark, WARM_DIR) if os.path.isdir(WARM_DIR) else None
    for name in LAYERS if warm else []:
        warm[name].count()
    layers = Layers(spark, SF_DIR)

    times: dict[str, float] = {}
    for name in LAYERS:
        times[f"layer_{name}"] = timed(lambda: layers[name])

    def drain(query):
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        times[name] = min(timed(lambda: drain(QUERIES[name])) for _ in range(RUNS))
    for name in RUNS_ONCE:
        times[name] = timed(lambda: drain(QUERIES[name]))

    print(
        json.dumps(
            {
                "metric": "total headline time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": SF_DIR.rstrip("/").split("sf")[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
