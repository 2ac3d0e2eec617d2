"""All checks of the silver layer; ``tables`` maps table names to frames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from ledgermill.functions.fixed_values import (
    DOMAINS,
    NUMBER_LIMITS,
    REFERENCES,
    REQUIRED,
    TEXT_LIMITS,
    UNIQUE_KEYS,
)
from ledgermill.operators import quality

Tables = Mapping[str, DataFrame]


def together(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def key_of(table: str) -> str:
    """The column that names a row in a violation."""
    return UNIQUE_KEYS.get(table, REQUIRED[table])[0]


def not_null(tables: Tables) -> list[DataFrame]:
    return [quality.check_not_null(tables[n], n, key_of(n), columns) for n, columns in REQUIRED.items()]


def domain(tables: Tables) -> list[DataFrame]:
    return [quality.check_domain(tables[n], n, key_of(n), labels) for n, labels in DOMAINS.items()]


def unique(tables: Tables) -> list[DataFrame]:
    return [quality.check_unique(tables[n], n, keys) for n, keys in UNIQUE_KEYS.items()]


def reference(tables: Tables) -> list[DataFrame]:
    return [
        quality.check_reference(tables[child], child, column, tables[parent], parent_column)
        for child, (column, parent, parent_column) in REFERENCES.items()
    ]


def limits(tables: Tables) -> list[DataFrame]:
    return [
        quality.check_limits(tables[n], n, key_of(n), TEXT_LIMITS.get(n, {}), NUMBER_LIMITS.get(n, {}))
        for n in dict.fromkeys([*TEXT_LIMITS, *NUMBER_LIMITS])
    ]


def check_silver(tables: Tables) -> DataFrame:
    """Every violation of the silver layer: (rule, table_name, key, detail)."""
    return together(
        [
            *not_null(tables),
            *domain(tables),
            *unique(tables),
            *reference(tables),
            *limits(tables),
            quality.check_current_address(tables["dim_addresses"]),
        ]
    )


def check_tables(tables: Tables) -> DataFrame | None:
    """The violations of every rule whose tables are among these; none if no rule applies."""
    there = {n: tables[n] for n in tables}
    found = [quality.check_not_null(there[n], n, key_of(n), c) for n, c in REQUIRED.items() if n in there]
    found += [quality.check_domain(there[n], n, key_of(n), labels) for n, labels in DOMAINS.items() if n in there]
    found += [quality.check_unique(there[n], n, keys) for n, keys in UNIQUE_KEYS.items() if n in there]
    found += [
        quality.check_reference(there[child], child, column, there[parent], parent_column)
        for child, (column, parent, parent_column) in REFERENCES.items()
        if child in there and parent in there
    ]
    found += [
        quality.check_limits(there[n], n, key_of(n), TEXT_LIMITS.get(n, {}), NUMBER_LIMITS.get(n, {}))
        for n in dict.fromkeys([*TEXT_LIMITS, *NUMBER_LIMITS])
        if n in there
    ]
    if "dim_addresses" in there:
        found.append(quality.check_current_address(there["dim_addresses"]))
    return together(found) if found else None
