"""Types of an entity over all its yearly extracts.

Each extract gives a target type for every column (the rules of ``bronze.profile_types``). The registry
holds the least type that takes the values of all years; it is kept in the manifest with the tables and
is the schema in which extracts are written and years are read together.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.sources import bronze
from ledgermill.sources.bronze import METADATA_COLUMNS, RESCUED
from ledgermill.sources.layers import Lake
from ledgermill.sources.schemas import conform, rescued

# digits before the point, and characters as text
WHOLE_DIGITS = {"BIT": 1, "INTEGER": 10, "BIGINT": 19}
TEXT_SIZES = {"BIT": 1, "INTEGER": 11, "BIGINT": 20, "DATE": 10, "DATETIME": 26}
SPARK_TYPES = {"BIT": "boolean", "INTEGER": "bigint", "BIGINT": "bigint", "DATE": "date", "DATETIME": "timestamp_ntz"}
MOST_DIGITS = 38


def entity_of(table: str) -> str:
    """The table name without its year."""
    return re.sub(r"_\d{4}$", "", table)


def _arguments(kind: str) -> tuple[int, ...]:
    return tuple(int(n) for n in re.findall(r"\d+", kind))


def _text_size(kind: str) -> int:
    if kind.startswith("DECIMAL"):
        return _arguments(kind)[0] + 2
    return TEXT_SIZES[kind] if kind in TEXT_SIZES else _arguments(kind)[0]


def wider(one: str, other: str) -> str:
    """The least target type that holds the values of both.

    Whole numbers and decimals meet in a decimal with enough digits on both sides of the point (as text
    beyond 38), dates and times in DATETIME, all else in text of the larger width; TEXT holds everything.
    """
    if one == other:
        return one
    kinds = {one, other}
    if "TEXT" in kinds:
        return "TEXT"
    if kinds == {"DATE", "DATETIME"}:
        return "DATETIME"
    if kinds <= set(WHOLE_DIGITS):
        return max(kinds, key=WHOLE_DIGITS.__getitem__)
    if all(k in WHOLE_DIGITS or k.startswith("DECIMAL") for k in kinds):
        sizes = [(WHOLE_DIGITS[k], 0) if k in WHOLE_DIGITS else _arguments(k) for k in kinds]
        scale = max(s for _, s in sizes)
        digits = max(p - s for p, s in sizes) + scale
        if digits <= MOST_DIGITS:
            return f"DECIMAL({digits},{scale})"
    return f"NVARCHAR({max(_text_size(k) for k in kinds)})"


def merge(types: list[dict[str, str]]) -> dict[str, str]:
    """Column -> type over several extracts.

    Columns stand in the order in which they first appear and are spelled as there; case does not tell
    columns apart.
    """
    merged: dict[str, str] = {}
    spelling: dict[str, str] = {}
    for extract in types:
        for column, kind in extract.items():
            name = spelling.setdefault(column.lower(), column)
            merged[name] = wider(merged[name], kind) if name in merged else kind
    return merged


def spark_type(kind: str) -> str:
    if kind.startswith("DECIMAL"):
        return kind.lower()
    return SPARK_TYPES.get(kind, "string")


def stored_types(lake: Lake, but: set[str] = frozenset()) -> dict[str, dict[str, str]]:
    """Entity -> its types by the manifest, without the tables named.

    A table keeps the types in which it was written, so the types of an entity never become narrower
    while one of its tables is there.
    """
    found: dict[str, list[dict[str, str]]] = {}
    for name, entry in sorted(lake.manifest()[1].items()):
        layer, table = name.split("/", 1)
        if layer == "bronze" and entry.get("types") and table not in but:
            found.setdefault(entity_of(table), []).append(dict(entry["types"]))
    return {entity: merge(types) for entity, types in found.items()}


def as_registered(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The columns of the registry in its types; missing ones are NULL, text that a cast loses is rescued."""
    spec: dict[str, list[str]] = {}
    for name, kind in types.items():
        spec.setdefault(spark_type(kind), []).append(name)
    spelling = {name.lower(): name for name in types}
    df = df.withColumnsRenamed({c: spelling[c.lower()] for c in df.columns if c.lower() in spelling})
    held = df.withColumn(RESCUED, rescued(df, spec))
    kept = [c for c in METADATA_COLUMNS if c in df.columns]
    cast = conform(held, {**spec, "map<string,string>": [RESCUED]})
    return cast.select(*types, *kept, RESCUED)


def profile_extract(raw: DataFrame, path: str) -> tuple[str | None, dict[str, str]]:
    """Content hash and types of one extract, both from one pass over it."""
    kinds = bronze.plain_types(bronze.preprocess(raw))
    digest, longest = bronze.hash_and_lengths(raw, path, [c for c, kind in kinds.items() if kind == "string"])
    rows = [(c, kind, longest.get(c)) for c, kind in kinds.items()]
    named = raw.sparkSession.createDataFrame(rows, "column string, dtype string, max_len int")
    return digest, {r["column"]: r["target_type"] for r in bronze.with_targets(named).collect()}


def type_registry(lake: Lake) -> DataFrame:
    """``entity, column, target_type`` of all entities loaded with types."""
    rows = [(entity, c, kind) for entity, types in stored_types(lake).items() for c, kind in types.items()]
    return lake.spark.createDataFrame(rows, "entity string, column string, target_type string")


def read_entity(lake: Lake, entity: str) -> DataFrame:
    """All years of an entity in one schema, with the table as ``_table``; a year loaded narrower is cast."""
    types = stored_types(lake).get(entity)
    if types is None:
        raise ValueError(f"no table of {entity} was loaded with types")
    tables = [n.split("/", 1)[1] for n, e in sorted(lake.manifest()[1].items()) if n.startswith("bronze/") and e.get("types")]
    years = [
        as_registered(lake.read("bronze", t), types).withColumn("_table", F.lit(t)) for t in tables if entity_of(t) == entity
    ]
    return reduce(DataFrame.unionByName, years)
