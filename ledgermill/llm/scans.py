"""Running results along the rows of a key, which may have more rows than one task should hold.

Rows are range-partitioned by key and order, so the rows of a long key lie in neighbouring partitions. A
task runs over its rows; all it hands on is the product at its last row. The driver chains these, a row
for each task, and rows of a key that began in an earlier partition combine what came before with theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import ship_package
from ledgermill.session import written

Map = tuple[int, int | None]  # base and prime: x -> x * base + value, modulo the prime if there is one


def running(rows: DataFrame, key: str, order: list[Column], values: list[str], maps: list[Map], name: str) -> DataFrame:
    """The rows, sorted and written, with ``place``, ``power0..`` and ``product0..``.

    ``place`` counts the rows of the key from 1. Each value with its map's base is a link; ``product`` is
    the combination of all links of the key up to the row, ``power`` the base to the power of ``place``. With
    base 1 and no prime the product is a running sum. Keys are whole numbers and not null.
    """
    ship_package(rows.sparkSession)
    names = rows.columns
    at_key, at_values = names.index(key), [names.index(v) for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, held, place = TaskContext.get().partitionId(), 0, None, 0
        power, product = [1] * len(maps), [0] * len(maps)
        for batch in batches:
            keys = batch.column(at_key).to_pylist()
            links = zip(*(batch.column(k).to_pylist() for k in at_values), strict=True)
            places, powers, products = [], [], []
            for mine, link in zip(keys, links, strict=True):
                if mine != held:
                    held, place, power, product = mine, 0, [1] * len(maps), [0] * len(maps)
                place += 1
                power = [w * b % p if p else w * b for w, (b, p) in zip(power, maps, strict=True)]
                product = [(s * b + v) % p if p else s * b + v for s, v, (b, p) in zip(product, link, maps, strict=True)]
                places.append(place)
                powers.append(power)
                products.append(product)
            n = len(keys)
            added = [[part] * n, range(row, row + n), places]
            for table in (powers, products):
                added += [[r[k] for r in table] for k in range(len(maps))]
            row += n
            columns = [*batch.columns, *(pa.array(c, pa.int64()) for c in added)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *extra])

    many = range(len(maps))
    extra = ["part", "row", "place", *(f"power{k}" for k in many), *(f"product{k}" for k in many)]
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"{c} long" for c in extra])
    placed = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    local = written(placed.mapInArrow(run, kind), name)

    state = F.struct("row", key, "place", *(f"power{k}" for k in many), *(f"product{k}" for k in many))
    edges = local.groupBy("part").agg(F.min(F.struct("row", key)).alias("first"), F.max(state).alias("last"))
    carried: list[tuple] = []
    before = None  # key, place, powers and products at the end of the part before
    for edge in sorted(edges.collect(), key=lambda e: e["part"]):
        last = edge["last"]
        now = (last[key], last["place"], [last[f"power{k}"] for k in many], [last[f"product{k}"] for k in many])
        if before and before[0] == edge["first"][key]:
            carried.append((edge["part"], before[0], before[1], *before[2], *before[3]))
            if before[0] == now[0]:
                now = _combined(before, now, maps)
        before = now
    columns = [f"c_{c}" for c in ["part", key, *extra[2:]]]
    carry = rows.sparkSession.createDataFrame(carried, ", ".join(f"`{c}` long" for c in columns))
    # One row for each task at most.
    both = local.join(F.broadcast(carry), (F.col("part") == F.col("c_part")) & (F.col(key) == F.col(f"c_{key}")), "left")
    power = [_modulo(F.coalesce(F.col(f"c_power{k}"), F.lit(1)) * F.col(f"power{k}"), maps[k][1]) for k in many]
    product = [
        _modulo(F.coalesce(F.col(f"c_product{k}"), F.lit(0)) * F.col(f"power{k}") + F.col(f"product{k}"), maps[k][1])
        for k in many
    ]
    return both.select(
        *names,
        (F.col("place") + F.coalesce("c_place", F.lit(0))).alias("place"),
        *(c.alias(f"power{k}") for k, c in zip(many, power, strict=True)),
        *(c.alias(f"product{k}") for k, c in zip(many, product, strict=True)),
    )


def _modulo(column: Column, prime: int | None) -> Column:
    return column if prime is None else column % prime


def _combined(left: tuple, right: tuple, maps: list[Map]) -> tuple:
    powers = [a * b % p if p else a * b for a, b, (_, p) in zip(left[2], right[2], maps, strict=True)]
    products = [
        (a * w + b) % p if p else a * w + b for a, w, b, (_, p) in zip(left[3], right[2], right[3], maps, strict=True)
    ]
    return right[0], left[1] + right[1], powers, products
