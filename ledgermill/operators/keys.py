"""Surrogate keys and audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import CODEC, written

# monotonically_increasing_id keeps the partition above and the row position below this bit
POSITION_BITS = 33


def add_surrogate_key(df: DataFrame, name: str, order_by: list[str] | None = None) -> DataFrame:
    """Dense keys 1..n without a global window.

    The rows are written to the shared folder together with their partition and position, so
    the counting pass and the numbering pass see the same rows in the same places even if
    executors are lost. Every partition then starts after the rows of the partitions before
    it. With ``order_by``, which should tell all rows apart, the rows are range-partitioned
    and sorted first and the keys follow that order; without it no shuffle is added and the
    keys follow no order.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by) if order_by else df
    placed = written(ranged.withColumn("_place", F.monotonically_increasing_id()), name, CODEC)
    part = F.shiftright("_place", POSITION_BITS).alias("_part")
    # one row per partition, a number set by configuration
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + position + 1).alias(name), *df.columns)
    )


def add_audit_columns(df: DataFrame, created: str = "created_date", updated: str = "update_date") -> DataFrame:
    """Load timestamps without a time zone."""
    now = F.localtimestamp()
    return df.withColumns({created: now, updated: now})


def add_defaults(df: DataFrame, table: str) -> DataFrame:
    """Defaults of the columns a load leaves out; given values, NULLs included, stay."""
    missing = {
        "dim_addresses": {
            "is_current_address": F.lit(1),
            # open-ended while the address is current
            "end_date": F.lit(None).cast("date"),
        },
        "dim_contacts": {"is_opted_in_marketing": F.lit(0)},
    }.get(table, {})
    return df.withColumns({c: v for c, v in missing.items() if c not in df.columns}) if missing else df
