"""Equi joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rows of one key that a single task may hold; larger keys are cut into slices
SLICE_ROWS = 1_000_000
# a slice holds at least this share of all rows, so fewer keys than this are ever cut
SLICED_KEYS = 10_000
# rows with a NULL key never match and are only spread
NULL_SLICES = 1 << 20


def row_tag(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows of a scan.

    Taken directly on a scan the number is stable when a task runs again, so it can pick a
    slice for a row, identical copies included. A frame that comes out of a shuffle should be
    written first.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def distinct_rows(df: DataFrame) -> DataFrame:
    """The distinct rows of a wide table that holds few copies.

    Rows are dealt by their content first. A task then looks for copies in its share of the shuffle, and does
    not collect all wide rows of its input split before the shuffle, which combines next to nothing.
    """
    return df.repartition(*df.columns).distinct()


def key_counts(df: DataFrame, key: Column, name: str = "key", rows: str = "rows") -> DataFrame:
    """Rows per key, combined before the shuffle."""
    return df.where(key.isNotNull()).groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias(rows))


def hot_keys(counts: DataFrame, slice_rows: int) -> DataFrame:
    """(_hot_key, _slices) of every key larger than a slice, from (key, rows).

    The size of a slice is ``slice_rows``, or 1/SLICED_KEYS of all rows if that is more; fewer
    than SLICED_KEYS keys can exceed it, which bounds the list without leaving any out.
    """
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    size = F.greatest(F.lit(slice_rows).cast("double"), total / F.lit(float(SLICED_KEYS)))
    return counts.where(F.col("key").isNotNull() & (F.col("rows") > size)).select(
        F.col("key").alias("_hot_key"), F.ceil(F.col("rows") / size).cast("int").alias("_slices")
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    counts: DataFrame | None = None,
    row: str = "_row",
    slice_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` on one key; hot keys of ``left`` are cut into slices.

    ``left`` needs the ``row`` column of :func:`row_tag`. The rows of ``left`` per key come from
    ``counts`` (key, rows) or are counted here; it is one plan, and nothing runs before it does.
    A hot key gets one slice per ``slice_rows`` rows: its left rows are dealt over the slices and
    its right rows are repeated once per slice, so each pair meets exactly once. Left rows with a
    NULL key never match and are only spread. The right key is dropped from the result.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    counted = key_counts(left, F.col(left_key)) if counts is None else counts
    # bounded: fewer than SLICED_KEYS rows
    hot = F.broadcast(hot_keys(counted, slice_rows or SLICE_ROWS))
    keyed = right.withColumnRenamed(right_key, "_right_key")
    own = F.pmod(F.col(row), F.coalesce("_slices", F.lit(1)))
    spread = F.when(F.col(left_key).isNull(), F.pmod(F.col(row), F.lit(NULL_SLICES))).otherwise(own)
    dealt = (
        left.join(hot, F.col(left_key) == F.col("_hot_key"), "left")
        .withColumn("_slice", spread.cast("int"))
        .drop("_hot_key", "_slices")
    )
    repeated = (
        keyed.join(hot, F.col("_right_key") == F.col("_hot_key"), "left")
        .withColumn(
            "_right_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))
        )
        .drop("_hot_key", "_slices")
    )
    same = (F.col(left_key) == F.col("_right_key")) & (F.col("_slice") == F.col("_right_slice"))
    return dealt.join(repeated, same, how).drop("_right_key", "_slice", "_right_slice")
