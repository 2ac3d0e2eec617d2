"""Generic measures the gold metrics are made of: growth, ratio, average and product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    return c.cast("double")


def quotient(numerator: Column, denominator: Column) -> Column:
    """Division in double precision; a zero denominator gives NULL."""
    return number(numerator) / F.nullif(number(denominator), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    return number(numerator) * 100 / F.nullif(number(denominator), F.lit(0.0))


def period_start(c: Column, unit: str) -> Column:
    return F.date_trunc(unit, c).cast("date")


def shift_period(c: Column, unit: str, steps: int) -> Column:
    """The period that lies ``steps`` units later."""
    if unit in ("day", "week"):
        return F.date_add(c, steps * (7 if unit == "week" else 1))
    return F.add_months(c, steps * {"month": 1, "quarter": 3, "year": 12}[unit])


def growth_rate(df: DataFrame, period: str, value: str, unit: str = "month", back: int = 1) -> DataFrame:
    """Percent change against the period ``back`` units earlier: (period, value, previous_value, growth_pct).

    Takes one row per period. Each row is also booked as the previous value of a later
    period and both meet in one aggregation, so neither a self join nor a global window is
    needed. A missing or zero earlier value gives NULL.
    """
    none = F.lit(None).cast(df.schema[value].dataType)
    booked = F.array(
        F.struct(F.col(period), F.col(value).alias("current"), none.alias("earlier")),
        F.struct(
            shift_period(F.col(period), unit, back).alias(period),
            none.alias("current"),
            F.col(value).alias("earlier"),
        ),
    )
    met = (
        df.select(F.inline(booked))
        .groupBy(period)
        .agg(F.max("current").alias(value), F.max("earlier").alias("previous_value"))
        .where(F.col(value).isNotNull())
    )
    change = percent(F.col(value) - F.col("previous_value"), F.col("previous_value"))
    return met.withColumn("growth_pct", change)


def ratio(
    df: DataFrame, keys: list[str], numerator: Column, denominator: Column, name: str = "pct"
) -> DataFrame:
    """Share of two sums in percent, overall or per key: (keys, numerator, denominator, name)."""
    sums = df.groupBy(*keys).agg(
        F.coalesce(F.sum(numerator), F.lit(0)).alias("numerator"),
        F.coalesce(F.sum(denominator), F.lit(0)).alias("denominator"),
    )
    return sums.withColumn(name, percent(F.col("numerator"), F.col("denominator")))


def average(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Mean of the known values, overall or per key."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("known"))
    return sums.select(*keys, "known", quotient(F.col("total"), F.col("known")).alias(name))


def product(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Product of two measured columns, row by row."""
    return df.withColumn(name, number(F.col(left)) * number(F.col(right)))


def count_if(condition: Column) -> Column:
    """1 where the condition holds, 0 otherwise; meant to be summed."""
    return F.when(condition, 1).otherwise(0)


def running_total(df: DataFrame, period: str, value: str, name: str) -> DataFrame:
    """Running sum over periods.

    Takes one row per calendar period. The calendar bounds the window: ten thousand years
    hold at most 3.7 million days.
    """
    so_far = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(so_far))
