"""Data quality: violations of keys, domains, references and limits as rows.

Every check returns (rule, table_name, key, detail). Row rules of a table are tested in one scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.sources.bronze import RESCUED
from ledgermill.sources.schemas import lost_text


def _violations(df: DataFrame, table: str, key: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rows breaking any of (rule, SQL condition, SQL detail); details are spelled out for those rows only."""
    found = ", ".join(
        f"struct({broken} as broken, '{rule}' as rule, cast({detail} as string) as detail)"
        for rule, broken, detail in rules
    )
    return (
        df.where(" or ".join(f"({broken})" for _, broken, _ in rules))
        .select(
            F.lit(table).alias("table_name"),
            F.col(key).cast("string").alias("key"),
            F.expr(f"inline(array({found}))"),
        )
        .where("broken")
        .select("rule", "table_name", "key", "detail")
    )


def check_not_null(df: DataFrame, table: str, key: str, columns: list[str]) -> DataFrame:
    """Required columns without a value; detail names the column."""
    return _violations(df, table, key, [("NOT_NULL", f"`{c}` is null", f"'{c}'") for c in columns])


def check_domain(df: DataFrame, table: str, key: str, domains: dict[str, list[str]]) -> DataFrame:
    """Labels outside their domain; NULL passes."""

    def outside(column: str, allowed: list[str]) -> str:
        labels = ", ".join("'" + v.replace("'", "\\'") + "'" for v in allowed)
        return f"`{column}` not in ({labels})"

    rules = [("DOMAIN", outside(c, allowed), f"concat('{c}=', `{c}`)") for c, allowed in domains.items()]
    return _violations(df, table, key, rules)


def check_unique(df: DataFrame, table: str, columns: list[str], where: Column | None = None) -> DataFrame:
    """Natural keys held by several rows; detail counts them. ``where`` limits the rule."""
    rows = df if where is None else df.where(where)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return (
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
        .select(
            F.lit("UNIQUE").alias("rule"),
            F.lit(table).alias("table_name"),
            F.concat_ws("|", *parts).alias("key"),
            F.col("_copies").cast("string").alias("detail"),
        )
    )


def check_reference(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child keys without a parent; detail counts the child rows.

    Children are counted per key first, so a common key reaches the join once.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("child_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.select(F.col(parent_column).alias("parent_key"))
    return counted.join(parents, F.col("child_key") == F.col("parent_key"), "left_anti").select(
        F.lit("REFERENCE").alias("rule"),
        F.lit(table).alias("table_name"),
        F.col("child_key").cast("string").alias("key"),
        F.col("n").cast("string").alias("detail"),
    )


def check_current_address(addresses: DataFrame) -> DataFrame:
    """More than one current address of a type for a customer."""
    return check_unique(
        addresses, "dim_addresses", ["customer_id", "address_type"], F.col("is_current_address") == 1
    )


def check_limits(
    df: DataFrame,
    table: str,
    key: str,
    text: dict[str, int],
    numbers: dict[str, tuple[int, int]],
) -> DataFrame:
    """Text longer than allowed, and numbers that do not fit (precision, scale)."""
    rules = [
        ("TEXT_LIMIT", f"length(`{c}`) > {limit}", f"concat('{c}=', length(`{c}`))")
        for c, limit in text.items()
    ]
    for c, (precision, scale) in numbers.items():
        fits = f"try_cast(cast(`{c}` as string) as decimal({precision},{scale})) is not null"
        rules.append(("NUMBER_LIMIT", f"`{c}` is not null and not ({fits})", f"concat('{c}=', `{c}`)"))
    return _violations(df, table, key, rules)


def check_casts(df: DataFrame, table: str, key: str, spec: dict[str, list[str]]) -> DataFrame:
    """Delivered values that do not fit the type of their column; detail is column=value.

    The rows themselves are kept with a NULL, so this is where such a value is seen.
    """
    present = dict(df.dtypes)
    rules = []
    for kind, names in spec.items():
        for c in names:
            if c in present and present[c] != kind:
                given = f"trim(cast(`{c}` as string))"
                lost = f"{given} != '' and try_cast({given} as {kind}) is null"
                rules.append(("CAST_LOSS", lost, f"concat('{c}=', {given})"))
    return _violations(df, table, key, rules) if rules else df.limit(0).selectExpr(
        "'CAST_LOSS' as rule", f"'{table}' as table_name", f"cast(`{key}` as string) as key", "cast(null as string) as detail"
    )


def rescued_values(df: DataFrame, table: str, key: str, spec: dict[str, list[str]], source: str | None = None) -> DataFrame:
    """Values lost on the way to their types: (table_name, source, key, column_name, value).

    Reads the columns whose type differs, and none if all fit. Without the column ``source`` it is NULL.
    Every value is tested once: entries are spelled out as rows, and those that lost nothing dropped.
    """
    origin = F.col(source) if source and source in df.columns else F.lit(None).cast("string")
    name = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    lost = {c: (f"_lost{i}", value) for i, (c, value) in enumerate(lost_text(df, spec).items())}
    texts = [value.alias(n) for n, value in lost.values()]
    earlier = [F.col(RESCUED)] if RESCUED in df.columns else []
    rows = df.select(F.lit(table).alias("table_name"), origin.alias("source"), name.alias("key"), *texts, *earlier)
    shape = "array<struct<column_name:string,value:string,_earlier:boolean>>"
    now = [F.struct(F.lit(c).alias("c"), F.col(n).alias("v"), F.lit(False).alias("e")) for c, (n, _) in lost.items()]
    entries = F.array(*now).cast(shape)
    again = F.lit(False)
    if earlier:
        before = F.col(RESCUED)
        told = F.arrays_zip(F.map_keys(before), F.map_values(before), F.array_repeat(F.lit(True), F.size(before)))
        entries = F.concat(entries, F.when(F.size(before) > 0, told.cast(shape)).otherwise(F.array().cast(shape)))
        # what a column loses now stands for what it lost before
        again = reduce(Column.__or__, ((F.col("column_name") == c) & F.col(n).isNotNull() for c, (n, _) in lost.items()), again)
    return (
        rows.select("*", F.inline(entries))
        .where(F.when(F.col("_earlier"), ~again).otherwise(F.col("value").isNotNull()))
        .select("table_name", "source", "key", "column_name", "value")
    )


def customer_flags() -> dict[str, Column]:
    flags = ("is_invalid_email_format", "registered_expired_document", "registered_expired_visa")
    return {n: F.col(n) == 1 for n in flags}


def account_flags() -> dict[str, Column]:
    return {
        "duplicate_account_number": F.col("account_number_count") > 1,
        "duplicate_account_id": F.col("account_id_count") > 1,
        "duplicate_card_number": F.col("card_number_count") > 1,
        "over_one_primary_acc": F.col("over_one_primary_acc") == 1,
        "invalid_date": F.col("invalid_date") == 1,
    }


def counters(flags: dict[str, Column]) -> list[Column]:
    """How many rows each flag marks."""
    return [F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias(n) for n, c in flags.items()]


def quality_summary(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """(flag, flagged, rows) for the quality flags of the two staging tables."""

    def counted(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
        totals = df.agg(F.count(F.lit(1)).alias("rows"), *counters(flags))
        rows = [F.struct(F.lit(n).alias("flag"), F.col(n).alias("flagged"), F.col("rows")) for n in flags]
        return totals.select(F.inline(F.array(*rows)))

    return counted(customers, customer_flags()).unionByName(counted(accounts, account_flags()))
