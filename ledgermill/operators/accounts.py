"""Account cleaning: bronze rows to staging rows, one to one for known customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.fixed_values import DATE_ORDER
from ledgermill.functions.text import any_of, flag, from_right, label, norm, split_list
from ledgermill.operators.skew import key_counts, row_tag, spread_join
from ledgermill.sources.schemas import ACCOUNTS, conform

# --- fixed values -----------------------------------------------------------------------

STANDARD_TEXT = ["customer_id", "account_type", "account_status", "account_tier", "statement_frequency"]
CODE_TEXT = ["account_purpose", "status_reason", "card_type", "opening_channel"]
# bronze name -> staging name
RENAMED = {
    "opening_date": "account_opening_date",
    "approval_date": "account_approval_date",
    "status_change_date": "account_status_change_date",
    "closure_date": "account_closing_date",
    "status_reason": "account_status_change_reason",
    "opening_channel": "account_opening_channel",
}


def _with_row(df: DataFrame) -> DataFrame:
    return df if "_row" in df.columns else row_tag(df)


def add_duplicate_counts(
    df: DataFrame, slice_rows: int | None = None, counted_on: DataFrame | None = None
) -> DataFrame:
    """Adds account_number_count, account_id_count and card_number_count.

    Both account counters are taken per account number. The counts are combined before the
    shuffle, and only keys that occur more than once are joined back: where duplicates are
    few, Spark broadcasts them and the accounts are not shuffled at all. A missing number
    counts 0; its account ids are counted together. ``counted_on`` holds the same rows before any
    join, where counting them costs a scan of two columns.
    """
    tagged = _with_row(df)
    number, card = F.col("account_number"), F.col("card_number")
    scan = df if counted_on is None else counted_on
    by_number = (
        scan.where(number.isNotNull())
        .groupBy("account_number")
        .agg(
            F.count(F.lit(1)).alias("account_number_count"),
            F.count("account_id").alias("account_id_count"),
        )
    )
    by_card = key_counts(scan, card, "card_number", "card_number_count")
    counted = tagged
    for counts, key, rows in (
        (by_number, "account_number", "account_number_count"),
        (by_card, "card_number", "card_number_count"),
    ):
        repeated = counts.where(F.col(rows) > 1)
        sizes = repeated.select(F.col(key).alias("key"), F.col(rows).alias("rows"))
        counted = spread_join(counted, repeated, key, key, counts=sizes, slice_rows=slice_rows)
    # one row: the account ids that carry no account number
    unnumbered = scan.where(number.isNull()).agg(F.count("account_id")).scalar()
    has_id = F.col("account_id").isNotNull().cast("long")
    return counted.withColumns(
        {
            "account_number_count": F.when(number.isNull(), 0).otherwise(
                F.coalesce("account_number_count", F.lit(1))
            ),
            "account_id_count": F.when(number.isNull(), unnumbered).otherwise(
                F.coalesce("account_id_count", has_id)
            ),
            "card_number_count": F.when(card.isNull(), 0).otherwise(F.coalesce("card_number_count", F.lit(1))),
        }
    ).select(*df.columns, "account_number_count", "account_id_count", "card_number_count")


def primary_counts(df: DataFrame) -> DataFrame:
    """Per customer: rows and the number of primary accounts."""
    return (
        df.where(F.col("customer_id").isNotNull())
        .groupBy(norm(F.col("customer_id")).alias("customer_key"))
        .agg(F.sum("is_primary_account").alias("primary_acc_count"), F.count(F.lit(1)).alias("rows"))
    )


def add_primary_sanity(df: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """Adds primary_acc_count per customer and over_one_primary_acc."""
    keyed = _with_row(df).withColumn("_customer", norm(F.col("customer_id")))
    primaries = primary_counts(df)
    sizes = primaries.select(F.col("customer_key").alias("key"), "rows")
    joined = spread_join(
        keyed, primaries, "_customer", "customer_key", counts=sizes, slice_rows=slice_rows
    )
    # one row: the primary accounts that carry no customer
    unowned = df.where(F.col("customer_id").isNull()).agg(F.sum("is_primary_account")).scalar()
    joined = joined.withColumn(
        "primary_acc_count",
        F.when(F.col("customer_id").isNull(), unowned).otherwise(F.col("primary_acc_count")),
    )
    return joined.withColumn("over_one_primary_acc", flag(F.col("primary_acc_count") > 1)).select(
        *df.columns, "primary_acc_count", "over_one_primary_acc"
    )


def flag_date_sequence(df: DataFrame, order: dict[str, list[str]] = DATE_ORDER) -> DataFrame:
    """Adds invalid_date: some date lies after one that must not precede it.

    Missing dates violate nothing.
    """
    late = any_of([F.col(first) > F.col(then) for first, others in order.items() for then in others])
    return df.withColumn("invalid_date", flag(late))


def flag_missing_status_date(df: DataFrame) -> DataFrame:
    """Adds missing_status_change_date: a changed status without the date of the change."""
    changed = norm(F.col("account_status")) != "ACTIVE"
    return df.withColumn(
        "missing_status_change_date", flag(changed & F.col("status_change_date").isNull())
    )


def explode_joint(df: DataFrame) -> DataFrame:
    """One row per joint holder; no list gives a NULL row, an empty list an empty holder."""
    holder = F.explode_outer(split_list(F.col("linked_joint_accounts")))
    return df.withColumn("joint_customer_id", holder).withColumn(
        "joint_customer_id", norm(F.col("joint_customer_id"))
    )


def explode_products(df: DataFrame) -> DataFrame:
    """One row per bundled product."""
    product = F.explode_outer(split_list(F.col("bundled_products")))
    return df.withColumn("bundled_product", product).withColumn(
        "bundled_product", label(F.col("bundled_product"))
    )


def explode_beneficiaries(df: DataFrame) -> DataFrame:
    """One row per beneficiary: name, relationship and share.

    The share is a decimal fraction (60% gives 0.60); dividing whole numbers would turn every
    share below 100% into 0. More than four fields, or an empty field, give NULL.
    """
    fields = F.split(F.col("_beneficiary"), "[|]")
    usable = F.when(F.size(fields) <= 4, fields)
    percent = F.trim(F.replace(from_right(usable, 1), F.lit("%"), F.lit("")))
    return (
        df.withColumn("_beneficiary", F.explode_outer(split_list(F.col("beneficiaries"))))
        .withColumns(
            {
                "beneficiary_name": from_right(usable, 3),
                "beneficiary_relationship": from_right(usable, 2),
                "beneficiary_percentage": (percent.try_cast("decimal(10,4)") / 100).try_cast("decimal(5,2)"),
            }
        )
        .drop("_beneficiary")
    )


def registrations(fact_customers: DataFrame) -> DataFrame:
    """(customer_key, _registered): the registration dates of an id, each with its number of customers.

    A list has one entry per calendar day at most, however many customers share the id.
    """
    dated = fact_customers.select(norm(F.col("customer_id")).alias("customer_key"), "customer_registration_date")
    each = dated.where(F.col("customer_key").isNotNull()).groupBy(*dated.columns).agg(F.count(F.lit(1)).alias("_customers"))
    told = F.struct("customer_registration_date", "_customers")
    return each.groupBy("customer_key").agg(F.collect_list(told).alias("_registered"))


def join_customers(
    df: DataFrame,
    fact_customers: DataFrame,
    slice_rows: int | None = None,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Adds the primary-account counters and _registered of the customer id; unknown customers drop out.

    Both come from one row per customer id, so accounts are joined once and none is repeated.
    """
    primaries = primary_counts(df if counted_on is None else counted_on)
    keyed = _with_row(df).withColumn("_customer", norm(F.col("customer_id")))
    joined = spread_join(
        keyed,
        primaries.join(registrations(fact_customers), "customer_key"),
        "_customer",
        "customer_key",
        how="inner",
        counts=primaries.select(F.col("customer_key").alias("key"), "rows"),
        slice_rows=slice_rows,
    )
    return joined.withColumn("over_one_primary_acc", flag(F.col("primary_acc_count") > 1)).drop("_customer", "rows")


def per_customer(joined: DataFrame) -> DataFrame:
    """One row per account and customer of its id: customer_registration_date, and _first for one row of an account."""
    dates = joined.select("*", F.posexplode("_registered").alias("_date", "_of"))
    copies = dates.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_of._customers"))).alias("_copy"))
    columns = [c for c in joined.columns if c not in ("_registered", "over_one_primary_acc")]
    return copies.select(
        *columns,
        "_of.customer_registration_date",
        "over_one_primary_acc",
        ((F.col("_date") == 0) & (F.col("_copy") == 1)).alias("_first"),
    )


def first_copies(stg: DataFrame) -> DataFrame:
    """One staging row per account row: several customers of one id give rows that differ in invalid_date alone."""
    return stg.where("_first") if "_first" in stg.columns else stg


def join_registration(
    df: DataFrame,
    fact_customers: DataFrame,
    slice_rows: int | None = None,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Adds the primary-account counters and the registration date; unknown customers drop out.

    An account comes once per customer of its id. ``counted_on`` holds the same rows before any join.
    """
    return per_customer(join_customers(df, fact_customers, slice_rows, counted_on)).drop("_first")


def clean_text(df: DataFrame) -> DataFrame:
    cleaned = {c: norm(F.col(c)) for c in STANDARD_TEXT} | {c: label(F.col(c)) for c in CODE_TEXT}
    return df.withColumns(cleaned)


def standardise(df: DataFrame) -> DataFrame:
    return clean_text(df).withColumnsRenamed(RENAMED)


def clean_accounts(
    bronze: DataFrame, fact_customers: DataFrame, slice_rows: int | None = None, mark_copies: bool = False
) -> DataFrame:
    """Staging accounts: one row per bronze account and customer of its id, lists still encoded.

    Texts are cleaned before an account is repeated for the customers that share its id. With ``mark_copies``
    the column _first tells one row of every account, for builders whose tables hold no copies.
    """
    rows = conform(bronze, ACCOUNTS)
    staged = (
        row_tag(rows)
        .transform(add_duplicate_counts, slice_rows, rows)
        .transform(join_customers, fact_customers, slice_rows, rows)
        .transform(clean_text)
        .transform(per_customer)
        .transform(flag_date_sequence)
        .withColumnsRenamed(RENAMED)
        .drop("_row", "customer_registration_date")
    )
    return staged if mark_copies else staged.drop("_first")
