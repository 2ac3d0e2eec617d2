"""Bronze ingestion: scan, route, tag, type, hash and compare yearly Parquet files."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.dates import moment
from ledgermill.functions.fixed_values import (
    CUSTOMER_FILE_MARK,
    CUSTOMER_PREFIX,
    METADATA_TYPES,
    OTHER_PREFIX,
    TEXT_WIDTH_DEFAULT,
    TEXT_WIDTH_FACTOR,
    TEXT_WIDTH_MAX,
    TEXT_WIDTH_MIN,
    TYPE_RULES,
    TYPE_TARGETS,
)
from ledgermill.operators.skew import row_tag, spread_join

METADATA_COLUMNS = list(METADATA_TYPES)
# a row digest is added up in pieces of four hex digits; 47 further bits of a long leave room
# for 1e14 rows per source
HASH_PIECES = 8
PIECE_DIGITS = 4
# pieces read at once: twelve digits fit a long
READ_PIECES = 3


def read_bronze(spark: SparkSession, paths: list[str], source: str = "_source_file_url") -> DataFrame:
    """All files of an entity in one scan, each row carrying the file it came from."""
    return spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias(source))


def bronze_table_name(file: Column) -> Column:
    """Bronze table of a file: crm_ for customer files, erp_ for all others."""
    base = F.regexp_replace(F.regexp_replace(file, "^.*/", ""), "[.]parquet$", "")
    crm = base.contains(CUSTOMER_FILE_MARK)
    return F.concat(F.when(crm, CUSTOMER_PREFIX).otherwise(OTHER_PREFIX), base)


def bronze_table_of(path: str) -> str:
    """The same for the path of one extract."""
    base = os.path.basename(path.rstrip("/")).removesuffix(".parquet")
    return (CUSTOMER_PREFIX if CUSTOMER_FILE_MARK in base else OTHER_PREFIX) + base


def _canonical_text(df: DataFrame) -> Column:
    # the unit separator keeps ("ab", "c") apart from ("a", "bc"), the marker NULL from ""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]
    return F.concat_ws("\u001f", *cells)


def _digits(digest: Column, piece: int) -> Column:
    """A piece of a digest as a number; pieces next to each other are read from hex together."""
    first = piece - piece % READ_PIECES
    last = min(first + READ_PIECES, HASH_PIECES)
    read = F.conv(F.substring(digest, 1 + PIECE_DIGITS * first, PIECE_DIGITS * (last - first)), 16, 10).cast("long")
    behind = 4 * PIECE_DIGITS * (last - 1 - piece)
    return F.shiftright(read, behind).bitwiseAND(F.lit((1 << 4 * PIECE_DIGITS) - 1))


def source_hash(df: DataFrame, source: str = "_source_file_url") -> DataFrame:
    """(source, rows, content hash) for every source, independent of row order.

    The MD5 digest of each row is added up piecewise, so equal contents give equal hashes,
    copies count, and a task only ever holds one running total per source.
    """
    content = df.drop(*(c for c in METADATA_COLUMNS if c != source))
    digest = F.md5(_canonical_text(content.drop(source)))
    pieces = [_digits(F.col("digest"), i) for i in range(HASH_PIECES)]
    totals = (
        content.select(F.col(source).alias("source"), digest.alias("digest"))
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.sum(piece).alias(f"p{i}") for i, piece in enumerate(pieces)),
        )
    )
    return totals.select(
        "source",
        "rows",
        F.md5(F.concat_ws("-", "rows", *(f"p{i}" for i in range(HASH_PIECES)))).alias("source_hash"),
    )


def _loaded_at() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def add_ingest_metadata(df: DataFrame, source: str = "_source_file_url") -> DataFrame:
    """Adds load time in UTC and the content hash of the row's source."""
    hashes = source_hash(df, source).withColumnRenamed("source_hash", "_source_hash")
    counts = hashes.select(F.col("source").alias("key"), "rows")
    tagged = spread_join(row_tag(df), hashes, source, "source", counts=counts)
    return tagged.select(*df.columns, _loaded_at().alias("_ingestion_timestamp"), "_source_hash")


def extract_hash(df: DataFrame, path: str) -> str | None:
    """The content hash of a frame that is one extract; NULL without rows."""
    found = source_hash(df.withColumn("_source_file_url", F.lit(path))).first()
    return found["source_hash"] if found else None


def hash_and_lengths(df: DataFrame, path: str, text_columns: list[str]) -> tuple[str | None, dict[str, int | None]]:
    """The content hash and the longest text of each column, both from one pass."""
    if not text_columns:
        return extract_hash(df, path), {}
    seen = Observation(f"lengths-{uuid.uuid4().hex}")
    longest = [F.max(F.length(F.col(f"`{c}`").cast("string"))).alias(f"l{i}") for i, c in enumerate(text_columns)]
    digest = extract_hash(df.observe(seen, *longest), path)
    if digest is None:  # without rows nothing is observed
        return None, {}
    return digest, {c: seen.get.get(f"l{i}") for i, c in enumerate(text_columns)}


def tag_extract(df: DataFrame, path: str, digest: str | None) -> DataFrame:
    """The three metadata columns of a frame that is one extract."""
    return df.withColumns(
        {
            "_source_file_url": F.lit(path),
            "_ingestion_timestamp": _loaded_at(),
            "_source_hash": F.lit(digest).cast("string"),
        }
    )


def detect_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Per source: NEW, REMOVED, CHANGED or UNCHANGED between two results of source_hash."""
    before = previous.select("source", F.col("source_hash").alias("previous_hash"))
    after = current.select("source", F.col("source_hash").alias("current_hash"))
    change = (
        F.when(F.col("previous_hash").isNull(), "NEW")
        .when(F.col("current_hash").isNull(), "REMOVED")
        .when(F.col("previous_hash") != F.col("current_hash"), "CHANGED")
        .otherwise("UNCHANGED")
    )
    return before.join(after, "source", "full_outer").select(
        "source", "previous_hash", "current_hash", change.alias("change")
    )


def ingest_summary(df: DataFrame, source: str = "_source_file_url") -> DataFrame:
    """Rows and columns per source."""
    width = len([c for c in df.columns if c not in METADATA_COLUMNS and c != source])
    return (
        df.groupBy(F.col(source).alias("source"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("columns", F.lit(width))
    )


def _dtype(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, T.IntegralType):
        return "int"
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return "float"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "string"


def _target_type(name: Column, dtype: Column, longest: Column) -> Column:
    """Target type by column name, then by type, then by text length; first hit wins."""
    picked = F
    for column, target in METADATA_TYPES.items():
        picked = picked.when(name == column, target)
    for keywords, target in TYPE_RULES:
        chosen = F.lit(target)
        if target == "DATE":
            chosen = F.when(dtype == "datetime", "DATETIME").otherwise(chosen)
        if target == "NVARCHAR(50)":
            chosen = F.when(dtype == "int", "INTEGER").otherwise(chosen)
        picked = picked.when(F.lower(name).rlike("|".join(keywords)), chosen)
    for kind, target in TYPE_TARGETS.items():
        picked = picked.when(dtype == kind, target)
    padded = F.floor(longest * F.lit(TEXT_WIDTH_FACTOR).cast("decimal(3,1)"))
    width = F.least(F.greatest(padded, F.lit(TEXT_WIDTH_MIN)), F.lit(TEXT_WIDTH_MAX))
    width = F.when(F.coalesce(longest, F.lit(0)) == 0, TEXT_WIDTH_DEFAULT).otherwise(width)
    return picked.otherwise(F.format_string("NVARCHAR(%d)", width.cast("int")))


def plain_types(df: DataFrame) -> dict[str, str]:
    """Column -> plain type."""
    return {f.name: _dtype(f.dataType) for f in df.schema.fields}


def with_targets(profile: DataFrame) -> DataFrame:
    """Adds the target type to (column, dtype, max_len)."""
    target = _target_type(F.col("column"), F.col("dtype"), F.col("max_len"))
    return profile.select("column", "dtype", "max_len", target.alias("target_type"))


def profile_types(df: DataFrame) -> DataFrame:
    """(column, dtype, max_len, target_type); lengths come from one pass over the text columns."""
    kinds = plain_types(df)
    lengths = df.agg(
        *(
            F.expr(f"cast(max(length(cast(`{n}` as string))) as int) as `{n}`")
            if kind == "string"
            else F.expr(f"cast(max(null) as int) as `{n}`")
            for n, kind in kinds.items()
        )
    ).unpivot([], list(kinds), "column", "max_len")
    dtype_of = F.expr("map(" + ", ".join(f"'{n}', '{k}'" for n, k in kinds.items()) + ")")
    return with_targets(lengths.withColumn("dtype", dtype_of[F.col("column")]))


def preprocess(df: DataFrame) -> DataFrame:
    """Booleans as 0/1, times without zone, text dates parsed (unreadable ones become NULL).

    A time of day without a date stays one; it is given a fixed day.
    """

    def column(field: T.StructField) -> Column:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.BooleanType):
            return c.cast("long")
        if isinstance(kind, T.TimestampType):
            return F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")
        dated = any(k in field.name.lower() for k in ("date", "time"))
        if isinstance(kind, T.StringType) and dated:
            return moment(c)
        return c

    return df.select(*(column(f).alias(f.name) for f in df.schema.fields))


RESCUED = "_rescued"


def rescued_map(lost: dict[str, Column], before: Column | None = None) -> Column:
    """Column name -> delivered text that was lost; NULL if none was. ``lost``: that text or NULL.

    The map is put together for rows that lost something only.
    """
    entries = F.array(*(F.struct(F.lit(n).alias("key"), c.alias("value")) for n, c in lost.items()))
    found = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())) if lost else F.create_map()
    found = found.cast("map<string,string>")
    broken = reduce(Column.__or__, (c.isNotNull() for c in lost.values()), F.lit(False))
    if before is None:
        return F.when(broken, found)
    kept = F.map_filter(before, lambda k, _: ~F.map_contains_key(found, k))
    both = F.when(before.isNull(), found).when(broken, F.map_concat(kept, found)).otherwise(before)
    return F.when(broken | (F.size(before) > 0), both)


def preprocess_rescued(df: DataFrame) -> DataFrame:
    """As :func:`preprocess`, with the text of dates that could not be read in a map column."""
    lost = {}
    for field in df.schema.fields:
        dated = any(k in field.name.lower() for k in ("date", "time"))
        if isinstance(field.dataType, T.StringType) and dated:
            given = F.col(field.name)
            lost[field.name] = F.when((F.trim(given) != "") & moment(given).isNull(), given)
    return preprocess(df.withColumn(RESCUED, rescued_map(lost)))
