"""Text standardisation and delimited or JSON-like lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(c: Column) -> Column:
    """Upper case without surrounding blanks; tabs stay."""
    return F.upper(F.trim(c))


def label(c: Column) -> Column:
    """Code such as ``debit_card`` as the label ``DEBIT CARD``."""
    return F.translate(norm(c), "_", " ")


def yes_flag(c: Column) -> Column:
    """1 for any spelling of YES, else 0 (also for NULL)."""
    return F.when(norm(c) == "YES", 1).otherwise(0)


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def concat_text(*parts: Column) -> Column:
    """Concatenation that reads NULL as empty text."""
    return F.concat_ws("", *parts)


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def split_list(c: Column, separator: str = ";") -> Column:
    """Delimited text as an array; empty text gives one empty element, NULL gives NULL."""
    return F.split(c, f"[{separator}]")


def from_right(parts: Column, position: int) -> Column:
    """Element counted from the right (1 = last); absent or empty elements give NULL."""
    return F.nullif(F.try_element_at(parts, F.lit(-position)), F.lit(""))


def _json_nulls(c: Column) -> Column:
    # a bare None token, not the letters inside a quoted name
    return F.regexp_replace(c, r"([\[,:]\s*)None(?=\s*[,\]}])", "$1null")


def json_list(c: Column, element: str) -> Column:
    """Single- or double-quoted JSON-like array; malformed text gives NULL."""
    return F.from_json(_json_nulls(c), f"array<{element}>")


def json_fields(c: Column, fields: list[str]) -> Column:
    """Scalar text fields of a JSON object as a struct; malformed text gives NULL fields."""
    return F.from_json(c, ", ".join(f"{f} string" for f in fields))


def band(c: Column, bands: list[tuple[int, str]], above: str) -> Column:
    """Label of the first band whose upper end is not below the value; NULL counts as above."""
    picked = F
    for upper, name in bands:
        picked = picked.when(c <= upper, name)
    return picked.otherwise(above)


def any_of(conditions: list[Column]) -> Column:
    """Disjunction with SQL three-valued logic."""
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
