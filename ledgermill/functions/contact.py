"""Address, phone and e-mail functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.fixed_values import (
    EMAIL_PATTERN,
    LONG_ADDRESS_PATTERN,
    ZA_COUNTRY_CODE,
    ZA_COUNTRY_NAME,
    ZA_DIAL_PREFIX,
    ZA_PROVINCES,
)
from ledgermill.functions.text import blank, flag, from_right, norm

MAX_ADDRESS_PARTS = 4


def has_country(address: Column) -> Column:
    """Three or more commas: the last part names the country."""
    return address.like(LONG_ADDRESS_PATTERN)


def address_parts(address: Column) -> Column:
    """Comma- or dot-separated parts; more than four give NULL."""
    parts = F.split(F.translate(address, ",", "."), "[.]")
    return F.when(F.size(parts) <= MAX_ADDRESS_PARTS, parts)


def address_fields(address: Column, parts: Column) -> dict[str, Column]:
    """Street, city, province and country, counted from the right; empty parts give NULL.

    An address without a country has empty text there, and its last part is the province.
    """
    long = has_country(address)
    return {
        "street_name": F.when(long, from_right(parts, 4)).otherwise(from_right(parts, 3)),
        "city": F.when(long, from_right(parts, 3)).otherwise(from_right(parts, 2)),
        "province": F.when(long, from_right(parts, 2)).otherwise(from_right(parts, 1)),
        "country": F.when(long, from_right(parts, 1)).otherwise(""),
    }


def default_country(country: Column, province: Column) -> Column:
    """Country in standard form; a blank one in a known province becomes South Africa."""
    local = blank(country) & norm(province).isin(ZA_PROVINCES)
    return F.when(local, ZA_COUNTRY_NAME).otherwise(norm(country))


def bad_email(email: Column) -> Column:
    """1 when the text has no ``@`` followed by a dot; a missing address is not bad."""
    return flag(~email.like(EMAIL_PATTERN))


def normalise_phone(phone: Column, citizenship: Column) -> Column:
    """International form of the numbers of South African citizens; others stay as given."""
    local = norm(citizenship) == ZA_COUNTRY_CODE
    trunk = phone.startswith("0")
    return (
        F.when(local & trunk, F.regexp_replace(phone, "^0", ZA_DIAL_PREFIX))
        .when(local & ~phone.startswith("+"), F.concat(F.lit(ZA_DIAL_PREFIX), phone))
        .otherwise(phone)
    )
