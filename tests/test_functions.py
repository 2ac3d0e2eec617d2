import datetime as dt

from pyspark.sql import functions as F

from ledgermill.functions import contact, dates, text
from ledgermill.functions.fixed_values import (
    COMPANY_AGE_ABOVE,
    COMPANY_AGE_BANDS,
    INDIVIDUAL_AGE_ABOVE,
    INDIVIDUAL_AGE_BANDS,
)


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_norm_strips_blanks_only(spark):
    assert column(spark, [" ab ", "\tx ", "", None], "string", text.norm) == ["AB", "\tX", "", None]


def test_label_and_yes_flag(spark):
    assert column(spark, [" debit_card", None], "string", text.label) == ["DEBIT CARD", None]
    assert column(spark, ["yes ", "No", None], "string", text.yes_flag) == [1, 0, 0]


def test_concat_text_reads_null_as_empty(spark):
    assert column(spark, ["a", None], "string", lambda c: text.concat_text(F.lit("+"), c)) == ["+a", "+"]


def test_json_list_is_lenient(spark):
    values = [
        "['A', None, 'B']",
        '["O\'Brien"]',
        "['Nonesuch Ltd', None, None]",
        "[]",
        "broken",
        None,
    ]
    assert column(spark, values, "string", lambda c: text.json_list(c, "string")) == [
        ["A", None, "B"],
        ["O'Brien"],
        ["Nonesuch Ltd", None, None],
        [],
        None,
        None,
    ]


def test_json_fields_of_bad_text_are_null(spark):
    out = column(spark, ['{"a": "1"}', "no json", None], "string", lambda c: text.json_fields(c, ["a"])["a"])
    assert out == ["1", None, None]


def test_bands(spark):
    ages = [18, 24, 25, 34, 44, 54, 64, 65, None]
    out = column(spark, ages, "int", lambda c: text.band(c, INDIVIDUAL_AGE_BANDS, INDIVIDUAL_AGE_ABOVE))
    assert out == [
        "YOUNG ADULT",
        "YOUNG ADULT",
        "EARLY CAREER",
        "EARLY CAREER",
        "ESTABLISHED PROFESSIONAL",
        "MID-CAREER",
        "PRE-RETIREMENT",
        "RETIREES",
        "RETIREES",
    ]
    firms = column(
        spark,
        [0, 1, 2, 3, 5, 6, 20, 50, 51],
        "int",
        lambda c: text.band(c, COMPANY_AGE_BANDS, COMPANY_AGE_ABOVE),
    )
    assert firms[0] == "STARTUP" and firms[3] == firms[4] == "3-5 YEARS OLD"
    assert firms[-2:] == ["21-50 YEARS OLD", "OVER 50 YEARS OLD"]


def test_year_gap_counts_year_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2019, 12, 31), dt.date(2020, 1, 1))], "a date, b date")
    assert df.select(dates.year_gap(F.col("a"), F.col("b"))).first()[0] == 1


def test_birth_dates_move_by_a_century(spark):
    entry = F.lit(dt.date(2020, 5, 1))
    born = [dt.date(2068, 2, 29), dt.date(1890, 3, 1), dt.date(1990, 1, 1), dt.date(1900, 7, 1), None]
    assert column(spark, born, "date", lambda c: dates.fix_birth_date(c, entry)) == [
        dt.date(1968, 2, 29),
        dt.date(1990, 3, 1),
        dt.date(1990, 1, 1),
        dt.date(1900, 7, 1),
        None,
    ]
    # 29 February moves to 28 February where the century year is common
    assert column(spark, [dt.date(2000, 2, 29)], "date", lambda c: dates.fix_birth_date(c, F.lit(dt.date(1990, 1, 1)))) == [
        dt.date(1900, 2, 28)
    ]


def test_time_text(spark):
    assert column(spark, ["09:05:00", " 23:59:59", "nope", None], "string", dates.time_text) == [
        "09:05:00",
        "23:59:59",
        None,
        None,
    ]


def test_address_parts_count_from_the_right(spark):
    given = [
        "1 Main Rd, City, Gauteng, South Africa",
        "1 Oak St, City, Western Cape",
        "Durban, KwaZulu-Natal",
        "Flat 1, 1 High St, Leeds, Yorkshire, UK",
        "1 Main Rd,,Gauteng, South Africa",
        "1 St. Main Rd, City, Gauteng",
        "alone",
        "",
        None,
    ]

    def split(c):
        fields = contact.address_fields(c, contact.address_parts(c))
        return F.struct(*(v.alias(n) for n, v in fields.items()))

    assert [tuple(r) for r in column(spark, given, "string", split)] == [
        ("1 Main Rd", " City", " Gauteng", " South Africa"),
        ("1 Oak St", " City", " Western Cape", ""),
        (None, "Durban", " KwaZulu-Natal", ""),
        (None, None, None, None),
        ("1 Main Rd", None, "Gauteng", " South Africa"),
        (" Main Rd", " City", " Gauteng", ""),
        (None, None, "alone", ""),
        (None, None, None, ""),
        (None, None, None, ""),
    ]


def test_default_country(spark):
    df = spark.createDataFrame(
        [("", " gauteng"), (None, "LIMPOPO"), ("", "Ile"), (" france ", "GAUTENG"), (None, None)],
        "country string, province string",
    )
    out = [r[0] for r in df.select(contact.default_country(F.col("country"), F.col("province"))).collect()]
    assert out == ["SOUTH AFRICA", "SOUTH AFRICA", "", "FRANCE", None]


def test_bad_email_passes_missing_addresses(spark):
    assert column(spark, ["a@b.c", "bad.email", "x@y", None], "string", contact.bad_email) == [0, 1, 1, 0]


def test_phone_of_local_citizens(spark):
    df = spark.createDataFrame(
        [("0821", "ZA"), ("821", "za "), ("+441", "ZA"), ("0821", "GB"), ("821", None), (None, "ZA")],
        "phone string, citizenship string",
    )
    out = [r[0] for r in df.select(contact.normalise_phone(F.col("phone"), F.col("citizenship"))).collect()]
    assert out == ["+27821", "+27821", "+441", "0821", "821", None]
