"""Unit tables for the column builders (semantics list of the survey, §0)."""

import datetime as dt

from pyspark.sql import functions as F

from stratum.functions.normalize import (fold, parse_amount, parse_date, parse_date_gated,
                                         phone_digits, prefix_lookup, recode)
from stratum.plans import transactions, users


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_parse_amount_european_convention(spark):
    values = ["1.234,56", "12,75", "12.25", "1,234.56", "1,234", "abc", "-5.00", "999.00", None,
              "0", "12.345,50"]
    got = one_col(spark, values, parse_amount)
    assert got == [1234.56, 12.75, 12.25, 1.23456, 1.234, None, -5.0, 999.0, None, 0.0, 12345.5]


def test_parse_amount_nan_and_infinity_pass_as_doubles(spark):
    got = one_col(spark, ["NaN", "Infinity"], parse_amount)
    assert got[0] != got[0]  # NaN
    assert got[1] == float("inf")


def test_parse_amount_numeric_input(spark):
    got = one_col(spark, [12.5, None], parse_amount, "double")
    assert got == [12.5, None]


def test_fold_trims_spaces_only(spark):
    got = one_col(spark, [" Pago ", "\tWEB", "APP\n", None], fold)
    assert got == ["pago", "\tweb", "app\n", None]


def test_recode_is_one_simultaneous_lookup(spark):
    m = transactions.CURRENCY_ALIASES
    aliases = sorted(m)
    got = one_col(spark, [*aliases, "unlisted", None], lambda c: recode(c, m))
    assert got == [*[m[a] for a in aliases], "unlisted", None]


def test_parse_date_strict_formats(spark):
    values = ["2024-01-05", "31/12/2024", "2024-02-30", "31-12-2023", "2024-1-5", " 2024-01-05",
              "2024-01-05 10:00:00", None, "17/05/2023"]
    got = one_col(spark, values, parse_date)
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 12, 31), None, None, None, None, None, None,
                   dt.date(2023, 5, 17)]


def test_parse_date_gated_rejects_impossible_and_unshaped(spark):
    values = ["15/03/2024", "2024-03-15", "31/02/2024", "2024/01/01", "+12024-01-01", None]
    got = one_col(spark, values, lambda c: parse_date_gated(c, users.DATE_SHAPES))
    assert got == [dt.date(2024, 3, 15), dt.date(2024, 3, 15), None, None, None, None]


def test_phone_digits_and_country_prefix(spark):
    df = spark.createDataFrame([("+51 999-000123",), ("+51 ext abc",), ("(52) 0000000001",),
                                ("+1 (555) 000-11122",), ("5",)], "phone string")
    letters = F.col("phone").rlike("[A-Za-z]")
    clean = phone_digits("phone", letters)
    rows = df.select(clean.alias("d"), prefix_lookup(clean, users.PHONE_PREFIXES, "UNKNOWN").alias("c")).collect()
    assert [(r.d, r.c) for r in rows] == [
        ("51999000123", "PE"), (None, "UNKNOWN"), ("520000000001", "MX"),
        ("1555000111 22".replace(" ", ""), "UNKNOWN"), ("5", "UNKNOWN")]


def test_prefix_lookup_general_path_matches_first_prefix(spark):
    got = one_col(spark, ["123", "129", "1", None],
                  lambda c: prefix_lookup(c, (("12", "a"), ("1", "b")), "z"))
    assert got == ["a", "a", "b", "z"]
