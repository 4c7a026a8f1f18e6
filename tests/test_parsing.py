"""Text to numbers, dates and flags: edge rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import dates, numbers, rules, text


def test_currency(column):
    given = ["Rp 1,234.5", "Rp. 1.234", "-", "", "nan", "1d", "1_000", None, " 12 ", "1e3", "+7", "1e999", "Rp 5"]
    assert column(numbers.currency_number, given) == [1234.5, None, None, None, None, None, None, None, 12.0, 1000.0, 7.0, None, 5.0]


def test_comma_number_keeps_currency_signs_bad(column):
    assert column(numbers.comma_number, ["1,234.5", "Rp 5", "-3"]) == [1234.5, None, -3.0]


def test_locale_float(column):
    given = ["1,234.56", "1.234,56", "79,31", "5.2%", "1.234.567", "", "nan", "None", None, "1_000.5", "12"]
    assert column(numbers.locale_float, given) == [1234.56, 1234.56, 79.31, 5.2, 0.0, 0.0, 0.0, 0.0, 0.0, 1000.5, 12.0]


def test_locale_int(column):
    given = ["1234.0", "1.234", "1,234,567", "", None, "12 %", "-5", "9007199254740993"]
    assert column(numbers.locale_int, given) == [12340, 1234, 1234567, 0, 0, 12, -5, 9007199254740993]
    assert column(lambda c: numbers.locale_int(c, trim_decimal=True), ["1234.0", "1.234"]) == [1234, 1234]


def test_dash_zero(column):
    given = ["-", "-5", "1,000", "1 000", None, "x"]
    assert column(numbers.dash_zero, given) == [0, 5, 1000, 1000, 0, 0]
    assert column(lambda c: numbers.dash_zero(c, history=True), given) == [0, -5, 1000, 1000, 0, 0]


def test_signed(column):
    assert column(numbers.signed_long, ["+1,234", "-1,234", "2.7", "-2.7", None, "x"]) == [1234, -1234, 2, -2, 0, None]
    assert column(numbers.price_or_zero, ["", None, "1,250", "x"]) == [0.0, 0.0, 1250.0, None]


def test_fill(column):
    given = [2.7, -2.7, None, float("nan"), float("inf")]
    assert column(numbers.fill_long, given, "double") == [2, -2, 0, 0, 0]
    assert column(numbers.fill_double, given, "double") == [2.7, -2.7, 0.0, 0.0, 0.0]


def test_round_binary_agrees_with_python(column):
    given = [2.675, 0.125, 1.005, 10083.845, 1.0, 2.344999, 0.375, 12345.6789]
    assert column(lambda c: numbers.round_binary(c, 2), given, "double") == [round(x, 2) for x in given]


def test_true_text(column):
    assert column(text.true_text, ["TRUE", "true", "1", "0", "FALSE", "yes", None]) == [True, True, True, False, False, False, False]


def test_local_months(column):
    given = ["05 Mei 2024", " 5  Agt 2024 ", "05 Maret 2024", "2024-05-06", "", "05/06/2024", "13/05/2024", "31 Feb 2024",
             "20240507", "05 May 2024", "May 5, 2024", "12345", "Jan 05 2024", "01 Jan Feb 2024", None]
    assert column(dates.local_months_date, given) == [
        date(2024, 5, 5), date(2024, 8, 5), None, date(2024, 5, 6), None, date(2024, 5, 6), date(2024, 5, 13), None,
        date(2024, 5, 7), date(2024, 5, 5), date(2024, 5, 5), None, date(2024, 5, 1), None, None]


def test_monthly_date(column):
    given = ["31-MEI-2024", "31-Oct-2024", "31-Agt-2024", "31-05-2024", "2024-05-31", "31 Mei 2024", "bad", None, "31-feb-2024"]
    assert column(dates.monthly_date, given) == [
        date(2024, 5, 31), date(2024, 10, 31), date(2024, 8, 31), date(2024, 5, 31), None, None, None, None, None]


def test_file_date_and_fallback(rows):
    df = rows("cell string, f string", ("", "x_20240507.xlsx"), ("05 Maret 2024", "20240301"), ("05 Mei 2024", "none"), ("x", "y"), (None, "9_20241399"))
    got = [r[0] for r in df.select(dates.cell_or_file_date(F.col("cell"), F.col("f"))).collect()]
    assert got == [date(2024, 5, 7), date(2024, 3, 1), date(2024, 5, 5), None, None]


def test_two_digit_years(column):
    given = ["05 May 24", "5 MAY 99", "05 Mei 24", "32 Jan 24", None, "05 Jan 68", "05 Jan 69"]
    assert column(dates.two_digit_year_date, given) == [
        date(2024, 5, 5), date(1999, 5, 5), None, None, None, date(2068, 1, 5), date(1969, 1, 5)]


def test_iso_prefix(column):
    build = lambda c: dates.iso_prefix(c, F.lit("2024-01-01"))
    assert column(build, ["2024-05-06T00:00:00Z", "2024-05-06", "", None]) == ["2024-05-06", "2024-05-06", "2024-01-01", "2024-01-01"]


def test_lookups(column):
    assert column(lambda c: text.map_values(c, schemas.LOCAL_FOREIGN), ["A", "Asing", "", "X", "domestik"]) == ["F", "F", "L", "X", "L"]
    assert column(lambda c: text.map_values(c, schemas.INVESTOR_TYPES), ["cp", "Mutual Funds", "nan", "ZZ", ""]) == [
        "Corporate", "Fund Manager", "Others", "ZZ", "Others"]


def test_stem(column):
    assert column(text.stem, ["a.b.xlsx", "plain", ".hidden", "x.csv"]) == ["a.b", "plain", ".hidden", "x"]


@pytest.mark.parametrize(
    ("prev", "curr", "action"), [(0, 5, "Buying"), (5, 9, "Accumulation"), (9, 5, "Reduction"), (5, 5, "Holding"), (0, 0, "Skip"), (5, 0, "Reduction")]
)
def test_holder_action(rows, prev, curr, action):
    df = rows("p bigint, c bigint", (prev, curr))
    assert df.select(rules.holder_action(F.col("p"), F.col("c"))).first()[0] == action


def test_alert_levels(column):
    assert column(rules.alert_level, [0.3, -1.0, 2.0, -2.5, 0.999], "double") == ["LOW", "MEDIUM", "HIGH", "HIGH", "LOW"]


def test_dates_by_file(spark):
    """A file's own dates tell the order of day and month; without any that fit one reading alone, or with as many for each, the month comes first."""
    rows = [("a", "05/04/2024"), ("a", "25/04/2024"), ("a", "2024-07-08"), ("b", "05/04/2024"), ("c", "05-04-2024"), ("c", "25/04/2024"), ("c", "04/25/2024"),
            ("d", "05/04/2024"), ("d", "04/25/2024"), (None, "05/04/2024"), (None, "31/12/2024"), ("e", "n/a"), ("e", None), ("a", "04/30/2024"), ("a", "May 5, 2024"), ("a", "30/04/2024")]
    df = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(rows)], "i int, file string, t string")
    got = {r["i"]: r["t"] and r["t"].isoformat() for r in dates.date_by_file(df, "t", "file").collect()}
    assert [got[i] for i in range(len(rows))] == [
        "2024-04-05", "2024-04-25", "2024-07-08", "2024-05-04", "2024-05-04", "2024-04-25", "2024-04-25",
        "2024-05-04", "2024-04-25", "2024-04-05", "2024-12-31", None, None, "2024-04-30", "2024-05-05", "2024-04-30"]
