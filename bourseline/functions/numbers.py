"""Number parsing. Bad text gives null (or 0 where the target says so), never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bourseline.functions.text import BLANKS

# A plain decimal number, cut out by its pattern: a bare cast would also take type
# suffixes ("1d") and the words NaN and Infinity. No match gives an empty text,
# which casts to null.
DECIMAL = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE](?:[+-]?[0-2]?\d?\d|[+-]?30[0-7]))?)\s*$"
WHOLE_PART = r"^\s*([+-]?\d{1,38})(?:\.\d*)?\s*$"


def _without(c: Column, characters: str) -> Column:
    if len(characters) == 1:
        return F.replace(c, F.lit(characters), F.lit(""))
    return F.translate(c, characters, "")


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def to_double(c: Column) -> Column:
    return F.regexp_extract(c, DECIMAL, 1).try_cast("double")


def to_long(c: Column) -> Column:
    """Digits are kept exactly, a fraction is cut towards zero; what no bigint can hold is null.
    Only a number with an exponent goes through double."""
    whole = F.regexp_extract(c, WHOLE_PART, 1)
    return F.when(whole != "", whole.try_cast("bigint")).otherwise(to_double(c).try_cast("bigint"))


def round_binary(c: Column, places: int) -> Column:
    """Round the exact binary value, so 2.675 gives 2.67 (SQL round gives 2.68).

    The two differ only where the decimal spelling ends in a 5 one place further
    down; only such values take the slow way through text."""
    maybe_tie = F.round(c, places + 1) == c
    exact = F.replace(F.format_number(c, places), F.lit(","), F.lit("")).try_cast("double")
    return F.when(maybe_tie, exact).otherwise(F.round(c, places))


def comma_number(c: Column) -> Column:
    return to_double(_without(c, ","))


def currency_number(c: Column) -> Column:
    """Commas, blanks and the letters R and p go; what is left must be a number."""
    return to_double(_without(c, "," + BLANKS + "Rp"))


def locale_float(c: Column) -> Column:
    """Percentages in either notation. With both signs present the later one is
    the decimal sign; a lone comma is a decimal comma; bad text is 0."""
    s = _without(c, "%" + BLANKS)
    comma, dot = F.instr(s, ","), F.instr(s, ".")
    plain = (
        F.when((comma > 0) & (dot > comma), _without(s, ","))
        .when((comma > 0) & (dot > 0), F.translate(s, ",.", "."))
        .when(comma > 0, F.translate(s, ",", "."))
        .otherwise(F.regexp_replace(s, r"(?<=\d)_(?=\d)", ""))
    )
    return F.coalesce(to_double(plain), F.lit(0.0))


def locale_int(c: Column, trim_decimal: bool = False) -> Column:
    """Share counts: every dot and comma is a grouping sign; bad text is 0.

    So the text 1234.0 reads as 12340. `trim_decimal` cuts a trailing .0 first.
    """
    s = F.regexp_replace(c, r"\.0+\s*$", "") if trim_decimal else c
    return F.coalesce(to_long(_without(s, "%.," + BLANKS)), F.lit(0).cast("bigint"))


def dash_zero(c: Column, history: bool = False) -> Column:
    """Holder-list counts. On new rows each dash reads as a zero digit (so -5 is
    5); rows from stored history keep their sign. Bad text is 0."""
    s = _without(c, ", ") if history else F.translate(c, "-, ", "0")
    return F.coalesce(to_long(s), F.lit(0).cast("bigint"))


def signed_double(c: Column) -> Column:
    """+1,234.5 style text; a missing field is 0, bad text is null."""
    return to_double(_without(F.coalesce(c, F.lit("0")), ",+"))


def signed_long(c: Column) -> Column:
    return signed_double(c).try_cast("bigint")


def price_or_zero(c: Column) -> Column:
    """Like `signed_double`, but an empty text is 0 too."""
    s = _without(F.coalesce(c, F.lit("0")), ",")
    return F.when(s == "", F.lit(0.0)).otherwise(to_double(s))


def fill_long(c: Column) -> Column:
    """Publish as a whole number: cut towards zero, null and non-finite to 0."""
    return F.coalesce(finite(c.cast("double")).try_cast("bigint"), F.lit(0).cast("bigint"))


def fill_double(c: Column) -> Column:
    return F.coalesce(finite(c.cast("double")), F.lit(0.0))


def safe_ratio(a: Column, b: Column, default: float) -> Column:
    """a / b where b is above 0, else the default."""
    return F.when(b > 0, a / b).otherwise(F.lit(default))
