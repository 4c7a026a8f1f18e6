"""Text cleaning, look-ups and list helpers as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n\f\v\u00a0"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def one_line(c: Column) -> Column:
    """Line breaks inside a cell become blanks."""
    return F.replace(c, F.lit("\n"), F.lit(" "))


def stem(file_name: Column) -> Column:
    """File name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(file_name, r"(?<=[^.])\.[^.]*$", "")


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.replace(c, F.lit(prefix), F.lit(""))


def text_or(c: Column, default: str) -> Column:
    return F.coalesce(c, F.lit(default))


def map_values(c: Column, lookup: dict[str, str]) -> Column:
    """Upper-case and translate by exact match; unknown values stay, upper-cased."""
    key = F.upper(c)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(lookup.items())])
    return F.coalesce(F.try_element_at(table, key), key)


def has_badge(badges: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(badges, name), F.lit(False))


def join_badges(badges: Column, prefix: str) -> Column:
    """Prefix-free badge names joined by commas; no badges gives an empty text."""
    clean = F.transform(badges, lambda b: F.replace(b, F.lit(prefix), F.lit("")))
    return F.coalesce(F.array_join(clean, ","), F.lit(""))


def true_text(c: Column) -> Column:
    """TRUE/1 is true; everything else, null included, is false."""
    return F.coalesce(F.upper(c.cast("string")).isin("TRUE", "1"), F.lit(False))
