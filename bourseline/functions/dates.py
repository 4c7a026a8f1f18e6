"""Date parsing; what cannot be read gives null.

Texts are taken apart by one anchored pattern per form and cast once. That stays in
generated code and, unlike trying one format after another, raises nothing per row.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Local month names of the daily sheets, in look-up order.
DAILY_MONTHS = {
    "Jan": "01", "Feb": "02", "Mar": "03", "Apr": "04", "Mei": "05", "Jun": "06",
    "Jul": "07", "Agt": "08", "Sep": "09", "Okt": "10", "Nov": "11", "Des": "12",
}

# Local and English month names of the monthly files, in look-up order.
MONTHLY_MONTHS = {
    "jan": "01", "feb": "02", "mar": "03", "apr": "04", "mei": "05", "may": "05",
    "jun": "06", "jul": "07", "agt": "08", "aug": "08", "sep": "09",
    "okt": "10", "oct": "10", "nov": "11", "des": "12", "dec": "12",
}

ENGLISH = ["january", "february", "march", "april", "may", "june", "july", "august",
           "september", "october", "november", "december"]
ENGLISH_MONTHS = {n: str(i) for i, n in enumerate(ENGLISH, 1)} | {n[:3]: str(i) for i, n in enumerate(ENGLISH, 1)}

# Number-only spellings of the general parser and how each becomes year-month-day,
# in order: month before day wherever both readings fit, or day before month.
DAY_FIRST_FORMS = (
    (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})\s*$", "$1-$2-$3"),
    (r"^\s*(\d{4})(\d{2})(\d{2})\s*$", "$1-$2-$3"),
    (r"^\s*(\d{1,2})[/-](0?[1-9]|1[0-2])[/-](\d{4})\s*$", "$3-$2-$1"),
    (r"^\s*(\d{1,2})[/-](\d{1,2})[/-](\d{4})\s*$", "$3-$1-$2"),
)
NUMBER_FORMS = (
    (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})\s*$", "$1-$2-$3"),
    (r"^\s*(\d{4})(\d{2})(\d{2})\s*$", "$1-$2-$3"),
    (r"^\s*(0?[1-9]|1[0-2])[/-](\d{1,2})[/-](\d{4})\s*$", "$3-$1-$2"),
    (r"^\s*(\d{1,2})[/-](\d{1,2})[/-](\d{4})\s*$", "$3-$2-$1"),
)
# A time may follow, other text may not.
ISO = r"^\s*(\d{4}-\d{1,2}-\d{1,2})(?:[ T]\d{1,2}(?::\d{2}){0,2}(?:[.,]\d+)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?\s*$"
MONTH_FIRST = r"^\s*([a-z]{3,9})\s+(\d{1,2}),?\s+(\d{4})\s*$"
DAY_MONTH_YEAR = r"^\s*(\d{1,2})(?:\s+|-)([a-z]{3,9})(?:\s+|-)(\d{4})\s*$"


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())]), key)


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def _iso_date(c: Column) -> Column:
    return F.regexp_extract(c, ISO, 1).try_cast("date")


def _as_iso(c: Column, forms: tuple[tuple[str, str], ...]) -> Column:
    for pattern, target in forms:
        c = F.regexp_replace(c, pattern, target)
    return c


TWO_NUMBERS = r"^\s*(\d{1,2})[/-](\d{1,2})[/-]\d{4}\s*$"


def day_first_vote(c: Column) -> Column:
    """An aggregate: whether the texts of a group write the day before the month. Only dates that fit one reading count; as many for
    either, or none, is month first."""
    first, second = (F.regexp_extract(c, TWO_NUMBERS, i).try_cast("int") for i in (1, 2))
    day_first = first.between(13, 31) & second.between(1, 12)
    month_first = first.between(1, 12) & second.between(13, 31)
    return F.count_if(day_first) > F.count_if(month_first)


def date_by_file(df: DataFrame, name: str, file_name: str) -> DataFrame:
    """`df` with the texts of the column `name` read as dates, in each file by the order that its dates show: one aggregate
    by file, joined back. Rows without a file name are a file of their own."""
    votes = df.groupBy(F.col(file_name).alias("_file")).agg(day_first_vote(F.col(name)).alias("_day_first"))
    both = df.join(votes, F.col(file_name).eqNullSafe(F.col("_file")))
    return both.withColumn(name, general_date(F.col(name), F.col("_day_first"))).select(*df.columns)


def general_date(c: Column, day_first: Column | None = None) -> Column:
    """ISO, slashed, dashed, packed and English month-name dates; month first, unless the flag says that the day is."""
    numeric = _as_iso(c, NUMBER_FORMS)
    if day_first is not None:
        numeric = F.when(day_first, _as_iso(c, DAY_FIRST_FORMS)).otherwise(numeric)
    named = F.regexp_replace(F.lower(c), MONTH_FIRST, "$2 $1 $3")
    day, month, year = (F.regexp_extract(named, DAY_MONTH_YEAR, i) for i in (1, 2, 3))
    spelled = F.when(c.rlike("[A-Za-z]{3}"), _date(year, _lookup(ENGLISH_MONTHS, month), day))
    return F.coalesce(_iso_date(c), F.when(~c.rlike("[A-Za-z]"), _iso_date(numeric)), spelled)


def _numbered_date(c: Column, months: dict[str, str], separator: str) -> Column:
    """Day, month and year, where a month's name stands for its number. Two different names are null."""
    part = rf"({'|'.join(months)}|\d{{1,2}})"
    form = rf"(?s)^(?:\s*{part}{separator}{part}{separator}(\d{{4}})\s*|.*)$"
    found = F.split(F.regexp_replace(c, form, "$1|$2|$3"), r"\|")
    day, month, year = (F.get(found, F.lit(i)) for i in range(3))
    named = [_lookup(months, x) for x in (day, month)]
    value = _date(year, F.coalesce(named[1], month), F.coalesce(named[0], day))
    return F.when(named[0].isNull() | named[1].isNull() | (day == month), value)


def local_months_date(c: Column) -> Column:
    """"05 Mei 2024" in local months; text without a local month goes to the
    general parser. A month that leaves letters over ("Maret") is null."""
    local = _numbered_date(c, DAILY_MONTHS, r"\s+")
    return F.when(c.rlike("|".join(DAILY_MONTHS)), local).otherwise(general_date(c))


def monthly_date(c: Column) -> Column:
    """"31-MEI-2024" or "31-05-2024", any case, local or English months."""
    return _numbered_date(F.lower(c), MONTHLY_MONTHS, "-")


def file_name_date(file_name: Column) -> Column:
    """First run of eight digits read as yyyyMMdd."""
    first = r"(?s)^(?:.*?(\d{4})(\d{2})(\d{2}).*|.*)$"
    return F.regexp_replace(file_name, first, "$1-$2-$3").try_cast("date")


def cell_or_file_date(cell: Column, file_name: Column) -> Column:
    return F.coalesce(local_months_date(cell), file_name_date(file_name))


def two_digit_year_date(c: Column) -> Column:
    """"05 May 24"; years 69 to 99 belong to the last century."""
    form = r"^\s*(\d{1,2})\s+([a-z]{3})\s+(\d{2})\s*$"
    day, month, year = (F.regexp_extract(F.lower(c), form, i) for i in (1, 2, 3))
    century = F.when(year >= "69", "19").otherwise("20")
    return _date(F.concat(century, year), _lookup(ENGLISH_MONTHS, month), day)


def iso_prefix(c: Column, default: Column) -> Column:
    """First ten characters of a time stamp; other text as is; none: the default."""
    t = F.coalesce(c, F.lit(""))
    return F.when(t.contains("T"), F.left(t, F.lit(10))).otherwise(F.coalesce(F.nullif(t, F.lit("")), default))
