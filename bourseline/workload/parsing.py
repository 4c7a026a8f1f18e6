"""Queries on text that has to be read as dates, numbers and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from bourseline.functions import dates, numbers, text
from bourseline.operators.frames import has_width
from bourseline.plans import daily as D
from bourseline.workload import adapters as A
from bourseline.workload.registry import add

KEYS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
ON = ", ".join(KEYS)


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _by_line(*cases: str) -> str:
    return "CASE l_linenumber " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(cases, 1)) + " END"


# The same spellings as the adapter's, built by the other engine.
TEXTS = f"""
base AS (
  SELECT *, CAST(l_shipdate AS DATE) AS d, strftime(d, '%d') AS dd, CAST(day(d) AS VARCHAR) AS d1, strftime(d, '%Y') AS yyyy,
    {_list(A.SHORT_MONTHS)}[month(d)] AS ms, {_list(A.LONG_MONTHS)}[month(d)] AS ml, {_list(A.ENGLISH_MONTHS)}[month(d)] AS me,
    format('{{:,.2f}}', l_extendedprice) AS grouped, translate(grouped, ',.', '.,') AS swapped,
    CAST(floor(l_extendedprice) AS BIGINT) AS fl, format('{{:,}}', fl) AS whole FROM lineitem
),
texts AS (
  SELECT *,
    {_by_line("dd || ' ' || ms || ' ' || yyyy", "' ' || d1 || ' ' || ms || '  ' || yyyy", "strftime(d, '%Y-%m-%d')",
              "dd || ' ' || ml || ' ' || yyyy", "''", "strftime(d, '%m/%d/%Y')", "'n/a'")} AS date_text,
    {_by_line("dd || '-' || upper(ms) || '-' || yyyy", "dd || '-' || me || '-' || yyyy", "d1 || '-' || lower(me) || '-' || yyyy",
              "dd || ' ' || me || ' ' || yyyy", "'31-Feb-2024'", "strftime(d, '%d-%m-%Y')", "'bad'")} AS monthly_text,
    {_by_line("'x_'", "''", "'rep-v1-'", "'2_'", "'a'", "'b 12 '", "'none'")} || CASE WHEN l_linenumber < 7 THEN strftime(d, '%Y%m%d') ELSE '' END
      || '.tar.xlsx' AS file_name,
    dd || ' ' || me || ' ' || CASE WHEN l_linenumber = 7 THEN '1x' ELSE strftime(d, '%y') END AS short_date_text,
    {_by_line("strftime(d, '%Y-%m-%d') || 'T00:00:00Z'", "strftime(d, '%Y-%m-%d')", "''", "NULL", "strftime(d, '%Y-%m-%d')", "''",
              "strftime(d, '%Y-%m-%d') || 'T17:00:00'")} AS iso_text,
    {_by_line("'Rp ' || grouped", "'Rp. ' || swapped", "'-'", "''", "'nan'", "grouped", "CAST(l_quantity AS VARCHAR) || 'd'")} AS currency_text,
    {_by_line("grouped", "swapped", "replace(CAST(l_extendedprice AS VARCHAR), '.', ',')", "CAST(l_quantity AS VARCHAR) || ' %'",
              "replace(whole, ',', '.') || '.000'", "''", "'None'")} AS float_text,
    {_by_line("whole", "replace(whole, ',', '.')", "CAST(fl AS VARCHAR) || '.0'", "' 12 345 '", "'abc'", "''", "'-' || whole")} AS int_text,
    {_by_line("whole", "'-'", "'-' || whole", "replace(whole, ',', ' ')", "''", "'n.a.'", "whole || '.7'")} AS dash_text,
    {_by_line("'+' || whole", "'-' || whole", "NULL", "whole || '.9'", "'1d'", "'0'", "'-' || whole || '.9'")} AS signed_text,
    {_by_line("'true'", "'FALSE'", "'1'", "'0'", "NULL", "'yes'", "'True'")} AS bool_text
  FROM base
)"""


def number(expr: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({expr}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim({expr}) AS DOUBLE) END"


def whole(expr: str) -> str:
    return f"CAST(trunc({number(expr)}) AS BIGINT)"


def months(expr: str, table: dict[str, str], fmt: str, otherwise: str) -> str:
    cases = " ".join(f"WHEN contains({expr}, '{k}') THEN CAST(try_strptime(replace({expr}, '{k}', '{v}'), '{fmt}') AS DATE)" for k, v in table.items())
    return f"CASE {cases} ELSE {otherwise} END"


_t = "regexp_replace(trim(date_text), '\\s+', ' ', 'g')"
LOCAL_DATE = months(_t, dates.DAILY_MONTHS, "%d %m %Y", f"CAST(COALESCE(try_strptime({_t}, '%Y-%m-%d'), try_strptime({_t}, '%m/%d/%Y')) AS DATE)")
MONTHLY_DATE = months("lower(monthly_text)", dates.MONTHLY_MONTHS, "%d-%m-%Y", "CAST(try_strptime(monthly_text, '%d-%m-%Y') AS DATE)")
FILE_DATE = "CAST(try_strptime(nullif(regexp_extract(file_name, '([0-9]{8})', 1), ''), '%Y%m%d') AS DATE)"


def _parsed(key: str, expr, sql: str, dated: bool = False) -> None:
    add(key, lambda s, sf: A.trade_texts(s, sf).select(*KEYS, expr().alias("parsed")),
        f"WITH {TEXTS} SELECT {ON}, {sql} AS parsed FROM texts", ["parsed"] if dated else [])


c = F.col
_parsed("fn_date_local_months", lambda: dates.local_months_date(c("date_text")), LOCAL_DATE, True)
_parsed("fn_date_monthly", lambda: dates.monthly_date(c("monthly_text")), MONTHLY_DATE, True)
_parsed("fn_date_from_filename", lambda: dates.file_name_date(c("file_name")), FILE_DATE, True)
_parsed("fn_date_fallback", lambda: dates.cell_or_file_date(c("date_text"), c("file_name")), f"COALESCE({LOCAL_DATE}, {FILE_DATE})", True)
_parsed("fn_date_coerce", lambda: dates.general_date(c("date_text")),
        f"CAST(COALESCE(try_strptime({_t}, '%Y-%m-%d'), try_strptime({_t}, '%m/%d/%Y'), try_strptime({_t}, '%d %b %Y'), try_strptime({_t}, '%d %B %Y')) AS DATE)", True)
_parsed("fn_date_ddmonyy", lambda: dates.two_digit_year_date(c("short_date_text")), "CAST(try_strptime(short_date_text, '%d %b %y') AS DATE)", True)
_parsed("fn_iso_date_prefix", lambda: dates.iso_prefix(c("iso_text"), F.lit("2024-05-06")),
        "CASE WHEN contains(COALESCE(iso_text, ''), 'T') THEN left(iso_text, 10) WHEN COALESCE(iso_text, '') <> '' THEN iso_text ELSE '2024-05-06' END")
_parsed("fn_num_currency", lambda: numbers.currency_number(c("currency_text")), number("regexp_replace(currency_text, '[,\\sRp]', '', 'g')"))
_s = "regexp_replace(float_text, '[\\s%]', '', 'g')"
_parsed(
    "fn_num_locale_float", lambda: numbers.locale_float(c("float_text")),
    "COALESCE(" + number(
        f"(CASE WHEN contains({_s}, ',') AND contains({_s}, '.') THEN CASE WHEN strpos({_s}, ',') < strpos({_s}, '.') THEN replace({_s}, ',', '') "
        f"ELSE replace(replace({_s}, '.', ''), ',', '.') END ELSE replace({_s}, ',', '.') END)") + ", 0)",
)
_i = "regexp_replace(int_text, '[\\s%.,]', '', 'g')"
_parsed("fn_num_locale_int", lambda: numbers.locale_int(c("int_text")), f"COALESCE({whole(_i)}, 0)")
_d = "replace(regexp_replace(dash_text, '[, ]', '', 'g'), '-', '0')"
_parsed("fn_num_dash_zero", lambda: numbers.dash_zero(c("dash_text")), f"COALESCE({whole(_d)}, 0)")
_g = "regexp_replace(COALESCE(signed_text, '0'), '[,+]', '', 'g')"
_parsed("fn_num_signed", lambda: numbers.signed_long(c("signed_text")), whole(_g))
_parsed("fn_cast_fill", lambda: numbers.fill_long(numbers.currency_number(c("currency_text"))),
        "COALESCE(" + whole("regexp_replace(currency_text, '[,\\sRp]', '', 'g')") + ", 0)")
_parsed("fn_bool_text", lambda: text.true_text(c("bool_text")), "COALESCE(upper(bool_text) IN ('TRUE', '1'), FALSE)")



def dates_of_files(spark, sf):
    """Ship dates in one file for each supplier, whose number tells whether the day comes first; month and day are told by each file's own dates."""
    day = c("l_shipdate").cast("date")
    text = F.when(c("l_suppkey") % 2 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MM/dd/yyyy"))
    rows = A.table(spark, sf, "lineitem").select(*KEYS, F.concat(F.lit("list_"), c("l_suppkey").cast("string")).alias("file_name"), text.alias("d"))
    return dates.date_by_file(rows, "d", "file_name")


add(
    "fn_date_by_file",
    dates_of_files,
    f"""WITH texts AS (SELECT {ON}, 'list_' || l_suppkey AS file_name, CASE WHEN l_suppkey % 2 = 0 THEN strftime(l_shipdate, '%d/%m/%Y') ELSE strftime(l_shipdate, '%m/%d/%Y') END AS t FROM lineitem),
parts AS (SELECT *, CAST(left(t, 2) AS INTEGER) AS a, CAST(substr(t, 4, 2) AS INTEGER) AS b, CAST(right(t, 4) AS INTEGER) AS y FROM texts),
votes AS (SELECT file_name, count(*) FILTER (WHERE a > 12) > count(*) FILTER (WHERE b > 12) AS day_first FROM parts GROUP BY file_name)
SELECT {ON}, file_name, CASE WHEN (day_first AND b <= 12) OR a > 12 THEN make_date(y, b, a) ELSE make_date(y, a, b) END AS d FROM parts JOIN votes USING (file_name)""",
    ["d"],
)

# 14 days, not 90: the other engine holds 90 days and 3 months for equal intervals
# and reuses the first difference for the second.
add(
    "fn_date_interval",
    lambda s, sf: A.trade_texts(s, sf).select(*KEYS, c("date_text"), dates.cell_or_file_date(c("date_text"), c("file_name")).alias("d")).select(
        *KEYS, "d", F.date_sub("d", 14).alias("d14"), F.add_months("d", -3).alias("m3"), F.date_format("d", "yyyy-MM-dd").alias("t")),
    f"""WITH {TEXTS}, p AS (SELECT {ON}, COALESCE({LOCAL_DATE}, {FILE_DATE}) AS d FROM texts)
SELECT {ON}, d, CAST(d - INTERVAL 14 DAYS AS DATE) AS d14, CAST(d - INTERVAL 3 MONTHS AS DATE) AS m3, CAST(d AS VARCHAR) AS t FROM p""",
    ["d", "d14", "m3"],
)

# ---- sheets ---------------------------------------------------------------------

SHEET = """
rows AS (
  SELECT CAST(l_shipdate AS DATE) AS d, 'S' || l_suppkey AS stock_code, l_orderkey * 256 + l_linenumber * 32 + l_partkey % 32 AS load_seq, l_linenumber,
    floor(l_extendedprice / l_quantity) AS close, l_quantity * 4200 AS volume, round(l_extendedprice * 100) * 300 AS value,
    CAST(l_linenumber AS DOUBLE) AS frequency, CASE WHEN l_returnflag = 'R' THEN l_quantity * 4200 ELSE 0 END AS foreign_buy,
    CASE WHEN l_returnflag = 'A' THEN l_quantity * 4200 END AS foreign_sell, 'sheet_' || strftime(d, '%Y%m%d') || '.xlsx' AS source_file
  FROM lineitem
)"""
add(
    "filt_exact_width",
    lambda s, sf: (lambda rows: rows.filter((c("row_idx") > 0) & has_width(c("cells"), len(D.sheet_headings(rows)))).select("file_name", "row_idx", F.size("cells").alias("width")))(A.daily_sheets(s, sf)),
    f"WITH {SHEET} SELECT source_file AS file_name, load_seq + 10 AS row_idx, 8 AS width FROM rows WHERE l_linenumber <> 7",
)
add(
    "pipe_daily_intake",
    lambda s, sf: D.parse_sheet(D.sheet_records(A.daily_sheets(s, sf))).select(
        "stock_code", "trading_date", "close", "volume", "value", "frequency", "foreign_buy", "foreign_sell", "net_foreign_value", "source_file", "load_seq"),
    f"""WITH {SHEET} SELECT stock_code, d AS trading_date, close, volume, value, frequency, foreign_buy, foreign_sell,
  foreign_buy * (value / volume) - foreign_sell * (value / volume) AS net_foreign_value, source_file, load_seq FROM rows WHERE l_linenumber <> 7""",
    ["trading_date"],
)
