"""Holder lists of 1 percent: heading detection, cleaning, and the two views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import dates, numbers, rules, text
from bourseline.functions.rules import CORPORATE, FINANCIAL, FOREIGN, FUND, INDIVIDUAL, ScreenerFlags
from bourseline.operators import ranges, windows
from bourseline.operators.frames import any_cell, with_date
from bourseline.operators.joins import latest, previous_date
from bourseline.sources.storage import stage

SCAN_ROWS = 15
TABLE = schemas.HOLDER_TABLE.fieldNames()


# ---- raw rows to table -----------------------------------------------------


def _heading(cells: Column) -> Column:
    """Cells trimmed, upper-cased, blanks to underscores, synonyms renamed."""
    names = F.transform(cells, lambda c: F.replace(text.strip(F.upper(c)), F.lit(" "), F.lit("_")))
    pairs = [x for pair in schemas.HOLDER_SYNONYMS.items() for x in pair]
    table = F.create_map(*[F.lit(x) for x in pairs])
    return F.transform(names, lambda n: F.coalesce(F.try_element_at(table, n), n))


def file_headings(rows: DataFrame) -> DataFrame:
    """Heading of each file: the first of its first 15 filled data rows that holds
    a key column's name, else row 0. One row per file.

    The first rows of a file are found by rank, which Spark limits on the map side.
    """
    data = rows.filter((F.col("row_idx") > 0) & any_cell(F.col("cells")))
    marks = F.array(*[F.lit(m) for m in schemas.HOLDER_HEADING_MARKS])
    marked = F.arrays_overlap(F.transform("cells", lambda c: text.strip(F.upper(c))), marks)
    near = (
        windows.top_per_group(data, ["file_name"], [F.col("row_idx")], SCAN_ROWS)
        .filter(F.coalesce(marked, F.lit(False)))
        .groupBy("file_name")
        .agg(F.min(F.struct("row_idx", "cells")).alias("_found"))
    )
    first = rows.filter(F.col("row_idx") == 0).select("file_name", F.struct("row_idx", "cells").alias("_first"))
    heading = F.coalesce("_found", "_first")
    named = first.join(near, "file_name", "left").select(
        "file_name", heading["row_idx"].alias("heading_row"), _heading(heading["cells"]).alias("heading")
    )
    every = F.sequence(F.lit(1), F.size("heading"))

    def of(name: str) -> Column:
        """All places of a name: a file may have several spellings of one column."""
        places = F.filter(every, lambda i: F.try_element_at(F.col("heading"), i) == name)
        return F.when(F.size("heading") > 0, places).otherwise(F.array().cast("array<int>"))

    named = named.withColumn("place", F.struct(*[of(name).alias(name) for name in schemas.HOLDER_COLUMNS]))
    return stage(named, "headings")


def detect_headings(rows: DataFrame, headings: DataFrame | None = None) -> DataFrame:
    """Filled rows below their file's heading, with that heading. Headings are read first and stored, so that Spark
    knows their size and rows need not move where they are few."""
    headings = file_headings(rows) if headings is None else headings
    filled = rows.filter(any_cell(F.col("cells")) & (F.col("row_idx") > 0))
    return filled.join(headings, "file_name").filter(F.col("row_idx") > F.col("heading_row"))


def align(rows: DataFrame) -> DataFrame:
    """The twelve expected columns as text, taken from the places their headings
    have in the file (the first that is filled in the row), with defaults for columns the file lacks. Rows need a valid
    share code if the file has codes."""
    headings = file_headings(rows)
    # As many places of a column as any heading has: one, but for files with several spellings.
    most = headings.agg(*[F.coalesce(F.max(F.size(F.col("place")[n])), F.lit(0)).alias(n) for n in schemas.HOLDER_COLUMNS]).first()

    def value(name: str, default: str) -> Column:
        cells = [F.try_element_at(F.col("cells"), F.get(F.col("place")[name], F.lit(k))) for k in range(most[name])]
        if not cells:
            return F.lit(default)
        filled = [F.when(text.strip(c) != "", c) for c in cells] if len(cells) > 1 else []
        return F.when(F.size(F.col("place")[name]) > 0, F.coalesce(*filled, cells[0])).otherwise(F.lit(default))

    texts = {name.lower(): value(name, default) for name, default in schemas.HOLDER_COLUMNS.items()}
    texts["share_code"] = F.upper(text.strip(text.text_or(texts["share_code"], "nan")))
    named = detect_headings(rows, headings).select(
        text.stem(F.col("file_name")).alias("data_source"),
        *[v.alias(k) for k, v in texts.items()],
        "load_seq", (F.col("heading_row") == 0).alias("plain_heading"), (F.size("place.SHARE_CODE") == 0).alias("_no_codes"),
    )
    return named.filter(F.col("_no_codes") | valid_code(F.col("share_code"))).drop("_no_codes")


def valid_code(code: Column) -> Column:
    return code.rlike(r"^[A-Z0-9-]{4,6}$")


def clean(df: DataFrame, dates_by_file: bool = False) -> DataFrame:
    """Types, standard values, dated rows only. `dates_by_file`: whether 05/04 is a day in April or in May is for each
    file's own dates to say, not month first everywhere. A missing text reads "nan", as the
    stored table has always had it. Below a heading in row 0 counts are numeric cells, and
    their text may end in .0; elsewhere each dot is a grouping sign."""
    counts = ["holdings_scripless", "holdings_scrip", "total_holding_shares"]
    texts = ["data_source", "share_code", "issuer_name", "investor_name", "investor_type", "local_foreign", "nationality", "domicile"]

    def as_text(c: str) -> Column:
        return text.strip(text.one_line(text.text_or(F.col(c), "nan")))

    if dates_by_file:
        dated = dates.date_by_file(df, "date", "data_source").na.drop(subset=["date"])
    else:
        dated = with_date(df, "date", dates.general_date(F.col("date")))
    return dated.withColumns({c: as_text(c) for c in texts}).withColumns(
        {
            "local_foreign": text.map_values(F.col("local_foreign"), schemas.LOCAL_FOREIGN),
            "investor_type": text.map_values(F.col("investor_type"), schemas.INVESTOR_TYPES),
            "percentage": numbers.locale_float(F.col("percentage")),
        }
        | {c: numbers.locale_int(F.when(F.col("plain_heading"), F.regexp_replace(c, r"(?<=\d)\.0\s*$", "")).otherwise(F.col(c))) for c in counts}
    )


def ownership(rows: DataFrame, dates_by_file: bool = False) -> DataFrame:
    """Raw cells of all files in, the holder table (with load position) out."""
    return clean(align(rows), dates_by_file).select(*TABLE, "load_seq")


# ---- views -----------------------------------------------------------------


def with_previous(df: DataFrame) -> DataFrame:
    """Previous row's percentage and shares per (share, holder)."""
    return ranges.previous_row(
        df, ["share_code", "investor_name"], "date", "load_seq",
        {"percentage": "prev_percentage", "total_holding_shares": "prev_shares"},
    )


def recent_individuals(table: DataFrame) -> DataFrame:
    """Individuals in the three months up to the latest date."""
    since = F.add_months(latest(table, "date"), -3)
    return table.filter(F.col("investor_type").isin(*INDIVIDUAL) & (F.col("date") >= since))


def individual_changes(table: DataFrame) -> DataFrame:
    """Holders whose percentage moved by at least 0.3 points, with the alert level.

    The span is cut before the lag: a row outside it is never a previous row.
    """
    rows = with_previous(recent_individuals(table))
    points = F.col("percentage") - F.col("prev_percentage")
    shares = F.col("total_holding_shares") - F.coalesce("prev_shares", "total_holding_shares")
    return rows.filter(F.col("prev_percentage").isNotNull() & (F.abs(points) >= 0.3)).select(
        F.col("date").alias("report_date"), "share_code", "investor_name", "investor_type", "nationality",
        "prev_percentage",
        F.col("percentage").alias("curr_percentage"),
        F.round(points, 4).alias("pct_point_change"),
        shares.alias("share_change"),
        rules.trade_action(shares).alias("action"),
        rules.alert_level(points).alias("alert_level"),
    )


GROUPS = {
    "corp": lambda: F.col("investor_type").isin(*CORPORATE),
    "foreign": lambda: F.col("local_foreign").isin(*FOREIGN),
    "ind": lambda: F.col("investor_type").isin(*INDIVIDUAL),
    "fund": lambda: F.col("investor_type").isin(*FUND),
    "fin": lambda: F.col("investor_type").isin(*FINANCIAL),
}
COMPARED = ("corp", "foreign", "ind")


def current_and_previous(table: DataFrame) -> DataFrame:
    """Per (share, holder) of the latest date: group sums now, and what a left join
    to the snapshot before would add up to.

    Joining copies pairs every current copy with every previous one. Both sides
    are aggregated first instead: a holder with m previous rows counts each current
    row max(m, 1) times, and each current row adds all m previous percentages.
    """
    keys = ["share_code", "investor_name"]
    now = table.filter(F.col("date") == latest(table, "date")).groupBy(*keys).agg(
        *[F.sum(F.when(cond(), F.col("percentage")).otherwise(0.0)).alias(f"_{g}") for g, cond in GROUPS.items()],
        *[F.count_if(GROUPS[g]()).alias(f"_n_{g}") for g in COMPARED],
        F.count(F.lit(1)).alias("curr_rows"),
    )
    before = table.filter(F.col("date") == previous_date(table, "date")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("prev_rows"), F.sum("percentage").alias("prev_pct")
    )
    joined = now.join(before, keys, "left")
    times = F.coalesce("prev_rows", F.lit(1))
    prev = F.coalesce("prev_pct", F.lit(0.0))
    return joined.select(
        *keys, "curr_rows", F.coalesce("prev_rows", F.lit(0)).alias("prev_rows"),
        *[(F.col(f"_{g}") * times).alias(f"{g}_curr") for g in GROUPS],
        *[(F.col(f"_n_{g}") * prev).alias(f"{g}_prev") for g in COMPARED],
    )


def group_totals(table: DataFrame) -> DataFrame:
    """Eight percentage sums per share: five groups now, three before."""
    parts = current_and_previous(table)
    names = [f"{g}_curr" for g in GROUPS] + [f"{g}_prev" for g in COMPARED]
    return parts.groupBy("share_code").agg(*[F.sum(n).alias(n) for n in names])


def insider_screener(table: DataFrame) -> DataFrame:
    """Score and labels of every share whose group holdings moved."""
    totals = group_totals(table)
    change = {g: F.col(f"{g}_curr") - F.col(f"{g}_prev") for g in COMPARED}
    held = F.col("corp_curr") + F.col("fund_curr") + F.col("fin_curr")
    flags = ScreenerFlags(change["corp"], change["foreign"], change["ind"], held)
    moved = F.lit(False)
    for g in COMPARED:
        moved = moved | (F.abs(change[g]) >= 0.1)
    return totals.filter(moved).select(
        F.col("share_code").alias("code"),
        *[change[g].alias(f"{g}_change") for g in COMPARED],
        flags.score().alias("score"),
        flags.labels().alias("signals"),
    )
