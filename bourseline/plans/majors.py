"""Holder lists of 5 percent: document rows to a change log with exits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import dates, numbers, rules, text
from bourseline.operators import joins
from bourseline.operators.frames import positional, union_by_name
from bourseline.operators.windows import first_date
from bourseline.sources.storage import stage

DATE = "tanggal_data"
KEYS = ["kode_efek", "nama_pemegang_saham"]
MIN_CELLS = 6
COLUMNS = [c for c in schemas.MAJOR_TABLE.fieldNames() if c != "perubahan_saham"]


def list_rows(rows: DataFrame) -> DataFrame:
    """Table rows of dated documents: no cover page, no headings or footers, no
    short or empty rows. A page whose first row is short is skipped whole."""
    cells = F.col("cells")
    dated = rows.filter(F.col("file_name").rlike(r"^\d{8}") & (F.col("page_idx") > 0))
    page = ["file_name", "page_idx"]
    # The pages to skip are few, so the join below can turn into a broadcast.
    skipped = (
        dated.groupBy(*page)
        .agg(F.min_by(F.size(cells), "row_idx").alias("_width"))
        .filter(F.col("_width") < MIN_CELLS)
        .select(*page)
    )
    whole = F.lower(F.concat_ws("\n", cells))
    noise = reduce(lambda a, b: a | b, [whole.contains(p) for p in schemas.MAJOR_NOISE])
    # What an empty cell looks like.
    blank = F.forall(F.slice(cells, 1, 4), lambda c: c.isNull() | text.strip(c).isin("", "—"))
    kept = dated.filter((F.size(cells) >= MIN_CELLS) & ~noise & ~blank)
    return kept.join(skipped, page, "left_anti")


def positions(rows: DataFrame) -> DataFrame:
    """Named columns with counts; rows without a code or a holder go."""
    day = dates.file_name_date(F.col("file_name")).alias(DATE)
    named = rows.select(day, *positional(F.col("cells"), schemas.MAJOR_CELLS), "load_seq")
    return named.na.drop(subset=KEYS).withColumns(
        {
            "jumlah_saham_prev": numbers.dash_zero(F.col("saham_prev")),
            "jumlah_saham_curr": numbers.dash_zero(F.col("saham_curr")),
        }
    ).drop("saham_prev", "saham_curr")


def with_actions(df: DataFrame) -> DataFrame:
    action = rules.holder_action(F.col("jumlah_saham_prev"), F.col("jumlah_saham_curr"))
    return df.withColumn("aksi", action).filter(F.col("aksi") != "Skip")


def listing(rows: DataFrame) -> DataFrame:
    """Typed rows of the lists as sent, with their actions: what a job stores as history."""
    return with_actions(positions(list_rows(rows))).select(*COLUMNS, "load_seq")


def exits(active_rows: DataFrame) -> DataFrame:
    """Rows for holders that vanished since the list before: their last count
    becomes the previous one, the current one is 0."""
    gone = joins.dropouts(active_rows, DATE, KEYS, F.col("jumlah_saham_curr") > 0)
    return gone.withColumns(
        {
            "jumlah_saham_prev": F.col("jumlah_saham_curr"),
            "jumlah_saham_curr": F.lit(0).cast("bigint"),
            "aksi": F.lit("Reduction"),
        }
    )


def baseline_only(df: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """Optional: keep a Holding row only on the holder's first date (of `lists`, if given)."""
    if lists is None:
        rows = first_date(df, KEYS, DATE, "_first")
    else:
        firsts = lists.groupBy(*KEYS).agg(F.min(DATE).alias("_first"))
        rows = df.join(firsts, KEYS, "left")
    return rows.filter((F.col("aksi") != "Holding") | (F.col(DATE) == F.col("_first"))).drop("_first")


def full_log(lists: DataFrame) -> DataFrame:
    """Listed rows and exits between neighbouring dates, with the share change."""
    log = union_by_name(lists, exits(lists))
    return log.withColumn("perubahan_saham", F.col("jumlah_saham_curr") - F.col("jumlah_saham_prev"))


def change_log(rows: DataFrame, history: DataFrame | None = None, baseline: bool = False) -> DataFrame:
    """The log of all dates at once or, with `history` (rows from `listing` of earlier files), of the
    dates that the new files change: a date they hold, and the one after it, each as a whole, to be
    upserted by date. A date that is sent again replaces its list; late dates find their neighbours
    on both sides. Dates are taken in calendar order, and files of one date form one list.

    The typed rows are needed four times (log, exits, calendar, today's holders), so they are
    written once to the shared folder and read back column by column.
    """
    new = stage(listing(rows), "majors")
    if history is None:
        log = full_log(new)
        return (baseline_only(log) if baseline else log).select(*schemas.MAJOR_TABLE.fieldNames())
    sent = new.select(DATE).distinct()
    lists = union_by_name(history.join(F.broadcast(sent), DATE, "left_anti"), new)  # dates: bounded by the calendar
    near = joins.next_dates(lists, DATE).join(sent.withColumn("_sent", F.lit(True)), DATE, "left")
    days = W.orderBy(DATE)
    near = near.withColumn("_touched", F.coalesce("_sent", F.lag("_sent").over(days), F.lit(False)))
    near = near.withColumn("_needed", F.col("_touched") | F.coalesce(F.lead("_touched").over(days), F.lit(False)))
    near = stage(near.select(DATE, "_touched", "_needed"), "dates")
    needed = lists.join(F.broadcast(near.filter("_needed").select(DATE)), DATE, "left_semi")
    log = full_log(needed).join(F.broadcast(near.filter("_touched").select(DATE)), DATE, "left_semi")
    return (baseline_only(log, lists) if baseline else log).select(*schemas.MAJOR_TABLE.fieldNames())
