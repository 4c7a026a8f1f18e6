"""Queries that land data in the shared folder and read or publish it."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.operators import frames, joins
from bourseline.plans import monthly as B
from bourseline.sources import archives, ledger, listing, readers, writers
from bourseline.sources.storage import fresh_path, land, stage, stage_path
from bourseline.streaming import intake
from bourseline.workload import adapters as A
from bourseline.workload.daily import TRADES
from bourseline.workload.holders import OWN
from bourseline.workload.majors import HELD
from bourseline.workload.monthly import CHAIN, RAW, WIDE, snapshot
from bourseline.workload.parsing import SHEET
from bourseline.workload.registry import add

HISTORY = schemas.struct("stock_code string, trading_date date, close double, volume double, source_file string")
H = ", ".join(HISTORY.fieldNames())


def history(spark, sf):
    return A.trades(spark, sf).select(*HISTORY.fieldNames())


def landed_csv(spark, sf):
    path = fresh_path(spark, "history")
    writers.write_csv(history(spark, sf).select(*HISTORY.fieldNames()[::-1]), path)
    return path


def src_history_csv(spark, sf):
    """A history whose columns stand in another order, without the rows of sources loaded before 1998."""
    rows = readers.history_csv(spark, landed_csv(spark, sf), HISTORY)
    done = readers.processed_sources(rows.filter(F.col("trading_date") < "1998-01-01"), "source_file")
    return rows.join(done, "source_file", "left_anti").select(*HISTORY.fieldNames())


add(
    "src_history_csv",
    src_history_csv,
    f"""WITH {TRADES} SELECT {H} FROM trades
WHERE source_file NOT IN (SELECT source_file FROM trades WHERE trading_date < DATE '1998-01-01' AND source_file IS NOT NULL) OR source_file IS NULL""",
    ["trading_date"],
)
add(
    "sink_csv",
    lambda s, sf: readers.history_csv(s, landed_csv(s, sf), HISTORY).groupBy("stock_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"), F.count("close").alias("n_close")),
    f"WITH {TRADES} SELECT stock_code, count(*) AS n, sum(volume) AS volume, count(close) AS n_close FROM trades GROUP BY stock_code",
)


def src_sheet_rows(spark, sf):
    rows = readers.sheet_rows(spark, land(A.daily_sheets(spark, sf), "sheets"))
    return rows.select("file_name", "row_idx", F.size("cells").alias("width"), F.element_at("cells", 1).alias("first_cell"))


add(
    "src_sheet_rows",
    src_sheet_rows,
    f"""WITH {SHEET} SELECT source_file AS file_name, load_seq + 10 AS row_idx, CASE WHEN l_linenumber = 7 THEN 7 ELSE 8 END AS width, stock_code AS first_cell FROM rows
UNION ALL SELECT DISTINCT source_file, 0, 8, 'Stock Code' FROM rows""",
)


def src_json_pages(spark, sf):
    path = stage_path(spark, "pages")
    writers.write_json(A.broker_rows(spark, sf), path)
    pages = readers.json_pages(spark, path, schemas.BROKER_PAGE)
    tx = F.col("data.broker_activity_transaction")
    return pages.select("broker_code", "target_date", "load_seq", F.size(tx["brokers_buy"]).alias("buys"), F.size(tx["brokers_sell"]).alias("sells"))


add(
    "src_json_pages",
    src_json_pages,
    """SELECT 'B' || l_suppkey AS broker_code, CAST(l_shipdate AS DATE) AS target_date, l_orderkey * 256 + l_linenumber * 32 + l_partkey % 32 AS load_seq,
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE 2 END AS buys, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 0 END AS sells FROM lineitem""",
    ["target_date"],
)


def monthly_zips(spark, sf):
    """A folder with one zip for each month and segment; a file holds one line per listed code, as the exchange's
    files do. Besides them a file that is no zip, a zip without text, and a file of another kind."""
    heads = ["Date", "Code", "Type", "Sec. Num", "Price", *[x.replace("_", " ") for x in schemas.LOCALS], "Total",
             *[x.replace("_", " ") for x in schemas.FOREIGNS], "Total"]
    text = A.monthly_text(spark, sf)
    name = F.concat(F.left("Code", F.lit(2)), F.lit("_"), F.col("file_name"))
    lines = text.select(name.alias("name"), "row_idx", F.concat_ws("|", *schemas.MONTHLY_REQUIRED).alias("line"))

    def zipped(member: str, body: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.md", "x")
            z.writestr(member, body.encode("latin1"))
        return out.getvalue()

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        body = "\n".join(["|".join(heads), *part.sort_values("row_idx")["line"]])
        return pd.DataFrame({"name": [part["name"].iloc[0]], "content": [zipped("balance.TXT", body)]})

    folder = stage_path(spark, "zips")
    archives.write_files(lines.groupBy("name").applyInPandas(pack, "name string, content binary"), folder)
    others = [("broken.zip", b"no zip"), ("empty.ZIP", zipped("notes.md", "x")), ("readme.txt", b"Date|Code")]
    archives.write_files(spark.createDataFrame(others, "name string, content binary"), folder)
    return folder


MONTHLY_COLUMNS = schemas.MONTHLY_REQUIRED
_ZIPPED = "left(Code, 2) || '_balancepos' || strftime(Date, '%Y%m%d') || '.zip' AS file_name"
add(
    "src_zip_pipe",
    lambda s, sf: B.typed(archives.rows_of(archives.zip_pipe(s, monthly_zips(s, sf)))).select("file_name", *MONTHLY_COLUMNS),
    f"""WITH {RAW} SELECT {_ZIPPED}, {', '.join(MONTHLY_COLUMNS)}
FROM raw WHERE NOT (o_orderstatus = 'P' AND Code LIKE 'MA%')""",
    ["Date"],
)
add(
    "src_zip_report",
    lambda s, sf: archives.report_of(archives.zip_pipe(s, monthly_zips(s, sf))),
    f"""WITH {RAW} SELECT {_ZIPPED}, 'rows' AS status, count(*) AS n_rows FROM raw GROUP BY 1
UNION ALL SELECT 'broken.zip', 'bad', 0 UNION ALL SELECT 'empty.ZIP', 'no member', 0""",
)


def sink_sorted_export(spark, sf):
    path = fresh_path(spark, "export")
    table = snapshot(spark, sf)
    writers.sorted_export(table, path, ["code", "date"])
    return spark.read.schema(table.schema).option("header", True).csv(path)


add("sink_sorted_export", sink_sorted_export, f"WITH {CHAIN} SELECT {WIDE} FROM done", ["date"])


def sink_replace_table(spark, sf):
    """Replace a table by an aggregate of itself: it is read while being replaced."""
    first = writers.replace_table(history(spark, sf), "bourseline_history")
    per_stock = first.groupBy("stock_code").agg(F.count(F.lit(1)).alias("n"), F.max("trading_date").alias("last_date"))
    return writers.replace_table(per_stock, "bourseline_history")


add(
    "sink_replace_table",
    sink_replace_table,
    f"WITH {TRADES} SELECT stock_code, count(*) AS n, max(trading_date) AS last_date FROM trades GROUP BY stock_code",
    ["last_date"],
)

UPSERT = schemas.struct("share_code string, shares bigint, version int, date date")


def share_totals(holdings, version: int):
    totals = holdings.groupBy("date", "share_code").agg(F.sum("total_holding_shares").alias("shares"))
    return totals.select("share_code", "shares", F.lit(version).alias("version"), "date")


def sink_upsert_by_date(spark, sf):
    """A first load of all dates, then a second one of the dates from 2000 on."""
    path = fresh_path(spark, "totals")
    own = A.ownership(spark, sf)
    writers.declare_table(spark, path, UPSERT, "date")
    writers.upsert_by_date(share_totals(own, 1), path, "date")
    writers.upsert_by_date(share_totals(own.filter(F.col("date") >= "2000-01-01"), 2), path, "date")
    return writers.read_table(spark, path, UPSERT)


TOTALS = f"""WITH {OWN} SELECT date, share_code, CAST(sum(total_holding_shares) AS BIGINT) AS shares,
  CASE WHEN date >= DATE '2000-01-01' THEN 2 ELSE 1 END AS version FROM own GROUP BY ALL"""
add("sink_upsert_by_date", sink_upsert_by_date, TOTALS, ["date"])


def stream_upsert_by_date(spark, sf):
    """Two landings of holder rows, each date in two pieces. Each run stops when it is done; the
    second sees only the new files, and the totals of a date are those of both pieces."""
    landing, kept, path, checkpoint = (fresh_path(spark, x) for x in ("landing", "intake", "totals", "progress"))
    own = A.ownership(spark, sf).withColumn("version", (F.col("load_seq") % 2 + 1).cast("int"))

    def totals(rows):
        sums = rows.groupBy("date", "share_code").agg(F.sum("total_holding_shares").alias("shares"), F.max("version").alias("version"))
        return sums.select(*UPSERT.fieldNames())

    for version in (1, 2):
        own.filter(F.col("version") == version).write.mode("append").parquet(landing)
        stream = intake.landed(spark, landing, own.schema, "parquet")
        intake.upsert_new_files(stream, lambda batch: batch, totals, kept, path, "date", checkpoint)
    return writers.read_table(spark, path, UPSERT)


add(
    "stream_upsert_by_date",
    stream_upsert_by_date,
    f"""WITH {OWN} SELECT date, share_code, CAST(sum(total_holding_shares) AS BIGINT) AS shares,
  CAST(max(load_seq % 2 + 1) AS INTEGER) AS version FROM own GROUP BY date, share_code""",
    ["date"],
)


def sink_view_snapshot(spark, sf):
    own = A.ownership(spark, sf)
    writers.replace_table(own, "bourseline_holdings")
    writers.define_view(spark, "bourseline_totals", "SELECT date, share_code, sum(total_holding_shares) AS shares FROM bourseline_holdings GROUP BY date, share_code")
    return writers.snapshot_view(spark, "bourseline_totals", "bourseline_totals_snapshot")


add(
    "sink_view_snapshot",
    sink_view_snapshot,
    f"WITH {OWN} SELECT date, share_code, CAST(sum(total_holding_shares) AS BIGINT) AS shares FROM own GROUP BY ALL",
    ["date"],
)


def set_union_history(spark, sf):
    """History up to 1998 with a column the new rows no longer have, new rows after."""
    rows = history(spark, sf)
    old = rows.filter(F.col("trading_date") < "1999-01-01").withColumn("obsolete", F.lit(1)).drop("volume")
    new = rows.filter(F.col("trading_date") >= "1999-01-01")
    return frames.append_to_history(old, new)


add(
    "set_union_history",
    set_union_history,
    f"WITH {TRADES} SELECT stock_code, trading_date, close, CASE WHEN trading_date >= DATE '1999-01-01' THEN volume END AS volume, source_file FROM trades",
    ["trading_date"],
)


def join_anti_processed(spark, sf):
    """Document rows not yet loaded; the processed list holds eight-digit prefixes,
    stems or whole names, depending on the year."""
    docs = A.major_documents(spark, sf)
    year, name = F.left("file_name", F.lit(4)), F.col("file_name")
    key = F.when(year == "1995", F.left(name, F.lit(8))).when(year == "1996", F.replace(name, F.lit(".pdf"), F.lit(""))).when(year == "1997", name)
    done = docs.select(key.alias("source")).na.drop().distinct()
    return joins.unprocessed(docs, done, "file_name", "source", loose=True).select("file_name", "page_idx", "row_idx")


add(
    "join_anti_processed",
    join_anti_processed,
    f"""WITH {HELD}, listed AS (
  SELECT strftime(tanggal_data, '%Y%m%d') || '_list.pdf' AS file_name, CAST(c_nationkey + 1 AS INTEGER) AS page_idx, load_seq + 10 AS row_idx
  FROM held WHERE year(tanggal_data) NOT IN (1995, 1996, 1997)
)
SELECT * FROM listed UNION ALL SELECT DISTINCT file_name, 0, 0 FROM listed
UNION ALL SELECT file_name, page_idx, r FROM (SELECT DISTINCT file_name, page_idx FROM listed), range(4) AS t(r)""",
)


def major_files(spark, sf):
    """A folder with one file of JSON rows for each document, and files that no rule selects, one of them broken."""
    docs = A.major_documents(spark, sf)
    line = F.to_json(F.struct("page_idx", "row_idx", "load_seq", "cells"))
    folder = stage_path(spark, "documents")
    archives.write_lines(docs.select(F.col("file_name").alias("name"), line.alias("line"), "page_idx", "row_idx"), folder, ["page_idx", "row_idx"])
    others = [("19990101_list.doc", b"{broken"), ("list.pdf", b"{broken"), ("19990101_notes.pdf", b"{broken")]
    archives.write_files(spark.createDataFrame(others, "name string, content binary"), folder)
    return folder


DOCUMENT_ROWS = schemas.struct("page_idx int, row_idx bigint, load_seq bigint, cells array<string>")


def src_file_select(spark, sf):
    """Rows of the documents whose name holds LIST (any case), ends in .pdf and starts with a date; the others are not opened."""
    files = listing.select_files(listing.list_files(spark, major_files(spark, sf)), contains="LIST", extension=".pdf", dated=True)
    return listing.read_files(files, DOCUMENT_ROWS).groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.sum("load_seq").alias("seq_sum"))


_FILES = f"""WITH {HELD}, files AS (SELECT strftime(tanggal_data, '%Y%m%d') || '_list.pdf' AS file_name, tanggal_data,
  count(*) + 4 * count(DISTINCT c_nationkey) + 1 AS n, sum(load_seq) + 6 * count(DISTINCT c_nationkey) AS seq_sum FROM held GROUP BY ALL)"""
add("src_file_select", src_file_select, f"{_FILES} SELECT file_name, n, CAST(seq_sum AS BIGINT) AS seq_sum FROM files")


def src_file_ledger(spark, sf):
    """Two runs over a folder that changes in between: the second reads only files that are new or have changed. What each run read."""
    folder, store = major_files(spark, sf), stage_path(spark, "ledger")
    out = None
    for run in (1, 2):
        if run == 2:  # one file is sent again with a row more, one is new
            late = spark.createDataFrame([("19950131_list.pdf", b'{"row_idx": 1}\n{"row_idx": 2}'), ("21000101_list.pdf", b'{"row_idx": 3}')], "name string, content binary")
            archives.write_files(late, folder)
        files = listing.select_files(listing.list_files(spark, folder), contains="list", extension=".pdf", dated=True)
        fresh = listing.unprocessed_files(files, store)
        read = stage(listing.read_files(fresh, DOCUMENT_ROWS).groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.lit(run)), "read")
        ledger.write(ledger.of_files(fresh), store, run)
        ledger.commit(spark, store, run)
        out = read if out is None else out.unionByName(read)
    return out


add(
    "src_file_ledger",
    src_file_ledger,
    f"""{_FILES} SELECT file_name, n, 1 AS run FROM files UNION ALL SELECT '19950131_list.pdf', 2, 2 UNION ALL SELECT '21000101_list.pdf', 1, 2""",
)


def sink_declare_table(spark, sf):
    """Declared twice: the second time leaves the rows written in between alone."""
    path = fresh_path(spark, "declared")
    writers.declare_table(spark, path, UPSERT, "date")
    writers.upsert_by_date(share_totals(A.ownership(spark, sf), 1), path, "date")
    writers.declare_table(spark, path, UPSERT, "date")
    return writers.read_table(spark, path, UPSERT)


add(
    "sink_declare_table",
    sink_declare_table,
    f"WITH {OWN} SELECT date, share_code, CAST(sum(total_holding_shares) AS BIGINT) AS shares, 1 AS version FROM own GROUP BY date, share_code",
    ["date"],
)


def sink_view(spark, sf):
    """A view over a stored table, replaced by a narrower one."""
    writers.replace_table(A.ownership(spark, sf), "bourseline_holdings")
    writers.define_view(spark, "bourseline_large_holdings", "SELECT * FROM bourseline_holdings")
    return writers.define_view(spark, "bourseline_large_holdings", "SELECT date, share_code, investor_name, load_seq, percentage FROM bourseline_holdings WHERE percentage >= 1")


add(
    "sink_view",
    sink_view,
    f"WITH {OWN} SELECT date, share_code, investor_name, load_seq, percentage FROM own WHERE percentage >= 1",
    ["date"],
)


def sink_register(spark, sf):
    """A frame queried with SQL by its registered name."""
    history(spark, sf).createOrReplaceTempView("bourseline_daily")
    return spark.sql("SELECT stock_code, count(*) AS n, sum(volume) AS volume FROM bourseline_daily GROUP BY stock_code")


add("sink_register", sink_register, f"WITH {TRADES} SELECT stock_code, count(*) AS n, sum(volume) AS volume FROM trades GROUP BY stock_code")
