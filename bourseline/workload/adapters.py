"""The test tables reshaped into market inputs.

Every adapter keeps all rows of its tables. Money is carried in whole cents and
percentages in steps of 1/1024, so sums are exact in any order.
"""

from __future__ import annotations

from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bourseline import schemas
from bourseline.sources.storage import land

c, lit = F.col, F.lit

_splits: dict[tuple, int] = {}
_schemas: dict[tuple, StructType] = {}
_landed: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def landed(build):
    """Raw text inputs arrive as files: write them once per session and table
    folder, then read them as any landed file is read."""

    @wraps(build)
    def read(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, build.__name__, sf)
        if key in _landed:
            path, schema = _landed[key]
            try:
                return spark.read.schema(schema).parquet(path)
            except AnalysisException:  # someone cleaned the folder: land again
                pass
        df = build(spark, sf)
        _landed[key] = land(df, build.__name__), df.schema
        path, schema = _landed[key]
        return spark.read.schema(schema).parquet(path)

    return read


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per session."""
    path = f"{sf}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def spread(spark: SparkSession, sf: str, name: str, *keys: str) -> DataFrame:
    """A table for costly row work: rows of fewer splits than cores (a single small
    file) are spread over the cores; a table of many files is left as it is."""
    df = table(spark, sf, name)
    cores = spark.sparkContext.defaultParallelism
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _splits:
        _splits[key] = df.rdd.getNumPartitions()
    return df.repartition(cores, *keys) if _splits[key] < cores else df


def load_position() -> Column:
    """Where a line item stands in load order. Order and line number alone repeat;
    the part tells rows of one supplier and day apart."""
    return c("l_orderkey") * 256 + c("l_linenumber") * 32 + c("l_partkey") % 32


# ---- daily trading: one sheet row per line item ------------------------------


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Stock = supplier, day = ship date. Several line items of one supplier and
    day are copies; some prices and volumes are missing."""
    ln, qty, ext = c("l_linenumber"), c("l_quantity"), c("l_extendedprice")
    px = (F.floor(ext / qty / 3) * 3).cast("double")
    volume = qty * 4200
    rows = table(spark, sf, "lineitem").withColumns({"px": px, "volume": volume}).withColumn(
        "previous",
        F.when((ln == 5) & (c("l_linestatus") == "O"), 0.0)
        .when((ln == 4) & (c("l_linestatus") == "O"), None)
        .otherwise(c("px") - 3 * F.round(c("l_discount") * 100)),
    )
    day = c("l_shipdate").cast("date")
    return rows.select(
        F.concat(lit("S"), c("l_suppkey").cast("string")).alias("stock_code"),
        day.alias("trading_date"),
        c("px").alias("open_price"),
        F.when(ln != 6, c("px") + 3 * ln).alias("high"),
        F.when(ln != 6, c("px") - 3 * ln).alias("low"),
        F.when(ln != 7, c("px")).alias("close"),
        "previous",
        (c("px") - c("previous")).alias("change"),
        "volume",
        (F.round(ext * 100) * 300).alias("value"),
        (ln - 1).cast("double").alias("frequency"),
        (c("px") - 3).alias("bid"),
        (c("px") + 3).alias("offer"),
        (qty * 100).alias("bid_volume"),
        F.when(ln != 3, qty * 200).alias("offer_volume"),
        F.when(c("l_returnflag") == "R", c("volume")).otherwise(0.0).alias("foreign_buy"),
        F.when(c("l_returnflag") == "A", c("volume")).otherwise(0.0).alias("foreign_sell"),
        (c("l_partkey") * 1000).alias("tradeable_shares"),
        F.concat(lit("daily_"), F.date_format(day, "yyyyMMdd"), lit(".xlsx")).alias("source_file"),
        load_position().alias("load_seq"),
    )


# Month names as a local sheet spells them in full and in short.
LONG_MONTHS = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember"]
SHORT_MONTHS = ["Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agt", "Sep", "Okt", "Nov", "Des"]
ENGLISH_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_name(day: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[lit(n) for n in names]), F.month(day))


def by_line(cases: list[Column]) -> Column:
    """One of the spellings, by line number."""
    expr = F.when(c("l_linenumber") == 1, cases[0])
    for i, case in enumerate(cases[1:], 2):
        expr = expr.when(c("l_linenumber") == i, case)
    return expr


def trade_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with dates, prices and counts spelled in many ways."""
    day = c("l_shipdate").cast("date")
    dd, yyyy, d1 = F.date_format(day, "dd"), F.date_format(day, "yyyy"), F.dayofmonth(day).cast("string")
    ext, ln = c("l_extendedprice"), c("l_linenumber")
    grouped = F.format_number(ext, 2)
    swapped = F.translate(grouped, ",.", ".,")
    whole = F.format_number(F.floor(ext), 0)
    return spread(spark, sf, "lineitem", "l_orderkey", "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        by_line([
            F.concat_ws(" ", dd, month_name(day, SHORT_MONTHS), yyyy),
            F.concat(lit(" "), d1, lit(" "), month_name(day, SHORT_MONTHS), lit("  "), yyyy),
            F.date_format(day, "yyyy-MM-dd"),
            F.concat_ws(" ", dd, month_name(day, LONG_MONTHS), yyyy),
            lit(""),
            F.date_format(day, "MM/dd/yyyy"),
            lit("n/a"),
        ]).alias("date_text"),
        by_line([
            F.concat_ws("-", dd, F.upper(month_name(day, SHORT_MONTHS)), yyyy),
            F.concat_ws("-", dd, month_name(day, ENGLISH_MONTHS), yyyy),
            F.concat_ws("-", d1, F.lower(month_name(day, ENGLISH_MONTHS)), yyyy),
            F.concat_ws(" ", dd, month_name(day, ENGLISH_MONTHS), yyyy),
            lit("31-Feb-2024"),
            F.date_format(day, "dd-MM-yyyy"),
            lit("bad"),
        ]).alias("monthly_text"),
        F.concat(by_line([lit("x_"), lit(""), lit("rep-v1-"), lit("2_"), lit("a"), lit("b 12 "), lit("none")]),
                 F.when(ln < 7, F.date_format(day, "yyyyMMdd")).otherwise(""), lit(".tar.xlsx")).alias("file_name"),
        F.concat_ws(" ", dd, month_name(day, ENGLISH_MONTHS), F.when(ln == 7, "1x").otherwise(F.date_format(day, "yy"))).alias("short_date_text"),
        by_line([
            F.concat(F.date_format(day, "yyyy-MM-dd"), lit("T00:00:00Z")), F.date_format(day, "yyyy-MM-dd"), lit(""),
            lit(None).cast("string"), F.date_format(day, "yyyy-MM-dd"), lit(""), F.concat(F.date_format(day, "yyyy-MM-dd"), lit("T17:00:00")),
        ]).alias("iso_text"),
        by_line([
            F.concat(lit("Rp "), grouped), F.concat(lit("Rp. "), swapped), lit("-"), lit(""), lit("nan"), grouped, F.concat(c("l_quantity").cast("string"), lit("d")),
        ]).alias("currency_text"),
        by_line([
            grouped, swapped, F.replace(ext.cast("string"), lit("."), lit(",")), F.concat(c("l_quantity").cast("string"), lit(" %")),
            F.concat(F.translate(whole, ",", "."), lit(".000")), lit(""), lit("None"),
        ]).alias("float_text"),
        by_line([
            whole, F.translate(whole, ",", "."), F.concat(F.floor(ext).cast("string"), lit(".0")), lit(" 12 345 "), lit("abc"), lit(""), F.concat(lit("-"), whole),
        ]).alias("int_text"),
        by_line([
            whole, lit("-"), F.concat(lit("-"), whole), F.translate(whole, ",", " "), lit(""), lit("n.a."), F.concat(whole, lit(".7")),
        ]).alias("dash_text"),
        by_line([
            F.concat(lit("+"), whole), F.concat(lit("-"), whole), lit(None).cast("string"), F.concat(whole, lit(".9")), lit("1d"), lit("0"), F.concat(lit("-"), whole, lit(".9")),
        ]).alias("signed_text"),
        by_line([lit("true"), lit("FALSE"), lit("1"), lit("0"), lit(None).cast("string"), lit("yes"), lit("True")]).alias("bool_text"),
    )


@landed
def daily_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Sheet rows as cells: one file per ship date with a heading in row 0; rows of
    line 7 lack a cell."""
    base = spread(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    day = c("l_shipdate").cast("date")
    name = F.concat(lit("sheet_"), F.date_format(day, "yyyyMMdd"), lit(".xlsx")).alias("file_name")
    heads = base.select(name).distinct().select(
        "file_name", lit(0).alias("page_idx"), lit(0).cast("bigint").alias("row_idx"), lit(0).cast("bigint").alias("load_seq"),
        F.array(*[lit(h) for h in SHEET_HEADINGS]).alias("cells"),
    )
    seq = load_position()
    body = [
        F.concat(lit("S"), c("l_suppkey").cast("string")),
        F.when(c("l_linenumber") == 5, "").otherwise(
            F.concat_ws(" ", F.date_format(day, "dd"), month_name(day, SHORT_MONTHS), F.date_format(day, "yyyy"))),
        F.format_number(F.floor(c("l_extendedprice") / c("l_quantity")), 0),
        F.format_number(c("l_quantity") * 4200, 0),
        F.format_number(F.round(c("l_extendedprice") * 100) * 300, 0),
        F.concat(lit("Rp "), c("l_linenumber").cast("string")),
        F.when(c("l_returnflag") == "R", F.format_number(c("l_quantity") * 4200, 0)).otherwise("0"),
        F.when(c("l_returnflag") == "A", F.format_number(c("l_quantity") * 4200, 0)).otherwise("-"),
    ]
    rows = base.select(
        name, lit(0).alias("page_idx"), (seq + 10).alias("row_idx"), seq.alias("load_seq"),
        F.when(c("l_linenumber") == 7, F.array(*body[:-1])).otherwise(F.array(*body)).alias("cells"),
    )
    return heads.unionByName(rows)


SHEET_HEADINGS = ["Stock Code", "Last Trading Date", "Close", "Volume", "Value", "Frequency", "Foreign Buy", "Foreign Sell"]


# ---- holder lists: one row per order ------------------------------------------


def placed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer; `snap` is the month end two days back."""
    orders, customer = spread(spark, sf, "orders", "o_custkey"), table(spark, sf, "customer")
    return orders.join(customer, c("o_custkey") == c("c_custkey")).withColumn(
        "snap", F.last_day(F.date_sub(c("o_orderdate").cast("date"), 2))
    )


SEGMENT_TYPES = {"MACHINERY": "cp", "BUILDING": "ID", "AUTOMOBILE": "Mutual Funds", "HOUSEHOLD": " Individual", "FURNITURE": "zz"}
ORIGINS = ["A", "Asing", "l", "", "X"]


def pick(key: Column, values: dict) -> Column:
    expr = None
    for k, v in values.items():
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr


def holder_fields() -> dict[str, Column]:
    cents = F.round(c("o_totalprice") * 100).cast("bigint")
    scrip = F.floor(c("o_totalprice")).cast("bigint")
    return {
        "date": c("snap"),
        "share_code": F.concat(lit("N"), F.lpad(c("c_nationkey").cast("string"), 3, "0")),
        "issuer_name": F.concat(lit("ISSUER\nNO "), c("c_nationkey").cast("string")),
        "investor_name": F.concat_ws(" ", "c_mktsegment", "o_orderpriority"),
        "investor_type": pick(c("c_mktsegment"), SEGMENT_TYPES),
        "local_foreign": pick(c("c_nationkey") % 5, dict(enumerate(ORIGINS))),
        "nationality": F.concat(lit("NATION_"), c("c_nationkey").cast("string")),
        "domicile": c("c_mktsegment"),
        "holdings_scripless": cents - scrip,
        "holdings_scrip": scrip,
        "total_holding_shares": cents,
        "percentage": F.floor(c("o_totalprice") / 20) / lit(1024.0),
    }


# Standard values of the raw types and origins above, for typed input.
CLEAN_TYPES = {"MACHINERY": "Corporate", "BUILDING": "Individual", "AUTOMOBILE": "Fund Manager", "HOUSEHOLD": "Individual", "FURNITURE": "Financial Institutional"}


def ownership(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned holder table, one row per order; a holder has copies on a date."""
    f = holder_fields()
    f["investor_type"] = pick(c("c_mktsegment"), CLEAN_TYPES)
    f["local_foreign"] = F.when(c("c_nationkey") % 5 < 2, "F").otherwise("L")
    source = F.concat(lit("holders_"), F.date_format("snap", "yyyyMMdd")).alias("data_source")
    return placed(spark, sf).select(source, *[v.alias(k) for k, v in f.items()], c("o_orderkey").alias("load_seq"))


HEADING_A = [k.upper() for k in schemas.HOLDER_COLUMNS]
HEADING_B = ["Share Code", "Investor Name", "Date", "Investor_Classification", "LocalForeign", "Nationality", "Domicile",
             "Total Shares", "Holdings Scrip", "Holdings Scripless", "Issuer Name", "Percentage"]
HEADING_C = ["DATE", "SHARE_CODE", "INVESTOR_NAME", "TOTAL_HOLDING_SHARES", "PERCENTAGE"]


def sheet_layout(snap: Column) -> Column:
    """Layout of a month's file: C in 1997, else A in odd and B in even months."""
    return F.when(F.year(snap) == 1997, "C").when(F.month(snap) % 2 == 1, "A").otherwise("B")


@landed
def holder_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Raw holder-list cells in three layouts, with titles, blank rows and bad codes."""
    f = holder_fields()
    key = c("o_orderkey")
    pct = f["percentage"].cast("string")
    pct_text = F.when(key % 3 == 0, pct).when(key % 3 == 1, F.replace(pct, lit("."), lit(","))).otherwise(F.concat(pct, lit(" %")))

    def count(v: Column) -> Column:
        text = F.format_number(v, 0)
        return F.when(key % 2 == 0, text).otherwise(F.translate(text, ",", "."))

    code = F.when(c("c_nationkey") == 7, "too-long-7").otherwise(F.lower(f["share_code"]))
    cells = {
        "DATE": F.when(sheet_layout(c("snap")) == "B", F.date_format("snap", "dd/MM/yyyy")).otherwise(F.date_format("snap", "yyyy-MM-dd")),
        "SHARE_CODE": code,
        "HOLDINGS_SCRIPLESS": count(f["holdings_scripless"]),
        "HOLDINGS_SCRIP": count(f["holdings_scrip"]),
        "TOTAL_HOLDING_SHARES": count(f["total_holding_shares"]),
        "PERCENTAGE": pct_text,
    } | {k.upper(): f[k] for k in ("issuer_name", "investor_name", "investor_type", "local_foreign", "nationality", "domicile")}
    order_b = ["SHARE_CODE", "INVESTOR_NAME", "DATE", "INVESTOR_TYPE", "LOCAL_FOREIGN", "NATIONALITY", "DOMICILE",
               "TOTAL_HOLDING_SHARES", "HOLDINGS_SCRIP", "HOLDINGS_SCRIPLESS", "ISSUER_NAME", "PERCENTAGE"]
    layout = sheet_layout(c("snap"))

    def row(names: list[str]) -> Column:
        return F.array(*[cells[n] for n in names])

    name = F.concat(lit("holders_"), F.date_format("snap", "yyyyMMdd"), lit(".xlsx"))
    base = placed(spark, sf)
    body = base.select(
        name.alias("file_name"), lit(0).alias("page_idx"), (key + 10).alias("row_idx"), key.alias("load_seq"),
        F.when(layout == "A", row(HEADING_A)).when(layout == "B", row(order_b)).otherwise(row(HEADING_C)).alias("cells"),
    )

    def texts(values: list[str | None]) -> Column:
        return F.array(*[lit(v).cast("string") for v in values])

    none = [None] * 11
    tops = F.when(layout == "A", F.array(F.struct(lit(0).alias("r"), texts(HEADING_A).alias("v")))).when(
        layout == "B",
        F.array(*[
            F.struct(lit(r).alias("r"), texts(v).alias("v"))
            for r, v in enumerate([["Daftar Pemegang Saham", *none], [None, *none], ["Per bulan", *none], HEADING_B])
        ]),
    ).otherwise(F.array(F.struct(lit(0).alias("r"), texts(HEADING_C).alias("v"))))
    heads = base.select("snap").distinct().select(name.alias("file_name"), F.explode(tops).alias("h")).select(
        "file_name", lit(0).alias("page_idx"), c("h.r").cast("bigint").alias("row_idx"), c("h.r").cast("bigint").alias("load_seq"), c("h.v").alias("cells")
    )
    return heads.unionByName(body)


def major_counts() -> tuple[Column, Column]:
    """Previous and current count of a 5 percent holder, covering every action."""
    base, status, prio = F.floor(c("o_totalprice")).cast("bigint"), c("o_orderstatus"), F.left(c("o_orderpriority"), lit(1))
    zero = lit(0).cast("bigint")
    prev = F.when(status == "F", zero).when(status == "P", F.when(prio.isin("1", "3"), zero).otherwise(base)).otherwise(
        F.when(prio == "1", base).when(prio == "2", base - 500).otherwise(base + 500))
    curr = F.when(status == "P", zero).otherwise(base)
    return prev, curr


def majors(spark: SparkSession, sf: str) -> DataFrame:
    """Typed 5 percent rows before the action is set."""
    prev, curr = major_counts()
    return placed(spark, sf).select(
        c("snap").alias("tanggal_data"),
        F.concat(lit("N"), c("c_nationkey").cast("string")).alias("kode_efek"),
        F.concat(lit("ACC "), c("c_mktsegment")).alias("nama_pemegang_rekening_efek"),
        F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("nama_pemegang_saham"),
        F.concat(lit("REK "), c("o_orderpriority")).alias("nama_rekening_efek"),
        c("o_orderstatus").alias("status"),
        prev.alias("jumlah_saham_prev"), curr.alias("jumlah_saham_curr"),
        c("o_orderkey").alias("load_seq"),
    )


MAJOR_HEADING = ["No", "Kode Efek", "Nama Emiten", "Nama Pemegang Rekening Efek", "Nama Pemegang Saham"] + ["-"] * 13


@landed
def major_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Document rows: a cover page, a page per nation with heading and footer, short
    and empty rows; pages of nation 24 start with a short row and are skipped."""
    prev, curr = major_counts()

    def count(v: Column) -> Column:
        return F.when(v == 0, "-").otherwise(F.format_number(v, 0))

    name = F.concat(F.date_format("snap", "yyyyMMdd"), lit("_list.pdf"))
    blank = lit("")
    cells = F.array(
        c("o_orderkey").cast("string"), F.concat(lit("N"), c("c_nationkey").cast("string")), blank, F.concat(lit("ACC "), c("c_mktsegment")),
        F.concat_ws(" ", "c_mktsegment", "o_orderpriority"), F.concat(lit("REK "), c("o_orderpriority")), blank, blank, blank, blank,
        c("o_orderstatus"), count(prev), blank, blank, count(curr), blank, blank, blank,
    )
    base = placed(spark, sf)
    body = base.select(
        name.alias("file_name"), (c("c_nationkey") + 1).alias("page_idx"), (c("o_orderkey") + 10).alias("row_idx"), c("o_orderkey").alias("load_seq"), cells.alias("cells")
    )

    def texts(values: list[str | None]) -> Column:
        return F.array(*[lit(v).cast("string") for v in values])

    heading = F.when(c("page_idx") == 25, texts(MAJOR_HEADING[:3])).otherwise(texts(MAJOR_HEADING))
    extra = {0: heading, 1: texts(["—", "", None, " — "] + ["x"] * 14), 2: texts(["1", "2", "3", "4", "5"]), 3: texts(["Halaman 2"] + [None] * 17)}
    pages = body.select("file_name", "page_idx").distinct()
    heads = pages.select("file_name", "page_idx", F.explode(F.array(*[F.struct(lit(r).alias("r"), v.alias("v")) for r, v in extra.items()])).alias("h"))
    cover = pages.select("file_name").distinct().select(
        "file_name", lit(0).alias("page_idx"), F.struct(lit(0).alias("r"), texts(["cover"] * 18).alias("v")).alias("h"))
    tops = heads.unionByName(cover).select("file_name", "page_idx", c("h.r").cast("bigint").alias("row_idx"), c("h.r").cast("bigint").alias("load_seq"), c("h.v").alias("cells"))
    return tops.unionByName(body)


# ---- monthly balances: orders by code, month and status -------------------------


def monthly_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows; the statuses of one (code, month) are copies of it."""
    cents = F.round(c("o_totalprice") * 100).cast("bigint")
    bucket = c("o_orderkey") % 18
    sums = [F.coalesce(F.sum(F.when(bucket == i, cents)), lit(0).cast("bigint")).alias(p) for i, p in enumerate(schemas.POSITIONS)]
    code = F.concat(F.left(c("c_mktsegment"), lit(2)), c("c_nationkey").cast("string"))
    df = placed(spark, sf).groupBy(code.alias("Code"), c("snap").alias("Date"), "o_orderstatus").agg(
        (F.count(lit(1)) * 1000).alias("Sec_Num"),
        F.floor(F.max("o_totalprice") / 1000).cast("double").alias("Price"),
        F.max("o_orderkey").alias("load_seq"), *sums,
    )
    local = sum((c(p) for p in schemas.LOCALS[1:]), c(schemas.LOCALS[0]))
    foreign = sum((c(p) for p in schemas.FOREIGNS[1:]), c(schemas.FOREIGNS[0]))
    off = F.when(c("o_orderstatus") == "P", 2).when(c("o_orderstatus") == "O", 1).otherwise(0)
    return df.withColumns({"Total_Local": local + off, "Total_Foreign": foreign - off}).select(
        "Date", "Code", lit("EQUITY").alias("Type"), *[x for x in schemas.MONTHLY_REQUIRED if x not in ("Date", "Code", "Type")],
        "o_orderstatus", "load_seq",
    )


@landed
def monthly_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows as raw text; status P of nations without a bond list is a bond."""
    df = monthly_raw(spark, sf)
    day = c("Date")
    text_date = F.concat_ws("-", F.date_format(day, "dd"), F.upper(month_name(day, SHORT_MONTHS)), F.date_format(day, "yyyy"))
    kind = F.when((c("o_orderstatus") == "P") & c("Code").startswith("MA"), "CORPORATE BOND").otherwise("EQUITY")
    numbers = [x for x in schemas.MONTHLY_REQUIRED if x not in ("Date", "Code", "Type")]
    return df.select(
        F.concat(lit("balancepos"), F.date_format(day, "yyyyMMdd"), lit(".zip")).alias("file_name"), c("load_seq").alias("row_idx"),
        text_date.alias("Date"), "Code", kind.alias("Type"), *[F.format_number(c(n), 0).alias(n) for n in numbers],
    )


# ---- broker and insider pages ----------------------------------------------------


def broker_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A page per line item; its transaction comes twice, the second with another value."""
    day, ln = c("l_shipdate").cast("date"), c("l_linenumber")
    cents = F.round(c("l_extendedprice") * 100).cast("bigint")
    iso = F.date_format(day, "yyyy-MM-dd")

    def item(value: Column) -> Column:
        return F.struct(
            F.when(ln == 1, F.concat(iso, lit("T00:00:00Z"))).when(ln == 2, "").otherwise(iso).alias("date"),
            F.when(ln != 7, F.concat(lit("P"), c("l_partkey").cast("string"))).alias("stock_code"),
            F.when(ln != 6, value.cast("string")).alias("value"),
            c("l_quantity").cast("bigint").cast("string").alias("lot"),
            (c("l_extendedprice") / c("l_quantity")).cast("string").alias("avg_price"),
            ln.cast("string").alias("freq"),
        )

    items = F.array(item(cents), item(cents + 1))
    none = F.filter(items, lambda _: lit(False))
    sell = c("l_returnflag") == "R"
    tx = F.struct(F.when(sell, none).otherwise(items).alias("brokers_buy"), F.when(sell, items).otherwise(none).alias("brokers_sell"))
    return spread(spark, sf, "lineitem", "l_orderkey", "l_partkey").select(
        F.concat(lit("B"), c("l_suppkey").cast("string")).alias("broker_code"),
        F.concat(lit("Broker "), c("l_suppkey").cast("string")).alias("broker_name"),
        day.alias("target_date"), load_position().alias("load_seq"),
        F.struct(tx.alias("broker_activity_transaction")).alias("data"),
    )


@landed
def broker_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages, landed."""
    return broker_rows(spark, sf)


@landed
def insider_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per order; its movement comes twice, the second under another name."""
    day, prio, status = c("o_orderdate").cast("date"), F.left(c("o_orderpriority"), lit(1)), c("o_orderstatus")
    base = F.floor(c("o_totalprice")).cast("bigint")
    prev = F.greatest(F.floor(c("c_acctbal")).cast("bigint") * 10, lit(0).cast("bigint"))
    diff = base - prev

    def amount(value: Column, pct: Column) -> Column:
        return F.struct(value.alias("value"), pct.alias("percentage"))

    def item(name: Column) -> Column:
        sign = F.when(diff >= 0, "+").otherwise("")
        return F.struct(
            F.concat(lit("I"), c("c_custkey").cast("string")).alias("id"),
            name.alias("name"),
            F.concat(lit("N"), c("c_nationkey").cast("string")).alias("symbol"),
            F.when(prio == "5", "someday").otherwise(
                F.concat_ws(" ", F.date_format(day, "dd"), month_name(day, ENGLISH_MONTHS), F.date_format(day, "yy"))).alias("date"),
            F.concat(lit("ACTION_TYPE_"), F.when(diff >= 0, "BUY").otherwise("SELL")).alias("action_type"),
            F.when(c("c_nationkey") % 2 == 0, "NATIONALITY_TYPE_LOCAL").otherwise("NATIONALITY_TYPE_FOREIGN").alias("nationality"),
            amount(F.format_number(prev, 0), F.format_number(prev / lit(1024.0), 4)).alias("previous"),
            amount(F.format_number(base, 0), F.format_number(base / lit(1024.0), 4)).alias("current"),
            amount(F.concat(sign, F.format_number(diff, 0)), F.concat(sign, F.format_number(diff / lit(1024.0), 4))).alias("changes"),
            F.when(prio == "1", "").when(prio == "2", None).otherwise(F.format_number(base, 0)).alias("price_formatted"),
            F.struct(c("c_mktsegment").alias("label"), F.concat(lit("SOURCE_TYPE_"), status).alias("type")).alias("data_source"),
            F.struct(F.when(prio != "3", F.concat(lit("B"), prio)).alias("code"), F.when(prio != "3", "BROKER_GROUP_LOCAL").alias("group")).alias("broker_detail"),
            F.when(status == "F", F.array(lit("SHAREHOLDER_BADGE_PENGENDALI"), lit("SHAREHOLDER_BADGE_DIREKSI")))
            .when(status == "O", F.array(lit("SHAREHOLDER_BADGE_KOMISARIS"))).alias("badges"),
        )

    movement = F.array(item(c("c_name")), item(F.concat(c("c_name"), lit(" copy"))))
    return placed(spark, sf).select(
        day.alias("target_date"), c("o_orderkey").alias("load_seq"), F.struct(lit(False).alias("is_more"), movement.alias("movement")).alias("data")
    )
