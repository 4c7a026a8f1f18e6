"""Column names, types and fixed look-up values of every dataset."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "array<string>": T.ArrayType(T.StringType()),
}


def struct(spec: str) -> T.StructType:
    """Schema of a flat table from "name type" pairs; needs no session."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


SHEET_ROWS = struct("file_name string, page_idx int, row_idx bigint, load_seq bigint, cells array<string>")

# ---- daily trading ---------------------------------------------------------

# Headings of the daily sheet and our names for them.
DAILY_HEADERS = {
    "Stock Code": "stock_code",
    "Last Trading Date": "trading_date",
    "Open Price": "open_price",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Previous": "previous",
    "Change": "change",
    "Volume": "volume",
    "Value": "value",
    "Frequency": "frequency",
    "Bid": "bid",
    "Offer": "offer",
    "Bid Volume": "bid_volume",
    "Offer Volume": "offer_volume",
    "Foreign Buy": "foreign_buy",
    "Foreign Sell": "foreign_sell",
    "Tradeble Shares": "tradeable_shares",
    "Source File": "source_file",
}

PRICES = ["high", "low", "close", "previous", "open_price", "bid", "offer"]
VOLUMES = ["volume", "value", "bid_volume", "offer_volume", "frequency"]

DAILY_TABLE = struct(
    "trading_date date, stock_code string, open_price double, high double, low double, close double, "
    "previous double, change_percent double, volume bigint, value bigint, frequency bigint, "
    "foreign_buy_value bigint, foreign_sell_value bigint, net_foreign_value bigint, vwma_20d double, "
    "ma20_volume bigint, avg_order_volume double, ma50_avg_order_volume double, aov_ratio_ma20 double, "
    "whale_signal boolean, big_player_anomaly boolean, signal string, tradeable_shares bigint, source_file string"
)

# ---- broker and insider ----------------------------------------------------

BROKER_ITEM = "struct<date:string,stock_code:string,value:string,lot:string,avg_price:string,freq:string>"
BROKER_PAGE = (
    "broker_code string, broker_name string, target_date date, load_seq bigint, "
    f"data struct<broker_activity_transaction:struct<brokers_buy:array<{BROKER_ITEM}>,brokers_sell:array<{BROKER_ITEM}>>>"
)
BROKER_TABLE = struct(
    "date date, broker_code string, broker_name string, side string, stock_code string, "
    "value bigint, lot bigint, avg_price double, freq bigint"
)

INSIDER_AMOUNT = "struct<value:string,percentage:string>"
INSIDER_ITEM = (
    "struct<id:string,name:string,symbol:string,date:string,action_type:string,nationality:string,"
    f"previous:{INSIDER_AMOUNT},current:{INSIDER_AMOUNT},changes:{INSIDER_AMOUNT},price_formatted:string,"
    "data_source:struct<label:string,type:string>,broker_detail:struct<code:string,group:string>,badges:array<string>>"
)
INSIDER_PAGE = (
    f"target_date date, load_seq bigint, data struct<is_more:boolean,movement:array<{INSIDER_ITEM}>>"
)
INSIDER_TABLE = struct(
    "insider_id string, insider_name string, stock_code string, transaction_date date, action_type string, "
    "nationality string, shares_previous bigint, pct_previous double, shares_current bigint, pct_current double, "
    "shares_change bigint, pct_change double, price_formatted double, data_source string, source_type string, "
    "broker_code string, broker_group string, is_pengendali boolean, is_komisaris boolean, is_direksi boolean, "
    "badges string, target_date date"
)

# Enumeration prefixes cut from the insider fields.
ACTION_PREFIX = "ACTION_TYPE_"
NATIONALITY_PREFIX = "NATIONALITY_TYPE_"
SOURCE_PREFIX = "SOURCE_TYPE_"
GROUP_PREFIX = "BROKER_GROUP_"
BADGE_PREFIX = "SHAREHOLDER_BADGE_"

# ---- holder lists, 1 percent -----------------------------------------------

# Cells that mark a heading row.
HOLDER_HEADING_MARKS = ["SHARE_CODE", "SHARE CODE", "INVESTOR_NAME", "INVESTOR NAME"]

# Heading synonyms, after normalization.
HOLDER_SYNONYMS = {
    "SHARECODE": "SHARE_CODE",
    "ISSUERNAME": "ISSUER_NAME",
    "INVESTORNAME": "INVESTOR_NAME",
    "INVESTOR_CLASSIFICATION": "INVESTOR_TYPE",
    "INVESTORCLASSIFICATION": "INVESTOR_TYPE",
    "INVESTORTYPE": "INVESTOR_TYPE",
    "LOCALFOREIGN": "LOCAL_FOREIGN",
    "HOLDINGSSCRIPLESS": "HOLDINGS_SCRIPLESS",
    "HOLDINGSSCRIP": "HOLDINGS_SCRIP",
    "TOTALHOLDINGSHARES": "TOTAL_HOLDING_SHARES",
    "TOTAL_HOLDING": "TOTAL_HOLDING_SHARES",
    "TOTAL_SHARES": "TOTAL_HOLDING_SHARES",
}

# The twelve columns of a holder list and their defaults, as text.
HOLDER_COLUMNS = {
    "DATE": "",
    "SHARE_CODE": "",
    "ISSUER_NAME": "",
    "INVESTOR_NAME": "",
    "INVESTOR_TYPE": "",
    "LOCAL_FOREIGN": "",
    "NATIONALITY": "",
    "DOMICILE": "",
    "HOLDINGS_SCRIPLESS": "0",
    "HOLDINGS_SCRIP": "0",
    "TOTAL_HOLDING_SHARES": "0",
    "PERCENTAGE": "0",
}

# Local or foreign.
LOCAL_FOREIGN = {
    "A": "F",
    "ASING": "F",
    "FOREIGN": "F",
    "L": "L",
    "LOKAL": "L",
    "LOCAL": "L",
    "D": "L",
    "DOMESTIK": "L",
    "": "L",
}

# Investor types, short and long forms.
INVESTOR_TYPES = {
    "CP": "Corporate",
    "CORPORATE": "Corporate",
    "ID": "Individual",
    "INDIVIDUAL": "Individual",
    "MF": "Fund Manager",
    "MUTUAL FUNDS": "Fund Manager",
    "MUTUAL FUND": "Fund Manager",
    "FUND MANAGER": "Fund Manager",
    "IB": "Financial Institutional",
    "BANK": "Financial Institutional",
    "FINANCIAL INSTITUTIONAL": "Financial Institutional",
    "IS": "Insurance",
    "INSURANCE": "Insurance",
    "PF": "Pension Fund",
    "PENSION FUNDS": "Pension Fund",
    "PENSION FUND": "Pension Fund",
    "SC": "Securities",
    "SECURITIES COMPANY": "Securities",
    "SECURITIES": "Securities",
    "FD": "Others",
    "FOUNDATION": "Others",
    "OT": "Others",
    "OTHERS": "Others",
    "": "Others",
    "NAN": "Others",
}

HOLDER_TABLE = struct(
    "data_source string, date date, share_code string, issuer_name string, investor_name string, "
    "investor_type string, local_foreign string, nationality string, domicile string, "
    "holdings_scripless bigint, holdings_scrip bigint, total_holding_shares bigint, percentage double"
)

# ---- holder lists, 5 percent -----------------------------------------------

# The positional columns after the file's own date; our names.
MAJOR_CELLS = [
    "no", "kode_efek", "nama_emiten", "nama_pemegang_rekening_efek", "nama_pemegang_saham",
    "nama_rekening_efek", "alamat_1", "alamat_2", "kebangsaan", "domisili", "status",
    "saham_prev", "gabungan_prev", "pct_prev", "saham_curr", "gabungan_curr", "pct_curr", "perubahan",
]

# Phrases of repeated headings and footers.
MAJOR_NOISE = ["kode efek", "nama emiten", "halaman"]

MAJOR_TABLE = struct(
    "tanggal_data date, kode_efek string, nama_pemegang_rekening_efek string, nama_pemegang_saham string, "
    "nama_rekening_efek string, status string, jumlah_saham_prev bigint, jumlah_saham_curr bigint, "
    "perubahan_saham bigint, aksi string"
)

# ---- monthly balances ------------------------------------------------------

# Holder categories.
CATEGORIES = ["IS", "CP", "PF", "IB", "ID", "MF", "SC", "FD", "OT"]
LOCALS = [f"Local_{c}" for c in CATEGORIES]
FOREIGNS = [f"Foreign_{c}" for c in CATEGORIES]
POSITIONS = LOCALS + FOREIGNS
MONTHLY_REQUIRED = ["Date", "Code", "Type", "Sec_Num", "Price", *LOCALS, "Total_Local", *FOREIGNS, "Total_Foreign"]

# Headings of the raw file; a second Total arrives as Total.1. "Sec. Num" loses
# its dot, which would need quoting in every Spark expression.
MONTHLY_HEADERS = (
    {"Sec. Num": "Sec_Num", "Total": "Total_Local", "Total.1": "Total_Foreign"}
    | {f"Local {c}": f"Local_{c}" for c in CATEGORIES}
    | {f"Foreign {c}": f"Foreign_{c}" for c in CATEGORIES}
)
MONTHLY_TEXT = T.StructType(
    [T.StructField("file_name", T.StringType()), T.StructField("row_idx", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in MONTHLY_REQUIRED]
)
