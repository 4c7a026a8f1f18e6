"""Small aggregates, filters and checks over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions.rules import DEFAULTS
from bourseline.operators import frames
from bourseline.operators.joins import latest
from bourseline.plans import audit, daily as D
from bourseline.sources import footers
from bourseline.workload import adapters as A
from bourseline.workload.daily import PUBLISHED, TRADES, published
from bourseline.workload.monthly import RAW
from bourseline.workload.parsing import SHEET
from bourseline.workload.registry import add

c = F.col

add("agg_max_date", lambda s, sf: A.trades(s, sf).agg(F.max("trading_date").alias("max_date")), f"WITH {TRADES} SELECT max(trading_date) AS max_date FROM trades", ["max_date"])
add(
    "agg_min_max",
    lambda s, sf: A.trades(s, sf).agg(F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"), F.count(F.lit(1)).alias("n")),
    f"WITH {TRADES} SELECT min(trading_date) AS first_date, max(trading_date) AS last_date, count(*) AS n FROM trades",
    ["first_date", "last_date"],
)
add(
    "agg_distinct",
    lambda s, sf: A.trades(s, sf).select(c("trading_date").cast("string").alias("date_text"), "source_file").distinct(),
    f"WITH {TRADES} SELECT DISTINCT CAST(trading_date AS VARCHAR) AS date_text, source_file FROM trades",
)
add(
    "agg_count_where",
    lambda s, sf: A.trades(s, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c("value") >= DEFAULTS.whale_value).alias("n_whale_value"),
        F.count_if((c("volume") >= DEFAULTS.min_volume) & (c("frequency") > 0)).alias("n_traded")),
    f"""WITH {TRADES} SELECT count(*) AS n, count(*) FILTER (WHERE value >= 500000000) AS n_whale_value,
  count(*) FILTER (WHERE volume >= 100000 AND frequency > 0) AS n_traded FROM trades""",
)
add(
    "filt_trailing_range",
    lambda s, sf: D.in_last_days(A.trades(s, sf), 90).select("stock_code", "trading_date", "load_seq", "value"),
    f"WITH {TRADES} SELECT stock_code, trading_date, load_seq, value FROM trades WHERE trading_date >= (SELECT max(trading_date) FROM trades) - 90",
    ["trading_date"],
)
add(
    "dq_false_positive",
    lambda s, sf: D.false_positives(published(s, sf)),
    f"""WITH {PUBLISHED} SELECT count(*) FILTER (WHERE whale_signal AND value < 500000000) AS fp_whale,
  count(*) FILTER (WHERE big_player_anomaly AND value < 2000000000) AS fp_anomaly,
  count(*) FILTER (WHERE whale_signal) AS whale_total, count(*) FILTER (WHERE big_player_anomaly) AS anomaly_total FROM pub""",
)

PAIRS = [("F", "1-URGENT"), ("O", "2-HIGH"), ("P", "3-MEDIUM")]
add(
    "filt_row_in",
    lambda s, sf: A.table(s, sf, "orders").filter(frames.pair_in(c("o_orderstatus"), c("o_orderpriority"), PAIRS)).select("o_orderkey", "o_orderstatus", "o_orderpriority"),
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '2-HIGH'), ('P', '3-MEDIUM'))",
)
add(
    "filt_ilike_any",
    lambda s, sf: A.table(s, sf, "part").filter(frames.any_pattern(c("p_name"), ["%RED%", "%Bolt", "small%"])).select("p_partkey", "p_name"),
    "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' OR p_name ILIKE '%Bolt' OR p_name ILIKE 'small%'",
)

# ---- audit ---------------------------------------------------------------------

DATASETS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id",
        "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id"}


def datasets(spark, sf):
    return {name: A.table(spark, sf, name) for name in DATASETS}


_counts = " UNION ALL ".join(f"SELECT '{d}' AS dataset, count(*) AS n FROM {d}" for d in DATASETS)
add("set_union_counts", lambda s, sf: frames.named_counts(datasets(s, sf)), _counts)


def folders(sf):
    return {d: f"{sf}/{d}.parquet" for d in DATASETS}


WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}
add(
    "dq_dataset_audit",
    lambda s, sf: audit.audit(s, [*DATASETS, "missing_view"], datasets(s, sf), footers.row_counts(s, folders(sf))),
    "SELECT dataset, 'TABLE' AS object_type, CAST(CASE dataset " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WIDTHS.items())
    + f" END AS BIGINT) AS n_columns, n AS n_rows FROM ({_counts}) UNION ALL SELECT 'missing_view', 'MISSING', NULL, NULL",
)
add(
    "dq_dataset_columns",
    lambda s, sf: audit.columns(s, datasets(s, sf)).select("dataset", "column_name", "ordinal_position"),
    "SELECT table_name AS dataset, column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position FROM information_schema.columns WHERE table_name IN ("
    + ", ".join(f"'{d}'" for d in DATASETS) + ")",
)
# Flat columns of each dataset; a nested column's footers tell of its elements.
FLAT = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal", "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props", "documents": "doc_id text lang source n_chars", "embeddings": "vec_id label",
    "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}
add(
    "dq_column_bounds",
    lambda s, sf: footers.column_bounds(s, folders(sf)).select("dataset", "column", "n_values"),
    " UNION ALL ".join(f"""SELECT '{d}' AS dataset, '{k}' AS "column", count({k}) AS n_values FROM {d}""" for d, own in FLAT.items() for k in own.split()),
)


def limit_sample(spark, sf):
    """The first row, by key, of each dataset."""
    parts = [A.table(spark, sf, d).orderBy(k).limit(1).select(F.lit(d).alias("dataset"), c(k).cast("bigint").alias("first_key")) for d, k in KEYS.items()]
    return frames.union_by_name(*parts)


add("limit_sample", limit_sample, " UNION ALL ".join(f"SELECT * FROM (SELECT '{d}' AS dataset, CAST({k} AS BIGINT) AS first_key FROM {d} ORDER BY {k} LIMIT 1)" for d, k in KEYS.items()))


def join_wanted_list(spark, sf):
    """Wanted: every customer as (segment, name). Views: customers with an open
    order, tables: customers with any order."""
    customer, orders = A.table(spark, sf, "customer"), A.table(spark, sf, "orders")
    wanted = customer.select(c("c_mktsegment").alias("schema_name"), c("c_name").alias("name"))
    placed = orders.join(customer, c("o_custkey") == c("c_custkey")).select(
        c("c_mktsegment").alias("schema_name"), c("c_name").alias("name"), "o_orderstatus", "o_orderpriority")
    views = placed.filter((c("o_orderstatus") == "O") & (c("o_orderpriority") == "1-URGENT"))
    return audit.presence(wanted, views, placed.filter(c("o_orderstatus") == "P"))


add(
    "join_wanted_list",
    join_wanted_list,
    """SELECT c_mktsegment AS schema_name, c_name AS name,
  CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') THEN 'VIEW'
       WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN 'TABLE' ELSE 'MISSING' END AS object_type
FROM customer""",
)


def gen_weekdays(spark, sf):
    """The last 30 weekdays up to the latest trading date, with each day's trades."""
    trades = A.trades(spark, sf)
    last = trades.agg(F.max("trading_date").alias("as_of"))
    days = last.select(F.explode(frames.weekdays(c("as_of"), 30)).alias("day"))
    per_day = D.in_last_days(trades, 60, latest(trades, "trading_date")).groupBy("trading_date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, c("day") == c("trading_date"), "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


add(
    "gen_weekdays",
    gen_weekdays,
    f"""WITH {TRADES}, m AS (SELECT max(trading_date) AS as_of FROM trades),
days AS (SELECT CAST(unnest(generate_series(as_of - 60, as_of, INTERVAL 1 DAY)) AS DATE) AS day FROM m),
work AS (SELECT day FROM days WHERE isodow(day) <= 5 ORDER BY day DESC LIMIT 30)
SELECT day, CAST((SELECT count(*) FROM trades WHERE trading_date = day) AS BIGINT) AS n FROM work""",
    ["day"],
)

# ---- names, columns and inline lists -----------------------------------------------

add(
    "proj_normalize_headers",
    lambda s, sf: (lambda df: df.toDF(*frames.normalize_headers(df.columns)))(
        A.table(s, sf, "orders").select(c("o_orderkey").alias(" order key"), c("o_totalprice").alias("Total price "))),
    'SELECT o_orderkey AS "ORDER_KEY", o_totalprice AS "TOTAL_PRICE" FROM orders',
)
add(
    "proj_rename_synonyms",
    lambda s, sf: frames.rename(D.sheet_records(A.daily_sheets(s, sf), A.SHEET_HEADINGS), schemas.DAILY_HEADERS).select(
        "stock_code", "foreign_buy", "frequency", "source_file", "load_seq"),
    f"""WITH {SHEET} SELECT stock_code, CASE WHEN foreign_buy > 0 THEN format('{{:,}}', CAST(foreign_buy AS BIGINT)) ELSE '0' END AS foreign_buy,
  'Rp ' || l_linenumber AS frequency, source_file, load_seq FROM rows WHERE l_linenumber <> 7""",
)
add(
    "proj_keep_existing",
    lambda s, sf: frames.keep_existing(A.table(s, sf, "lineitem"), ["l_quantity", "no_such_column", "l_orderkey", "l_partkey"]),
    "SELECT l_quantity, l_orderkey, l_partkey FROM lineitem",
)


def set_values(spark, sf):
    """An inline list of wanted (status, priority) pairs with their order counts."""
    wanted = spark.createDataFrame([*PAIRS, ("X", "9-NONE")], "o_orderstatus string, o_orderpriority string")
    counts = A.table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, ["o_orderstatus", "o_orderpriority"], "left")


add(
    "set_values",
    set_values,
    """SELECT w.*, (SELECT count(*) FROM orders o WHERE o.o_orderstatus = w.o_orderstatus AND o.o_orderpriority = w.o_orderpriority HAVING count(*) > 0) AS n
FROM (VALUES ('F', '1-URGENT'), ('O', '2-HIGH'), ('P', '3-MEDIUM'), ('X', '9-NONE')) AS w(o_orderstatus, o_orderpriority)""",
)
add(
    "dq_required_columns",
    lambda s, sf: frames.require_columns(A.monthly_text(s, sf), schemas.MONTHLY_REQUIRED).groupBy("Type").agg(F.count(F.lit(1)).alias("n")),
    f"WITH {RAW} SELECT CASE WHEN o_orderstatus = 'P' AND Code LIKE 'MA%' THEN 'CORPORATE BOND' ELSE 'EQUITY' END AS Type, count(*) AS n FROM raw GROUP BY 1",
)
