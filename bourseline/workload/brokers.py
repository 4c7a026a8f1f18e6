"""Queries on broker activity and insider movements."""

from __future__ import annotations

from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.operators import windows
from bourseline.plans import brokers as B
from bourseline.workload import adapters as A
from bourseline.workload.holders import PLACED
from bourseline.workload.registry import add

# The transaction of a line item; its copy differs in value only.
ITEMS = """
items AS (
  SELECT CAST(l_shipdate AS DATE) AS date, 'B' || l_suppkey AS broker_code, 'Broker ' || l_suppkey AS broker_name,
    CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
    CASE WHEN l_linenumber <> 7 THEN 'P' || l_partkey END AS stock_code,
    CASE WHEN l_linenumber <> 6 THEN CAST(round(l_extendedprice * 100) AS BIGINT) + copy ELSE 0 END AS value,
    CAST(l_quantity AS BIGINT) AS lot, CAST(format('{:.2f}', l_extendedprice / l_quantity) AS DOUBLE) AS avg_price, CAST(l_linenumber AS BIGINT) AS freq,
    l_orderkey * 256 + l_linenumber * 32 + l_partkey % 32 AS load_seq, copy
  FROM lineitem, (SELECT unnest([0, 1]) AS copy)
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY date, broker_code, side, stock_code ORDER BY load_seq, copy) AS rn
  FROM items WHERE stock_code IS NOT NULL
),
activity AS (SELECT date, broker_code, broker_name, side, stock_code, value, lot, avg_price, freq FROM firsts WHERE rn = 1)"""


def normalized(spark, sf):
    return B.normalize_broker(B.broker_items(A.broker_pages(spark, sf)))


add(
    "set_union_sides",
    lambda s, sf: B.broker_items(A.broker_pages(s, sf)).groupBy("broker_code", "side").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("item.lot").cast("bigint")).alias("lots")),
    f"WITH {ITEMS} SELECT broker_code, side, count(*) AS n, CAST(sum(lot) AS BIGINT) AS lots FROM items GROUP BY ALL",
)
add("pipe_broker_activity", lambda s, sf: B.broker_activity(A.broker_pages(s, sf)), f"WITH {ITEMS} SELECT * FROM activity", ["date"])
add(
    "win_dedup_keep_first",
    lambda s, sf: windows.keep_first(normalized(s, sf), B.BROKER_KEYS, ["load_seq", "_side_rank", "_pos"]).select("date", "broker_code", "side", "stock_code", "load_seq", "value"),
    f"""WITH {ITEMS}, f AS (SELECT *, row_number() OVER (PARTITION BY date, broker_code, side, stock_code ORDER BY load_seq, copy) AS r FROM items)
SELECT date, broker_code, side, stock_code, load_seq, value FROM f WHERE r = 1""",
    ["date"],
)
add(
    "topk_brokers",
    lambda s, sf: B.top_brokers(B.broker_activity(A.broker_pages(s, sf))),
    f"""WITH {ITEMS}, t AS (SELECT date, broker_code, CAST(sum(value) AS BIGINT) AS total_value FROM activity GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY total_value DESC, broker_code) AS rn FROM t)
SELECT date, broker_code, total_value FROM r WHERE rn <= 100""",
    ["date"],
)

INSIDERS = PLACED + """,
moves AS (
  SELECT 'I' || c_custkey AS insider_id, c_name || CASE copy WHEN 1 THEN ' copy' ELSE '' END AS insider_name, 'N' || c_nationkey AS stock_code,
    CASE WHEN left(o_orderpriority, 1) <> '5' THEN CAST(o_orderdate AS DATE) END AS transaction_date,
    CAST(floor(o_totalprice) AS BIGINT) AS curr, greatest(CAST(floor(c_acctbal) AS BIGINT) * 10, 0) AS prev, curr - prev AS diff,
    CASE WHEN diff >= 0 THEN 'BUY' ELSE 'SELL' END AS action_type, CASE WHEN c_nationkey % 2 = 0 THEN 'LOCAL' ELSE 'FOREIGN' END AS nationality,
    prev AS shares_previous, CAST(format('{:.4f}', prev / 1024) AS DOUBLE) AS pct_previous, curr AS shares_current,
    CAST(format('{:.4f}', curr / 1024) AS DOUBLE) AS pct_current, diff AS shares_change, CAST(format('{:.4f}', diff / 1024) AS DOUBLE) AS pct_change,
    CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 0 ELSE CAST(curr AS DOUBLE) END AS price_formatted,
    c_mktsegment AS data_source, o_orderstatus AS source_type,
    CASE WHEN left(o_orderpriority, 1) <> '3' THEN 'B' || left(o_orderpriority, 1) ELSE '' END AS broker_code,
    CASE WHEN left(o_orderpriority, 1) <> '3' THEN 'LOCAL' ELSE '' END AS broker_group,
    o_orderstatus = 'F' AS is_pengendali, o_orderstatus = 'O' AS is_komisaris, o_orderstatus = 'F' AS is_direksi,
    CASE o_orderstatus WHEN 'F' THEN 'PENGENDALI,DIREKSI' WHEN 'O' THEN 'KOMISARIS' ELSE '' END AS badges,
    CAST(o_orderdate AS DATE) AS target_date, o_orderkey AS load_seq, copy
  FROM placed, (SELECT unnest([0, 1]) AS copy)
)"""
FLAT = ", ".join(schemas.INSIDER_TABLE.fieldNames())


def moves(spark, sf):
    return B.normalize_insider(B.insider_items(A.insider_pages(spark, sf)))


add(
    "pipe_insider",
    lambda s, sf: B.insider_movements(A.insider_pages(s, sf)),
    f"""WITH {INSIDERS}, f AS (SELECT *, row_number() OVER (PARTITION BY target_date, insider_id, stock_code, transaction_date ORDER BY load_seq, copy) AS r FROM moves)
SELECT {FLAT} FROM f WHERE r = 1""",
    ["transaction_date", "target_date"],
)


def _flat(key: str, cols: list[str]) -> None:
    add(key, lambda s, sf: moves(s, sf).select("load_seq", "insider_name", *cols), f"WITH {INSIDERS} SELECT load_seq, insider_name, {', '.join(cols)} FROM moves")


_flat("fn_strip_prefix", ["action_type", "nationality", "source_type", "broker_group"])
_flat("fn_array_flags", ["is_pengendali", "is_komisaris", "is_direksi"])
_flat("fn_array_join", ["badges"])


def from_json_text(spark, sf):
    """The same pages written as JSON text and parsed back with the given schema."""
    pages = A.insider_pages(spark, sf)
    body = F.from_json(F.to_json("data"), f"struct<is_more:boolean,movement:array<{schemas.INSIDER_ITEM}>>")
    return B.normalize_insider(B.insider_items(pages.withColumn("data", body)))


_paths = ["shares_previous", "pct_current", "shares_change", "data_source", "broker_code", "price_formatted"]
add(
    "fn_json_path",
    lambda s, sf: from_json_text(s, sf).select("load_seq", "insider_name", *_paths),
    f"WITH {INSIDERS} SELECT load_seq, insider_name, {', '.join(_paths)} FROM moves",
)


def with_bad_numbers(spark, sf):
    """The movements, with a price in every tenth page and a count in every seventh that are no numbers."""
    n, item = F.col("load_seq"), F.col("item")
    price = F.when(n % 10 == 0, "n/a").otherwise(item["price_formatted"])
    count = F.when(n % 7 == 0, "1.2.3").otherwise(item["current"]["value"])
    bad = item.withField("price_formatted", price).withField("current.value", count)
    return B.normalize_insider(B.insider_items(A.insider_pages(spark, sf)).withColumn("item", bad))


add(
    "dq_rejects",
    lambda s, sf: B.rejects(with_bad_numbers(s, sf), ["shares_previous", "shares_current", "shares_change", "price_formatted"]),
    f"WITH {INSIDERS} SELECT count(*) AS n, count(*) FILTER (WHERE load_seq % 10 = 0 OR load_seq % 7 = 0) AS rejected FROM moves",
)
