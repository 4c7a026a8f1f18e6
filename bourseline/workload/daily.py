"""Queries on daily trading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions.dates import file_name_date
from bourseline.functions.text import stem
from bourseline.operators import windows
from bourseline.operators.joins import latest
from bourseline.plans import daily as D
from bourseline.workload import adapters as A
from bourseline.workload.registry import add

KEY = ["stock_code", "trading_date"]

# ---- SQL of the adapter and of each pipeline step ----------------------------

TRADES = """
li AS (
  SELECT *, CAST(3 * floor(l_extendedprice / l_quantity / 3) AS DOUBLE) AS px, l_quantity * 4200 AS vol,
         CAST(l_shipdate AS DATE) AS d, l_linenumber AS ln
  FROM lineitem
),
lp AS (
  SELECT *, CASE WHEN ln = 5 AND l_linestatus = 'O' THEN 0 WHEN ln = 4 AND l_linestatus = 'O' THEN NULL
                 ELSE px - 3 * round(l_discount * 100) END AS prev
  FROM li
),
trades AS (
  SELECT 'S' || l_suppkey AS stock_code, d AS trading_date, px AS open_price,
         CASE WHEN ln <> 6 THEN px + 3 * ln END AS high, CASE WHEN ln <> 6 THEN px - 3 * ln END AS low,
         CASE WHEN ln <> 7 THEN px END AS close, prev AS previous, px - prev AS change, vol AS volume,
         round(l_extendedprice * 100) * 300 AS value, CAST(ln - 1 AS DOUBLE) AS frequency, px - 3 AS bid, px + 3 AS offer,
         l_quantity * 100 AS bid_volume, CASE WHEN ln <> 3 THEN l_quantity * 200 END AS offer_volume,
         CASE WHEN l_returnflag = 'R' THEN vol ELSE 0 END AS foreign_buy,
         CASE WHEN l_returnflag = 'A' THEN vol ELSE 0 END AS foreign_sell,
         l_partkey * 1000 AS tradeable_shares, 'daily_' || strftime(d, '%Y%m%d') || '.xlsx' AS source_file,
         l_orderkey * 256 + l_linenumber * 32 + l_partkey % 32 AS load_seq
  FROM lp
)"""

FOREIGN = """
fx AS (
  SELECT *, CASE WHEN volume > 0 THEN value / volume ELSE close END AS vwap FROM trades
),
priced AS (
  SELECT * EXCLUDE (vwap), foreign_buy * vwap AS foreign_buy_value, foreign_sell * vwap AS foreign_sell_value,
         foreign_buy * vwap - foreign_sell * vwap AS net_foreign_value
  FROM fx
)"""

_fills = ", ".join(
    f"COALESCE(last_value({c} IGNORE NULLS) OVER run, first_value({c} IGNORE NULLS) OVER whole) AS {c}" for c in schemas.PRICES
)
_zeros = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in schemas.VOLUMES)
CHAIN = f"""{TRADES},{FOREIGN},
filled AS (
  SELECT * REPLACE ({_fills}, {_zeros}) FROM priced
  WINDOW run AS (PARTITION BY stock_code ORDER BY trading_date, load_seq ROWS UNBOUNDED PRECEDING),
         whole AS (PARTITION BY stock_code ORDER BY trading_date, load_seq
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
derived AS (
  SELECT *, CASE WHEN previous IS NULL THEN NULL WHEN previous <> 0 THEN change / previous * 100 ELSE 0 END AS change_percent,
         (high + low + close) / 3 AS typical_price,
         CASE WHEN frequency > 0 THEN volume / frequency ELSE 0 END AS avg_order_volume
  FROM filled
),
rolled AS (
  SELECT *, CASE WHEN sum(volume) OVER w20 <> 0 THEN sum(typical_price * volume) OVER w20 / sum(volume) OVER w20 ELSE close END AS vwma_20d,
         avg(volume) OVER w20 AS ma20_volume, avg(avg_order_volume) OVER w20 AS ma20_avg_order_volume,
         avg(avg_order_volume) OVER w50 AS ma50_avg_order_volume,
         row_number() OVER (PARTITION BY stock_code, trading_date ORDER BY load_seq DESC) AS from_end
  FROM derived
  WINDOW w20 AS (PARTITION BY stock_code ORDER BY trading_date, load_seq ROWS 19 PRECEDING),
         w50 AS (PARTITION BY stock_code ORDER BY trading_date, load_seq ROWS 49 PRECEDING)
),
ratios AS (
  SELECT *, CASE WHEN ma20_avg_order_volume > 0 THEN avg_order_volume / ma20_avg_order_volume ELSE 1.0 END AS aov_ratio_ma20,
         CASE WHEN ma50_avg_order_volume > 0 THEN avg_order_volume / ma50_avg_order_volume ELSE 1.0 END AS aov_ratio,
         CASE WHEN close > vwma_20d AND volume > ma20_volume THEN 'Akumulasi'
              WHEN close < vwma_20d AND volume > ma20_volume THEN 'Distribusi' ELSE 'Netral' END AS signal
  FROM rolled
),
ind AS (
  SELECT *, (aov_ratio >= 1.5 AND value >= 500000000 AND volume >= 100000 AND ma50_avg_order_volume > 0) AS whale_signal,
         (avg_order_volume > 2 * ma50_avg_order_volume AND ma50_avg_order_volume > 0 AND value >= 2000000000
          AND volume >= 100000) AS big_player_anomaly
  FROM ratios WHERE from_end = 1
)"""


def _published() -> str:
    parts = []
    for f in schemas.DAILY_TABLE.fields:
        kind = f.dataType.simpleString()
        if kind == "bigint":
            parts.append(f"CAST(trunc(COALESCE({f.name}, 0)) AS BIGINT) AS {f.name}")
        elif kind == "double":
            parts.append(f"COALESCE({f.name}, 0) AS {f.name}")
        else:
            parts.append(f.name)
    return ", ".join(parts)


PUBLISHED = f"{CHAIN},\npub AS (SELECT {_published()} FROM ind)"


def _screener(*parts: str) -> str:
    cols = []
    if "max" in parts:
        cols.append("max(aov_ratio_ma20) AS aov_max")
        cols += [f"max(CASE WHEN trading_date >= m - {d} THEN aov_ratio_ma20 END) AS aov_max_{d}d" for d in D.HORIZONS]
    if "spike" in parts:
        cols += [
            f"count(CASE WHEN aov_ratio_ma20 >= 1.5 AND trading_date >= m - {d} AND value >= 500000000 THEN 1 END) AS spike_{d}d"
            for d in D.HORIZONS
        ]
    if "flow" in parts:
        cols += [f"CAST(sum(CASE WHEN trading_date >= m - {d} THEN net_foreign_value ELSE 0 END) AS BIGINT) AS foreign_{d}d" for d in D.HORIZONS]
    return (
        f"WITH {PUBLISHED}, latest AS (SELECT max(trading_date) AS m FROM pub) "
        f"SELECT stock_code, {', '.join(cols)} FROM pub, latest WHERE trading_date >= m - 90 GROUP BY stock_code"
    )


# ---- queries -----------------------------------------------------------------


def priced(spark: SparkSession, sf: str) -> DataFrame:
    return D.foreign_values(A.trades(spark, sf))


def indicators(spark: SparkSession, sf: str) -> DataFrame:
    return D.indicators(priced(spark, sf))


def published(spark: SparkSession, sf: str) -> DataFrame:
    return D.publish(indicators(spark, sf))


def as_of(spark: SparkSession, sf: str):
    """Latest trading date, read from the raw rows: the same as the table's."""
    return latest(A.trades(spark, sf), "trading_date")


def screener(spark: SparkSession, sf: str) -> DataFrame:
    return D.screener_period(published(spark, sf), as_of=as_of(spark, sf))


def _part(i: int):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        last = as_of(spark, sf)
        recent = D.in_last_days(published(spark, sf), max(D.HORIZONS), last)
        return recent.groupBy("stock_code").agg(*D.period_aggregates(last)[i])

    return run


add("agg_period_max", _part(0), _screener("max"))
add("agg_period_spikes", _part(1), _screener("spike"))
add("agg_period_flow", _part(2), _screener("flow"))
add("agg_screener_period", screener, _screener("max", "spike", "flow"))
add(
    "join_left_equi",
    lambda s, sf: screener(s, sf).select("stock_code", "spike_90d", "foreign_1d", "foreign_90d"),
    f"""WITH {PUBLISHED}, latest AS (SELECT max(trading_date) AS m FROM pub),
spikes AS (SELECT stock_code, count(CASE WHEN aov_ratio_ma20 >= 1.5 AND value >= 500000000 THEN 1 END) AS spike_90d
           FROM pub, latest WHERE trading_date >= m - 90 GROUP BY stock_code),
flow AS (SELECT stock_code, CAST(sum(CASE WHEN trading_date >= m - 1 THEN net_foreign_value ELSE 0 END) AS BIGINT) AS foreign_1d,
                CAST(sum(net_foreign_value) AS BIGINT) AS foreign_90d
         FROM pub, latest WHERE trading_date >= m - 90 GROUP BY stock_code)
SELECT s.stock_code, spike_90d, COALESCE(foreign_1d, 0) AS foreign_1d, COALESCE(foreign_90d, 0) AS foreign_90d
FROM spikes s LEFT JOIN flow f ON s.stock_code = f.stock_code""",
)


def _columns(*cols: str):
    return lambda s, sf: indicators(s, sf).select(*KEY, *cols)


def _check(*cols: str) -> str:
    return f"WITH {CHAIN} SELECT stock_code, trading_date, {', '.join(cols)} FROM ind"


for _key, _cols in {
    "win_vwma20": ["vwma_20d"],
    "win_ma20_volume": ["ma20_volume"],
    "win_ma50_aov": ["avg_order_volume", "ma50_avg_order_volume"],
    "win_ma20_aov": ["ma20_avg_order_volume", "aov_ratio_ma20"],
    "win_ffill": ["high", "low", "close", "previous", "open_price", "bid", "offer"],
    "fn_signal": ["close", "vwma_20d", "volume", "ma20_volume", "signal"],
    "fn_whale_signal": ["aov_ratio", "value", "volume", "whale_signal"],
    "fn_big_player": ["avg_order_volume", "ma50_avg_order_volume", "value", "big_player_anomaly"],
}.items():
    add(_key, _columns(*_cols), _check(*_cols), ["trading_date"])

add(
    "pipe_daily_indicators",
    lambda s, sf: indicators(s, sf).select(
        *KEY, "close", "volume", "value", "change_percent", "typical_price", "vwma_20d", "ma20_volume", "avg_order_volume",
        "ma50_avg_order_volume", "aov_ratio_ma20", "aov_ratio", "signal", "net_foreign_value", "whale_signal", "big_player_anomaly"),
    _check("close", "volume", "value", "change_percent", "typical_price", "vwma_20d", "ma20_volume", "avg_order_volume",
           "ma50_avg_order_volume", "aov_ratio_ma20", "aov_ratio", "signal", "net_foreign_value", "whale_signal", "big_player_anomaly"),
    ["trading_date"],
)
add("pipe_daily_publish", published, f"WITH {PUBLISHED} SELECT * FROM pub", ["trading_date"])


def sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Closes known only on days with a foreign sale; suppliers whose number divides by five have no high at all."""
    rows = A.trades(spark, sf).withColumns({p: F.when(F.col("foreign_sell") > 0, F.col(p)) for p in ["high", "low", "close"]})
    return rows.withColumn("high", F.when(F.substring("stock_code", 2, 9).cast("int") % 5 != 0, F.col("high")))


def back_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Filled both ways, each stock from its own prices."""
    return windows.keep_last(D.fill_gaps(sparse(spark, sf)), KEY, ["load_seq"]).select(*KEY, "high", "low", "close")


def leaking(spark: SparkSession, sf: str) -> DataFrame:
    """Filled as by an ungrouped back fill: a stock without any price takes the next stock's."""
    return windows.keep_last(D.fill_gaps(sparse(spark, sf), "next_stock"), KEY, ["load_seq"]).select(*KEY, "high", "low", "close")


_bfill = ", ".join(
    f"COALESCE(last_value({c} IGNORE NULLS) OVER run, first_value({c} IGNORE NULLS) OVER whole) AS {c}" for c in ["high", "low", "close"]
)
_SPARSE = f"""{TRADES},
gaps AS (SELECT stock_code, trading_date, load_seq, CASE WHEN foreign_sell > 0 AND CAST(substr(stock_code, 2) AS INTEGER) % 5 <> 0 THEN high END AS high,
                CASE WHEN foreign_sell > 0 THEN low END AS low, CASE WHEN foreign_sell > 0 THEN close END AS close FROM trades)"""
add(
    "win_bfill",
    back_filled,
    f"""WITH {_SPARSE},
f AS (SELECT stock_code, trading_date, {_bfill},
             row_number() OVER (PARTITION BY stock_code, trading_date ORDER BY load_seq DESC) AS from_end
      FROM gaps
      WINDOW run AS (PARTITION BY stock_code ORDER BY trading_date, load_seq ROWS UNBOUNDED PRECEDING),
             whole AS (PARTITION BY stock_code ORDER BY trading_date, load_seq
                       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT stock_code, trading_date, high, low, close FROM f WHERE from_end = 1""",
    ["trading_date"],
)
_forward = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY stock_code ORDER BY trading_date, load_seq ROWS UNBOUNDED PRECEDING) AS {c}" for c in ["high", "low", "close"])
_onward = ", ".join(f"first_value({c} IGNORE NULLS) OVER onward AS {c}" for c in ["high", "low", "close"])
add(
    "win_bfill_next_stock",
    leaking,
    f"""WITH {_SPARSE},
run AS (SELECT stock_code, trading_date, load_seq, {_forward} FROM gaps),
f AS (SELECT stock_code, trading_date, {_onward}, row_number() OVER (PARTITION BY stock_code, trading_date ORDER BY load_seq DESC) AS from_end
      FROM run
      WINDOW onward AS (ORDER BY stock_code, trading_date, load_seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT stock_code, trading_date, high, low, close FROM f WHERE from_end = 1""",
    ["trading_date"],
)

# ---- row functions on raw trades ----------------------------------------------

ROW = ["stock_code", "trading_date", "load_seq"]


def _row_query(key: str, select, sql: str, where: str = "TRUE") -> None:
    check = f"WITH {TRADES},{FOREIGN} SELECT stock_code, trading_date, load_seq, {sql} FROM priced WHERE {where}"
    add(key, lambda s, sf: select(priced(s, sf)), check, ["trading_date"])


_row_query(
    "fn_foreign_value",
    lambda df: df.select(*ROW, "foreign_buy_value", "foreign_sell_value", "net_foreign_value"),
    "foreign_buy_value, foreign_sell_value, net_foreign_value",
)
_row_query(
    "fn_change_pct",
    lambda df: D.derive(df).select(*ROW, "change", "previous", "change_percent"),
    "change, previous, CASE WHEN previous IS NULL THEN NULL WHEN previous <> 0 THEN change / previous * 100 ELSE 0 END AS change_percent",
)
_row_query(
    "fn_typical_price",
    lambda df: D.derive(df).select(*ROW, "typical_price", "tpxv"),
    "(high + low + close) / 3 AS typical_price, (high + low + close) / 3 * volume AS tpxv",
)
_row_query(
    "fn_safe_ratio",
    lambda df: D.derive(df).select(*ROW, "avg_order_volume"),
    "CASE WHEN frequency > 0 THEN volume / frequency ELSE 0 END AS avg_order_volume",
)
_row_query(
    "fn_fill_zero",
    lambda df: df.fillna(0, subset=schemas.VOLUMES).select(*ROW, *schemas.VOLUMES),
    _zeros,
)
_row_query(
    "filt_not_null",
    lambda df: df.na.drop(subset=["trading_date", "high", "close"]).select(*ROW, "high", "close"),
    "high, close",
    "high IS NOT NULL AND close IS NOT NULL",
)
_row_query(
    "proj_lineage",
    lambda df: df.select(*ROW, "source_file", stem(F.col("source_file")).alias("data_source"), file_name_date(F.col("source_file")).alias("file_date")),
    "source_file, replace(source_file, '.xlsx', '') AS data_source, strftime(trading_date, '%Y-%m-%d') AS file_date",
)
