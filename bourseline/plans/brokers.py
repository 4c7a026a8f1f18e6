"""Broker activity and insider movements: JSON pages to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import dates, numbers, text
from bourseline.operators import windows

BROKER_KEYS = ["date", "broker_code", "side", "stock_code"]
INSIDER_KEYS = ["insider_id", "stock_code", "transaction_date"]
# Fixed value: brokers kept per date.
TOP_BROKERS = 100


def broker_items(pages: DataFrame) -> DataFrame:
    """One row per transaction, buys and sells tagged by side, in one pass."""
    tx = F.col("data.broker_activity_transaction")
    head = ["broker_code", "broker_name", "target_date", "load_seq"]

    def one_side(name: str, rank: int, items: Column) -> Column:
        return F.struct(F.lit(name).alias("side"), F.lit(rank).alias("rank"), items.alias("items"))

    sides = F.array(one_side("BUY", 0, tx["brokers_buy"]), one_side("SELL", 1, tx["brokers_sell"]))
    tagged = pages.select(*head, F.explode(sides).alias("s"))
    return tagged.select(
        *head, F.col("s.side").alias("side"), F.col("s.rank").alias("_side_rank"), F.posexplode("s.items").alias("_pos", "item")
    )


def normalize_broker(items: DataFrame) -> DataFrame:
    """Typed columns. A missing number is 0; text that is no number is null."""
    item, default = F.col("item"), F.date_format("target_date", "yyyy-MM-dd")

    def count(c: Column) -> Column:
        return numbers.to_long(F.coalesce(c, F.lit("0")))

    price = numbers.to_double(F.coalesce(item["avg_price"], F.lit("0")))
    return items.select(
        dates.general_date(dates.iso_prefix(item["date"], default)).alias("date"),
        "broker_code", "broker_name", "side",
        item["stock_code"].alias("stock_code"),
        count(item["value"]).alias("value"),
        count(item["lot"]).alias("lot"),
        numbers.round_binary(price, 2).alias("avg_price"),
        count(item["freq"]).alias("freq"),
        "load_seq", "_side_rank", "_pos",
    )


def broker_activity(pages: DataFrame) -> DataFrame:
    """First row per (date, broker, side, stock), in page order."""
    rows = normalize_broker(broker_items(pages)).na.drop(subset=["stock_code", "broker_code"])
    return windows.keep_first(rows, BROKER_KEYS, ["load_seq", "_side_rank", "_pos"]).select(
        *schemas.BROKER_TABLE.fieldNames()
    )


def top_brokers(rows: DataFrame, n: int = TOP_BROKERS) -> DataFrame:
    """Brokers of each date by total value, the n highest."""
    totals = rows.groupBy("date", "broker_code").agg(F.sum("value").alias("total_value"))
    return windows.top_per_group(totals, ["date"], [F.col("total_value").desc(), F.col("broker_code").asc()], n)


def insider_items(pages: DataFrame) -> DataFrame:
    return pages.select("target_date", "load_seq", F.posexplode("data.movement").alias("_pos", "item"))


def normalize_insider(items: DataFrame) -> DataFrame:
    """The 22 flat columns of an insider movement."""
    m = F.col("item")

    def cleaned(c: Column, prefix: str) -> Column:
        return text.strip_prefix(text.text_or(c, ""), prefix)

    badges = m["badges"]
    return items.select(
        text.text_or(m["id"], "").alias("insider_id"),
        text.text_or(m["name"], "").alias("insider_name"),
        text.text_or(m["symbol"], "").alias("stock_code"),
        dates.two_digit_year_date(m["date"]).alias("transaction_date"),
        cleaned(m["action_type"], schemas.ACTION_PREFIX).alias("action_type"),
        cleaned(m["nationality"], schemas.NATIONALITY_PREFIX).alias("nationality"),
        numbers.signed_long(m["previous"]["value"]).alias("shares_previous"),
        numbers.signed_double(m["previous"]["percentage"]).alias("pct_previous"),
        numbers.signed_long(m["current"]["value"]).alias("shares_current"),
        numbers.signed_double(m["current"]["percentage"]).alias("pct_current"),
        numbers.signed_long(m["changes"]["value"]).alias("shares_change"),
        numbers.signed_double(m["changes"]["percentage"]).alias("pct_change"),
        numbers.price_or_zero(m["price_formatted"]).alias("price_formatted"),
        text.text_or(m["data_source"]["label"], "").alias("data_source"),
        cleaned(m["data_source"]["type"], schemas.SOURCE_PREFIX).alias("source_type"),
        text.text_or(m["broker_detail"]["code"], "").alias("broker_code"),
        cleaned(m["broker_detail"]["group"], schemas.GROUP_PREFIX).alias("broker_group"),
        text.has_badge(badges, schemas.BADGE_PREFIX + "PENGENDALI").alias("is_pengendali"),
        text.has_badge(badges, schemas.BADGE_PREFIX + "KOMISARIS").alias("is_komisaris"),
        text.has_badge(badges, schemas.BADGE_PREFIX + "DIREKSI").alias("is_direksi"),
        text.join_badges(badges, schemas.BADGE_PREFIX).alias("badges"),
        "target_date", "load_seq", "_pos",
    )


def insider_movements(pages: DataFrame) -> DataFrame:
    """First row per (target date, insider, stock, transaction date); a null
    transaction date equals another null."""
    rows = normalize_insider(insider_items(pages))
    return windows.keep_first(rows, ["target_date", *INSIDER_KEYS], ["load_seq", "_pos"]).select(
        *schemas.INSIDER_TABLE.fieldNames()
    )


def rejects(rows: DataFrame, numeric: list[str]) -> DataFrame:
    """How many rows hold a number that could not be read."""
    bad = F.lit(False)
    for c in numeric:
        bad = bad | F.col(c).isNull()
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("rejected"))
