"""Rolling indicators against a row-by-row pandas model, with many copies."""

import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions.rules import Thresholds
from bourseline.operators import ranges
from bourseline.plans import daily as D

NUMBERS = ["high", "low", "close", "previous", "open_price", "bid", "offer", "change", "volume", "value", "bid_volume",
           "offer_volume", "frequency", "foreign_buy", "foreign_sell"]
SCHEMA = "stock_code string, trading_date date, load_seq bigint, " + ", ".join(f"{n} double" for n in NUMBERS)
LOW = Thresholds(whale_value=500, anomaly_value=800, min_volume=40)


def make(seed: int, hot: int = 400) -> list[tuple]:
    """Four stocks over 30 days; one day of stock A comes `hot` times; stock B has no
    close at all; stock C starts with gaps; some rows have no stock code."""
    rnd = random.Random(seed)
    out, seq = [], 0
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(30)]
    plan = [(s, d, 1 + rnd.randrange(3)) for s in ["A", "B", "C", "D", None] for d in days if rnd.random() < 0.8]
    plan.append(("A", days[10], hot))
    rnd.shuffle(plan)
    for stock, day, copies in plan:
        for _ in range(copies):
            seq += rnd.randrange(1, 4)
            r = {n: float(rnd.randrange(1, 60)) for n in NUMBERS}
            r["value"] = float(rnd.randrange(0, 1000))
            r["volume"] = rnd.choice([0.0, float(rnd.randrange(1, 100))])
            r["frequency"] = float(rnd.randrange(0, 5))
            for n in schemas.PRICES:
                if rnd.random() < 0.6 or (stock == "B" and n == "close") or (stock == "C" and day < days[9]):
                    r[n] = None
            for n in ("volume", "frequency"):
                if rnd.random() < 0.1:
                    r[n] = None
            if rnd.random() < 0.05:
                r["previous"] = 0.0
            out.append((stock, day, seq, *[r[n] for n in NUMBERS]))
    return out


def model(data: list[tuple], leak: bool) -> pd.DataFrame:
    """The rules spelled out on one sorted frame."""
    df = pd.DataFrame(data, columns=["stock_code", "trading_date", "load_seq", *NUMBERS]).sort_values(
        ["stock_code", "trading_date", "load_seq"], na_position="last").reset_index(drop=True)
    known = df["stock_code"].notna()
    for p in schemas.PRICES:
        up = df.groupby("stock_code")[p].ffill()
        df[p] = up.bfill() if leak else up.groupby(df["stock_code"]).bfill()
    df[schemas.VOLUMES] = df[schemas.VOLUMES].fillna(0)
    df["aov"] = [v / f if f > 0 else 0.0 for v, f in zip(df["volume"], df["frequency"])]
    df["tpxv"] = (df["high"] + df["low"] + df["close"]) / 3 * df["volume"]
    by = df.groupby("stock_code")
    out = {}
    for i, row in df.iterrows():
        if not known[i]:
            out[i] = (np.nan,) * 4
            continue
        group = by.get_group(row["stock_code"]).loc[:i]
        w20, w50 = group.tail(20), group.tail(50)
        volume = w20["volume"].sum()
        vwma = row["close"] if volume == 0 else (w20["tpxv"].sum(min_count=1) / volume)
        out[i] = (vwma, w20["volume"].mean(), w20["aov"].mean(), w50["aov"].mean())
    df[["vwma", "mav", "ma20", "ma50"]] = pd.DataFrame.from_dict(out, orient="index", dtype=float)
    ratio = np.where(df["ma50"] > 0, df["aov"] / df["ma50"], 1.0)
    df["whale"] = (ratio >= 1.5) & (df["value"] >= 500) & (df["volume"] >= 40) & (df["ma50"] > 0)
    df["anomaly"] = (df["aov"] > 2 * df["ma50"]) & (df["ma50"] > 0) & (df["value"] >= 800) & (df["volume"] >= 40)
    busy = df["volume"] > df["mav"]
    df["signal"] = np.select([(df["close"] > df["vwma"]) & busy, (df["close"] < df["vwma"]) & busy], ["Akumulasi", "Distribusi"], "Netral")
    return df.drop_duplicates(["stock_code", "trading_date"], keep="last")


@pytest.mark.parametrize("sparse", [1, 1 << 28])
@pytest.mark.parametrize("backfill", ["own", "next_stock"])
def test_indicators_match_the_model(spark, sparse, backfill):
    data = [(*r[:2], r[2] * sparse, *r[3:]) for r in make(7)]
    got = D.indicators(spark.createDataFrame(data, SCHEMA), LOW, backfill).toPandas()
    want = model(data, leak=backfill == "next_stock")
    key = ["stock_code", "trading_date"]
    both = got.merge(want, on=key, how="outer", suffixes=("", "_w"), indicator=True)
    assert (both["_merge"] == "both").all() and len(got) == len(want)
    pairs = {"close": "close_w", "high": "high_w", "vwma_20d": "vwma", "ma20_volume": "mav", "ma20_avg_order_volume": "ma20",
             "ma50_avg_order_volume": "ma50", "avg_order_volume": "aov"}
    for a, b in pairs.items():
        if backfill == "next_stock" and a in ("close", "high", "vwma_20d"):
            both_known = both[both["stock_code"].notna()]
        else:
            both_known = both
        np.testing.assert_allclose(both_known[a].astype(float), both_known[b].astype(float), rtol=1e-9, err_msg=a)
    rows = both[both["stock_code"].notna()]
    assert (rows["whale_signal"] == rows["whale"]).all() and rows["whale"].any()
    assert (rows["big_player_anomaly"] == rows["anomaly"]).all()
    assert (rows["signal"] == rows["signal_w"]).all()


def test_ranges_split_a_hot_stock(spark):
    """A million rows of one stock, most of them of one day: no range holds more than its share, and the fill is the window's."""
    n = 1_000_000
    known = F.when(F.col("id") % 50_021 == 49_000, F.col("id").cast("double"))
    rows = spark.range(n).select(
        F.lit("A").alias("stock_code"), F.when(F.col("id") < 200_000, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int"))).otherwise(F.lit("2025-01-01").cast("date")).alias("trading_date"),
        F.col("id").alias("load_seq"), known.alias("close"), F.lit(1.0).alias("volume"),
    )
    sizes = [r["count"] for r in ranges.deal(rows, ["stock_code"], D.ORDER).groupBy("_range").count().collect()]
    assert sum(sizes) == n and max(sizes) < 3 * n / len(sizes) and len(sizes) > 16
    w = W.partitionBy("stock_code").orderBy("trading_date", "load_seq")
    plain = F.coalesce(F.last("close", True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.first("close", True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    of = lambda df: df.agg(F.count("close"), F.sum(F.xxhash64("load_seq", "close").cast("decimal(38,0)"))).first()[:]
    assert of(D.fill_gaps(rows)) == of(rows.withColumn("close", plain))


def test_frames_reach_over_many_small_ranges(spark, monkeypatch):
    """More ranges than a frame has rows: halos come from many ranges before."""
    monkeypatch.setattr(ranges, "RANGES_PER_PARTITION", 60)
    data = make(3, hot=900)
    got = D.indicators(spark.createDataFrame(data, SCHEMA), LOW).toPandas()
    want = model(data, leak=False)
    both = got.merge(want, on=["stock_code", "trading_date"], how="outer", suffixes=("", "_w"))
    assert len(got) == len(want) == len(both)
    for a, b in {"close": "close_w", "vwma_20d": "vwma", "ma20_volume": "mav", "ma20_avg_order_volume": "ma20", "ma50_avg_order_volume": "ma50"}.items():
        np.testing.assert_allclose(both[a].astype(float), both[b].astype(float), rtol=1e-9, err_msg=a)


def test_fill_gaps_keeps_all_rows(spark):
    data = [("A", date(2024, 1, 2), i << 28, *[1.0 if i == 3 else None] * len(NUMBERS)) for i in range(1000)]
    rows = D.fill_gaps(spark.createDataFrame(data, SCHEMA))
    assert rows.count() == 1000 and rows.filter("close = 1").count() == 1000


@pytest.mark.parametrize("step", [1, 1 << 28])
def test_previous_row_of_a_hot_key(spark, step):
    data = [("A", date(2024, 1, 1 + i // 300), i * step, i) for i in range(900)] + [("B", date(2024, 1, 2), 5, 7), (None, date(2024, 1, 2), 6, 8), (None, date(2024, 1, 3), 4, 9)]
    rows = spark.createDataFrame(data, "k string, d date, s bigint, v int").repartition(7)
    got = {(r["k"], r["v"]): r["p"] for r in ranges.previous_row(rows, ["k"], "d", "s", {"v": "p"}).collect()}
    assert len(got) == 903 and got["A", 0] is None and all(got["A", i] == i - 1 for i in range(1, 900))
    assert (got["B", 7], got[None, 8], got[None, 9]) == (None, None, 8)


def test_thresholds_are_inclusive(spark):
    df = spark.createDataFrame(
        [(1.5, 500_000_000.0, 100_000.0, 1.0), (1.5, 499_999_999.0, 100_000.0, 1.0), (1.4999, 5e8, 1e5, 1.0), (1.5, 5e8, 99_999.0, 1.0),
         (None, 5e8, 1e5, 1.0), (2.0, 5e8, 1e5, 0.0)], "r double, v double, n double, b double")
    from bourseline.functions import rules

    assert [x[0] for x in df.select(rules.whale_signal(F.col("r"), F.col("v"), F.col("n"), F.col("b"))).collect()] == [True, False, False, False, False, False]
    exact = spark.createDataFrame([(2.0, 1.0, 2e9, 1e5), (2.0001, 1.0, 2e9, 1e5)], "o double, b double, v double, n double")
    assert [x[0] for x in exact.select(rules.big_player(F.col("o"), F.col("b"), F.col("v"), F.col("n"))).collect()] == [False, True]


def test_screener_horizons_and_null_stock(spark):
    top = date(2024, 6, 30)
    data = [("A", top - timedelta(days=n), float(n), 600_000_000, 10 + n) for n in (0, 1, 7, 14, 30, 90, 91)]
    data.append((None, top, 9.0, 600_000_000, 77))
    table = spark.createDataFrame(data, "stock_code string, trading_date date, aov_ratio_ma20 double, value bigint, net_foreign_value bigint")
    got = {r["stock_code"]: r for r in D.screener_period(table).collect()}
    a = got["A"]
    assert (a["aov_max"], a["aov_max_1d"], a["aov_max_7d"], a["aov_max_90d"]) == (90.0, 1.0, 7.0, 90.0)
    assert [a[f"spike_{d}d"] for d in (1, 7, 14, 30, 90)] == [0, 1, 2, 3, 4]
    assert [a[f"foreign_{d}d"] for d in (1, 7, 14, 30, 90)] == [21, 38, 62, 102, 202]
    assert got[None]["foreign_90d"] == 0 and got[None]["spike_1d"] == 1


def test_intake_and_publish(spark):
    heads = ["Stock Code ", "Last Trading Date", "Open Price", "Close", "Volume", "Value", "Foreign Buy", "Foreign Sell"]
    rows = spark.createDataFrame(
        [("x_20240507.xlsx", 0, 0, 0, heads), ("x_20240507.xlsx", 0, 1, 1, ["AA", "05 Mei 2024", "Rp 1,000", "1,100", "10", "11,000", "4", "1"]),
         ("x_20240507.xlsx", 0, 2, 2, ["AA", "", "Rp 5", "Rp 5", "0", "0", "1", "0"]), ("x_20240507.xlsx", 0, 3, 3, ["short"]),
         ("nodate.xlsx", 0, 4, 4, ["BB", "", "1", "1", "1", "1", "1", "1"])], schemas.SHEET_ROWS)
    parsed = D.parse_sheet(D.sheet_records(rows, heads)).orderBy("load_seq").collect()
    assert [(r["trading_date"], r["open_price"], r["close"], r["net_foreign_value"]) for r in parsed] == [
        (date(2024, 5, 5), 1000.0, 1100.0, 3300.0), (date(2024, 5, 7), 5.0, None, None)]
    published = D.publish(D.parse_sheet(D.sheet_records(rows, heads)))
    assert published.columns == [f.name for f in schemas.DAILY_TABLE.fields if f.name in published.columns]
    assert published.filter("close = 0").count() == 1
