"""Daily trading: intake of sheet rows, rolling indicators, published table, screener."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import dates, numbers, rules, text
from bourseline.functions.rules import DEFAULTS, Thresholds
from bourseline.operators import ranges, windows
from bourseline.operators.frames import has_width, keep_existing, rename, with_date
from bourseline.operators.joins import latest

STOCK, DATE, SEQ = "stock_code", "trading_date", "load_seq"
SHORT, LONG = 20, 50
# Look-back days of the period screener.
HORIZONS = (1, 7, 14, 30, 90)


# ---- intake ----------------------------------------------------------------


def sheet_headings(rows: DataFrame) -> list[str]:
    """The heading of all sheets: row 0 of the first one in load order. One row comes to the driver."""
    first = rows.filter(F.col("row_idx") == 0).orderBy(SEQ, "file_name").select("cells").first()
    return list(first["cells"]) if first else []


def sheet_records(rows: DataFrame, headers: list[str] | None = None) -> DataFrame:
    """Data rows of exactly the heading's width, named by the heading (that of the first sheet, if none is given), as text."""
    cells = F.col("cells")
    headers = sheet_headings(rows) if headers is None else headers
    named = [F.try_element_at(cells, F.lit(i + 1)).alias(h.strip()) for i, h in enumerate(headers)]
    return (
        rows.filter((F.col("row_idx") > 0) & has_width(cells, len(headers)))
        .select(*named, F.col("file_name").alias("Source File"), SEQ)
    )


def parse_sheet(records: DataFrame) -> DataFrame:
    """Dates and numbers of new sheet rows. Close, volume, value and the foreign
    counts only lose their commas; a currency sign in them makes them null."""
    df = rename(records, schemas.DAILY_HEADERS)
    df = with_date(df, DATE, dates.cell_or_file_date(F.col(DATE), F.col("source_file")))
    strict = ["close", "volume", "value", "foreign_buy", "foreign_sell"]
    loose = ["high", "low", "previous", "change", "open_price", "frequency", "bid", "offer", "bid_volume", "offer_volume"]
    have = set(df.columns)
    df = df.withColumns(
        {c: numbers.comma_number(F.col(c)) for c in strict if c in have}
        | {c: numbers.currency_number(F.col(c)) for c in loose if c in have}
        | {c: numbers.comma_number(F.col(c)) for c in ["tradeable_shares"] if c in have}
    )
    return foreign_values(df)


def foreign_values(df: DataFrame) -> DataFrame:
    """Foreign buy and sell counts in money, at the day's average price."""
    if not {"foreign_buy", "foreign_sell"} <= set(df.columns):
        return df
    price = rules.vwap(F.col("value"), F.col("volume"), F.col("close"))
    buy, sell = F.col("foreign_buy") * price, F.col("foreign_sell") * price
    return df.withColumns(
        {"foreign_buy_value": buy, "foreign_sell_value": sell, "net_foreign_value": buy - sell}
    )


# ---- indicators ------------------------------------------------------------


ORDER = [DATE, SEQ]


class Ranges:
    """Dated rows dealt by ranges of (stock, date, load position), with what crosses the borders of ranges."""

    def __init__(self, rows: DataFrame) -> None:
        self.prices = [c for c in schemas.PRICES if c in rows.columns]
        self.rows = ranges.deal(rows, [STOCK], ORDER)
        self.ends = ranges.ends(self.rows, STOCK)
        self.spans = ranges.spans(self.rows, self.ends, STOCK, ORDER, self.prices)
        self.edges = ranges.edges(self.spans, STOCK, self.prices)
        self.all = ranges.with_edges(self.rows, self.edges)

    def filled(self, rows: DataFrame, backfill: str) -> DataFrame:
        """Some of the rows, by whole stocks of a range, with their gaps filled."""
        out = ranges.carried(rows, STOCK, ORDER, self.prices)
        if backfill == "next_stock":
            leaks = windows.next_stock_values(self.rows, STOCK, DATE, SEQ, self.prices)
            out = windows.fill_from_next_stock(out, leaks, STOCK, self.prices)
        return out.fillna(0, subset=[c for c in schemas.VOLUMES if c in out.columns])


def fill_gaps(rows: DataFrame, backfill: str = "own") -> DataFrame:
    """Prices carried forward per stock, then backward; missing volumes are 0. All dated rows stay.

    `backfill`: "own" uses the stock's own first price; "next_stock" also lets a
    stock without any price take the next stock's, as an ungrouped back fill does.
    """
    dealt = Ranges(rows.na.drop(subset=[DATE]))
    return dealt.filled(dealt.all, backfill).select(*rows.columns)


def derive(df: DataFrame) -> DataFrame:
    c = F.col
    has_frequency = "frequency" in df.columns
    order_volume = numbers.safe_ratio(c("volume"), c("frequency"), 0.0) if has_frequency else F.lit(0.0)
    return df.withColumns(
        {
            "change_percent": rules.change_pct(c("change"), c("previous")),
            "typical_price": rules.typical_price(c("high"), c("low"), c("close")),
            "avg_order_volume": order_volume,
        }
    ).withColumn("tpxv", c("typical_price") * c("volume"))


ROLLED = {"_tpxv": ("tpxv", SHORT), "_volume": ("volume", SHORT), "_order20": ("avg_order_volume", SHORT), "_order50": ("avg_order_volume", LONG)}


def roll(df: DataFrame, halo: DataFrame) -> DataFrame:
    """20- and 50-row frames per stock, at the last row of each day. Rows without a stock code get no averages."""
    c = F.col

    def per_stock(value: Column) -> Column:
        return F.when(c(STOCK).isNotNull(), value)

    sums = ranges.rolled(df, halo, STOCK, ORDER, ROLLED, ranges.last_of(df, STOCK, ORDER))

    # Volumes hold no nulls here, so a frame's mean is its sum over its row count.
    def mean(total: str, rows: int) -> Column:
        return per_stock(c(total) / F.least(c("_row"), F.lit(rows)))

    vwma = F.when(c("_volume") == 0, c("close")).otherwise(F.try_divide(c("_tpxv"), c("_volume")))
    return sums.withColumns(
        {
            "vwma_20d": per_stock(vwma),
            "ma20_volume": mean("_volume", SHORT),
            "ma20_avg_order_volume": mean("_order20", SHORT),
            "ma50_avg_order_volume": mean("_order50", LONG),
        }
    ).drop("_row", *ROLLED)


def flags(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    c = F.col
    order, ma20, ma50 = c("avg_order_volume"), c("ma20_avg_order_volume"), c("ma50_avg_order_volume")
    df = df.withColumns(
        {
            "aov_ratio_ma20": numbers.safe_ratio(order, ma20, 1.0),
            "aov_ratio": numbers.safe_ratio(order, ma50, 1.0),
            "signal": rules.trade_signal(c("close"), c("vwma_20d"), c("volume"), c("ma20_volume")),
        }
    )
    return df.withColumns(
        {
            "whale_signal": rules.whale_signal(c("aov_ratio"), c("value"), c("volume"), ma50, t),
            "big_player_anomaly": rules.big_player(order, ma50, c("value"), c("volume"), t),
        }
    )


def indicators(rows: DataFrame, t: Thresholds = DEFAULTS, backfill: str = "own") -> DataFrame:
    """All rows in, one row per (stock, date) out: the last loaded copy wins, but
    the copies before it do count inside the rolling frames."""
    dealt = Ranges(rows.na.drop(subset=[DATE]))
    # The rows before a border that frames beyond it reach; stocks inside a range have none.
    near = dealt.all.where(F.col(STOCK).eqNullSafe(F.col("_tail")) & F.col("_next").isNotNull())
    tails = ranges.reaching(derive(dealt.filled(near, backfill)), STOCK, ORDER, LONG - 1)
    halo = ranges.halo(tails, dealt.spans, STOCK, ["tpxv", "volume", "avg_order_volume"], LONG - 1)
    df = roll(derive(dealt.filled(dealt.all, backfill)), halo)
    df = ranges.drop_edges(df)
    if "foreign_buy_value" not in df.columns:
        df = foreign_values(df)
    return flags(df, t)


def publish(df: DataFrame) -> DataFrame:
    """The published columns that exist, in table order, cast; null numbers are 0."""
    columns = {}
    for field in schemas.DAILY_TABLE.fields:
        c, kind = F.col(field.name), field.dataType.simpleString()
        if kind == "bigint":
            columns[field.name] = numbers.fill_long(c)
        elif kind == "double":
            columns[field.name] = numbers.fill_double(c)
        elif kind == "boolean":
            columns[field.name] = text.true_text(c)
        else:
            columns[field.name] = c.cast(kind)
    present = keep_existing(df, columns)
    return present.select(*[columns[c].alias(c) for c in present.columns])


# ---- period screener -------------------------------------------------------


def _from(days: int, last: Column) -> Column:
    return F.col(DATE) >= F.date_sub(last, days)


def in_last_days(table: DataFrame, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the trailing span, its first day included. `as_of` defaults to the
    table's latest date."""
    return table.filter(_from(days, latest(table, DATE) if as_of is None else as_of))


def period_aggregates(last: Column, t: Thresholds = DEFAULTS) -> tuple[list[Column], list[Column], list[Column]]:
    """Highest ratio, spike count and net foreign flow of each horizon."""
    ratio, spike = F.col("aov_ratio_ma20"), (F.col("aov_ratio_ma20") >= t.spike_ratio) & (F.col("value") >= t.whale_value)
    peaks = [F.max(ratio).alias("aov_max")]
    peaks += [F.max(F.when(_from(d, last), ratio)).alias(f"aov_max_{d}d") for d in HORIZONS]
    spikes = [F.count(F.when(spike & _from(d, last), 1)).alias(f"spike_{d}d") for d in HORIZONS]
    zero = F.lit(0).cast("bigint")
    flow = [
        # A group without a stock code has no partner to join, so its flow is 0.
        F.when(
            F.col(STOCK).isNotNull(),
            F.coalesce(F.sum(F.when(_from(d, last), F.col("net_foreign_value")).otherwise(zero)), zero),
        ).otherwise(zero).alias(f"foreign_{d}d")
        for d in HORIZONS
    ]
    return peaks, spikes, flow


def screener_period(table: DataFrame, t: Thresholds = DEFAULTS, as_of: Column | None = None) -> DataFrame:
    """One row per stock seen in the last 90 days, all horizons in one aggregate."""
    last = latest(table, DATE) if as_of is None else as_of
    peaks, spikes, flow = period_aggregates(last, t)
    return in_last_days(table, max(HORIZONS), last).groupBy(STOCK).agg(*peaks, *spikes, *flow)


def false_positives(table: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Flags set below their value floor (expected: none) and flag totals."""
    whale, anomaly, value = F.col("whale_signal"), F.col("big_player_anomaly"), F.col("value")
    return table.agg(
        F.count_if(whale & (value < t.whale_value)).alias("fp_whale"),
        F.count_if(anomaly & (value < t.anomaly_value)).alias("fp_anomaly"),
        F.count_if(whale).alias("whale_total"),
        F.count_if(anomaly).alias("anomaly_total"),
    )
