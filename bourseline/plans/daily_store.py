"""Daily trading kept in a store that follows its sources: only what a run touches is read and made again.

A store holds, by runs (see `sources.ledger`), the rows as they came, and tables, all in folders by month, since a folder
for each day would hold a small file for years of days:


* `daily`, the published table;
* `state`, for each stock and day: how many rows, the last known prices at its end, the day on which its last 49 rows
  begin (`reach`), and the prices known before that day. That is all a later run needs of the past: it reads a
  stock's rows from `reach` on, since no frame looks further back, with the prices of before put in front;
* `horizon`, for each stock and day what the period screener adds up.

A run finds the stocks it touches and the earliest day of each: of new sources, and of sources that have changed,
whose rows of before are passed over from then on. From that day on the stock's days are made anew. A stock
whose prices were not all known by then is made anew from its first day, since a first price
fills the days before it.

A run that dies leaves its intent, the touched stocks and days. The next run makes these anew as well, whether it has
the same sources or others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseline import schemas
from bourseline.functions.rules import DEFAULTS, Thresholds
from bourseline.operators.frames import union_by_name
from bourseline.plans import daily
from bourseline.plans.daily import DATE, LONG, SEQ, STOCK
from bourseline.sources import ledger
from bourseline.sources.storage import drop_landed, landed, names_in, remove, stage
from bourseline.sources.writers import read_table, upsert_by_date

SOURCE = "source_file"
MONTH = "month"
REACH = LONG - 1
NEAR = 120  # calendar days before a touched day in which most stocks' states are found
HORIZON = T.StructType([
    T.StructField(STOCK, T.StringType()), T.StructField("peak", T.DoubleType()), T.StructField("spikes", T.LongType()),
    T.StructField("flow", T.LongType()), T.StructField(DATE, T.DateType()),
])


def _known(c: str) -> str:
    return f"known_{c}"


def _base(c: str) -> str:
    return f"base_{c}"


def _brings(c: str) -> str:
    return f"brings_{c}"


def state_schema(prices: list[str]) -> T.StructType:
    double = [T.StructField(n, T.DoubleType()) for c in prices for n in (_known(c), _base(c))]
    return T.StructType([T.StructField(STOCK, T.StringType()), T.StructField("n", T.LongType()), T.StructField("reach", T.DateType()), *double, T.StructField(DATE, T.DateType())])


def touched_schema(prices: list[str]) -> T.StructType:
    brings = [T.StructField(_brings(c), T.BooleanType()) for c in prices]
    return T.StructType([T.StructField("_stock", T.StringType()), T.StructField("_day", T.DateType()), *brings])


@dataclass
class Store:
    """The folders of a store and the columns of its rows."""

    spark: SparkSession
    path: str
    schema: T.StructType

    @property
    def prices(self) -> list[str]:
        return [c for c in schemas.PRICES if c in self.schema.fieldNames()]

    def table(self, name: str, schema: T.StructType) -> DataFrame:
        """A table with its months; empty if nothing is stored yet."""
        return _table(self.spark, f"{self.path}/{name}", schema)

    def rows(self, upto: int) -> DataFrame:
        """All rows as they came, of runs up to one, with their run and month."""
        with_run = T.StructType([*self.schema.fields, T.StructField("run", T.LongType())])
        return _table(self.spark, f"{self.path}/history", with_run).filter(F.col("run") <= upto)


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])
    return read_table(spark, path, whole) if names_in(spark, path) else spark.createDataFrame([], whole)


def _in_months(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.trunc(DATE, "month"))


def _since(rows: DataFrame, day: Column) -> DataFrame:
    """Rows from a day on; folders of months before it are not read."""
    return rows.filter((F.col(MONTH) >= F.trunc(day, "month")) & (F.col(DATE) >= day))


def _stock_is(other: str) -> Column:
    return F.col(STOCK).eqNullSafe(F.col(other))


def in_force(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows of the run that took the present state of their source."""
    current = entries.select(F.col("name").alias("_name"), F.col("run").alias("_run"))
    return rows.join(current, F.col(SOURCE).cast("string").eqNullSafe(F.col("_name")) & (F.col("run") == F.col("_run"))).drop("_name", "_run", "run")


def touched_by(new: DataFrame, old: DataFrame, prices: list[str]) -> DataFrame:
    """Each stock of the rows with its earliest day, and which prices the rows hold."""
    both = new.select(STOCK, DATE, *prices).unionByName(old.select(STOCK, DATE, *prices))
    brings = [F.max(F.col(c).isNotNull()).alias(_brings(c)) for c in prices]
    return both.groupBy(F.col(STOCK).alias("_stock")).agg(F.min(DATE).alias("_day"), *brings)


def starts(touched: DataFrame, state: DataFrame, prices: list[str]) -> DataFrame:
    """For each touched stock `_from`, the first day to read, and `_day`, the first day to make anew (both null: all of its
    days), and the prices known before `_from`. The state is looked up in the days just before the earliest touched
    one, and further back only for stocks that have none there."""
    first = touched.agg(F.min("_day")).first()[0]

    def found(days: DataFrame, who: DataFrame) -> DataFrame:
        before = days.join(who, _stock_is("_stock")).filter(F.col(DATE) < F.col("_day"))
        last = F.struct(DATE, "reach", *[n for c in prices for n in (_known(c), _base(c))])
        return before.groupBy("_stock", "_day").agg(F.max(last).alias("_last"))

    near = F.date_sub(F.lit(first).cast("date"), NEAR)
    last = stage(found(_since(state, near), touched), "near-states")
    others = stage(touched.join(last.select(F.col("_stock").alias("_s")), F.col("_stock").eqNullSafe(F.col("_s")), "left_anti"), "others")
    if not others.isEmpty():
        last = last.unionByName(found(state.filter((F.col(MONTH) <= F.trunc(near, "month")) & (F.col(DATE) < near)), others))
    every = touched.join(last.select(F.col("_stock").alias("_s"), "_last"), F.col("_stock").eqNullSafe(F.col("_s")), "left")
    whole = F.lit(True)
    for c in prices:
        # A first price fills the days before it; one that does not come changes none.
        whole = whole & (F.col("_last")[_known(c)].isNotNull() | ~F.col(_brings(c)))
    # Rows without a stock are neither filled nor rolled. A stock without a state has nothing before its day.
    alone = F.col("_stock").isNull() | F.col("_last").isNull()
    begin = F.when(alone, F.col("_day")).when(whole, F.col("_last")["reach"])
    return every.select(
        "_stock", begin.alias("_from"), F.when(alone | whole, F.col("_day")).alias("_day"),
        *[F.when(~alone & whole, F.col("_last")[_base(c)]).alias(_base(c)) for c in prices],
    )


def _folders_from(rows: DataFrame, begins: DataFrame, day: str) -> DataFrame:
    """Without the folders of months before the earliest that any stock begins with."""
    first, everything = begins.agg(F.min(day), F.count_if(F.col(day).isNull())).first()
    return rows if everything or first is None else _since(rows, F.lit(first).cast("date"))


def context(rows: DataFrame, begins: DataFrame) -> DataFrame:
    """The touched stocks' rows from where frames reach. Folders of months before the first of them are not read."""
    rows = _folders_from(rows, begins, "_from")
    near = begins.select("_stock", "_from")
    return rows.join(near, _stock_is("_stock") & (F.col("_from").isNull() | (F.col(DATE) >= F.col("_from")))).drop("_stock", "_from", MONTH)


def carried_in(begins: DataFrame, prices: list[str]) -> DataFrame:
    """A row before the first one read of each stock that has a past, with the prices known by then."""
    some = begins.filter(F.coalesce(*[_base(c) for c in prices]).isNotNull() & F.col("_from").isNotNull())
    return some.select(
        F.col("_stock").alias(STOCK), F.date_sub("_from", 1).alias(DATE), F.lit(-(2**62)).alias(SEQ), *[F.col(_base(c)).alias(c) for c in prices]
    )


def states(rows: DataFrame, begins: DataFrame, prices: list[str]) -> DataFrame:
    """The state at the end of each day of `rows`, which begin where frames reach. A stock has a row a day here."""
    def last_known(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(SEQ, c)))[c].alias(c)

    days = rows.filter(F.col(STOCK).isNotNull()).groupBy(STOCK, DATE).agg(F.count(F.lit(1)).alias("n"), *[last_known(c) for c in prices])
    days = days.join(begins.select("_stock", *[_base(c) for c in prices]), F.col(STOCK) == F.col("_stock"), "left")
    so_far = W.partitionBy(STOCK).orderBy(DATE)
    through = so_far.rowsBetween(W.unboundedPreceding, 0)
    days = days.withColumns({_known(c): F.coalesce(F.last(c, True).over(through), F.col(_base(c))) for c in prices})
    before = {f"_before_{c}": F.coalesce(F.lag(_known(c)).over(so_far), F.col(_base(c))) for c in prices}
    days = days.withColumns(before)
    # Counted from a stock's first row, a day's last REACH rows begin on the day after the last one whose count lies REACH or more
    # below its own; if there is none, on the first day.
    here = F.struct(DATE, *[F.col(f"_before_{c}").alias(_base(c)) for c in prices])
    days = days.withColumns({"_rows": F.sum("n").over(through), "_first": F.first(here).over(through), "_next": F.lead(here).over(so_far)})
    passed = W.partitionBy(STOCK).orderBy("_rows").rangeBetween(W.unboundedPreceding, -REACH)
    days = days.withColumn("_at", F.coalesce(F.last("_next").over(passed), F.col("_first")))
    return days.select(
        STOCK, "n", F.col("_at")[DATE].alias("reach"), *[x for c in prices for x in (F.col(_known(c)), F.col("_at")[_base(c)].alias(_base(c)))], DATE
    )


def anew(table: DataFrame, begins: DataFrame) -> DataFrame:
    """The rows of days that are made anew."""
    days = begins.select("_stock", "_day")
    return table.join(days, _stock_is("_stock") & (F.col("_day").isNull() | (F.col(DATE) >= F.col("_day")))).drop("_stock", "_day")


def replace_days(fresh: DataFrame, stored: DataFrame, begins: DataFrame, path: str) -> None:
    """Put the days made anew in place of the stored ones of their stocks; other stocks' rows of their months, and other days, stay.
    `fresh` is read several times, so it comes from a stage."""
    spark = fresh.sparkSession
    mark = landed()
    fresh = _in_months(fresh).select(*stored.columns)
    gone = anew(_folders_from(stored, begins, "_day"), begins).select(MONTH)
    made = {r[MONTH] for r in fresh.select(MONTH).distinct().collect()}  # bounded by the calendar
    months = made | {r[MONTH] for r in gone.distinct().collect()}
    if not months:
        drop_landed(spark, mark)
        return
    days = begins.select("_stock", "_day")
    same = _stock_is("_stock") & (F.col("_day").isNull() | (F.col(DATE) >= F.col("_day")))
    # Stored first: the months are written over while these rows of them would be read.
    others = stage(stored.filter(F.col(MONTH).isin(sorted(months))).join(days, same, "left_anti"), "others")
    upsert_by_date(others.unionByName(fresh), path, MONTH)
    left = made | {r[MONTH] for r in others.select(MONTH).distinct().collect()}
    for month in months - left:
        remove(spark, f"{path}/{MONTH}={month}")
    drop_landed(spark, mark)


def horizon(table: DataFrame, t: Thresholds) -> DataFrame:
    """What the period screener needs of a stock's day; days add up by greatest, sum and sum."""
    spike = (F.col("aov_ratio_ma20") >= t.spike_ratio) & (F.col("value") >= t.whale_value)
    return table.groupBy(STOCK, DATE).agg(
        F.max("aov_ratio_ma20").alias("peak"), F.count_if(spike).alias("spikes"), F.sum("net_foreign_value").cast("bigint").alias("flow")
    ).select(*HORIZON.fieldNames())


def run(rows: DataFrame, path: str, t: Thresholds = DEFAULTS, backfill: str = "own") -> int:
    """Take in the sources of `rows` that are new or have changed, each as a whole, and make anew what they touch. The number of
    the run comes back, or 0 if there was nothing to do. With `backfill="next_stock"` a price may
    fill another stock's gaps, so all stocks are made anew."""
    spark = rows.sparkSession
    mark = landed()
    try:
        return _run(rows, path, t, backfill)
    finally:
        # The run's stages are read by nothing after it; a store of many runs would otherwise hold them all.
        drop_landed(spark, mark)


def _run(rows: DataFrame, path: str, t: Thresholds, backfill: str) -> int:
    spark = rows.sparkSession
    rows = rows.na.drop(subset=[DATE])
    store = Store(spark, path, rows.schema)
    number = ledger.committed(spark, path) + 1
    known = ledger.entries(spark, path)
    found = stage(ledger.unseen(ledger.of_rows(rows, SOURCE), known), "unseen")
    intent = f"{path}/intents/run={number}"
    kept = touched_schema(store.prices)
    left = read_table(spark, intent, kept) if names_in(spark, intent) else spark.createDataFrame([], kept)
    left = stage(left, "left")
    if found.isEmpty() and left.isEmpty():
        return 0

    names = found.select(F.col("name").alias("_name"))
    new = rows.join(names, F.col(SOURCE).cast("string").eqNullSafe(F.col("_name")), "left_semi")
    _in_months(new).hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(f"{path}/history/run={number}")
    ledger.write(found, path, number)
    entries = stage(union_by_name(
        known.join(names, F.col("name").eqNullSafe(F.col("_name")), "left_anti"), found.select(*ledger.KEY, F.lit(number).cast("bigint").alias("run"))
    ), "entries")

    every = store.rows(number)
    changed = found.filter(F.col("before").isNotNull()).select(F.col("name").alias("_name"), F.col("before").alias("_run"))
    runs = [r[0] for r in changed.select("_run").distinct().collect()]  # runs are counted, not rows
    old = every.filter(F.col("run").isin(runs)).join(changed, F.col(SOURCE).cast("string").eqNullSafe(F.col("_name")) & (F.col("run") == F.col("_run"))) if runs else every.limit(0)
    touched = touched_by(every.filter(F.col("run") == number), old, store.prices).unionByName(left)
    touched = touched.groupBy("_stock").agg(F.min("_day").alias("_day"), *[F.max(_brings(c)).alias(_brings(c)) for c in store.prices])
    touched = stage(touched, "touched")
    touched.write.mode("overwrite").parquet(intent)

    live = in_force(every, entries)
    if backfill == "own":
        begins = stage(starts(touched, store.table("state", state_schema(store.prices)), store.prices), "begins")
    else:
        nothing = [F.lit(None).cast("double").alias(_base(c)) for c in store.prices]
        stocks = live.select(F.col(STOCK).alias("_stock")).unionByName(touched.select("_stock")).distinct()
        begins = stage(stocks.select("_stock", F.lit(None).cast("date").alias("_from"), F.lit(None).cast("date").alias("_day"), *nothing), "begins")
    read = stage(context(live, begins), "context")
    in_front = union_by_name(read, carried_in(begins, store.prices)).select(*read.columns)
    table = daily.publish(daily.indicators(in_front, t, backfill))
    table = stage(anew(table, begins), "published")

    columns = T.StructType([f for f in schemas.DAILY_TABLE.fields if f.name in table.columns])
    replace_days(table, store.table("daily", columns), begins, f"{path}/daily")
    ended = stage(anew(states(read, begins, store.prices), begins), "states")
    replace_days(ended, store.table("state", state_schema(store.prices)), begins, f"{path}/state")
    if {"aov_ratio_ma20", "value", "net_foreign_value"} <= set(table.columns):
        replace_days(stage(horizon(table, t), "horizon"), store.table("horizon", HORIZON), begins, f"{path}/horizon")
    ledger.commit(spark, path, number)
    return number


def stored_daily(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return _table(spark, f"{path}/daily", T.StructType([f for f in schemas.DAILY_TABLE.fields if f.name in columns])).drop(MONTH)


def stored_screener(spark: SparkSession, path: str) -> DataFrame:
    """The period screener, merged from the stored days of the last 90 days' months."""
    days = _table(spark, f"{path}/horizon", HORIZON)
    last = days.select(F.max(MONTH)).first()[0]  # from the folders' names
    newest = F.lit(days.filter(F.col(MONTH) == F.lit(last)).select(F.max(DATE)).first()[0]).cast("date")
    recent = _since(days, F.date_sub(newest, max(daily.HORIZONS)))
    since = {d: F.col(DATE) >= F.date_sub(newest, d) for d in daily.HORIZONS}
    zero = F.lit(0).cast("bigint")

    def flow(d: int) -> Column:
        # A group without a stock code has no partner to join, so its flow is 0.
        return F.when(F.col(STOCK).isNotNull(), F.coalesce(F.sum(F.when(since[d], F.col("flow"))), zero)).otherwise(zero).alias(f"foreign_{d}d")

    return recent.groupBy(STOCK).agg(
        F.max("peak").alias("aov_max"), *[F.max(F.when(since[d], F.col("peak"))).alias(f"aov_max_{d}d") for d in daily.HORIZONS],
        *[F.coalesce(F.sum(F.when(since[d], F.col("spikes"))), zero).alias(f"spike_{d}d") for d in daily.HORIZONS], *[flow(d) for d in daily.HORIZONS],
    )
