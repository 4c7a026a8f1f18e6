"""Scans over ranges: fills, rolling sums and lags of keys of which one may hold most rows.

`deal` sorts rows into ranges of (key, order), which split a hot key however its rows lie, and stores
them once in buckets of ranges, so that every later step sees the same cut and finds the rows of a
range in one place. Windows run inside (range, key). What crosses a border concerns only the first
and the last key of a range, since ranges follow one another in key order:

* `spans` sums up those keys in each range: at most two rows a range, however many rows there are;
* `edges` lets them see one another along each key: the last known values before a range, the first
  known after it, how many rows came before, and where the key goes on;
* `halo` holds the last rows that a key has before a range, as far as a rolling frame reaches.

The tables of edges have one row for each range, four times as many as shuffles have partitions. That is the bound
of all broadcasts here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bourseline.sources.storage import stage, stage_buckets

RANGE = "_range"
RANGES_PER_PARTITION = 4  # so that the buckets, to which ranges go by hash, are even


def deal(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with `_range`, stored in buckets by it."""
    ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage_buckets(df.repartitionByRange(ranges, *keys, *order).withColumn(RANGE, F.spark_partition_id()), "ranges", RANGE)


def _same(key: str, other: str) -> Column:
    return F.col(key).eqNullSafe(F.col(other))


def ends(dealt: DataFrame, key: str) -> DataFrame:
    """For each range its first and last key, `_head` and `_tail`."""
    found = dealt.groupBy(RANGE).agg(F.min(F.struct(key)).alias("low"), F.max(F.struct(key)).alias("high"))
    return stage(found.select(RANGE, F.col("low")[key].alias("_head"), F.col("high")[key].alias("_tail")), "ends")


def spans(dealt: DataFrame, of: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row for each range and its head or tail key: `_n` rows, `_from` (the first value of the order),
    and the first and last known value of each column."""
    place = F.struct(*order)

    def known(pick, c: str) -> Column:
        return pick(F.when(F.col(c).isNotNull(), F.struct(place.alias("at"), F.col(c).alias("v"))))["v"]

    rows = dealt.select(RANGE, key, *order, *cols).join(F.broadcast(of), RANGE).where(_same(key, "_head") | _same(key, "_tail"))
    sums = [known(F.min, c).alias(f"_first_{c}") for c in cols] + [known(F.max, c).alias(f"_last_{c}") for c in cols]
    return stage(rows.groupBy(RANGE, key, "_head", "_tail").agg(F.count(F.lit(1)).alias("_n"), F.min(order[0]).alias("_from"), *sums), "spans")


def edges(found: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row for each range: `_head`, `_start` (rows of the head key before) and `_carry` (its last known values before),
    `_tail`, `_after` (the first known values of the tail key later on) and `_next` (where it goes on; null if it does not)."""
    along = W.partitionBy(key).orderBy(RANGE)
    before, later = along.rowsBetween(W.unboundedPreceding, -1), along.rowsBetween(1, W.unboundedFollowing)
    carry = F.struct(*[F.last(f"_last_{c}", True).over(before).alias(c) for c in cols], F.sum("_n").over(before).alias("_start"))
    after = F.struct(*[F.first(f"_first_{c}", True).over(later).alias(c) for c in cols], F.lead("_from").over(along).alias("_next"))
    seen = found.withColumns({"_carry": carry, "_after": after})
    rows = seen.groupBy(RANGE, "_head", "_tail").agg(
        F.max(F.when(_same(key, "_head"), F.col("_carry"))).alias("_carry"), F.max(F.when(_same(key, "_tail"), F.col("_after"))).alias("_after")
    )
    return stage(rows.select("*", F.coalesce(F.col("_carry")["_start"], F.lit(0)).alias("_start"), F.col("_after")["_next"].alias("_next")), "edges")


def with_edges(dealt: DataFrame, of: DataFrame) -> DataFrame:
    return dealt.join(F.broadcast(of), RANGE)


def inside(key: str, order: Sequence[str]):
    """The window of a key's rows in a range."""
    return W.partitionBy(RANGE, key).orderBy(*order)


def carried(rows: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Last known values per key; leading gaps take the key's first known value. Rows without a key get nulls, as in a grouped fill.
    `rows` have their edges, and lose the values among them."""
    w = inside(key, order)
    running = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def filled(c: str) -> Column:
        known = F.coalesce(
            F.last(c, True).over(running), F.when(_same(key, "_head"), F.col("_carry")[c]),
            F.first(c, True).over(whole), F.when(_same(key, "_tail"), F.col("_after")[c]),
        )
        return F.when(F.col(key).isNotNull(), known)

    return rows.withColumns({c: filled(c) for c in cols}).drop("_carry", "_after")


def reaching(rows: DataFrame, key: str, order: Sequence[str], reach: int) -> DataFrame:
    """The last `reach` rows of each range's tail key, where it goes on. `rows` have their edges."""
    back = W.partitionBy(RANGE, key).orderBy(*[F.col(c).desc() for c in order])
    tail = rows.where(_same(key, "_tail") & F.col("_next").isNotNull())
    return tail.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= reach)


def halo(tails: DataFrame, found: DataFrame, key: str, cols: Sequence[str], reach: int) -> DataFrame:
    """For each range `_halo`: element k holds the sums of each column over the last k rows that its head key has before the
    range, up to `reach`. `tails` are rows of `reaching` (`_back` counts them from the end), `found` the spans."""
    lists = tails.groupBy(RANGE, key).agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("at"), *cols))).alias("_own"))
    lists = lists.select(F.col(RANGE).alias("_r"), F.col(key).alias("_k"), "_own")
    listed = found.join(lists, (F.col(RANGE) == F.col("_r")) & F.col(key).eqNullSafe(F.col("_k")), "left")
    # Every span has a row at least, so no more spans than rows are within reach.
    before = W.partitionBy(key).orderBy(RANGE).rowsBetween(-reach, -1)
    rows = listed.select(RANGE, key, "_head", F.reverse(F.flatten(F.collect_list("_own").over(before))).alias("_rows")).where(_same(key, "_head"))

    def sums(k: Column) -> Column:
        part = F.slice(F.col("_rows"), F.lit(1), k)

        def total(c: str) -> Column:
            return F.aggregate(part, F.lit(None).cast("double"), lambda s, x: F.when(x[c].isNull(), s).otherwise(F.coalesce(s, F.lit(0.0)) + x[c]))

        return F.struct(*[total(c).alias(c) for c in cols])

    last = F.least(F.size("_rows"), F.lit(reach))
    return stage(rows.select(RANGE, F.transform(F.sequence(F.lit(0), last), sums).alias("_halo")), "halo")


def rolled(rows: DataFrame, of: DataFrame, key: str, order: Sequence[str], frames: dict[str, tuple[str, int]], only: Column | None = None) -> DataFrame:
    """`rows` (with their edges) with a sum for each frame (new name -> column, rows) and `_row`, the place in the key; of these the
    rows where `only` holds. Nulls are left out of a sum; a sum of nulls alone is null. Halos come to the rows after all
    sorting, so that no sort carries them."""
    w = inside(key, order)
    sums = {name: F.sum(c).over(w.rowsBetween(1 - n, W.currentRow)) for name, (c, n) in frames.items()}
    rows = rows.withColumns(sums | {"_own_row": F.row_number().over(w), "_only": F.lit(True) if only is None else only})
    rows = rows.filter("_only").drop("_only").join(F.broadcast(of), RANGE, "left")

    def total(name: str, c: str, n: int) -> Column:
        own = F.col(name)
        missing = F.least(F.lit(n) - F.col("_own_row"), F.size("_halo") - 1)
        extra = F.when(_same(key, "_head") & (missing > 0), F.get("_halo", missing)[c])
        return F.coalesce(own + extra, own, extra)

    row = F.col("_own_row") + F.when(_same(key, "_head"), F.col("_start")).otherwise(F.lit(0))
    return rows.withColumns({name: total(name, c, n) for name, (c, n) in frames.items()} | {"_row": row}).drop("_own_row", "_halo")


def last_of(rows: DataFrame, key: str, order: Sequence[str]) -> Column:
    """True on the last row of each (key, first column of the order). `rows` have their edges."""
    date = order[0]
    following = F.coalesce(F.lead(date).over(inside(key, order)), F.when(_same(key, "_tail"), F.col("_next")))
    return following.isNull() | (following != F.col(date))


def previous_row(df: DataFrame, keys: Sequence[str], date: str, load_seq: str, cols: dict[str, str]) -> DataFrame:
    """Add the previous row's values per key (`cols`: source -> new name), in (date, load position) order,
    copies of a date included. Inside a range a lag does; a range's first row of a key needs the last row of
    the range before, so only edge rows, at most two per range and key, are ordered over the whole key."""
    rows = deal(df, keys, [date, load_seq])
    own = W.partitionBy(RANGE, *keys).orderBy(date, load_seq)
    over_key = W.partitionBy(*keys).orderBy(date, load_seq)
    packed = F.struct(*[F.col(s).alias(n) for s, n in cols.items()])
    rows = rows.withColumns({"_first": F.row_number().over(own) == 1, "_final": F.lead(F.lit(1)).over(own).isNull(), "_prev": F.lag(packed).over(own)})
    first = rows.filter(F.col("_first") | F.col("_final")).withColumn("_prev", F.lag(packed).over(over_key)).filter("_first")
    both = rows.filter(~F.col("_first")).unionByName(first)
    return both.select(*df.columns, *[F.col("_prev")[n].alias(n) for n in cols.values()])


def drop_edges(df: DataFrame) -> DataFrame:
    return df.drop(RANGE, "_head", "_tail", "_carry", "_after", "_start", "_next")
