"""Row-ordered operators on small groups: de-duplication, top rows, values of the next stock.

Keep-first and keep-last are ``row_number() = 1``. Spark limits each group on the map side
(WindowGroupLimit), so a hot key sends one row per input task. Fills, rolling frames and lags
over keys of any size are in `ranges`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _keep_first_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per key in load order; null keys count as equal."""
    return _keep_first_ranked(df, keys, [F.col(c).asc() for c in order_by])


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row per key in load order; null keys count as equal."""
    return _keep_first_ranked(df, keys, [F.col(c).desc() for c in order_by])


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The n best rows of each group; the limit is applied on the map side first."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def next_stock_values(df: DataFrame, stock: str, date: str, load_seq: str, cols: Sequence[str]) -> DataFrame:
    """For each stock the value an ungrouped back fill would leak into it: the
    first known value of the next stock, in code order, that has one.

    Works on one row per stock. Codes are split by their first two characters, so
    only the two-character directory is ever ordered as a whole.
    """
    def first_known(c: str) -> Column:
        found = F.struct(F.col(date), F.col(load_seq), F.col(c).alias("v"))
        return F.min(F.when(F.col(c).isNotNull(), found))["v"].alias(c)

    firsts = (
        df.filter(F.col(stock).isNotNull())
        .groupBy(stock)
        .agg(*[first_known(c) for c in cols])
        .withColumn("_area", F.left(F.col(stock), F.lit(2)))
    )
    later = W.partitionBy("_area").orderBy(F.col(stock).desc()).rowsBetween(W.unboundedPreceding, -1)
    inside = firsts.select(
        stock, "_area", *[F.last(c, ignorenulls=True).over(later).alias(f"_next_{c}") for c in cols]
    )
    areas = firsts.groupBy("_area").agg(
        *[F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(stock), F.col(c).alias("v"))))["v"].alias(c) for c in cols]
    )
    # One row per two-character prefix: bounded by the alphabet.
    later_area = W.orderBy(F.col("_area").desc()).rowsBetween(W.unboundedPreceding, -1)
    beyond = areas.select("_area", *[F.last(c, ignorenulls=True).over(later_area).alias(f"_beyond_{c}") for c in cols])
    return inside.join(beyond, "_area").select(
        stock, *[F.coalesce(f"_next_{c}", f"_beyond_{c}").alias(f"_leak_{c}") for c in cols]
    )


def fill_from_next_stock(df: DataFrame, leaks: DataFrame, stock: str, cols: Sequence[str]) -> DataFrame:
    joined = df.join(leaks, stock, "left")
    return joined.withColumns({c: F.coalesce(c, f"_leak_{c}") for c in cols}).drop(*[f"_leak_{c}" for c in cols])


def first_date(df: DataFrame, keys: Sequence[str], date: str, name: str) -> DataFrame:
    """Earliest date per key on every row: a partial aggregate joined back, so a
    hot key is never gathered and AQE may split its rows."""
    firsts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(date).alias(name))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(firsts, reduce(lambda a, b: a & b, same), "left").select(*df.columns, name)
