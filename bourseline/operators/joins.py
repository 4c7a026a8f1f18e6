"""Joins: left joins on aggregates, exits, processed-set anti joins.

A side is broadcast by hint only if its size is bounded by the calendar (a date
column holds at most one value a day); otherwise Spark picks by measured size at run time (AQE) and splits
skewed sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bourseline.functions.text import stem

def latest(df: DataFrame, date: str) -> Column:
    """The greatest date as a scalar subquery, usable in any filter on `df`."""
    return df.select(F.max(date)).scalar()


def previous_date(df: DataFrame, date: str) -> Column:
    """The greatest date below the greatest, as a scalar subquery."""
    return df.filter(F.col(date) < latest(df, date)).select(F.max(date)).scalar()


def unprocessed(df: DataFrame, processed: DataFrame, file_name: str, source: str, loose: bool = False) -> DataFrame:
    """Rows of files not in the processed list. `loose` also takes the name
    without extension or its first eight characters as a match."""
    name = F.col(file_name)
    keys = [name, stem(name), F.left(name, F.lit(8))] if loose else [name]
    done = processed.select(F.col(source).alias("_key")).distinct()
    names = df.select(file_name).distinct().select(file_name, F.explode(F.array(*keys)).alias("_key"))
    seen = names.join(done, "_key", "left_semi").select(file_name).distinct()
    return df.join(seen, file_name, "left_anti")


def next_dates(df: DataFrame, date: str) -> DataFrame:
    """Each distinct date with the one after it: at most 366 rows a year."""
    return df.select(date).distinct().withColumn("_next", F.lead(date).over(W.orderBy(date)))


def dropouts(df: DataFrame, date: str, keys: Sequence[str], active: Column) -> DataFrame:
    """Active rows whose key is absent on the next date, moved to that date.

    Today's keys are made distinct first (combined on the map side), so copies of
    a holder on either side never multiply.
    """
    calendar = F.broadcast(next_dates(df, date))  # bounded by the calendar
    moved = df.filter(active).join(calendar, date).filter(F.col("_next").isNotNull())
    moved = moved.withColumn(date, F.col("_next")).drop("_next")
    return moved.join(df.select(date, *keys).distinct(), [date, *keys], "left_anti").select(*df.columns)
