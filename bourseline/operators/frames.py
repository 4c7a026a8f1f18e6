"""Projections, filters, set operations and small aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingColumns(ValueError):
    pass


def normalize_headers(names: Sequence[str]) -> list[str]:
    """Trim, upper-case, blanks to underscores."""
    return [n.strip().upper().replace(" ", "_") for n in names]


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def keep_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def align_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Expected columns in order; a missing one takes its default."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else d.alias(c) for c, d in defaults.items()])


def positional(cells: Column, names: Sequence[str]) -> list[Column]:
    """Name cells by position; short rows give nulls, long rows are cut."""
    return [F.try_element_at(cells, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]


def require_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing required columns: {missing}; have: {sorted(df.columns)}")
    return df


def with_date(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set a date column and drop the rows where it is null.

    An explode over the one value, not a filter: a filter would be pushed below and
    run the costly parse a second time.
    """
    nothing = F.array(F.lit(None).cast("date"))
    return df.withColumn(name, F.explode(F.array_except(F.array(value), nothing)))


def has_width(cells: Column, width: Column | int) -> Column:
    return F.size(cells) == width


def any_cell(cells: Column) -> Column:
    """At least one cell is filled."""
    return F.exists(cells, lambda c: c.isNotNull())


def any_pattern(c: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.ilike(p) for p in patterns])


def pair_in(a: Column, b: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """(a, b) IN (...)"""
    return F.struct(a.alias("a"), b.alias("b")).isin([F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, y in pairs])


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_to_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """History keeps only the columns the new rows also have."""
    return union_by_name(keep_existing(history, new.columns), new)


def named_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """One (name, rows) line per dataset."""
    return reduce(
        DataFrame.union,
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n") for name, df in datasets.items()],
    )


def weekdays(as_of: Column, days: int) -> Column:
    """The last `days` weekdays up to and including `as_of`, ascending."""
    span = F.lit(days + 2 * (days // 5 + 2))
    calendar = F.sequence(F.date_sub(as_of, span), as_of)
    work = F.filter(calendar, lambda d: F.weekday(d) < 5)
    return F.slice(work, F.size(work) - days + 1, days)
