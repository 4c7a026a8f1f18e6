"""Registered queries and their SQL checks.

A query is a function (spark, sf) -> DataFrame; its check is SQL over the same
tables. Dates leave as yyyy-MM-dd text on both sides, so the two engines' date
types cannot differ.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def dates_as_text(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd") for n in names}) if names else df


def add(key: str, query: Query, sql: str | None = None, dates: Sequence[str] = ()) -> None:
    if key in QUERIES:
        raise ValueError(f"{key} is registered twice")
    QUERIES[key] = lambda spark, sf: dates_as_text(query(spark, sf))
    if sql is not None:
        if dates:
            casts = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
            sql = f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) AS checked"
        CHECKS[key] = sql
