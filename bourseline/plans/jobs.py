"""The jobs as they run day by day: what is new, into tables stored by date.

A store is a folder that all executors share. Every job may be run again with the same
input: tables are replaced by whole dates. Daily trading is in `daily_store`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bourseline import schemas
from bourseline.plans import brokers, majors
from bourseline.sources.writers import declare_table, read_table, upsert_by_date


def _stored(spark: SparkSession, path: str, schema: T.StructType, date: str) -> DataFrame:
    declare_table(spark, path, schema, date)
    return read_table(spark, path, schema)


def by_date(pages: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, schema: T.StructType, date: str) -> DataFrame:
    """Make a table's rows from new pages and replace their dates in the store; the whole table comes back.
    Rows without a date cannot be stored by date and are left out of it."""
    spark = pages.sparkSession
    declare_table(spark, path, schema, date)
    upsert_by_date(make(pages).na.drop(subset=[date]), path, date)
    return read_table(spark, path, schema)


def broker_run(pages: DataFrame, store: str) -> DataFrame:
    return by_date(pages, brokers.broker_activity, f"{store}/brokers", schemas.BROKER_TABLE, "date")


def insider_run(pages: DataFrame, store: str) -> DataFrame:
    return by_date(pages, brokers.insider_movements, f"{store}/insiders", schemas.INSIDER_TABLE, "target_date")


def majors_run(rows: DataFrame, store: str, baseline: bool = False) -> DataFrame:
    """Log the new documents against the lists stored before, then store their lists and the changed days of the log."""
    spark = rows.sparkSession
    new = majors.listing(rows)
    lists = _stored(spark, f"{store}/lists", new.schema, majors.DATE)
    log = by_date(rows, lambda r: majors.change_log(r, lists, baseline), f"{store}/majors", schemas.MAJOR_TABLE, majors.DATE)
    upsert_by_date(new, f"{store}/lists", majors.DATE)
    return log
