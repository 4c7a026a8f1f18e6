"""Queries that run the jobs in pieces over a store, checked against all input in one go."""

from __future__ import annotations

from pyspark.sql import functions as F

from bourseline.plans import daily, daily_store, jobs
from bourseline.sources.storage import drop_landed, landed, stage_path
from bourseline.workload import adapters as A
from bourseline.workload.registry import CHECKS, add


def _same_as(key: str, query, other: str) -> None:
    """Register a query whose result is another's."""
    add(key, query)
    CHECKS[key] = CHECKS[other]


_stores: dict[tuple[str, str], str] = {}


def trading(spark, sf):
    """Two runs, once per session (a second call reads what is stored): the odd days, then all of them, of which the odd
    ones are known by then, so that every second day comes late."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        store = stage_path(spark, "daily-store")
        rows = A.trades(spark, sf)
        daily_store.run(rows.filter(F.dayofmonth("trading_date") % 2 == 1), store)
        daily_store.run(rows, store)
        _stores[key] = store
    return _stores[key]


def stored(spark, sf):
    """The published columns that the test rows have. Only the columns are wanted, so the plan that tells them is built over no
    rows, and what it stages goes."""
    mark = landed()
    columns = daily.publish(daily.indicators(spark.createDataFrame([], A.trades(spark, sf).schema))).columns
    drop_landed(spark, mark)
    return daily_store.stored_daily(spark, trading(spark, sf), columns)


_same_as("job_daily", stored, "pipe_daily_publish")
_same_as("job_daily_screener", lambda s, sf: daily_store.stored_screener(s, trading(s, sf)), "agg_screener_period")


def in_two_runs(make, pages, dated, store):
    """The second run sends some dates of the first again."""
    make(pages.filter(dated % 2 == 1), store)
    return make(pages.filter(dated % 4 != 1), store)


_same_as(
    "job_broker_activity",
    lambda s, sf: in_two_runs(jobs.broker_run, A.broker_pages(s, sf), F.dayofmonth("target_date"), stage_path(s, "broker-store")),
    "pipe_broker_activity",
)
_same_as(
    "job_insider",
    lambda s, sf: in_two_runs(jobs.insider_run, A.insider_pages(s, sf), F.dayofmonth("target_date"), stage_path(s, "insider-store")),
    "pipe_insider",
)
_same_as(
    "job_ownership_5pct",
    lambda s, sf: in_two_runs(jobs.majors_run, A.major_documents(s, sf), F.substring("file_name", 5, 2).cast("int"), stage_path(s, "major-store")),
    "pipe_ownership_5pct",
)
