"""The daily store against a full run over all rows: first, late, re-sent and corrected days, crashes, and what is read."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions.rules import Thresholds
from bourseline.plans import daily as D
from bourseline.plans import daily_store as S
from bourseline.sources import ledger

NUMBERS = ["high", "low", "close", "previous", "change", "volume", "value", "frequency", "foreign_buy", "foreign_sell"]
SCHEMA = "stock_code string, trading_date date, load_seq bigint, source_file string, " + ", ".join(f"{n} double" for n in NUMBERS)
LOW = Thresholds(whale_value=500, anomaly_value=800, min_volume=40)
DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(90)]


def make(seed=1):
    """Rows of four stocks by source (a day each): A trades daily, some days in many copies; B has no close before day 60; C trades
    seldom; D begins on day 40; E never has a high. Some rows have no stock."""
    rnd = random.Random(seed)
    out, seq = {}, 0
    for i, day in enumerate(DAYS):
        rows = []
        for stock, chance in (("A", 1.0), ("B", 0.9), ("C", 0.15), ("D", 0.8 if i >= 40 else 0), ("E", 0.6), (None, 0.1)):
            if rnd.random() >= chance:
                continue
            for _ in range(60 if stock == "A" and i in (10, 70) else 1 + (rnd.random() < 0.2)):
                seq += 1
                r = {n: float(rnd.randrange(1, 60)) for n in NUMBERS} | {"value": float(rnd.randrange(0, 1000)), "volume": float(rnd.randrange(0, 100))}
                for n in ("high", "low", "close"):
                    if rnd.random() < 0.4 or (stock == "B" and n == "close" and i < 60) or (stock == "E" and n == "high"):
                        r[n] = None
                rows.append((stock, day, seq, f"s{i:02}", *[r[n] for n in NUMBERS]))
        out[f"s{i:02}"] = rows
    return out


@pytest.fixture
def frame(spark):
    return lambda rows: D.foreign_values(spark.createDataFrame(rows, SCHEMA))


def texts(df):
    """Rows as sorted texts; sums of a frame may be taken in another order, so numbers have nine figures."""
    return sorted(repr([float(f"{v:.9g}") if isinstance(v, float) else v for v in r]) for r in df.collect())


def plain(rows):
    table = D.publish(D.indicators(rows, LOW))
    return table.columns, texts(table)


def stored(spark, path, columns):
    return texts(S.stored_daily(spark, path, columns).select(*columns))


def check(spark, path, rows):
    columns, want = plain(rows)
    assert stored(spark, path, columns) == want
    assert texts(S.stored_screener(spark, path)) == texts(D.screener_period(S.stored_daily(spark, path, columns), LOW))


def rows_of(data, names):
    return [r for n in names for r in data[n]]


def test_first_next_late_resent_and_corrected_days(spark, frame, tmp_path):
    path, data = str(tmp_path / "store"), make()
    names = sorted(data)
    first = [n for n in names[:80] if n not in ("s20", "s61")]
    assert S.run(frame(rows_of(data, first)), path, LOW) == 1
    check(spark, path, frame(rows_of(data, first)))
    # The next day, sent with the days before it, which are known by now.
    assert S.run(frame(rows_of(data, [*first[-5:], "s80"])), path, LOW) == 2
    check(spark, path, frame(rows_of(data, [*first, "s80"])))
    assert S.run(frame(rows_of(data, first)), path, LOW) == 0
    # Two late days: one before a stock's first close, one after.
    S.run(frame(rows_of(data, ["s20", "s61"])), path, LOW)
    seen = [*first, "s80", "s20", "s61"]
    check(spark, path, frame(rows_of(data, seen)))
    # A day sent again under another name is more copies; one corrected under its own name takes the old one's place.
    data["s50b"] = [(*r[:2], r[2] + 100_000, "s50b", *r[4:]) for r in data["s50"]]
    data["s30"] = [(*r[:4], *[None if v is None else v + 1 for v in r[4:]]) for r in data["s30"] if r[0] != "C"]
    data["s33"] = [("C", DAYS[33], 99_999, "s33", *[7.0] * len(NUMBERS))]  # all other stocks leave that day
    S.run(frame(rows_of(data, ["s50b", "s30", "s33"])), path, LOW)
    check(spark, path, frame(rows_of(data, [*seen, "s50b"])))
    assert {r["name"]: r["run"] for r in ledger.entries(spark, path).collect()}["s30"] == 4


def test_a_run_that_died_is_made_good(spark, frame, tmp_path, monkeypatch):
    path, data = str(tmp_path / "store"), make(2)
    names = sorted(data)
    S.run(frame(rows_of(data, names[:50])), path, LOW)
    for point in ("before the tables", "before the commit"):
        with monkeypatch.context() as m:
            m.setattr(*((S, "replace_days") if point == "before the tables" else (ledger, "commit")), lambda *a: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError):
                S.run(frame(rows_of(data, names[50:52])), path, LOW)
    assert ledger.committed(spark, path) == 1
    # Other sources come first: what the dead run had published must go.
    assert S.run(frame(rows_of(data, names[60:61])), path, LOW) == 2
    check(spark, path, frame(rows_of(data, [*names[:50], names[60]])))
    assert S.run(frame(rows_of(data, names[50:52])), path, LOW) == 3
    check(spark, path, frame(rows_of(data, [*names[:52], names[60]])))


def test_only_the_reach_is_read(spark, frame, tmp_path):
    path, data = str(tmp_path / "store"), make(3)
    names = sorted(data)
    S.run(frame(rows_of(data, names[:85])), path, LOW)
    rows = frame(rows_of(data, [names[85]]))
    store = S.Store(spark, path, rows.schema)
    touched = S.touched_by(rows, rows.limit(0), store.prices)
    begins = S.starts(touched, store.table("state", S.state_schema(store.prices)), store.prices)
    read = S.context(store.rows(1), begins)
    kept = {(r["_stock"], r["_from"], r["_day"]) for r in begins.collect()}
    assert {s for s, _, _ in kept} == {r[0] for r in data[names[85]]}
    for stock, begin, _ in kept:
        before = sorted((r[1] for n in names[:85] for r in data[n] if r[0] == stock), reverse=True)
        assert begin == (DAYS[85] if stock is None else before[min(len(before), 49) - 1])
        assert read.filter(F.col("stock_code").eqNullSafe(F.lit(stock))).count() == (0 if stock is None else sum(d >= begin for d in before))
    plan = S.context(store.rows(1), begins.filter("_stock = 'A'"))._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters")[1].split("]")[0]  # folders of earlier months are not read


def test_leaking_fill_is_made_anew_as_a_whole(spark, frame, tmp_path):
    path, data = str(tmp_path / "store"), make(4)
    names = sorted(data)
    for some in (names[:60], names[60:]):
        S.run(frame(rows_of(data, some)), path, LOW, "next_stock")
    table = D.publish(D.indicators(frame(rows_of(data, names)), LOW, "next_stock"))
    assert stored(spark, path, table.columns) == texts(table)


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "source_file string, x int")
    assert ledger.committed(spark, path) == 0 and ledger.entries(spark, path).count() == 0
    found = ledger.of_rows(rows, "source_file")
    ledger.write(found, path, 1)
    assert ledger.entries(spark, path).count() == 0  # not committed
    ledger.commit(spark, path, 1)
    with pytest.raises(FileExistsError):
        ledger.commit(spark, path, 1)
    known = ledger.entries(spark, path)
    assert ledger.unseen(ledger.of_rows(rows.repartition(3).orderBy(F.desc("x")), "source_file"), known).count() == 0
    other = spark.createDataFrame([("a", 1), ("a", 5), ("b", 3), ("c", 1)], "source_file string, x int")
    assert {(r["name"], r["before"]) for r in ledger.unseen(ledger.of_rows(other, "source_file"), known).collect()} == {("a", 1), ("c", None)}


def test_runs_leave_no_stages(spark, frame, tmp_path):
    """A run's stages go when it ends; runs of a store held all of theirs until the application ended."""
    from bourseline.sources.storage import shared_base

    path, data = str(tmp_path / "store"), make(3)
    names = sorted(data)
    folder = f"{shared_base(spark)}/bourseline/stages-{spark.sparkContext.applicationId}".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert S.run(frame(rows_of(data, names[:40])), path, LOW) == 1
    assert S.run(frame(rows_of(data, names)), path, LOW) == 2
    assert set(os.listdir(folder)) <= before
    check(spark, path, frame(rows_of(data, names)))


def test_rows_made_anew_are_stored_once_before_they_are_published(spark, frame, tmp_path, monkeypatch):
    """Each table's days made anew are staged once, and besides them only other stocks' rows of their months."""
    path, data = str(tmp_path / "store"), make(5)
    names = sorted(data)
    S.run(frame(rows_of(data, names[1::2])), path, LOW)
    staged = []

    def noted(df, label):
        out = real(df, label)
        staged.append((label, out.count()))
        return out

    real = S.stage
    monkeypatch.setattr(S, "stage", noted)
    rows = frame(rows_of(data, names))
    S.run(rows, path, LOW)
    check(spark, path, rows)
    after = staged[[label for label, _ in staged].index("published"):]
    columns = D.publish(D.indicators(rows, LOW)).columns
    tables = {"daily": S.stored_daily(spark, path, columns), "state": spark.read.parquet(f"{path}/state"), "horizon": spark.read.parquet(f"{path}/horizon")}
    assert sum(n for _, n in after) == sum(t.count() for t in tables.values())


def test_states_are_counted_without_lists(spark, frame, tmp_path):
    """The day on which a day's last 49 rows begin, and the prices before it, from running counts; no day gathers those before it."""
    path, data = str(tmp_path / "store"), make(6)
    rows = frame([r for r in rows_of(data, sorted(data)) if r[0] is not None])
    prices = S.Store(spark, path, rows.schema).prices
    begins = S.starts(S.touched_by(rows, rows.limit(0), prices), S.Store(spark, path, rows.schema).table("state", S.state_schema(prices)), prices)
    found = S.states(rows, begins, prices)
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["stock_code"], r["trading_date"]): r for r in found.collect()}
    at = {n: i for i, n in enumerate(rows.columns)}
    for stock in "ABCDE":
        own = sorted((r for n in data for r in data[n] if r[0] == stock), key=lambda r: (r[1], r[2]))
        for day in {r[1] for r in own}:
            upto = [r for r in own if r[1] <= day]
            reach = upto[-min(len(upto), 49)][1]
            r = got.pop((stock, day))
            assert (r["n"], r["reach"]) == (sum(x[1] == day for x in own), reach)
            for c in ("high", "low", "close"):
                known = [x[at[c]] for x in upto if x[at[c]] is not None]
                before = [x[at[c]] for x in upto if x[1] < reach and x[at[c]] is not None]
                assert (r[f"known_{c}"], r[f"base_{c}"]) == (known[-1] if known else None, before[-1] if before else None)
    assert not got


def test_columns_of_the_stored_table_cost_no_rows(spark, frame, tmp_path, monkeypatch):
    """The query over the store asks the plan for its columns only; no row is dealt for that."""
    from bourseline.workload import load

    load()
    from bourseline.workload import jobs

    path, data = str(tmp_path / "store"), make(7)
    rows = frame(rows_of(data, sorted(data)[:30]))
    S.run(rows, path, LOW)
    columns, want = plain(rows)
    seen, real = [], D.indicators
    monkeypatch.setattr(jobs, "trading", lambda spark, sf: path)
    monkeypatch.setattr(jobs.A, "trades", lambda spark, sf: rows)
    monkeypatch.setattr(D, "indicators", lambda df, *a: (seen.append(df.count()), real(df, *a))[1])
    found = jobs.stored(spark, "none")
    assert found.columns == columns and texts(found) == want
    assert seen == [0]
