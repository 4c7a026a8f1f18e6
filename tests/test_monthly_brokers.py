"""Monthly balances, broker and insider pages, files and tables."""

import io
import json
import os
import threading
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.operators import frames
from bourseline.operators.joins import unprocessed
from bourseline.plans import brokers as B
from bourseline.plans import monthly as M
from bourseline.sources import archives, footers, ledger, listing, readers, versions, writers
from bourseline.sources.storage import fresh_path, land
from bourseline.streaming import intake

COLUMNS = "Date date, Code string, Type string, Sec_Num bigint, Price double, " + ", ".join(
    f"{c} bigint" for c in [*schemas.LOCALS, "Total_Local", *schemas.FOREIGNS, "Total_Foreign"]) + ", load_seq bigint"


def balance(month, code, sec, seq, price=2.0, **positions):
    local = [positions.get(c, 0) for c in schemas.LOCALS]
    foreign = [positions.get(c, 0) for c in schemas.FOREIGNS]
    off = positions.get("off", 0)
    return (date(2024, month, 28), code, "EQUITY", sec, price, *local, sum(local) + off, *foreign, sum(foreign), seq)


def test_snapshot(spark):
    data = [
        balance(1, "A", 100, 1, Local_IS=10, Local_CP=10), balance(2, "A", 100, 2, Local_IS=15, Local_CP=15, Foreign_OT=1),
        balance(2, "A", 100, 3, Local_IS=12, Local_CP=12, Foreign_OT=1),  # a later copy wins
        balance(5, "A", 200, 4, Local_IS=90), balance(6, "A", 110, 5, Local_IS=1), balance(7, "A", 110, 6, Local_IS=1),
        balance(8, "A", 110, 7, Local_IS=0), balance(9, "A", 208, 8, Local_IS=3), balance(10, "A", 209, 9, Local_IS=3),
    ]
    df = M.snapshot(spark.createDataFrame(data, COLUMNS), ["load_seq"])
    assert len(df.columns) == 88
    r = {x["date"].month: x for x in df.collect()}
    assert (r[1]["local_is_chg_vol"], r[1]["top_buyer"], r[1]["is_split_suspect"]) == (0, None, False)
    assert (r[2]["top_buyer"], r[2]["top_buyer_vol"], r[2]["top_buyer_val"], r[2]["top_seller"]) == ("Local_IS", 2.0, 4.0, None)
    assert (r[5]["is_split_suspect"], r[5]["local_is_chg_vol"], r[5]["local_is_1"]) == (True, 0, 12)
    assert (r[6]["is_reverse_suspect"], r[6]["local_is_chg_vol"]) == (True, 0)
    assert (r[7]["top_buyer"], r[7]["top_seller"]) == (None, None)
    assert (r[8]["top_seller"], r[8]["top_seller_vol"], r[8]["top_buyer"]) == ("Local_IS", -1.0, None)
    assert (r[9]["is_split_suspect"], r[9]["total_shares"]) == (False, 3)
    report = M.change_report(df).first()
    assert (report["n"], report["rows_with_chg"], report["split_months"], report["reverse_months"]) == (8, 0, 1, 1)


def test_zero_changes_fail(spark):
    df = M.snapshot(spark.createDataFrame([balance(1, "A", 1, 1), balance(2, "A", 1, 2)], COLUMNS), ["load_seq"])
    with pytest.raises(Exception, match="no change"):
        M.require_changes(M.change_report(df)).collect()


def test_changes_pass(spark):
    df = M.snapshot(spark.createDataFrame([balance(1, "A", 1, 1), balance(2, "A", 1, 2, Local_ID=1)], COLUMNS), ["load_seq"])
    assert M.require_changes(M.change_report(df)).first()["rows_with_chg"] == 1


def test_reconcile(spark):
    data = [balance(1, "A", 1, 1, Local_IS=5, off=1), balance(2, "A", 1, 2, Local_IS=5, off=2), balance(3, "A", 1, 3, Local_IS=5, off=-2)]
    assert M.unreconciled(spark.createDataFrame(data, COLUMNS)).first()[0] == 2


HEADS = ["Date", "Code", "Type", "Sec. Num", "Price", *[f"Local {c}" for c in schemas.CATEGORIES], "Total", *[f"Foreign {c}" for c in schemas.CATEGORIES], "Total"]


def zipped(path, heads, *lines, member="b.TXT"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("notes.md", "x")
        z.writestr(member, "\n".join("|".join(x) for x in [heads, *lines]).encode("latin1"))


def test_zip_files(spark, tmp_path):
    line = ["31-MEI-2024", "AA", "EQUITY", "1,000", "12.5", *["1,234"] * 9, "11,106", *["0"] * 9, "0"]
    bond = ["31-Okt-2024", "BÉ", "CORPORATE BOND", *line[3:]]
    bad = ["someday", *line[1:]]
    zipped(tmp_path / "BalancePos1.zip", HEADS, line, bond, bad)
    zipped(tmp_path / "balancepos2.zip", HEADS, line, member="other.csv")
    (tmp_path / "balancepos3.zip").write_bytes(b"no zip at all")
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    read = archives.zip_pipe(spark, str(tmp_path))
    got = M.typed(archives.rows_of(read)).collect()
    assert [(r["Date"], r["Sec_Num"], r["Price"], r["Local_OT"], r["Total_Local"], r["file_name"]) for r in got] == [
        (date(2024, 5, 31), 1000, 12.5, 1234, 11106, "BalancePos1.zip")]
    assert {tuple(r) for r in archives.report_of(read).collect()} == {("BalancePos1.zip", "rows", 3), ("balancepos2.zip", "no member", 0), ("balancepos3.zip", "bad", 0)}
    zipped(tmp_path / "balancepos4.zip", HEADS[:-2] + ["Total"], line[:-1])
    with pytest.raises(Exception, match="missing required columns"):
        archives.zip_pipe(spark, str(tmp_path)).collect()


def test_archives_of_any_size(spark, tmp_path):
    """Three gigabytes of nothing before the archive (a sparse file), more rows than a batch, short and blank lines, a torn archive."""
    line = ["31-MEI-2024", "AA", "EQUITY", "1,000", "12.5", *["1,234"] * 9, "11,106", *["0"] * 9, "0"]
    zipped(tmp_path / "small.zip", HEADS, *[line] * 45_000, line[:5], [""])
    whole = (tmp_path / "small.zip").read_bytes()
    with open(tmp_path / "large.zip", "wb") as out:
        out.truncate(3 << 30)
        out.seek(0, 2)
        out.write(whole)
    stored = io.BytesIO()
    with zipfile.ZipFile(stored, "w", zipfile.ZIP_STORED) as z:
        z.writestr("b.txt", "\n".join("|".join(x) for x in [HEADS, *[line] * 30_000]))
    torn = bytearray(stored.getvalue())
    torn[len(torn) - 2_000] ^= 1  # the check sum is wrong, which shows at the end
    (tmp_path / "torn.zip").write_bytes(torn)
    read = archives.zip_pipe(spark, str(tmp_path))
    assert {tuple(r) for r in archives.report_of(read).collect()} == {("small.zip", "rows", 45_001), ("large.zip", "rows", 45_001), ("torn.zip", "bad", 20_000)}
    rows = archives.rows_of(read.filter("file_name = 'large.zip'"))
    assert rows.agg(F.count_distinct("row_idx"), F.max("row_idx"), F.count("Local_IS")).first()[:] == (45_001, 45_000, 45_000)
    assert archives.zip_pipe(spark, str(tmp_path), ".rar").count() == 0


def test_only_selected_files_are_opened(spark, tmp_path):
    rows = schemas.struct("a int")
    for name in ("20240101_list.json", "20240102_LIST.json"):
        (tmp_path / name).write_text('{"a": 1}\n{"a": 2}\n')
    os.mkfifo(tmp_path / "20240103_notes.json")  # whoever opens it waits for ever
    files = listing.select_files(listing.list_files(spark, str(tmp_path)), contains="list", extension=".json", dated=True)
    assert "binaryFile" in files._jdf.queryExecution().toString() and "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert {(r["file_name"], r["a"]) for r in listing.read_files(files, rows).collect()} == {(n, a) for n in ("20240101_list.json", "20240102_LIST.json") for a in (1, 2)}
    store = str(tmp_path / "store")
    assert listing.unprocessed_files(files, store).count() == 2
    ledger.write(ledger.of_files(files), store, 1)
    ledger.commit(spark, store, 1)
    assert listing.unprocessed_files(files, store).count() == 0
    (tmp_path / "20240102_LIST.json").write_text('{"a": 3}\n')
    again = listing.select_files(listing.list_files(spark, str(tmp_path)), contains="list", extension=".json", dated=True)
    assert [r["name"] for r in listing.unprocessed_files(again, store).collect()] == ["20240102_LIST.json"]
    assert listing.read_files(again.limit(0), rows).count() == 0


def test_footers_count_without_reading(spark, tmp_path):
    folders = {d: f"/root/testdata/sf0.001/{d}.parquet" for d in ("orders", "documents", "embeddings")}
    spark.range(100).selectExpr("id", "CASE WHEN id > 10 THEN id END AS some").repartition(3).write.parquet(str(tmp_path / "own"))
    spark.range(0).write.parquet(str(tmp_path / "none"))
    folders |= {"own": str(tmp_path / "own"), "none": str(tmp_path / "none")}
    assert dict(footers.row_counts(spark, folders).collect()) == {d: spark.read.parquet(p).count() for d, p in folders.items()}
    bounds = {(r["dataset"], r["column"]): (r["n_values"], r["bounded"]) for r in footers.column_bounds(spark, folders).collect()}
    assert bounds["own", "some"] == (89, True) and bounds["own", "id"] == (100, True) and ("embeddings", "embedding") not in bounds
    # A file whose data pages are gone still tells its rows.
    whole = open(folders["orders"], "rb").read()
    size = int.from_bytes(whole[-8:-4], "little") + 8
    (tmp_path / "gone").mkdir()
    (tmp_path / "gone" / "x.parquet").write_bytes(b"PAR1" + b"\0" * (len(whole) - size - 4) + whole[-size:])
    assert footers.row_counts(spark, {"gone": str(tmp_path / "gone")}).first()["n"] == spark.read.parquet(folders["orders"]).count()


def test_pipe_text(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes("Date|Code\n31-MEI-2024|BÉ\n".encode("latin1"))
    assert readers.pipe_text(spark, str(tmp_path)).first()["Code"] == "BÉ"


def test_required_columns(spark):
    with pytest.raises(frames.MissingColumns, match="Foreign_OT"):
        M.typed(spark.createDataFrame([("x",)], "Date string"))


def broker_page(spark, buys, sells, seq=1):
    schema = schemas.BROKER_PAGE
    return spark.createDataFrame([("B1", "Broker", date(2024, 5, 6), seq, ((buys, sells),))], schema)


def test_broker_activity(spark):
    item = ("2024-05-07T00:00:00Z", "AA", "10", "2", "2.675", "1")
    pages = broker_page(spark, [item, ("2024-05-07", "AA", "99", "9", "1", "1"), ("", "BB", None, "x", "1", "1"), ("", None, "1", "1", "1", "1")], [item])
    got = {(r["date"], r["side"], r["stock_code"]): r for r in B.broker_activity(pages).collect()}
    assert set(got) == {(date(2024, 5, 7), "BUY", "AA"), (date(2024, 5, 6), "BUY", "BB"), (date(2024, 5, 7), "SELL", "AA")}
    first = got[(date(2024, 5, 7), "BUY", "AA")]
    assert (first["value"], first["avg_price"]) == (10, 2.67)
    assert (got[(date(2024, 5, 6), "BUY", "BB")]["value"], got[(date(2024, 5, 6), "BUY", "BB")]["lot"]) == (0, None)


def test_top_brokers(spark):
    rows = spark.createDataFrame([(date(2024, 5, 6), f"B{i % 5}", i) for i in range(20)], "date date, broker_code string, value bigint")
    assert [r["broker_code"] for r in B.top_brokers(rows, 2).orderBy(F.desc("total_value")).collect()] == ["B4", "B3"]


def test_insiders(spark, tmp_path):
    page = (
        '{"target_date":"2024-05-06","load_seq":1,"data":{"is_more":false,"movement":['
        '{"id":"1","name":"N","symbol":"AA","date":"05 May 24","action_type":"ACTION_TYPE_BUY","nationality":"NATIONALITY_TYPE_LOCAL",'
        '"previous":{"value":"1,000","percentage":"1.5"},"current":{"value":"2,234","percentage":"2"},"changes":{"value":"+1,234","percentage":"+0.5"},'
        '"price_formatted":"","data_source":{"label":"L","type":"SOURCE_TYPE_X"},"badges":["SHAREHOLDER_BADGE_KOMISARIS","SHAREHOLDER_BADGE_DIREKSI"]},'
        '{"id":"2","symbol":"AA","date":"bad"},{"id":"2","symbol":"AA","name":"copy"},{"id":"3","symbol":"AA","changes":{"value":"?"}}]}}'
    )
    (tmp_path / "p.json").write_text(page)
    pages = readers.json_pages(spark, str(tmp_path), schemas.INSIDER_PAGE)
    got = {r["insider_id"]: r for r in B.insider_movements(pages).collect()}
    one = got["1"]
    assert (one["transaction_date"], one["action_type"], one["nationality"], one["shares_change"], one["pct_change"]) == (date(2024, 5, 5), "BUY", "LOCAL", 1234, 0.5)
    assert (one["price_formatted"], one["source_type"], one["badges"], one["is_komisaris"], one["is_pengendali"]) == (0.0, "X", "KOMISARIS,DIREKSI", True, False)
    assert (got["2"]["insider_name"], got["2"]["transaction_date"], got["2"]["badges"], got["2"]["shares_previous"]) == ("", None, "", 0)
    rejected = B.rejects(B.normalize_insider(B.insider_items(pages)), ["shares_change"]).first()
    assert (rejected["n"], rejected["rejected"]) == (4, 1)


def test_history_and_processed(spark):
    schema = schemas.struct("a bigint, source_file string")
    path = fresh_path(spark, "history")
    assert readers.history_csv(spark, path, schema).count() == 0
    writers.write_csv(spark.createDataFrame([(1, "f1"), (2, "f1"), (3, None)], schema), path)
    rows = readers.history_csv(spark, path, schema)
    assert rows.count() == 3
    assert [r[0] for r in readers.processed_sources(rows, "source_file").collect()] == ["f1"]


def test_history_is_read_by_name(spark):
    path = fresh_path(spark, "history")
    schema = schemas.struct("code string, close double, volume bigint")
    spark.createDataFrame([("AA", "7", "1.5"), ("BB", "x", "2")], "code string, volume string, close string").coalesce(1).write.option("header", True).csv(path)
    assert [tuple(r) for r in readers.history_csv(spark, path, schema).orderBy("code").collect()] == [("AA", 1.5, 7), ("BB", 2.0, None)]
    with pytest.raises(frames.MissingColumns, match="gone"):
        readers.history_csv(spark, path, schemas.struct("code string, gone int"))


def test_unprocessed(spark):
    files = spark.createDataFrame([("20240101_a.xlsx",), ("b.c.xlsx",), ("d.xlsx",), ("e.xlsx",)], "file_name string")
    done = spark.createDataFrame([("20240101",), ("b.c",), ("d.xlsx",)], "s string")
    assert [r[0] for r in unprocessed(files, done, "file_name", "s", loose=True).collect()] == ["e.xlsx"]
    assert unprocessed(files, done, "file_name", "s").count() == 3


def test_upsert_replaces_only_given_dates(spark):
    schema = schemas.struct("v bigint, date date")
    path = fresh_path(spark, "t")
    writers.declare_table(spark, path, schema, "date")
    assert writers.read_table(spark, path, schema).count() == 0
    d = [date(2024, 1, i) for i in (1, 2, 3)]
    writers.upsert_by_date(spark.createDataFrame([(1, d[0]), (2, d[1]), (3, d[1])], schema), path, "date")
    writers.upsert_by_date(spark.createDataFrame([(9, d[1]), (8, d[2])], schema), path, "date")
    writers.upsert_by_date(spark.createDataFrame([], schema), path, "date")
    assert sorted(r["v"] for r in writers.read_table(spark, path, schema).collect()) == [1, 8, 9]


def test_declared_schema_is_enforced(spark, tmp_path):
    path = str(tmp_path / "declared")
    schema = schemas.struct("a bigint, b double, c string, date date")
    writers.declare_table(spark, path, schema, "date")
    writers.declare_table(spark, path, schema, "date")
    assert writers.read_table(spark, path, schema).count() == 0 and writers.declared(spark, path) == schema
    day = date(2024, 1, 1)
    writers.upsert_by_date(spark.createDataFrame([(1, 2, "x", day)], "a int, b int, c string, date date"), path, "date")  # widened
    before = sorted(os.listdir(path))
    for wrong in ("a bigint, b double, date date", "a string, b double, c string, date date", "a double, b double, c string, date date", "a bigint, b double, c string, d int, date date", "a bigint, b double, c int, date date"):
        rows = spark.createDataFrame([], wrong)
        with pytest.raises(writers.SchemaMismatch):
            writers.upsert_by_date(rows, path, "date")
    with pytest.raises(writers.SchemaMismatch):
        writers.declare_table(spark, path, schemas.struct("a bigint, date date"), "date")
    with pytest.raises(writers.SchemaMismatch):
        writers.declare_table(spark, str(tmp_path / "other"), schemas.struct("a bigint"), "date")
    assert sorted(os.listdir(path)) == before
    swapped = spark.createDataFrame([("y", date(2024, 1, 2), 2.5, 7)], "c string, date date, b double, a bigint")
    writers.upsert_by_date(swapped, path, "date")
    assert sorted(map(tuple, writers.read_table(spark, path, schema).collect())) == [(1, 2.0, "x", day), (7, 2.5, "y", date(2024, 1, 2))]


def test_versions(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "table")
    rows = lambda n: spark.range(n).toDF("x")
    assert versions.version(spark, folder) is None
    with pytest.raises(LookupError):
        versions.read(spark, folder)
    assert versions.replace(rows(1), folder).number == 1
    pinned = versions.read(spark, folder)
    # A writer that dies before the commit leaves the table as it is.
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            versions.replace(rows(5), folder)
    assert versions.read(spark, folder).count() == 1 and versions.numbers(spark, folder) == [1]
    # Of two writers from one version the second fails.
    data = versions.write(rows(7), folder)
    versions.replace(rows(2), folder)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, folder, data, rows(7).schema, 1)
    assert versions.read(spark, folder).count() == 2 and pinned.count() == 1 and versions.read(spark, folder, 1).count() == 1
    versions.replace(rows(3).withColumn("y", F.lit("z")), folder)
    assert versions.read(spark, folder).columns == ["x", "y"]
    versions.replace(rows(4), folder)
    assert versions.numbers(spark, folder) == [2, 3, 4] and versions.version(spark, folder, 1) is None


def test_a_reader_always_finds_the_table(spark, monkeypatch):
    writers.replace_table(spark.range(1).toDF("x"), "always_there")
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.sql("SELECT count(*) AS n FROM always_there").first()["n"])
            except Exception as e:  # noqa: BLE001
                failed.append(str(e)[:200])

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 5):
        writers.replace_table(spark.range(n).withColumn(f"c{n}", F.lit(n)), "always_there")
    stop.set()
    reader.join()
    assert not failed and seen <= {1, 2, 3, 4} and spark.table("always_there").columns == ["id", "c4"]
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            writers.replace_table(spark.range(9), "always_there")
    assert spark.table("always_there").count() == 4


def test_replace_while_reading(spark):
    first = writers.replace_table(spark.range(5).toDF("x"), "replaced_table")
    again = writers.replace_table(first.filter("x > 2"), "replaced_table")
    assert again.count() == 2 and spark.table("replaced_table").count() == 2


def test_stream_takes_only_new_files(spark):
    schema = schemas.struct("v bigint, date date")
    source, kept, target, progress = (fresh_path(spark, x) for x in ("in", "kept", "out", "progress"))
    day = date(2024, 1, 1)
    seen = []

    def run():
        stream = intake.landed(spark, source, schema, "parquet")
        intake.upsert_new_files(stream, lambda b: (seen.append(b.count()), b)[1], lambda b: b, kept, target, "date", progress)

    spark.createDataFrame([(1, day), (2, date(2024, 1, 2))], schema).coalesce(1).write.parquet(source)
    run()
    spark.createDataFrame([(5, day)], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    assert seen == [2, 1]
    assert sorted(r["v"] for r in writers.read_table(spark, target, schema).collect()) == [1, 2, 5]  # both files of the day


def test_frames(spark):
    old = spark.createDataFrame([(1, 2)], "a int, gone int")
    new = spark.createDataFrame([(3, 4)], "a int, b int")
    assert sorted((tuple(r) for r in frames.append_to_history(old, new).collect()), key=str) == [(1, None), (3, 4)]
    assert frames.normalize_headers([" Share Code ", "x"]) == ["SHARE_CODE", "X"]
    assert frames.align_defaults(new, {"b": F.lit(0), "c": F.lit("")}).columns == ["b", "c"]
    week = spark.range(1).select(frames.weekdays(F.lit("2024-05-06").cast("date"), 4).alias("d")).first()["d"]
    assert [x.isoformat() for x in week] == ["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-06"]
    for end in ("2024-05-04", "2024-05-05"):
        week = spark.range(1).select(frames.weekdays(F.lit(end).cast("date"), 30).alias("d")).first()["d"]
        assert len(week) == 30 and week[-1].isoformat() == "2024-05-03"


def test_land_uses_the_shared_folder(spark):
    assert land(spark.range(1), "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_json_pages_lie_packed(spark, tmp_path, monkeypatch):
    """The query's pages lie on the disk once, packed, in files of a bounded number of rows; none is landed in another form besides."""
    from bourseline.sources.storage import shared_base
    from bourseline.workload import load

    load()
    from bourseline.workload import adapters, files

    columns = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp"
    items = spark.range(3000).selectExpr(
        "id DIV 7", "id % 50", "id % 11", "int(id % 7 + 1)", "double(id % 40 + 1)", "id * 7.25D", "element_at(array('R', 'A', 'N'), int(id % 3 + 1))",
        "timestamp'1997-03-01' + make_interval(0, 0, 0, int(id % 300))").toDF(*[x.split()[0] for x in columns.split(", ")])
    items.repartition(2).write.parquet(str(tmp_path / "lineitem.parquet"))
    read, real = [], readers.json_pages
    monkeypatch.setattr(readers, "json_pages", lambda s, path, schema: (read.append(path), real(s, path, schema))[1])
    monkeypatch.setattr(writers, "JSON_ROWS", 1000, raising=False)
    stages = f"{shared_base(spark)}/bourseline/stages-{spark.sparkContext.applicationId}".removeprefix("file:")
    before = set(os.listdir(stages)) if os.path.isdir(stages) else set()
    got = files.src_json_pages(spark, str(tmp_path)).collect()
    want = items.selectExpr(
        "concat('B', l_suppkey)", "date(l_shipdate)", "l_orderkey * 256 + l_linenumber * 32 + l_partkey % 32", "if(l_returnflag = 'R', 0, 2)", "if(l_returnflag = 'R', 2, 0)")
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))
    folder = read[0].removeprefix("file:")
    parts = [x for x in os.listdir(folder) if x.startswith("part-")]
    assert not {x.rsplit("-", 1)[0] for x in set(os.listdir(stages)) - before} - {"pages"}
    text = adapters.broker_pages(spark, str(tmp_path)).agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert sum(os.path.getsize(f"{folder}/{x}") for x in parts) < text / 4
    assert max(spark.read.text(f"{folder}/{x}").count() for x in parts) <= 1000


def test_documents_are_written_as_they_come(spark, tmp_path, monkeypatch):
    """No value holds a document: its lines go to its file some at a time, in their order, whatever lies between them in the rows."""
    from bourseline.workload import load

    load()
    from bourseline.workload import files

    names = ["20240101_list.pdf", "20240102_LIST.pdf", None]
    docs = spark.createDataFrame([(n, p, r, p * 1000 + r, [f"c{r}", None]) for n in names for r in range(700, 0, -1) for p in (2, 1)], schemas.struct("file_name string, page_idx int, row_idx bigint, load_seq bigint, cells array<string>"))
    longest, real = [], archives.write_files
    monkeypatch.setattr(archives, "write_files", lambda some, folder: (longest.append(some.agg(F.max(F.length("content"))).first()[0]), real(some, folder))[1])
    monkeypatch.setattr(files.A, "major_documents", lambda spark, sf: docs)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        folder = files.major_files(spark, "none").removeprefix("file:")
        assert max(longest) < 100
        for name in ("20240101_list.pdf", "20240102_LIST.pdf", "None"):
            lines = [json.loads(x) for x in open(f"{folder}/{name}").read().split("\n")]
            assert [(x["page_idx"], x["row_idx"], x["load_seq"], x["cells"]) for x in lines] == [(p, r, p * 1000 + r, [f"c{r}", None]) for p in (1, 2) for r in range(1, 701)]
        assert {tuple(r) for r in files.src_file_select(spark, "none").collect()} == {(n, 1400, sum(p * 1000 + r for p in (1, 2) for r in range(1, 701))) for n in names[:2]}
        assert archives.write_lines(docs.limit(0).selectExpr("file_name AS name", "'' AS line"), folder) == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
