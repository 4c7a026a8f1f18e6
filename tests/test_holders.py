"""Holder lists of 1 and 5 percent."""

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.operators import ranges
from bourseline.plans import holders as H
from bourseline.plans import majors as M

OWN = "date date, share_code string, investor_name string, investor_type string, local_foreign string, nationality string, percentage double, total_holding_shares bigint, load_seq bigint"


def own(*data):
    return [(date.fromisoformat(d), s, i, t, lf, "ID", p, n, k) for k, (d, s, i, t, lf, p, n) in enumerate(data)]


def test_heading_detection_and_cleaning(spark):
    canon = list(schemas.HOLDER_COLUMNS)
    data = [
        ("a.xlsx", 0, 0, 0, ["Title"] + [None] * 11), ("a.xlsx", 0, 1, 1, [None] * 12), ("a.xlsx", 0, 4, 4, ["share code", "Date", "InvestorName", "TOTAL_SHARES"] + [None] * 8),
        ("a.xlsx", 0, 5, 5, ["abcd", "2024-05-31", "X\nY", "1.234"] + [None] * 8), ("a.xlsx", 0, 6, 6, ["TOOLONG", "2024-05-31", "Z", "1"] + [None] * 8),
        ("a.xlsx", 0, 7, 7, ["ABCD-W", "31/05/2024", "Z", "1234.0"] + [None] * 8), ("a.xlsx", 0, 8, 8, ["ABCD", "not a date", "Z", "5"] + [None] * 8),
        ("b.xlsx", 0, 0, 0, canon), ("b.xlsx", 0, 1, 1, ["2024-05-31", "WXYZ", "i", "n", "nan", "", None, "d", "1,5", "x", "7", "1.234,56"]),
    ]
    # A heading below the first 15 filled data rows is not looked for.
    data += [("c.xlsx", 0, i, i, [f"v{i}", "2024-05-31"]) for i in range(1, 17)] + [("c.xlsx", 0, 0, 0, ["first", "DATE"]), ("c.xlsx", 0, 20, 20, ["SHARE_CODE", "DATE"])]
    table = H.ownership(spark.createDataFrame(data, schemas.SHEET_ROWS))
    a = table.filter("data_source = 'a'").orderBy("load_seq").collect()
    assert [(r["share_code"], r["date"], r["investor_name"], r["total_holding_shares"]) for r in a] == [
        ("ABCD", date(2024, 5, 31), "X Y", 1234), ("ABCD-W", date(2024, 5, 31), "Z", 12340)]
    assert (a[0]["investor_type"], a[0]["local_foreign"], a[0]["percentage"], a[0]["issuer_name"]) == ("Others", "L", 0.0, "")
    b = table.filter("data_source = 'b'").first()
    assert (b["investor_type"], b["local_foreign"], b["nationality"], b["percentage"], b["holdings_scripless"], b["holdings_scrip"]) == ("Others", "L", "nan", 1234.56, 15, 0)
    # No code column: no code filter. Row 20 has no date and goes.
    assert table.filter("data_source = 'c'").count() == 16


def test_individual_changes(spark):
    data = own(
        ("2024-02-29", "AA", "out of span", "Individual", "L", 1.0, 10), ("2024-05-31", "AA", "out of span", "Individual", "L", 9.0, 20),
        ("2024-04-30", "AA", "up", "ID", "L", 1.0, 10), ("2024-05-31", "AA", "up", "ID", "L", 3.0, 30),
        ("2024-04-30", "AA", "small", "ID", "L", 1.0, 10), ("2024-05-31", "AA", "small", "ID", "L", 1.29, 11),
        ("2024-04-30", "AA", "down", "ID", "L", 2.5, 10), ("2024-05-31", "AA", "down", "ID", "L", 1.5, 5),
        ("2024-04-30", "AA", "corp", "Corporate", "L", 1.0, 10), ("2024-05-31", "AA", "corp", "Corporate", "L", 9.0, 30),
        ("2024-05-31", "AA", "new", "ID", "L", 9.0, 30),
    )
    got = {r["investor_name"]: r for r in H.individual_changes(spark.createDataFrame(data, OWN)).collect()}
    # 2024-02-29 is three months before 2024-05-31 (clamped), so it is inside.
    assert set(got) == {"out of span", "up", "down"}
    assert (got["up"]["action"], got["up"]["alert_level"], got["up"]["share_change"]) == ("BUYING", "HIGH", 20)
    assert (got["down"]["action"], got["down"]["alert_level"], got["down"]["pct_point_change"]) == ("SELLING", "MEDIUM", -1.0)


def test_previous_row_over_ranges(spark):
    data = [(k % 3 if k % 7 else None, date(2024, 1, 1 + (k * 5) % 4), k, float(k)) for k in range(300)]
    df = spark.createDataFrame(data, "k int, d date, seq bigint, v double")
    got = {r["seq"]: r["p"] for r in ranges.previous_row(df, ["k"], "d", "seq", {"v": "p"}).collect()}
    pdf = pd.DataFrame(data, columns=["k", "d", "seq", "v"]).sort_values(["d", "seq"])
    want = pdf.assign(p=pdf.groupby("k", dropna=False)["v"].shift(1)).set_index("seq")["p"]
    assert got == {s: (None if pd.isna(p) else p) for s, p in want.items()} and len(got) == 300


def test_screener_counts_copies_like_a_join(spark):
    data = own(
        ("2024-04-30", "AA", "h", "Corporate", "F", 1.0, 1), ("2024-04-30", "AA", "h", "Corporate", "F", 2.0, 1),
        ("2024-05-31", "AA", "h", "Corporate", "F", 4.0, 1), ("2024-05-31", "AA", "h", "Individual", "L", 8.0, 1),
        ("2024-05-31", "AA", "solo", "Corporate", "L", 16.0, 1), ("2024-04-30", "AA", "left", "Corporate", "F", 32.0, 1),
        ("2024-03-31", "AA", "h", "Corporate", "F", 64.0, 1),
    )
    r = H.group_totals(spark.createDataFrame(data, OWN)).first()
    # Two current copies of h times two previous ones: 4 pairs.
    assert (r["corp_curr"], r["foreign_curr"], r["ind_curr"]) == (24.0, 8.0, 16.0)
    assert (r["corp_prev"], r["foreign_prev"], r["ind_prev"]) == (3.0, 3.0, 3.0)


def test_screener_on_a_single_date(spark):
    r = H.insider_screener(spark.createDataFrame(own(("2024-05-31", "AA", "h", "Corporate", "F", 60.0, 1)), OWN)).first()
    assert (r["score"], r["signals"], r["corp_change"]) == (3, "🟢 Foreign In, 💎 Inst Dom", 60.0)


def doc(day, page, row, seq, code, holder, prev, curr):
    cells = ["1", code, "", "acc", holder, "rek", "", "", "", "", "L", prev, "", "", curr, "", "", ""]
    return (f"{day}.pdf", page, row, seq, cells)


def test_change_log(spark):
    rows = [
        doc("20240501", 1, 1, 1, "AA", "stays", "0", "5"), doc("20240501", 1, 2, 2, "AA", "leaves", "5", "9"), doc("20240501", 1, 3, 3, "AA", "skip", "-", "-"),
        doc("20240503", 1, 1, 4, "AA", "stays", "5", "5"), doc("20240510", 1, 1, 5, "AA", "stays", "5", "1,000"),
        ("20240510.pdf", 1, 0, 6, ["x"] * 5 + ["Kode Efek"]), ("20240510.pdf", 1, 9, 7, ["Halaman 2"] + [None] * 17),
        ("20240510.pdf", 1, 10, 8, ["—", "", None, " "] + ["x"] * 14), ("20240510.pdf", 1, 11, 9, ["x"] * 5),
        doc("20240510", 0, 1, 10, "AA", "cover", "0", "5"), doc("nodate", 1, 1, 11, "AA", "z", "0", "5"),
        ("20240510.pdf", 2, 0, 12, ["short"]), doc("20240510", 2, 1, 13, "AA", "skipped page", "0", "5"),
        ("20240510.pdf", 1, 12, 14, ["1", None, "", "acc", "h"] + [""] * 13),
    ]
    log = M.change_log(spark.createDataFrame(rows, schemas.SHEET_ROWS))
    got = {(str(r["tanggal_data"]), r["nama_pemegang_saham"], r["aksi"], r["jumlah_saham_prev"], r["jumlah_saham_curr"], r["perubahan_saham"]) for r in log.collect()}
    assert got == {
        ("2024-05-01", "stays", "Buying", 0, 5, 5), ("2024-05-01", "leaves", "Accumulation", 5, 9, 4),
        ("2024-05-03", "stays", "Holding", 5, 5, 0), ("2024-05-03", "leaves", "Reduction", 9, 0, -9),
        ("2024-05-10", "stays", "Accumulation", 5, 1000, 995)}


def test_change_log_continues_history(spark):
    first = spark.createDataFrame([doc("20240501", 1, 1, 1, "AA", "leaves", "5", "9"), doc("20240501", 1, 2, 2, "AA", "stays", "1", "2")], schemas.SHEET_ROWS)
    history = M.listing(first)
    second = spark.createDataFrame([doc("20240502", 1, 1, 3, "AA", "stays", "2", "2")], schemas.SHEET_ROWS)
    got = {(str(r["tanggal_data"]), r["nama_pemegang_saham"], r["aksi"]) for r in M.change_log(second, history).collect()}
    assert got == {("2024-05-02", "stays", "Holding"), ("2024-05-02", "leaves", "Reduction")}
    # The holder's first date is in the history.
    assert M.change_log(second, history, baseline=True).filter(F.col("aksi") == "Holding").count() == 0


def log_rows(log):
    return sorted((str(r["tanggal_data"]), r["nama_pemegang_saham"], r["aksi"], r["jumlah_saham_prev"], r["jumlah_saham_curr"]) for r in log.collect())


@pytest.mark.parametrize("late", [False, True])
def test_late_and_resent_lists(spark, late):
    """Whatever the order of arrival, the log is that of all lists in one go."""
    lists = {
        "20240430": [("x", "0", "4"), ("y", "0", "7")], "20240502": [("x", "4", "4")], "20240503": [("z", "0", "1")], "20240601": [("x", "0", "2")],
    }
    stale = {"20240502": [("x", "4", "4"), ("y", "7", "9")]}

    def frame(some):
        return spark.createDataFrame([doc(d, 1, i, int(d) * 10 + i, "AA", *h) for d, rows in some.items() for i, h in enumerate(rows)], schemas.SHEET_ROWS)

    first = {d: rows for d, rows in lists.items() if d != "20240430"} if late else {**{"20240430": lists["20240430"]}, **stale}
    second = {"20240430": lists["20240430"]} if late else {d: rows for d, rows in lists.items() if d != "20240430"}
    before, after = M.change_log(frame(first)), M.change_log(frame(second), M.listing(frame(first)))
    assert ("2024-05-03" in {r[0] for r in log_rows(after)}) == (not late)
    merged = before.join(after.select("tanggal_data").distinct(), "tanggal_data", "left_anti").unionByName(after)
    assert log_rows(merged) == log_rows(M.change_log(frame(lists)))


def test_numeric_cells_blanks_and_several_spellings(spark):
    data = [
        ("a.xlsx", 0, 0, 0, ["DATE", "SHARE_CODE", "INVESTOR_NAME", "InvestorName", "TOTAL_HOLDING_SHARES"]),
        ("a.xlsx", 0, 1, 1, ["2024-05-31", "ABCD\u00a0", "", "second", "1234.0"]), ("a.xlsx", 0, 2, 2, ["2024-05-31", "EFGH", "first", "second", "1.000"]),
    ]
    got = H.ownership(spark.createDataFrame(data, schemas.SHEET_ROWS)).orderBy("share_code").collect()
    assert [(r["share_code"], r["investor_name"], r["total_holding_shares"]) for r in got] == [("ABCD", "second", 1234), ("EFGH", "first", 1000)]
