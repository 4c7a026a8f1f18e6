"""Queries on 5 percent holder lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import rules
from bourseline.operators import frames, windows
from bourseline.plans import majors as M
from bourseline.workload import adapters as A
from bourseline.workload.holders import PLACED
from bourseline.workload.registry import add

HELD = PLACED + """,
counted AS (
  SELECT snap AS tanggal_data, 'N' || c_nationkey AS kode_efek, 'ACC ' || c_mktsegment AS nama_pemegang_rekening_efek,
    c_mktsegment || ' ' || o_orderpriority AS nama_pemegang_saham, 'REK ' || o_orderpriority AS nama_rekening_efek, o_orderstatus AS status,
    CAST(floor(o_totalprice) AS BIGINT) AS base, left(o_orderpriority, 1) AS prio, c_nationkey, o_orderkey AS load_seq FROM placed
),
held AS (
  SELECT *, CASE status WHEN 'F' THEN 0 WHEN 'P' THEN CASE WHEN prio IN ('1', '3') THEN 0 ELSE base END
      ELSE CASE prio WHEN '1' THEN base WHEN '2' THEN base - 500 ELSE base + 500 END END AS jumlah_saham_prev,
    CASE WHEN status = 'P' THEN 0 ELSE base END AS jumlah_saham_curr FROM counted
),
acted AS (
  SELECT *, CASE WHEN jumlah_saham_prev = 0 AND jumlah_saham_curr > 0 THEN 'Buying'
    WHEN jumlah_saham_curr > jumlah_saham_prev AND jumlah_saham_prev > 0 THEN 'Accumulation'
    WHEN jumlah_saham_curr < jumlah_saham_prev THEN 'Reduction'
    WHEN jumlah_saham_curr = jumlah_saham_prev AND jumlah_saham_curr > 0 THEN 'Holding' ELSE 'Skip' END AS aksi FROM held
)"""

# Pages of nation 24 are skipped by their short first row.
EXITS = HELD + """,
live AS (SELECT * FROM acted WHERE aksi <> 'Skip' {where}),
calendar AS (SELECT tanggal_data AS day, lead(tanggal_data) OVER (ORDER BY tanggal_data) AS next_day FROM (SELECT DISTINCT tanggal_data FROM live)),
gone AS (
  SELECT next_day AS tanggal_data, kode_efek, nama_pemegang_rekening_efek, nama_pemegang_saham, nama_rekening_efek, status,
    jumlah_saham_curr AS jumlah_saham_prev, CAST(0 AS BIGINT) AS jumlah_saham_curr, 'Reduction' AS aksi, load_seq
  FROM live JOIN calendar ON tanggal_data = day
  WHERE jumlah_saham_curr > 0 AND next_day IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM live t WHERE t.tanggal_data = next_day AND t.kode_efek = live.kode_efek AND t.nama_pemegang_saham = live.nama_pemegang_saham)
),
log AS (
  SELECT tanggal_data, kode_efek, nama_pemegang_rekening_efek, nama_pemegang_saham, nama_rekening_efek, status,
    jumlah_saham_prev, jumlah_saham_curr, jumlah_saham_curr - jumlah_saham_prev AS perubahan_saham, aksi
  FROM (SELECT * EXCLUDE (base, prio, c_nationkey) FROM live UNION ALL BY NAME SELECT * FROM gone)
)"""
ALL_EXITS = EXITS.format(where="")
LISTED_EXITS = EXITS.format(where="AND c_nationkey <> 24")


def acted(spark, sf):
    return M.with_actions(A.majors(spark, sf))


add(
    "fn_holder_action",
    lambda s, sf: A.majors(s, sf).select("load_seq", "jumlah_saham_prev", "jumlah_saham_curr",
                                         rules.holder_action(F.col("jumlah_saham_prev"), F.col("jumlah_saham_curr")).alias("aksi")),
    f"WITH {HELD} SELECT load_seq, jumlah_saham_prev, jumlah_saham_curr, aksi FROM acted",
)
add(
    "fn_share_change",
    lambda s, sf: A.majors(s, sf).select("load_seq", (F.col("jumlah_saham_curr") - F.col("jumlah_saham_prev")).alias("perubahan_saham")),
    f"WITH {HELD} SELECT load_seq, jumlah_saham_curr - jumlah_saham_prev AS perubahan_saham FROM held",
)
add(
    "filt_equals",
    lambda s, sf: acted(s, sf).select("load_seq", "kode_efek", "aksi"),
    f"WITH {HELD} SELECT load_seq, kode_efek, aksi FROM acted WHERE aksi <> 'Skip'",
)
add(
    "win_first_date",
    lambda s, sf: windows.first_date(A.majors(s, sf), M.KEYS, M.DATE, "first_date").select("load_seq", "tanggal_data", "first_date"),
    f"WITH {HELD} SELECT load_seq, tanggal_data, min(tanggal_data) OVER (PARTITION BY kode_efek, nama_pemegang_saham) AS first_date FROM held",
    ["tanggal_data", "first_date"],
)
add(
    "filt_holding_baseline",
    lambda s, sf: M.baseline_only(acted(s, sf)).select("load_seq", "tanggal_data", "aksi"),
    f"""WITH {HELD}, f AS (SELECT *, min(tanggal_data) OVER (PARTITION BY kode_efek, nama_pemegang_saham) AS first_date FROM acted WHERE aksi <> 'Skip')
SELECT load_seq, tanggal_data, aksi FROM f WHERE aksi <> 'Holding' OR tanggal_data = first_date""",
    ["tanggal_data"],
)
add(
    "join_anti_dropout",
    lambda s, sf: M.exits(acted(s, sf)).select("load_seq", "tanggal_data", "kode_efek", "nama_pemegang_saham", "jumlah_saham_prev", "jumlah_saham_curr", "aksi"),
    f"WITH {ALL_EXITS} SELECT load_seq, tanggal_data, kode_efek, nama_pemegang_saham, jumlah_saham_prev, jumlah_saham_curr, aksi FROM gone",
    ["tanggal_data"],
)
add(
    "filt_noise_rows",
    lambda s, sf: M.list_rows(A.major_documents(s, sf)).select("file_name", "page_idx", "row_idx", F.size("cells").alias("width")),
    f"""WITH {HELD} SELECT strftime(tanggal_data, '%Y%m%d') || '_list.pdf' AS file_name, CAST(c_nationkey + 1 AS INTEGER) AS page_idx,
  load_seq + 10 AS row_idx, 18 AS width FROM held WHERE c_nationkey <> 24""",
)
add(
    "proj_positional",
    lambda s, sf: M.list_rows(A.major_documents(s, sf)).select(*frames.positional(F.col("cells"), schemas.MAJOR_CELLS)),
    f"""WITH {HELD} SELECT CAST(load_seq AS VARCHAR) AS no, kode_efek, '' AS nama_emiten, nama_pemegang_rekening_efek, nama_pemegang_saham, nama_rekening_efek,
  '' AS alamat_1, '' AS alamat_2, '' AS kebangsaan, '' AS domisili, status,
  CASE WHEN jumlah_saham_prev = 0 THEN '-' ELSE format('{{:,}}', jumlah_saham_prev) END AS saham_prev, '' AS gabungan_prev, '' AS pct_prev,
  CASE WHEN jumlah_saham_curr = 0 THEN '-' ELSE format('{{:,}}', jumlah_saham_curr) END AS saham_curr, '' AS gabungan_curr, '' AS pct_curr, '' AS perubahan
FROM held WHERE c_nationkey <> 24""",
)
add(
    "pipe_ownership_5pct",
    lambda s, sf: M.change_log(A.major_documents(s, sf)),
    f"WITH {LISTED_EXITS} SELECT * FROM log",
    ["tanggal_data"],
)


def history_log(spark, sf):
    """Odd months first, the lists of 1996 only in part; then the even months, late, and 1996 again in full."""
    docs = A.major_documents(spark, sf)
    year, odd = F.left("file_name", F.lit(4)), F.substring("file_name", 5, 2).cast("int") % 2 == 1
    first = docs.filter(odd & ((year != "1996") | (F.col("page_idx") <= 10)))
    second = docs.filter(~odd | (year == "1996"))
    before, after = M.change_log(first), M.change_log(second, M.listing(first))
    return before.join(after.select(M.DATE).distinct(), M.DATE, "left_anti").unionByName(after)


add("pipe_ownership_5pct_history", history_log, f"WITH {LISTED_EXITS} SELECT * FROM log", ["tanggal_data"])
add(
    "sort_keys",
    lambda s, sf: acted(s, sf).select("tanggal_data", "kode_efek", "nama_pemegang_saham", "load_seq").orderBy(
        *[F.col(x).asc_nulls_last() for x in ("tanggal_data", "kode_efek", "nama_pemegang_saham", "load_seq")]),
    f"WITH {HELD} SELECT tanggal_data, kode_efek, nama_pemegang_saham, load_seq FROM acted WHERE aksi <> 'Skip' ORDER BY ALL NULLS LAST",
    ["tanggal_data"],
)
