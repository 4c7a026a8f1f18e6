"""Queries on 1 percent holder lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import rules, text
from bourseline.functions.rules import INDIVIDUAL, ScreenerFlags
from bourseline.operators import frames
from bourseline.operators.joins import latest, previous_date
from bourseline.plans import holders as H
from bourseline.workload import adapters as A
from bourseline.workload.registry import add

PLACED = """
placed AS (
  SELECT o.*, c.*, last_day(CAST(o_orderdate AS DATE) - 2) AS snap
  FROM orders o JOIN customer c ON o_custkey = c_custkey
)"""

OWN = PLACED + """,
own AS (
  SELECT 'holders_' || strftime(snap, '%Y%m%d') AS data_source, snap AS date,
         'N' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS share_code,
         'ISSUER' || chr(10) || 'NO ' || c_nationkey AS issuer_name,
         c_mktsegment || ' ' || o_orderpriority AS investor_name,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'Corporate' WHEN 'AUTOMOBILE' THEN 'Fund Manager'
                           WHEN 'FURNITURE' THEN 'Financial Institutional' ELSE 'Individual' END AS investor_type,
         CASE WHEN c_nationkey % 5 < 2 THEN 'F' ELSE 'L' END AS local_foreign,
         'NATION_' || c_nationkey AS nationality, c_mktsegment AS domicile,
         CAST(round(o_totalprice * 100) AS BIGINT) - CAST(floor(o_totalprice) AS BIGINT) AS holdings_scripless,
         CAST(floor(o_totalprice) AS BIGINT) AS holdings_scrip,
         CAST(round(o_totalprice * 100) AS BIGINT) AS total_holding_shares,
         floor(o_totalprice / 20) / 1024 AS percentage, o_orderkey AS load_seq
  FROM placed
)"""

LAGS = """
recent AS (SELECT * FROM own WHERE investor_type IN ('ID', 'Individual')
           AND date >= CAST((SELECT max(date) FROM own) - INTERVAL '3 months' AS DATE)),
lagged AS (SELECT *, lag(percentage) OVER w AS prev_percentage, lag(total_holding_shares) OVER w AS prev_shares
           FROM recent WINDOW w AS (PARTITION BY share_code, investor_name ORDER BY date, load_seq))"""

CHANGES = """
changes AS (
  SELECT date AS report_date, share_code, investor_name, investor_type, nationality, prev_percentage,
         percentage AS curr_percentage, round(percentage - prev_percentage, 4) AS pct_point_change,
         total_holding_shares - COALESCE(prev_shares, total_holding_shares) AS share_change,
         CASE WHEN total_holding_shares > prev_shares THEN 'BUYING' WHEN total_holding_shares < prev_shares THEN 'SELLING'
              ELSE 'HOLDING' END AS action,
         CASE WHEN abs(percentage - prev_percentage) >= 2.0 THEN 'HIGH' WHEN abs(percentage - prev_percentage) >= 1.0 THEN 'MEDIUM'
              ELSE 'LOW' END AS alert_level
  FROM lagged WHERE prev_percentage IS NOT NULL AND abs(percentage - prev_percentage) >= 0.3
)"""

TOTALS = """
d1 AS (SELECT max(date) AS curr_date FROM own),
d0 AS (SELECT max(date) AS prev_date FROM own WHERE date < (SELECT curr_date FROM d1)),
pairs AS (
  SELECT n.share_code, n.investor_name, n.investor_type, n.local_foreign, n.percentage AS curr_pct,
         CASE WHEN p.investor_name IS NOT NULL THEN p.percentage ELSE 0 END AS prev_pct, p.load_seq AS prev_row, n.load_seq AS curr_row
  FROM (SELECT * FROM own WHERE date = (SELECT curr_date FROM d1)) n
  LEFT JOIN (SELECT * FROM own WHERE date = (SELECT prev_date FROM d0)) p
    ON n.share_code = p.share_code AND n.investor_name = p.investor_name
)"""


def _sums(prefix: str = "") -> str:
    groups = {
        "corp": "investor_type IN ('CP', 'Corporate')",
        "foreign": "local_foreign IN ('F', 'A')",
        "ind": "investor_type IN ('ID', 'Individual')",
        "fund": "investor_type IN ('MF', 'Mutual Funds', 'Fund Manager')",
        "fin": "investor_type IN ('IB', 'Bank', 'Financial Institutional')",
    }
    cols = [f"sum(CASE WHEN {cond} THEN curr_pct ELSE 0 END) AS {g}_curr" for g, cond in groups.items()]
    cols += [f"sum(CASE WHEN {groups[g]} THEN prev_pct ELSE 0 END) AS {g}_prev" for g in ("corp", "foreign", "ind")]
    return ", ".join(cols)


AGG = f"{TOTALS},\nagg AS (SELECT share_code, {_sums()} FROM pairs GROUP BY share_code)"
SCREEN = f"""{AGG},
diff AS (SELECT *, corp_curr - corp_prev AS cc, foreign_curr - foreign_prev AS fc, ind_curr - ind_prev AS ic FROM agg),
scored AS (
  SELECT share_code AS code, cc AS corp_change, fc AS foreign_change, ic AS ind_change,
    CASE WHEN cc > 1 AND ic < -0.5 THEN 3 ELSE 0 END + CASE WHEN fc > 1 THEN 2 ELSE 0 END
    + CASE WHEN corp_curr + fund_curr + fin_curr > 50 THEN 1 ELSE 0 END
    + CASE WHEN cc < -1 AND ic > 0.5 THEN -2 ELSE 0 END + CASE WHEN fc < -1 THEN -2 ELSE 0 END
    + CASE WHEN ic > 1 THEN 1 ELSE 0 END AS score,
    concat_ws(', ', CASE WHEN cc > 1 AND ic < -0.5 THEN '🟢 Corp Acc' END, CASE WHEN fc > 1 THEN '🟢 Foreign In' END,
      CASE WHEN corp_curr + fund_curr + fin_curr > 50 THEN '💎 Inst Dom' END, CASE WHEN cc < -1 AND ic > 0.5 THEN '🔴 Corp Dist' END,
      CASE WHEN fc < -1 THEN '🔴 Foreign Out' END, CASE WHEN ic > 1 THEN '🟡 Insider Buy' END) AS signals,
    abs(cc) >= 0.1 OR abs(fc) >= 0.1 OR abs(ic) >= 0.1 AS moved
  FROM diff
)"""

ROW = ["date", "share_code", "investor_name", "load_seq"]
ROWS = ", ".join(ROW)

# ---- views --------------------------------------------------------------------

add(
    "win_lag_holder",
    lambda s, sf: H.with_previous(H.recent_individuals(A.ownership(s, sf))).select(*ROW, "prev_percentage", "prev_shares"),
    f"WITH {OWN},{LAGS} SELECT {ROWS}, prev_percentage, prev_shares FROM lagged",
    ["date"],
)
add(
    "view_individual_changes",
    lambda s, sf: H.individual_changes(A.ownership(s, sf)),
    f"WITH {OWN},{LAGS},{CHANGES} SELECT * FROM changes",
    ["report_date"],
)
add(
    "sort_expr_desc",
    lambda s, sf: H.individual_changes(A.ownership(s, sf)).orderBy(
        F.abs(F.col("curr_percentage") - F.col("prev_percentage")).desc(), "share_code", "investor_name", "report_date", "share_change"),
    f"""WITH {OWN},{LAGS},{CHANGES} SELECT * FROM changes
ORDER BY abs(curr_percentage - prev_percentage) DESC, share_code, investor_name, report_date, share_change""",
    ["report_date"],
)
add(
    "filt_abs_threshold",
    lambda s, sf: H.with_previous(A.ownership(s, sf))
    .filter(F.abs(F.col("percentage") - F.col("prev_percentage")) >= 0.3).select(*ROW, "percentage", "prev_percentage"),
    f"""WITH {OWN}, l AS (SELECT *, lag(percentage) OVER (PARTITION BY share_code, investor_name ORDER BY date, load_seq) AS prev_percentage FROM own)
SELECT {ROWS}, percentage, prev_percentage FROM l WHERE prev_percentage IS NOT NULL AND abs(percentage - prev_percentage) >= 0.3""",
    ["date"],
)
add(
    "fn_change_label",
    lambda s, sf: H.with_previous(A.ownership(s, sf)).select(
        *ROW, rules.trade_action(F.col("total_holding_shares") - F.coalesce("prev_shares", "total_holding_shares")).alias("action"),
        rules.alert_level(F.col("percentage") - F.coalesce("prev_percentage", "percentage")).alias("alert_level")),
    f"""WITH {OWN}, l AS (SELECT *, lag(percentage) OVER w AS pp, lag(total_holding_shares) OVER w AS ps FROM own
  WINDOW w AS (PARTITION BY share_code, investor_name ORDER BY date, load_seq))
SELECT {ROWS}, CASE WHEN total_holding_shares > ps THEN 'BUYING' WHEN total_holding_shares < ps THEN 'SELLING' ELSE 'HOLDING' END AS action,
  CASE WHEN abs(percentage - pp) >= 2 THEN 'HIGH' WHEN abs(percentage - pp) >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level FROM l""",
    ["date"],
)
add(
    "fn_round",
    lambda s, sf: A.ownership(s, sf).select(*ROW, F.round("percentage", 4).alias("pct4"), F.round(F.col("total_holding_shares") / 7, 2).alias("sevenths")),
    f"WITH {OWN} SELECT {ROWS}, round(percentage, 4) AS pct4, round(total_holding_shares / 7, 2) AS sevenths FROM own",
    ["date"],
)
add(
    "join_left_composite",
    lambda s, sf: H.current_and_previous(A.ownership(s, sf)).select("share_code", "investor_name", "curr_rows", "prev_rows", "corp_curr", "foreign_prev", "ind_curr", "ind_prev"),
    f"""WITH {OWN},{TOTALS}
SELECT share_code, investor_name, count(DISTINCT curr_row) AS curr_rows, count(DISTINCT prev_row) AS prev_rows,
  sum(CASE WHEN investor_type = 'Corporate' THEN curr_pct ELSE 0 END) AS corp_curr,
  sum(CASE WHEN local_foreign = 'F' THEN prev_pct ELSE 0 END) AS foreign_prev,
  sum(CASE WHEN investor_type = 'Individual' THEN curr_pct ELSE 0 END) AS ind_curr,
  sum(CASE WHEN investor_type = 'Individual' THEN prev_pct ELSE 0 END) AS ind_prev
FROM pairs GROUP BY share_code, investor_name""",
)
add("agg_category_pivot", lambda s, sf: H.group_totals(A.ownership(s, sf)), f"WITH {OWN},{AGG} SELECT * FROM agg")
add(
    "view_insider_screener",
    lambda s, sf: H.insider_screener(A.ownership(s, sf)).orderBy(F.col("score").desc(), "code"),
    f"WITH {OWN},{SCREEN} SELECT * EXCLUDE (moved) FROM scored WHERE moved ORDER BY score DESC, code",
)


def _flags(df):
    change = {g: F.col(f"{g}_curr") - F.col(f"{g}_prev") for g in H.COMPARED}
    return ScreenerFlags(change["corp"], change["foreign"], change["ind"], F.col("corp_curr") + F.col("fund_curr") + F.col("fin_curr"))


add(
    "fn_score",
    lambda s, sf: (lambda t: t.select(F.col("share_code").alias("code"), _flags(t).score().alias("score")))(H.group_totals(A.ownership(s, sf))),
    f"WITH {OWN},{SCREEN} SELECT code, score FROM scored",
)
add(
    "fn_signal_text",
    lambda s, sf: (lambda t: t.select(F.col("share_code").alias("code"), _flags(t).labels().alias("signals")))(H.group_totals(A.ownership(s, sf))),
    f"WITH {OWN},{SCREEN} SELECT code, signals FROM scored",
)
add(
    "join_cross_scalar",
    lambda s, sf: (lambda t: t.filter(F.col("date") == latest(t, "date")).select(*ROW, "percentage"))(A.ownership(s, sf)),
    f"WITH {OWN} SELECT {ROWS}, percentage FROM own CROSS JOIN (SELECT max(date) AS m FROM own) WHERE date = m",
    ["date"],
)
add(
    "join_scalar_subquery",
    lambda s, sf: (lambda t: t.filter(F.col("date") == previous_date(t, "date")).select(*ROW, "percentage"))(A.ownership(s, sf)),
    f"WITH {OWN} SELECT {ROWS}, percentage FROM own WHERE date = (SELECT max(date) FROM own WHERE date < (SELECT max(date) FROM own))",
    ["date"],
)
add(
    "win_previous_snapshot",
    lambda s, sf: (lambda t: t.agg(F.max("date").alias("curr_date")).select("curr_date", previous_date(t, "date").alias("prev_date")))(A.ownership(s, sf)),
    f"WITH {OWN} SELECT max(date) AS curr_date, (SELECT max(date) FROM own WHERE date < (SELECT max(date) FROM own)) AS prev_date FROM own",
    ["curr_date", "prev_date"],
)
add(
    "filt_in_list",
    lambda s, sf: A.ownership(s, sf).filter(F.col("investor_type").isin(*INDIVIDUAL)).select(*ROW, "investor_type"),
    f"WITH {OWN} SELECT {ROWS}, investor_type FROM own WHERE investor_type IN ('ID', 'Individual')",
    ["date"],
)
add(
    "proj_exclude",
    lambda s, sf: A.ownership(s, sf).withColumn("date", F.col("date").cast("date")).drop("load_seq", "data_source"),
    f"WITH {OWN} SELECT CAST(date AS DATE) AS date, * EXCLUDE (date, load_seq, data_source) FROM own",
    ["date"],
)
add(
    "agg_count_distinct",
    lambda s, sf: A.ownership(s, sf).agg(F.count_distinct("date").alias("dates"), F.count_distinct("share_code").alias("codes"), F.count(F.lit(1)).alias("n")),
    f"WITH {OWN} SELECT count(DISTINCT date) AS dates, count(DISTINCT share_code) AS codes, count(*) AS n FROM own",
)

# ---- raw cells ----------------------------------------------------------------

# What the heading detection must find, per file.
SHEETS = OWN + """,
layouts AS (SELECT DISTINCT snap, CASE WHEN year(snap) = 1997 THEN 'C' WHEN month(snap) % 2 = 1 THEN 'A' ELSE 'B' END AS layout FROM placed),
raw AS (
  SELECT own.*, layout, snap, 'holders_' || strftime(snap, '%Y%m%d') || '.xlsx' AS file_name, p.c_nationkey, p.o_totalprice
  FROM placed p JOIN own ON own.load_seq = p.o_orderkey JOIN layouts USING (snap)
),
grouped AS (
  SELECT *, format('{:,}', holdings_scripless) AS t1, format('{:,}', holdings_scrip) AS t2, format('{:,}', total_holding_shares) AS t3,
         CAST(percentage AS VARCHAR) AS pt FROM raw
),
lists AS (
  SELECT 'holders_' || strftime(snap, '%Y%m%d') AS data_source,
    CASE WHEN layout = 'B' THEN strftime(snap, '%d/%m/%Y') ELSE strftime(snap, '%Y-%m-%d') END AS date,
    share_code,
    CASE WHEN layout = 'C' THEN '' ELSE issuer_name END AS issuer_name, investor_name,
    CASE WHEN layout = 'C' THEN '' ELSE CASE domicile WHEN 'MACHINERY' THEN 'cp' WHEN 'BUILDING' THEN 'ID' WHEN 'AUTOMOBILE' THEN 'Mutual Funds'
      WHEN 'HOUSEHOLD' THEN ' Individual' ELSE 'zz' END END AS investor_type,
    CASE WHEN layout = 'C' THEN '' ELSE ['A', 'Asing', 'l', '', 'X'][1 + c_nationkey % 5] END AS local_foreign,
    CASE WHEN layout = 'C' THEN '' ELSE nationality END AS nationality, CASE WHEN layout = 'C' THEN '' ELSE domicile END AS domicile,
    CASE WHEN layout = 'C' THEN '0' WHEN load_seq % 2 = 0 THEN t1 ELSE replace(t1, ',', '.') END AS holdings_scripless,
    CASE WHEN layout = 'C' THEN '0' WHEN load_seq % 2 = 0 THEN t2 ELSE replace(t2, ',', '.') END AS holdings_scrip,
    CASE WHEN load_seq % 2 = 0 THEN t3 ELSE replace(t3, ',', '.') END AS total_holding_shares,
    CASE load_seq % 3 WHEN 0 THEN pt WHEN 1 THEN replace(pt, '.', ',') ELSE pt || ' %' END AS percentage, load_seq
  FROM grouped WHERE c_nationkey <> 7
)"""

add(
    "proj_header_detect",
    lambda s, sf: H.detect_headings(A.holder_sheets(s, sf)).select("file_name", "row_idx", "heading_row", F.array_join("heading", "|").alias("heading")),
    f"""WITH {SHEETS} SELECT file_name, load_seq + 10 AS row_idx, CAST(CASE WHEN layout = 'B' THEN 3 ELSE 0 END AS BIGINT) AS heading_row,
  CASE layout WHEN 'A' THEN 'DATE|SHARE_CODE|ISSUER_NAME|INVESTOR_NAME|INVESTOR_TYPE|LOCAL_FOREIGN|NATIONALITY|DOMICILE|HOLDINGS_SCRIPLESS|HOLDINGS_SCRIP|TOTAL_HOLDING_SHARES|PERCENTAGE'
    WHEN 'B' THEN 'SHARE_CODE|INVESTOR_NAME|DATE|INVESTOR_TYPE|LOCAL_FOREIGN|NATIONALITY|DOMICILE|TOTAL_HOLDING_SHARES|HOLDINGS_SCRIP|HOLDINGS_SCRIPLESS|ISSUER_NAME|PERCENTAGE'
    ELSE 'DATE|SHARE_CODE|INVESTOR_NAME|TOTAL_HOLDING_SHARES|PERCENTAGE' END AS heading FROM raw""",
)
add(
    "proj_align_defaults",
    lambda s, sf: H.align(A.holder_sheets(s, sf)).drop("plain_heading"),
    f"WITH {SHEETS} SELECT data_source, date, share_code, * EXCLUDE (data_source, date, share_code) FROM lists",
)
add(
    "filt_all_null",
    lambda s, sf: A.holder_sheets(s, sf).filter(frames.any_cell(F.col("cells"))).groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.min("row_idx").alias("first_row"), F.sum("row_idx").alias("row_sum")),
    f"""WITH {SHEETS} SELECT file_name, count(*) + CASE WHEN any_value(layout) = 'B' THEN 3 ELSE 1 END AS n, CAST(0 AS BIGINT) AS first_row,
  CAST(sum(load_seq + 10) + CASE WHEN any_value(layout) = 'B' THEN 5 ELSE 0 END AS BIGINT) AS row_sum FROM raw GROUP BY file_name""",
)
add(
    "filt_code_regex",
    lambda s, sf: (lambda t: t.filter(H.valid_code(F.col("code"))))(
        A.holder_sheets(s, sf).select(
            "file_name", "row_idx", F.upper(text.strip(F.element_at("cells", 2))).alias("code"))),
    f"""WITH {SHEETS}, codes AS (SELECT file_name, load_seq + 10 AS row_idx, CASE WHEN layout = 'B' THEN upper(investor_name)
  WHEN c_nationkey = 7 THEN 'TOO-LONG-7' ELSE share_code END AS code FROM raw)
SELECT * FROM codes WHERE regexp_full_match(code, '[A-Z0-9-]{{4,6}}')""",
)
add(
    "pipe_ownership_1pct",
    lambda s, sf: H.ownership(A.holder_sheets(s, sf)).select(*H.TABLE),
    f"""WITH {SHEETS} SELECT data_source, date, share_code, CASE WHEN layout = 'C' THEN '' ELSE replace(issuer_name, chr(10), ' ') END AS issuer_name, investor_name,
  CASE WHEN layout = 'C' THEN 'Others' ELSE CASE domicile WHEN 'MACHINERY' THEN 'Corporate' WHEN 'AUTOMOBILE' THEN 'Fund Manager'
    WHEN 'FURNITURE' THEN 'ZZ' ELSE 'Individual' END END AS investor_type,
  CASE WHEN layout = 'C' THEN 'L' ELSE ['F', 'F', 'L', 'L', 'X'][1 + c_nationkey % 5] END AS local_foreign,
  CASE WHEN layout = 'C' THEN '' ELSE nationality END AS nationality, CASE WHEN layout = 'C' THEN '' ELSE domicile END AS domicile,
  CASE WHEN layout = 'C' THEN 0 ELSE holdings_scripless END AS holdings_scripless, CASE WHEN layout = 'C' THEN 0 ELSE holdings_scrip END AS holdings_scrip,
  total_holding_shares, percentage FROM raw WHERE c_nationkey <> 7""",
    ["date"],
)
add(
    "fn_map_values",
    lambda s, sf: A.placed(s, sf).select(
        "o_orderkey", text.map_values(text.strip(A.pick(F.col("c_mktsegment"), A.SEGMENT_TYPES)), schemas.INVESTOR_TYPES).alias("investor_type"),
        text.map_values(A.pick(F.col("c_nationkey") % 5, dict(enumerate(A.ORIGINS))), schemas.LOCAL_FOREIGN).alias("local_foreign")),
    f"""WITH {PLACED} SELECT o_orderkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Corporate' WHEN 'AUTOMOBILE' THEN 'Fund Manager' WHEN 'FURNITURE' THEN 'ZZ' ELSE 'Individual' END AS investor_type,
  ['F', 'F', 'L', 'L', 'X'][1 + c_nationkey % 5] AS local_foreign FROM placed""",
)
add(
    "fn_text_clean",
    lambda s, sf: A.holder_sheets(s, sf).select(
        "row_idx", text.stem(F.col("file_name")).alias("data_source"), text.strip(text.one_line(F.concat_ws("\n", F.lit(" "), F.element_at("cells", 3)))).alias("third")),
    f"""WITH {SHEETS} SELECT load_seq + 10 AS row_idx, 'holders_' || strftime(snap, '%Y%m%d') AS data_source,
  CASE layout WHEN 'A' THEN replace(issuer_name, chr(10), ' ') WHEN 'B' THEN strftime(snap, '%d/%m/%Y') ELSE investor_name END AS third FROM raw
UNION ALL SELECT 0, 'holders_' || strftime(snap, '%Y%m%d'), CASE layout WHEN 'A' THEN 'ISSUER_NAME' WHEN 'B' THEN '' ELSE 'INVESTOR_NAME' END FROM layouts
UNION ALL SELECT r, 'holders_' || strftime(snap, '%Y%m%d'), CASE WHEN r = 3 THEN 'Date' ELSE '' END FROM layouts, range(1, 4) AS t(r) WHERE layout = 'B'""",
)
