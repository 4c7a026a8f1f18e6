"""Monthly balances: typed rows, de-duplication, month-over-month wide table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bourseline import schemas
from bourseline.functions import dates, numbers, rules
from bourseline.operators import windows
from bourseline.operators.frames import require_columns, with_date

KEYS = ["Code", "Date"]



def typed(text: DataFrame) -> DataFrame:
    """Equity rows with a readable date; missing or bad numbers are 0."""
    require_columns(text, schemas.MONTHLY_REQUIRED)
    counts = ["Sec_Num", "Total_Local", "Total_Foreign", *schemas.POSITIONS]
    zero = F.lit(0).cast("bigint")

    def whole(c: str) -> Column:
        return F.coalesce(numbers.to_long(F.replace(F.col(c), F.lit(","), F.lit(""))), zero).alias(c)

    equity = with_date(text.filter(F.col("Type") == "EQUITY"), "Date", dates.monthly_date(F.col("Date")))
    price = F.coalesce(numbers.comma_number(F.col("Price")), F.lit(0.0))
    return equity.withColumns({c: whole(c) for c in counts} | {"Price": price})


def total(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in cols])


def unreconciled(df: DataFrame) -> DataFrame:
    """How often the nine positions and their total differ by more than 1."""
    local = F.count_if(F.abs(total(schemas.LOCALS) - F.col("Total_Local")) > 1)
    foreign = F.count_if(F.abs(total(schemas.FOREIGNS) - F.col("Total_Foreign")) > 1)
    return df.agg((local + foreign).alias("bad_rows"))


def deduplicate(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Last loaded row per (code, date)."""
    return windows.keep_last(df, KEYS, order_by)


def compared(df: DataFrame) -> DataFrame:
    """Each month beside the code's month before: `before` (share count and positions, null for
    the first), the split flags, and `moves`, the change of every position in table order.

    After de-duplication a code has one row per month, so a window is bounded by the calendar.
    """
    held = F.array(*schemas.POSITIONS)
    month = F.struct(F.col("Sec_Num").alias("shares"), held.alias("held"))
    df = df.withColumn("before", F.lag(month).over(W.partitionBy("Code").orderBy("Date")))
    split, reverse = (rule(F.col("Sec_Num"), F.col("before.shares")) for rule in (rules.is_split, rules.is_reverse))
    df = df.withColumns({"is_split_suspect": split, "is_reverse_suspect": reverse})
    adjusted = F.col("is_split_suspect") | F.col("is_reverse_suspect")
    known = F.coalesce("before.held", F.array_repeat(F.lit(None).cast("bigint"), len(schemas.POSITIONS)))
    return df.withColumn("moves", F.zip_with(held, known, lambda now, old: rules.position_delta(now, old, adjusted)))


def extreme(largest: bool) -> tuple[Column, Column, Column]:
    """Category, change and value of the row's largest or smallest move; the first category wins ties."""
    change = F.array_max("moves") if largest else F.array_min("moves")
    category = F.element_at(F.array(*[F.lit(p) for p in schemas.POSITIONS]), F.array_position("moves", change).cast("int"))
    return category, change.cast("double"), (change * F.col("Price")).cast("double")


def top_movers() -> list[Column]:
    """The buyer of the month, if any position grew, and its seller, if any shrank."""
    sides = {"buyer": extreme(True), "seller": extreme(False)}
    moved = {"buyer": sides["buyer"][1] > 0, "seller": sides["seller"][1] < 0}
    named = [(f"top_{who}{suffix}", who, part) for suffix, part in (("", 0), ("_vol", 1), ("_val", 2)) for who in sides]
    return [F.when(moved[who], sides[who][part]).alias(name) for name, who, part in named]


def wide(df: DataFrame) -> DataFrame:
    """The 88 published columns, lower-case."""
    places = list(enumerate(schemas.POSITIONS))
    zero = F.lit(0).cast("bigint")
    out = {c.lower(): F.col(c) for c in ("Date", "Code", "Type", "Sec_Num", "Price")}
    for side, sum_of_side in ((schemas.LOCALS, "Total_Local"), (schemas.FOREIGNS, "Total_Foreign")):
        out |= {c.lower(): F.col(c) for c in (*side, sum_of_side)}
    out |= {f"{p}_1".lower(): F.coalesce(F.get("before.held", F.lit(i)), zero) for i, p in places}
    out |= {"total_shares": total(schemas.POSITIONS), "is_split_suspect": F.col("is_split_suspect"), "is_reverse_suspect": F.col("is_reverse_suspect")}
    movers = top_movers()
    changes = {}
    for i, p in places:
        move = F.get("moves", F.lit(i))
        changes |= {f"{p}_chg_vol".lower(): move, f"{p}_chg_val".lower(): move * F.col("Price")}
    return df.select(*[c.alias(n) for n, c in out.items()], *movers, *[c.alias(n) for n, c in changes.items()])


def snapshot(raw: DataFrame, order_by: list[str]) -> DataFrame:
    """Typed rows of all files in, the monthly snapshot table out."""
    return wide(compared(deduplicate(raw, order_by)))


def change_report(table: DataFrame) -> DataFrame:
    moved = (F.col("local_id_chg_val") != 0) | (F.col("foreign_cp_chg_val") != 0)
    return table.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(moved).alias("rows_with_chg"),
        F.count_if(F.col("is_split_suspect")).alias("split_months"),
        F.count_if(F.col("is_reverse_suspect")).alias("reverse_months"),
        F.count_if(F.col("top_buyer").isNotNull()).alias("rows_with_top_buyer"),
    )


def require_changes(report: DataFrame) -> DataFrame:
    """Pass the one-row report on, or fail the job when nothing changed anywhere."""
    failed = F.raise_error(F.lit("the monthly snapshot holds no change at all"))
    return report.withColumn("rows_with_chg", F.when(F.col("rows_with_chg") > 0, F.col("rows_with_chg")).otherwise(failed.cast("bigint")))


def duplicate_report(raw: DataFrame) -> DataFrame:
    """Input rows, rows removed as copies, distinct months and codes."""
    per_key = raw.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").alias("n_rows"),
        (F.sum("_n") - F.count(F.lit(1))).alias("removed"),
        F.count_distinct("Date").alias("months"),
        F.count_distinct("Code").alias("codes"),
    )
