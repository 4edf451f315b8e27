"""Date-range runs of the daily tasks, as single set-based Spark jobs.

The original driver loops over calendar days, skips non-trading days and runs a
task with (T2, T1) = the two previous trading days, one Spark job chain per day.
For the merge / check / exception tasks every day is independent, so the whole
range is one job: the operators already work on all days at once and the range
only selects which T1 partitions are produced.  Positions and lots depend on the
previous day; their operators fold the whole range in one pass themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.calendar import calendar_fits, day_side, trading_days
from ledgerfold.keys import BOOKS
from ledgerfold.operators.account import account_check
from ledgerfold.operators.cashflow import merge_cash_flow
from ledgerfold.operators.exceptions import exception_detail, exception_stat
from ledgerfold.sources.tables import read_days

MAX_LITERAL_DAYS = 400  # days named in a filter; longer ranges are bounded by literals and semi-joined

TASKS = ("merge", "check", "check_exception_detail", "check_exception_stat")


def run_days(calendar: DataFrame, start: str, end: str) -> DataFrame:
    """(busi_date, t1_date, t2_date) for every trading day in [start, end] that has a T2."""
    return trading_days(calendar, start, end)


def backfill(task: str, tables, start: str, end: str, literal_days: int = MAX_LITERAL_DAYS) -> DataFrame:
    """Every partition (busi_date = T1) that running ``task`` for each day of [start, end] would write.

    Every input is read on the days of the range only: up to ``literal_days`` days are named in the filters; a longer range gives
    the scans its first and last day as literals, and the calendar's days between them prune partitions at run time (semi-join)."""
    if task not in TASKS:
        raise ValueError(f"no task {task!r}; one of {', '.join(TASKS)}")
    fits = calendar_fits(tables.trading_day)
    days = trading_days(tables.trading_day, start, end, fits).select("t1_date", "t2_date")
    few = days.limit(literal_days + 1).collect() if fits else []
    if 0 < len(few) <= literal_days:
        # the days as literals, so that every scan prunes to their partitions
        t1s, ends = sorted({r.t1_date for r in few}), sorted({d for r in few for d in r})
        on_t1 = lambda df: read_days(df, t1s)
        at_ends = lambda df: read_days(df, ends)
    else:
        # at most one row per trading day each
        bounds = days.agg(F.min("t2_date").alias("lo"), F.min("t1_date").alias("lo1"), F.max("t1_date").alias("hi")).first()
        t1 = day_side(days.select(F.col("t1_date").alias("busi_date")).distinct(), fits)
        both = day_side(days.select(F.explode(F.array("t1_date", "t2_date")).alias("busi_date")).distinct(), fits)
        inside = lambda df, lo, on: df.where(F.col("busi_date").between(lo, bounds["hi"])).join(on, "busi_date", "left_semi").select(*df.columns)
        on_t1 = lambda df: inside(df, bounds["lo1"], t1)
        at_ends = lambda df: inside(df, bounds["lo"], both)
    detail = on_t1(tables.cash_flow_detail)
    if task == "merge":
        return merge_cash_flow(detail)
    merged = merge_cash_flow(detail, with_names=False)  # the check reads codes, not names
    check = on_t1(account_check(merged, at_ends(tables.stock_asset_holding), at_ends(tables.stock_debt_holding),
                                tables.stock_return_rate_range, tables.trading_day, books=BOOKS))
    if task == "check":
        return check
    if task == "check_exception_detail":
        return exception_detail(check)
    return exception_stat(check)
