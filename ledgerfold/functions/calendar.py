"""Trading-calendar functions over ``trading_day(busi_date, rlt_rank)``.

The calendar stays a DataFrame with one row per trading day (about 250 rows a
year).  Joins with it are broadcast only after a checked size bound
(``calendar_fits``: one bounded count); beyond the bound they are left to the
planner's shuffle joins.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _check_date(s: str) -> str:
    try:
        datetime.strptime(s, "%Y-%m-%d")
    except ValueError as exc:
        raise ValueError(f"not a yyyy-MM-dd date: {s!r}") from exc
    return s


MAX_BROADCAST_DAYS = 100_000  # about 400 years of trading days


def calendar_fits(calendar: DataFrame, limit: int = MAX_BROADCAST_DAYS) -> bool:
    """The checked size bound: True when the calendar has at most ``limit`` rows (one small job)."""
    return calendar.limit(limit + 1).count() <= limit


def day_side(df: DataFrame, fits: bool) -> DataFrame:
    """Broadcast a calendar-sized side when the calendar passed the size check; otherwise leave
    the join strategy to the planner (AQE may still broadcast what it measures to be small)."""
    return F.broadcast(df) if fits else df


def day_shift(calendar: DataFrame, k: int, name: str = "shifted_date", fits: bool | None = None) -> DataFrame:
    """(busi_date, shifted_date): the trading day ``k`` ranks away; days without one are absent."""
    fits = calendar_fits(calendar) if fits is None else fits
    a = calendar.select("busi_date", "rlt_rank")
    b = calendar.select(F.col("busi_date").alias(name), (F.col("rlt_rank") - k).alias("rlt_rank"))
    return a.join(day_side(b, fits), "rlt_rank").select("busi_date", name)


def shift_trading_day(dates: DataFrame, calendar: DataFrame, k: int, date_col: str = "busi_date",
                      out_col: str = "shifted_date", fits: bool | None = None) -> DataFrame:
    """Attach the trading day ``k`` ranks from ``date_col``; NULL when outside the calendar."""
    fits = calendar_fits(calendar) if fits is None else fits
    m = day_shift(calendar, k, out_col, fits).withColumnRenamed("busi_date", date_col)
    return dates.join(day_side(m, fits), date_col, "left")


def trading_days(calendar: DataFrame, start: str, end: str, fits: bool | None = None) -> DataFrame:
    """Every calendar day start..end that is a trading day, with its T1 / T2 (previous two trading days).

    Days whose T1 or T2 falls before the calendar are dropped (no job runs for them).
    """
    _check_date(start)
    _check_date(end)
    if end < start:
        raise ValueError(f"the range ends ({end}) before it starts ({start})")
    span = calendar.sparkSession.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("d")
    ).select(F.date_format("d", "yyyy-MM-dd").alias("busi_date"))
    fits = calendar_fits(calendar) if fits is None else fits
    days = span.join(day_side(calendar.select("busi_date"), fits), "busi_date", "left_semi")
    t1 = day_shift(calendar, -1, "t1_date", fits)
    t2 = day_shift(calendar, -2, "t2_date", fits)
    return days.join(day_side(t1, fits), "busi_date").join(day_side(t2, fits), "busi_date")


def roll_bounds(calendar: DataFrame, seed_date: str, until: str | None = None) -> tuple[int, int]:
    """(rank of ``seed_date``, rank of the last day to produce) in one small job."""
    last = F.col("rlt_rank") if until is None else F.when(F.col("busi_date") <= until, F.col("rlt_rank"))
    r = calendar.agg(F.max(F.when(F.col("busi_date") == seed_date, F.col("rlt_rank"))).alias("s"),
                     F.max(last).alias("m")).first()
    if r["s"] is None:
        raise ValueError(f"seed date {seed_date} is not a trading day")
    return int(r["s"]), int(r["m"])


def previous_day(calendar: DataFrame, fits: bool | None = None) -> DataFrame:
    """(busi_date, prev_date) for every trading day that has a previous one."""
    return day_shift(calendar, -1, "prev_date", fits)
